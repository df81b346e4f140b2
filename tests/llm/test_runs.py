"""Periodic runs against a search of all periods from all places."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from evenkeel.llm import runs
from evenkeel.llm.queries import QUERIES


def brute(words):
    n, out = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            shorter = (r for r in range(1, q) if all(words[k] == words[k + r] for k in range(i, i + length - r)))
            if length >= max(6, 4 * q) and next(shorter, None) is None:
                out.add((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def plant(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def made(rng):
    words = [rng.choice("abcdefgh"[: rng.choice([1, 2, 3, 5])]) for _ in range(rng.randrange(90))]
    if words and rng.random() < 0.7:
        a, p = rng.randrange(len(words)), rng.randrange(1, 14)
        words = words[:a] + [words[min(a + i % p, len(words) - 1)] for i in range(len(words) - a)]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(150):
        texts = [[w.encode() for w in made(rng)] for _ in range(rng.randrange(1, 5))]
        for words, (found, kept) in zip(texts, runs._group_runs(texts)):
            assert found == brute(words)
            assert kept == collapsed(words, found)


@pytest.mark.parametrize("size", [1, 2, 8, 64])
def test_squared_differences(size):
    rng = np.random.default_rng(size)
    blocks, windows = rng.integers(0, 50, (5, size)), rng.integers(0, 50, (5, 2 * size))
    got = runs.squared_differences(blocks.astype(np.uint64), windows.astype(np.uint64), runs.Transform(2 * size))
    want = [[((b - w[k : k + size]) ** 2).sum() for k in range(size)] for b, w in zip(blocks, windows)]
    assert (got == np.array(want) % runs.PRIME).all()


def test_long_texts():
    """Work that is quadratic in a run or in its repeats would not end here."""
    assert next(runs._group_runs([[b"a"] * 300_000])) == ([(0, 300_000, 1)], [b"a"])
    rng = random.Random(1)
    unit = [b"%d" % rng.randrange(300) for _ in range(20_000)]
    found, kept = next(runs._group_runs([unit * 5]))
    assert (0, 100_000, 20_000) in found and len(kept) <= 20_000
    nested = ([b"x"] * 50 + [b"y"]) * 1000
    found, kept = next(runs._group_runs([nested]))
    assert (0, 51_000, 51) in found and len(found) == 1001 and len(kept) <= 51


def test_planted():
    for doc_id in range(300):
        words = [b"%d" % (i * i % 97) for i in range(doc_id % 41)]
        assert runs.planted(words, doc_id) == plant(words, doc_id)


def test_query(spark, sf_dir):
    want = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        words = plant((r.text or "").encode().split(), r.doc_id)
        if len(words) > 1500:  # the plain search takes the cube of these
            continue
        found = brute(words)
        top = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None, None, None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        want[r.doc_id] = (
            len(found), *top, 1000 * top[1] // top[2] if found else None, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(b" ".join(collapsed(words, found))).hexdigest(),
        )
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_periodic_runs"](spark, sf_dir).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()}
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert {i: got[i] for i in want} == want and any(w[0] for w in want.values())


def test_ids_and_groups(spark, monkeypatch):
    monkeypatch.setattr(runs, "GROUP_WORDS", 40)
    rows = [(1, "a b " * 9), (1, "a b " * 9), (2, None), (3, ""), (None, "z " * 7), (4, " \t\r\n"), (5, "one two three"), (6, "q q " * 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(docs).collect())
    assert got == [
        (0, 7, [(0, 7, 1)], "z"), (1, 18, [(0, 18, 2)], "a b"), (1, 18, [(0, 18, 2)], "a b"), (2, 0, [], ""), (3, 0, [], ""),
        (4, 0, [], ""), (5, 3, [], "one two three"), (6, 8, [(0, 8, 1)], "q q"),
    ]
