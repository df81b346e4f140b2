"""Fill-in-middle against string slicing."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from evenkeel.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
PIECES = ["a", "é", "漢", " ", "\n", "b", "<", "P", ">", "<S>", "  ", "x y ", " ", "\x1c"]


def plain_version(text, draws):
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or draws[2] % 100 >= 50:
        return n, "plain", None, None, text
    out = f"<S>{suf}<P>{pre}<M>{mid}" if draws[3] % 100 < 80 else f"<P>{pre}<S>{suf}<M>{mid}"
    return n, "spm" if draws[3] % 100 < 80 else "psm", len(pre), len(mid), out


def of_id(doc_id, text):
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return plain_version(text or "", [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)])


texts = st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), max_size=6)


@settings(max_examples=150, deadline=None)
@given(texts, st.randoms(use_true_random=False), st.sampled_from([3, 7, 1 << 20]))
def test_scatter_and_gather(some, random, tile):
    before, fim.TILE = fim.TILE, tile
    try:
        encoded = [t.encode() for t in some]
        bounds = np.concatenate(([0], np.cumsum([len(e) for e in encoded]))).astype(np.int64)
        draws = np.array([[random.randrange(1 << 32) for _ in range(4)] for _ in some], np.int64).reshape(-1, 4)
        buffer = np.frombuffer(b"".join(encoded), np.uint8)
        done = fim.transform(buffer, bounds, draws, 50, 80)
        back, back_bounds = fim.restore(done["output"], done["bounds"], done["form"])
    finally:
        fim.TILE = before
    for i, text in enumerate(some):
        n, form, pre, mid, out = plain_version(text, draws[i].tolist())
        assert (done["n"][i], fim.FORMS[done["form"][i]]) == (n, form)
        assert done["output"][done["bounds"][i] : done["bounds"][i + 1]].tobytes().decode() == out
        assert back[back_bounds[i] : back_bounds[i + 1]].tobytes().decode() == text
        if form != "plain":
            assert (done["prefix_chars"][i], done["middle_chars"][i]) == (pre, mid)


@pytest.mark.parametrize("group", [1 << 22, 64])
def test_documents(spark, group, monkeypatch):
    monkeypatch.setattr(fim, "GROUP", group)
    rows = [(i, "".join(PIECES[(i * 7 + j * j) % len(PIECES)] for j in range(i % 23))) for i in range(200)]
    rows += [(None, "without an id"), (None, None), (7, None), (8, ""), (8, "again the same id"), (9, "long text of words " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = [tuple(r) for r in fim.restored(fim.fill_in_middle(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored").collect()]
    want = [(i, *of_id(i, t), t or "") for i, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {r[2] for r in got} == set(fim.FORMS)


def test_rates(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "'one two three four' AS text")
    assert {r.form for r in fim.fill_in_middle(docs, rate=0).collect()} == {"plain"}
    assert {r.form for r in fim.fill_in_middle(docs, rate=100, suffix_first=0).collect()} == {"psm"}
