import collections
import random
import re

import pytest

from evenkeel.llm import linededup


def brute(rows, similarity=0.8):
    """Removed positions by id, from all earlier lines of each line."""
    lines = []
    for doc, text in sorted(rows, key=lambda r: r[0]):
        for pos, line in enumerate((text or "").split("\n")):
            words = re.findall(r"[^\x20\x09-\x0D]+", line)
            if words:
                grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or [tuple(words)]
                lines.append((doc, pos, frozenset(grams)))
    index, removed, compared = collections.defaultdict(list), collections.defaultdict(list), collections.Counter()
    for k, (doc, pos, grams) in enumerate(lines):
        compared[doc] += 1
        shared = collections.Counter(j for g in grams for j in index[g])
        if any(5 * n >= 4 * (len(grams) + len(lines[j][2]) - n) for j, n in shared.items()):
            removed[doc].append(pos)
        for g in grams:
            index[g].append(k)
    return {d: (compared[d], removed[d]) for d in compared}


def found(docs, **settings):
    return {r.doc_id: (r.compared, r.removed) for r in linededup.repeated_lines(docs, **settings).collect()}


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("buckets", [2, 1 << 16])
def test_variants_in_large_groups(spark, buckets):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4)))
    rows, bases = [], [[word() for _ in range(rng.randint(4, 70))] for _ in range(12)]
    for i in range(260):
        lines = []
        for _ in range(rng.randint(0, 4)):
            line = list(rng.choice(bases))
            for _ in range(rng.choice((0, 0, 1, 1, 2, 4))):
                line[rng.randrange(len(line))] = word()
            if rng.random() < 0.2:
                line += [word() for _ in range(rng.randint(1, 12))]
            lines.append(rng.choice((" ", "  ", "\t")).join(line))
        rows.append((i, "\n".join(lines)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert found(docs, buckets=buckets) == brute(rows)


def test_line_dedup_keeps_the_rest(spark):
    same = "one two three four five six seven"
    rows = [(1, f"a\n{same}\nb"), (2, same), (3, f"{same}\nshort line\n\n"), (4, "short line"), (5, "")]
    got = linededup.line_dedup(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r.doc_id: r.text for r in got.collect()} == {1: rows[0][1], 3: "short line\n\n", 5: ""}


def test_one_large_group(spark):
    """Hundreds of lines share tokens; many are similar to none of the first ones, so several rounds are needed."""
    rng = random.Random(5)
    core = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(150):
        line = list(core)
        for _ in range(rng.choice((1, 3, 5, 8))):
            line[rng.randrange(40)] = f"x{rng.randrange(10**6)}"
        rows.append((rng.randrange(10**6), " ".join(line + ["tail"] * rng.choice((0, 1)))))
    rows += [(10**7 + i, "a b c d") for i in range(50)] + [(10**8, None), (10**8 + 1, "a  b\tc d"), (10**8 + 2, "\n \n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    want = brute(rows)
    assert found(docs) == want and 0 < sum(bool(r) for _, r in want.values()) < 190


def test_pairs_stay_linear(spark, monkeypatch):
    """A thousand variants of one line: pairs that are verified grow with the lines, not with their square."""
    rng, seen = random.Random(6), []
    core = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(1000):
        line = list(core)
        line[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(line)))
    verified = linededup._verified
    monkeypatch.setattr(linededup, "_verified", lambda pairs, *rest: (seen.append(pairs.count()), verified(pairs, *rest))[1])
    got = found(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert all(r == [0] for i, (_, r) in got.items() if i) and sum(seen) < 5000
