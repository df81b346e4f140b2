import random
import re

import pytest

from evenkeel.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def passes(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    return {
        "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in hit.split(".")),
        "card": lambda: 14 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 10 <= len(digits) <= 15,
    }[kind]()


def plain(text):
    spans = [
        (m.start(), rank, m.end()) for rank, (kind, pattern) in enumerate(PLAIN.items())
        for m in re.finditer(pattern, text or "") if passes(kind, m.group())
    ]
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def base(df):
    found = pii.personal_data(df).select("doc_id", pii.listed(pii.F.col("base")).alias("base"))
    return {r.doc_id: r.base for r in found.collect()}


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = {r.doc_id: plain(r.text) for r in docs.collect()}
    assert any(want.values()) and base(docs) == want


def test_odd_texts(spark):
    rng = random.Random(2)
    texts = [
        "a@b.c_d@e.f", "a@b..c", "a@b.c.@d.e", "x@y", "1.2.3.4.5.6.7.8", "001.2.003.4 256.1.1.1 1.1.1.0255", "4111 1111 1111 1111",
        "4111-1111 -1111 1111 1", "+1 (212) 555-0100) +12", "++1234567890", "é😀 me@x.org 😀 1.2.3.4", "a" * 200_000, "1" * 100_000,
        "a@b" + ".c" * 50_000, "+1" + "(" * 50_000, "1.2.3.4 " * 700, None, "", "4" * 16 + " " + "0" * 15,
    ]
    texts += ["".join(rng.choice("01245+@. -()ab\n😀") for _ in range(300)) for _ in range(120)]
    rows = list(enumerate(texts))
    assert base(spark.createDataFrame(rows, "doc_id bigint, text string")) == {i: plain(t) for i, t in rows}


def test_reliabilities_are_learned():
    """Votes made by labelers of known reliability: each is found again to a few hundredths."""
    rng, rows = random.Random(4), {}
    right = {"strict": 0.9, "valid": 0.85, "gazetteer": 0.7, "cue": 0.8, "against": 0.95}
    for _ in range(20_000):
        true = rng.random() < 0.4
        votes = tuple(int(true == (rng.random() < right[c])) for c in pii.LABELERS)
        rows[votes] = rows.get(votes, 0) + 1
    table = [{"kind": "phone", **dict(zip(pii.LABELERS, v)), "shape": 20, "n": n} for v, n in rows.items()]
    model = pii.fit(table, anchored=False)
    for c in pii.LABELERS:
        assert model.reliability["phone"][c] == pytest.approx((right[c], right[c]), abs=0.04)
    weights = model.weights["phone"]
    assert all(weights[c] > 0 for c in pii.LABELERS) and weights["against"] > weights["gazetteer"]
    assert pii.fit([]).weights == {}


def test_classifier_adds_spans(spark):
    rows = [(i, f"call our office phone ann{i}@example.org tel +49 30 {1000000 + i} today") for i in range(60)]
    rows += [(100 + i, f"contact mail: ann{i} at example dot org") for i in range(20)]
    rows += [(200, "nothing to see")]
    got = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(got[0].base) == 2 and len(got[0].spans) >= 2 and got[200].spans == []
    assert all(set(map(tuple, r.base)) <= set(map(tuple, r.spans)) for r in got.values())
    assert got[100].base == [] and [s.rank for s in got[100].spans] == [0]


def test_long_text_with_many_hits(spark):
    """A megabyte of hits of all sorts, spelled-out ones included; work that grew with their square would not end."""
    part = "mail bob@example.org or ann at example dot org now, 10.1.2.3 and 4111 1111 1111 1111, call +1 212 555 0100. "
    text = part * 10_000
    found = pii.personal_data(spark.createDataFrame([(1, text), (2, part)], "doc_id bigint, text string")).select(
        "doc_id", pii.listed(pii.F.col("base")).alias("base"), pii.F.size("spans").alias("n"))
    got = {r.doc_id: r for r in found.collect()}
    assert got[1].base == plain(text) and got[2].base == plain(part)
    assert got[1].n == 10_000 * got[2].n


def test_spans_that_meet_a_base_span(spark):
    rng = random.Random(9)

    def spans(n, width):
        at, out = 0, []
        for _ in range(n):
            at += rng.randint(0, width)
            out.append((at, at + rng.randint(1, width)))
            at = out[-1][1]
        return out

    rows = []
    for i in range(60):
        n = rng.choice((0, 1, 5, 700))
        rows.append((i, spans(n, 9), spans(rng.choice((0, n, 3)), 12) + spans(rng.choice((0, 2, n)), 30)))
    kind = "array<struct<start:bigint,end:bigint>>"
    df = spark.createDataFrame(rows, f"i int, wide {kind}, base {kind}")
    got = {r.i: [tuple(s) for s in r.free] for r in df.select("i", pii._clear_of(pii.F.col("wide"), pii.F.col("base")).alias("free")).collect()}
    assert got == {i: [s for s in w if not any(s[0] < b[1] and b[0] < s[1] for b in base)] for i, w, base in rows}
