import collections
import re

import corpus_pipeline
import pytest

from evenkeel.llm import mixing, quality


def test_raked_weights_meet_the_targets(spark):
    cells = [(s, g, t, 10 + 7 * i) for i, (s, g, t) in enumerate((s, g, t) for s in "abcd" for g in ("en", None) for t in "xy")]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens bigint")
    goals = {
        "source": {"a": 0.4, "b": 0.3, "c": 0.2, "d": 0.1}, "lang": {"en": 0.75, None: 0.25}, "topic": {"x": 0.5, "y": 0.5},
    }
    targets = {d: spark.createDataFrame(list(g.items()), "value string, share double") for d, g in goals.items()}
    rows = mixing.rake(df, targets, 20).collect()
    total = sum(c[3] for c in cells)
    for d, goal in goals.items():
        sums = collections.Counter()
        for r in rows:
            sums[r[d]] += r.weight
        assert {k: v / total for k, v in sums.items()} == pytest.approx(goal, abs=1e-6)


def test_weighted_sample_follows_the_targets(spark):
    rows = [(i, "word " * 20, "en", "big" if i % 4 else "small") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = mixing.mix(docs).collect()
    share = {s: sum(r.weight * r.n_tokens for r in got if r.kept and r.source == s) for s in ("big", "small")}
    natural = {"big": 0.75**0.7, "small": 0.25**0.7}
    assert share["big"] / sum(share.values()) == pytest.approx(natural["big"] / sum(natural.values()), abs=0.02)
    assert all(r.kept for r in got if r.source == "small")


def test_rows_of_the_stage_meet_the_targets(spark):
    texts = {"prose": "word " * 20, "contact": "mail +4 to " + "word " * 17, "table": "a | b " + "word " * 17}
    rows = [
        (i, texts["contact" if i % 20 == 0 else "table" if i % 25 == 1 else "prose"], "es" if i % 10 == 2 else "en", "ab"[i % 7 == 3])
        for i in range(8000)
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    out = corpus_pipeline.mix_sources(spark, docs, "")
    assert out.columns == docs.columns
    tokens = mixing.tagged(out, "doc_id", "text", "source", "lang").collect()
    natural = mixing.tagged(docs, "doc_id", "text", "source", "lang").collect()
    for d in mixing.DIMENSIONS:
        had, got = collections.Counter(), collections.Counter()
        for counter, found in ((had, natural), (got, tokens)):
            for r in found:
                counter[r[d]] += r.n_tokens
        goal = {k: v**0.7 for k, v in had.items()}
        for k, v in goal.items():
            assert got[k] / sum(got.values()) == pytest.approx(v / sum(goal.values()), abs=0.01), (d, k)
    kept = {r.doc_id for r in mixing.mix(docs).collect() if r.kept}
    assert {r.doc_id for r in out.collect()} == kept


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = collections.defaultdict(list)
    for i in range(len(words) - 2):
        at[tuple(words[i : i + 3])].append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def test_measures(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    odd = {10_000: "a a a a a", 10_001: "a b c a b c x a b", 10_002: "é 😀 <b> | #\n\né 😀 <b> | #", 10_003: "x y", 10_004: "w " * 30_000}
    df = spark.createDataFrame([(i, t, "s") for i, t in {**texts, **odd}.items()], "doc_id bigint, text string, source string")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = {r.doc_id: tuple(r[n] for n in names) for r in quality.host_quality(df).collect()}
    assert got == {i: plain_measures(t) for i, t in {**texts, **odd}.items()}


def test_bad_hosts_go(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good if i % 10 else "too short", "fine") for i in range(100)]
    rows += [(1000 + i, "too short" if i % 10 else good + f" x{i}", "bad") for i in range(100)]
    rows += [(2000, good, "tiny"), (2001, "too short", None), (2002, good, None)]
    got = {r.doc_id: r.kept for r in quality.host_quality(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert got[1] and got[2000] and not got[0]
    assert not any(got[1000 + i] for i in range(100))
