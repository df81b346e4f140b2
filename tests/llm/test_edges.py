"""Nulls, empty and long texts, repeated rows, ties, empty tables and clashing column names, for every operator and stage."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from evenkeel.llm import (
    fim, html, linededup, mixing, neighbours, packing, pii, quality, runs, sharding, simhash, toxicity, vectordedup,
)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "far away one reads of rivers " * 4000
ROWS = [
    (1, "one two three four five six", "en", "a", 27),
    (2, "one two three four five six", "en", "a", 27),
    (2, "one two three four five six", "en", "a", 27),
    (3, "", "en", None, 0),
    (4, None, None, "b", None),
    (5, " \t\r\n", "de", "a", 4),
    (None, "a row without an id stands here alone", "en", "a", 37),
    (6, LONG, "fr", "a", len(LONG)),
    (7, "mail ann@example.org or +49 (030) 123-4567\nmail ann@example.org or +49 (030) 123-4567", "en", "c", 85),
]
CLASHES = (
    "fp root node a b u v m p s q t side least_id component_id least placed score predicted held_out body label_id toxic word pos neg"
    " stem exact fuzzy size grp draw shard bucket linked members place rank vec id dim kept weight probability topic n_tokens ratio"
    " wanted host rule rate failed found hashes lined n lines h g token tokens prefix first x y at part ids start base email ip card"
    " phone spans main path pages times vector html url page __gone __of __removed __left runs collapsed form output restored prefix_chars middle_chars c links other label tiles"
).split()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0), (6, 0), (7, 1), (7, 0), (None, 1), (3, None)], "doc_id bigint, toxic int")


OPERATORS = {
    "simhash": lambda d, lab: simhash.near_duplicates(d),
    "neighbours": lambda d, lab: neighbours.nearest(_vectors(d), _vectors(d)),
    "linededup": lambda d, lab: linededup.repeated_lines(d).withColumn("removed", F.array_join("removed", ",")),
    "mixing": lambda d, lab: mixing.mix(d).withColumn("probability", F.round("probability", 9)).withColumn("weight", F.round("weight", 9)),
    "pii": lambda d, lab: pii.personal_data(d).select("doc_id", pii.listed(F.col("base")).alias("b"), pii.listed(F.col("spans")).alias("s")),
    "html": lambda d, lab: html.main_text(d, "doc_id", "source", "text"),
    "toxicity": lambda d, lab: toxicity.toxicity(d, lab).withColumn("score", F.round("score", 9)),
    "sharding": lambda d, lab: sharding.balanced_shards(d).drop("shard", "slot"),
    "quality": lambda d, lab: quality.host_quality(d).withColumn("host_rate", F.round("host_rate", 9)),
    "vectordedup": lambda d, lab: vectordedup.near_duplicates(_vectors(d), label_col="lang"),
    "fim": lambda d, lab: fim.restored(fim.fill_in_middle(d)),
    "runs": lambda d, lab: runs.periodic_runs(d, rewrite=runs.planted).withColumn("runs", F.to_json("runs")),
    "packing": lambda d, lab: packing.pack(d).groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("all")),
}


def _vectors(docs):
    """Each id with a short vector; some are null, zero, or hold what cannot be compared."""
    n = F.length("text").cast("double")
    vec = F.when(F.col("doc_id") == 4, None).when(F.col("doc_id") == 5, F.array(F.lit(0.0), F.lit(0.0))).when(
        F.col("doc_id") == 3, F.array(F.lit(float("nan")), F.lit(1.0))).otherwise(F.array(n, F.lit(2.0)))
    extra = [c for c in docs.columns if c not in ("doc_id", "embedding")]
    return docs.select(F.col("doc_id").alias("vec_id"), vec.alias("embedding"), *extra)


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("name", OPERATORS)
def test_edges(docs, labels, name):
    plain = rows(OPERATORS[name](docs, labels))
    assert plain
    wide = docs.select("*", *[F.lit("x").alias(c) for c in CLASHES if c not in docs.columns])
    assert rows(OPERATORS[name](wide.repartition(2), labels.withColumn("quality", F.lit(1)))) == plain


@pytest.mark.parametrize("name", OPERATORS)
def test_empty(docs, labels, name):
    assert rows(OPERATORS[name](docs.limit(0), labels)) == []


def test_one_row_each(docs, labels):
    for name in ("simhash", "mixing", "pii", "html", "toxicity", "sharding", "quality", "fim", "runs", "vectordedup"):
        key = {"html": "page_id", "vectordedup": "vec_id"}.get(name, "doc_id")
        got = sorted((r[key] for r in OPERATORS[name](docs, labels).collect()), key=repr)
        assert got == sorted((r[0] for r in ROWS), key=repr), name


def test_no_labels(docs, labels):
    scores = {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()}
    assert len(scores) == 1 and 0 < scores.pop() < 0.5


@pytest.mark.parametrize("which", range(5))
def test_stages(spark, docs, tmp_path, labels, which):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    name, stage = corpus_pipeline.STAGES[which]
    wide = docs.select("*", *[F.lit("x").alias(c) for c in CLASHES if c not in docs.columns])
    for d in (docs, wide, docs.limit(0)):
        out = stage(spark, d, str(tmp_path))
        got = out.collect()
        if which < 4:
            assert out.columns == d.columns
            ids = [r["doc_id"] for r in got]
            assert None in ids or d.count() == 0
    if name == "line_dedup":
        texts = {r["doc_id"]: r["text"] for r in stage(spark, docs, str(tmp_path)).collect()}
        assert texts[1] == ROWS[0][1] and 2 not in texts and texts[3] == "" and texts[4] is None and texts[5] == ROWS[5][1]
        assert texts[7] == ROWS[8][1].split("\n")[0]
