"""Registered queries: against their SQL twins, and the pipeline against its stages' plain versions."""

import hashlib
import math

import corpus_pipeline
import pytest
import sqlcheck
import test_linededup
import test_simhash
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from evenkeel.llm import mixing, toxicity
from evenkeel.llm.queries import QUERIES, SQL

COLUMNS = {
    "op1_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op2_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op5_pii": {"doc_id": "bigint", "n_email": "bigint", "base_sha256": "string", "spans": "string"},
    "op6_html": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op7_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op9_host_quality": {"doc_id": "bigint", "n_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op11_vector_dedup": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op12_fill_in_middle": {"doc_id": "bigint", "n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint", "output_sha256": "string", "restored_sha256": "string"},
    "op13_periodic_runs": {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"},
    "op10_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
}


def test_registered():
    names = entry_module.queries()
    assert {"pipeline", *QUERIES} <= set(names) and set(SQL) <= set(entry_module.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert sqlcheck.differences(QUERIES[name](spark, sf_dir), sqlcheck.connect(sf_dir), SQL[name]) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    types = dict(df.dtypes)
    assert {c: types.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    if name not in ("op2_neighbours", "op10_packing"):
        table = {"op6_html": "pages", "op11_vector_dedup": "embeddings"}.get(name, "documents")
        assert df.count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, sf_dir).cache()
    toxic = {r.doc_id for r in toxicity.toxicity(docs, labels).where("score >= 0.7").collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    assert {r.doc_id for r in clean.collect()} == rows.keys() - toxic

    left = stages["line_dedup"](spark, clean, sf_dir).cache()
    removed = test_linededup.brute([(i, rows[i].text) for i in rows.keys() - toxic])
    want = {}
    for i in rows.keys() - toxic:
        gone = set(removed.get(i, (0, []))[1])
        text = "\n".join(x for k, x in enumerate(rows[i].text.split("\n")) if k not in gone)
        if not gone or text.strip(" \t\n\x0b\x0c\r"):
            want[i] = text
    assert {r.doc_id: r.text for r in left.collect()} == want

    single = stages["simhash"](spark, left, sf_dir).cache()
    ids = sorted(want)
    group = test_simhash.plain_groups([test_simhash.plain_fingerprint(want[i]) for i in ids], ids)
    assert {r.doc_id for r in single.collect()} == {i for i, g in zip(ids, group) if i == g}

    mixed = stages["mixing"](spark, single, sf_dir).cache()
    assert {r.doc_id for r in mixed.collect()} == {r.doc_id for r in mixing.mix(single).where("kept").collect()}

    whole = corpus_pipeline.run(spark, sf_dir)
    packed = whole.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    kept_ids = {r.doc_id for r in mixed.collect()}
    # each id is there as often as its ratio says: the whole part, and one more by an md5 draw
    copies = {}
    for r in mixing.mix(single).collect():
        draw = int(hashlib.md5(f"mix|{r.doc_id}".encode()).hexdigest()[:13], 16) / (1 << 52)
        ratio = r.probability * r.weight
        copies[r.doc_id] = math.floor(ratio) + (draw < ratio - math.floor(ratio))
    assert kept_ids == {i for i, n in copies.items() if n}
    assert {r.doc_id: r.n for r in packed} == {r.doc_id: r.t * copies[r.doc_id] for r in packed}
    assert {r.doc_id for r in packed} == kept_ids
