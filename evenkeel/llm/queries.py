"""Named queries of the corpus operators: thin, with the columns their contracts name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm import (
    fim, html, linededup, mixing, neighbours, packing, pii, quality, runs, sharding, simhash, toxicity, vectordedup,
)
from evenkeel.llm.sql import SQL_FIM, SQL_LINES, SQL_MIXING, SQL_QUALITY, SQL_RUNS, SQL_VECTORS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), added=packing.added_tokens())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op9_host_quality", SQL_QUALITY)
def op9_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.host_quality(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op8_sharding")
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op5_pii")
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(_table(spark, sf_dir, "documents"))

    def count(rank: int):
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("bigint")

    return found.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"),
    )


@query("op4_mixing", SQL_MIXING)
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.withColumns({c: F.round(c, 9) for c in ("probability", "weight")})


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query("op6_html")
def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.main_text(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query("op2_neighbours")
def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"))


@query("op3_line_dedup", SQL_LINES)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = linededup.repeated_lines(docs)
    return found.select("doc_id", "compared", F.size("removed").cast("bigint").alias("n_removed"), F.array_join("removed", ",").alias("removed"))


@query("op11_vector_dedup", SQL_VECTORS)
def op11_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectordedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


@query("op12_fill_in_middle", SQL_FIM)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.restored(fim.fill_in_middle(_table(spark, sf_dir, "documents")))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


@query("op13_periodic_runs", SQL_RUNS)
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(_table(spark, sf_dir, "documents"), rewrite=runs.planted)
    # the greatest length, then the smallest start and period
    top = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat_ws("", F.transform(line, lambda x: F.concat(x, F.lit("\n"))))
    return found.select("doc_id", "runs", "collapsed", top.alias("top"), listed.alias("listed")).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("top.start")).alias("start"), "top.length",
        (-F.col("top.period")).alias("period"),
        F.floor(F.expr("1000 * top.length div -top.period")).cast("bigint").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
