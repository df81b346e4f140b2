"""Five stages from raw documents to packed sequences; each calls one corpus operator.

Every stage but the last gives back the columns of ``documents``. Stages handle null and empty texts, repeated rows,
empty tables and further columns as their operators say: a null or empty text is never toxic, has no lines to take out,
is linked with the other empty ones, counts no tokens in the mix, and is packed as its end id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm import linededup, mixing, packing, simhash, toxicity
from evenkeel.llm.common import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; the model learns from the labelled rows of ``docs``."""
    return toxicity.keep_clean(docs, _table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go from their texts, and documents that lose all their lines; n_chars follows."""
    left = linededup.line_dedup(docs)
    return left.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else left


def first_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by four bits or fewer, the one with the smallest id stays."""
    return simhash.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of cells that the target weights call too large are thinned out, those of too small ones repeated."""
    return mixing.repeat_mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The boundary records of the packed sequences, with the token ids."""
    return packing.pack(docs, added=packing.added_tokens())


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", dedup_lines),
    ("simhash", first_of_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learned lexicons, xxhash64 fingerprints and token ids are not SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other on ``documents``; what each one gives is written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, f"pipeline-{name}")
    return docs
