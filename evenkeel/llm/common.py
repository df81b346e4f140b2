"""What the corpus operators share: reliable cuts, seeded draws, and the words of a text."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids that are sent to every executor at most when documents are left out (some 16 bytes each); more go by a shuffle.
FEW_IDS = 2_000_000
#: ASCII white space; a word is a longest run of anything else.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of an Arrow batch on its way to Python; a longer row goes by itself. Spark's own bound is 64 MB.
BATCH_BYTES = 4 << 20
_UNITS = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the folder that ``spark.checkpoint.dir`` names; where none is set, as in tests, take a temporary one.

    A session on a cluster without the setting fails here, before any work is done.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="evenkeel-llm-")
    context.setCheckpointDir(folder)


@contextmanager
def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> Iterator[None]:
    """Jobs that run inside hand texts to Python in batches of ``most`` bytes at most, which changes no result.

    Buffers of both sides grow with the largest batch and are kept. A lower bound that the session sets stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    size = re.fullmatch(r"(\d+)([bkmg]?)b?", before.strip().lower())
    if size and int(size[1]) * _UNITS[size[2] or "b"] <= most:
        yield
        return
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into reliable shared storage and go on from there.

    A lost executor loses nothing of it. Where the session sets
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` the files go when the frame does.
    """
    ensure_checkpoint_dir(df.sparkSession)
    with small_batches(df.sparkSession):
        return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: compressed, read column by column, and safe from lost executors."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    place = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(place)
    return spark.read.schema(df.schema).parquet(place)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, id_col: str, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is not in the one column of ``gone``, with their own columns; null ids stay."""
    name = fresh(docs, "gone")
    ids = settle(gone.toDF(name).where(F.col(name).isNotNull()).distinct())
    if ids.count() <= FEW_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, F.col(id_col) == F.col(name), "left_anti")


def uniform(key: Column, seed: str) -> Column:
    """A draw in [0, 1) that depends on the key and the seed alone: the first 52 bits of an md5."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def words(text: Column) -> Column:
    """The words of a text in order; an empty array for a null text."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def worker_cache(owner: str) -> dict:
    """A dictionary that lives as long as the Python worker, for what is costly to load and the same in every task.

    It holds what one operator keeps: a worker that goes on to the next one lets go of it.
    """
    held = sys.modules.setdefault("evenkeel_worker_cache", SimpleNamespace(owner=owner, kept={}))
    if held.owner != owner:
        held.owner, held.kept = owner, {}
    return held.kept


def oddly_spaced(text: Column) -> Column:
    """Whether a text's lines hold white space other than single spaces between words."""
    odd = text.startswith(" ") | text.endswith(" ")
    for found in ("  ", " \n", "\n ", "\t", "\x0b", "\x0c", "\r"):
        odd = odd | text.contains(found)
    return odd


def line_words(line: Column, odd: Column) -> Column:
    """The words of a line; cut at single spaces, some six times as fast as by pattern, where its text is not ``odd``."""
    return F.when(odd, words(line)).otherwise(F.split(line, " "))
