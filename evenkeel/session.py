"""Session settings, shared folder, and the one place where small results are
brought through the driver."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows and bytes a table may have at most to be copied to every executor.
SMALL_ROWS = 200_000
SMALL_BYTES = 64 * 1024 * 1024


def get_session(app: str = "evenkeel", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and a fixed time zone.

    Sizes (shuffle partitions, memory, split size) are left to the cluster
    unless the caller passes them.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new path under the folder every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. A temporary
    folder of this machine is taken only where the setting is absent, as in
    local tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="evenkeel-")
    return f"{root.rstrip('/')}/evenkeel/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to reliable storage and read it from there afterwards.

    Survives the loss of executors, unlike a local checkpoint or cache. With
    ``partition_by``, a filter on that column reads only its own files.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "stage")
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal a scan out over all cores if its files give fewer tasks than that.

    A file written as one row group is read by one task, however costly the work
    on its rows is. A scan that fills the cluster comes back as it was, without
    a shuffle. Meant for a plain scan: other plans would be run to be counted.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def small_side(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Compute ``df`` once, and mark it for broadcast if it turns out small.

    The stored rows are counted, none of them is fetched. With more of them than
    ``max_rows`` the joins that use the frame choose by its size, as any other.
    """
    stored = cut_lineage(df)
    return F.broadcast(stored) if stored.count() <= max_rows else stored


def count_by_label(df: DataFrame, label: str, max_labels: int = 10_000) -> dict:
    """Rows per label as a plain dict, for sizing decisions.

    One row per label reaches the driver; labels come from a fixed taxonomy, so
    more than ``max_labels`` of them means the wrong column was named.
    """
    rows = (
        df.where(F.col(label).isNotNull())
        .groupBy(label)
        .count()
        .limit(max_labels + 1)
        .collect()
    )
    if len(rows) > max_labels:
        raise ValueError(f"column {label} has more than {max_labels} values")
    return {r[0]: r[1] for r in sorted(rows, key=lambda r: r[0])}
