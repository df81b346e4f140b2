"""Load, check, clean, balance and weigh a training set."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions.labels import strict_label
from evenkeel.functions.text import normalize_text
from evenkeel.operators.joins import join_labels
from evenkeel.operators.metrics import class_distribution, class_weights, profile_inputs
from evenkeel.operators.sampling import SEED, balance_classes
from evenkeel.session import cut_lineage


def clean_messages(df: DataFrame, lower: bool = False) -> DataFrame:
    return df.withColumn("message", normalize_text(F.col("message"), lower))


@dataclass
class Prepared:
    train: DataFrame
    val: DataFrame
    test: DataFrame
    weights: DataFrame


def prepare(
    train: tuple[DataFrame, DataFrame],
    val: tuple[DataFrame, DataFrame],
    test: DataFrame,
    resample: bool = False,
    majority=0,
    target: int = 2000,
    minimum: int = 2000,
    seed: int = SEED,
) -> Prepared:
    """Join texts with labels, clean, check labels, rebalance, weigh.

    Rebalancing sees ids and labels only; the texts are joined to the rows that
    were taken. The result is stored once, because weights, training and counts
    all read it.
    """
    text, labels = train
    if resample:
        # ids may repeat: a row is known by its id and its text, and equal rows are joined as one
        marked = text.withColumn("_row", F.xxhash64("message"))
        keys = cut_lineage(strict_label(join_labels(marked.select("index", "_row"), labels)).select("index", "_row", "label"))
        taken = balance_classes(keys, "index", "label", majority, target, minimum, seed).drop("draw")
        texts = marked.dropDuplicates(["index", "_row"])
        rows = cut_lineage(clean_messages(texts.join(taken, ["index", "_row"]).drop("_row")))
    else:
        rows = strict_label(clean_messages(join_labels(text, labels)))
    return Prepared(
        train=rows,
        val=strict_label(clean_messages(join_labels(*val))),
        test=clean_messages(test),
        weights=class_weights(rows),
    )


def check_dataset(
    spark: SparkSession, readers: Mapping[str, "callable"], text: str, labels: str
) -> tuple[DataFrame, DataFrame | None]:
    """Which inputs can be read, and the class distribution of the training set.

    The second part is None if an input is missing.
    """
    report = profile_inputs(spark, readers)
    if report.where(~F.col("readable")).take(1):
        return report, None
    return report, class_distribution(join_labels(readers[text](), readers[labels]()))
