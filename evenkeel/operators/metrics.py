"""Class counts and weights, confusion counts, and every metric made from them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evenkeel.functions.labels import LABEL_NAMES, label_name
from evenkeel.functions.vectors import argmax
from evenkeel.operators.running import running_by_chunk
from evenkeel.session import small_side


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def class_distribution(
    df: DataFrame,
    label: str = "label",
    names: Mapping[int, str] | None = LABEL_NAMES,
    all_labels: Iterable[int] | None = None,
) -> DataFrame:
    """Count, percent and name per class; rows without a label are not counted.

    ``all_labels`` adds the classes without rows, with a count of zero.
    """
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("count"))
    if all_labels is not None:
        zero = df.sparkSession.createDataFrame([(int(v), 0) for v in all_labels], f"{label} int, count bigint")
        counts = counts.unionByName(zero).groupBy(label).agg(F.sum("count").alias("count"))
    # one row per class is left at this point
    whole = Window.partitionBy(F.lit(0))
    out = counts.withColumn("percent", _ratio(F.col("count") * 100.0, F.sum("count").over(whole)))
    return out if names is None else out.withColumn("name", label_name(F.col(label), names))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight per class present: rows / (classes * rows of the class)."""
    whole = Window.partitionBy(F.lit(0))
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("count"))
    return counts.select(
        label,
        "count",
        (F.sum("count").over(whole) / (F.count("*").over(whole) * F.col("count"))).alias("weight"),
    )


def weights_map(df: DataFrame, label: str = "label") -> dict[int, float]:
    """Balanced weights as a dict keyed by label."""
    return {r[label]: r["weight"] for r in small_side(class_weights(df, label)).collect()}


def with_sample_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Put the balanced weight of its class on every row."""
    weights = small_side(class_weights(df, label).select(label, F.col("weight").alias(out)))
    return df.join(weights, label, "left")


def split_counts(splits: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per named split."""
    tagged = [d.select(F.lit(name).alias("split")) for name, d in splits.items()]
    out = tagged[0]
    for d in tagged[1:]:
        out = out.unionAll(d)
    return out.groupBy("split").agg(F.count("*").alias("rows"))


def profile_inputs(spark: SparkSession, readers: Mapping[str, "callable"]) -> DataFrame:
    """One row per input: could it be read, how many rows, else what went wrong.

    ``readers`` maps a name to a function that gives back the DataFrame, so that
    a missing file becomes a row of the report and does not end it.
    """
    rows = []
    for name, read in readers.items():
        try:
            rows.append((name, True, read().count(), None))
        except Exception as err:  # the report is about what cannot be read
            rows.append((name, False, None, str(err).splitlines()[0]))
    return spark.createDataFrame(rows, "input string, readable boolean, rows bigint, error string")


def confusion(df: DataFrame, y_true: str = "label", y_pred: str = "prediction") -> DataFrame:
    """Rows per (true class, predicted class): the single pass over the data."""
    return df.groupBy(F.col(y_true).alias("y_true"), F.col(y_pred).alias("y_pred")).agg(F.count("*").alias("n"))


def per_class(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class, from confusion counts.

    Classes are those that occur as a true or as a predicted class. A row without
    a prediction is a miss of its class and of no other; one without a true
    class is left out.
    """
    hit = F.col("y_true") == F.col("y_pred")
    zero = F.lit(0).cast("bigint")
    shares = F.when(
        hit, F.array(F.struct(F.col("y_true").alias("c"), F.col("n").alias("tp"), zero.alias("fp"), zero.alias("fn")))
    ).otherwise(
        F.array(
            F.struct(F.col("y_true").alias("c"), zero.alias("tp"), zero.alias("fp"), F.col("n").alias("fn")),
            F.struct(F.col("y_pred").alias("c"), zero.alias("tp"), F.col("n").alias("fp"), zero.alias("fn")),
        )
    )
    sums = (
        counts.where(F.col("y_true").isNotNull())
        .select(*by, F.explode(shares).alias("s"))
        .where(F.col("s.c").isNotNull())
        .groupBy(*by, F.col("s.c").alias("class"))
        .agg(F.sum("s.tp").alias("tp"), F.sum("s.fp").alias("fp"), F.sum("s.fn").alias("fn"))
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return sums.select(
        *by,
        "class",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2.0 * tp, 2.0 * tp + fp + fn).alias("f1"),
        (tp + fn).alias("support"),
        tp.alias("hits"),
    )


def score_counts(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Accuracy and averaged scores from confusion counts, per group if asked."""
    support = F.col("support")

    def weighted(col: str) -> Column:
        return F.sum(F.col(col) * support) / F.sum(support)

    return per_class(counts, by).groupBy(*by).agg(
        (F.sum("hits") / F.sum(support)).alias("accuracy"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        weighted("f1").alias("f1_weighted"),
        F.sum(support).alias("rows"),
    )


def score(df: DataFrame, y_true: str = "label", y_pred: str = "prediction", by: tuple[str, ...] = ()) -> DataFrame:
    """Accuracy, macro precision / recall / F1 and weighted F1."""
    if not by:
        return score_counts(confusion(df, y_true, y_pred))
    counts = df.groupBy(*by, F.col(y_true).alias("y_true"), F.col(y_pred).alias("y_pred")).agg(
        F.count("*").alias("n")
    )
    return score_counts(counts, by)


def classification_report(
    df: DataFrame,
    y_true: str = "label",
    y_pred: str = "prediction",
    names: Mapping[int, str] | None = None,
) -> DataFrame:
    """Per-class rows, then accuracy, macro and weighted averages.

    The averages are formed from the class rows, of which there are as many as
    there are classes, so the data is read once.
    """
    rows = per_class(confusion(df, y_true, y_pred))
    title = F.col("class").cast("string") if names is None else label_name(F.col("class"), names)
    entry = F.struct(title.alias("row"), "precision", "recall", "f1", "support")
    s = F.col("support")

    def average(row: str, agg) -> Column:
        return F.struct(
            F.lit(row).alias("row"),
            agg("precision").alias("precision"),
            agg("recall").alias("recall"),
            agg("f1").alias("f1"),
            F.sum(s).alias("support"),
        )

    acc = F.sum("hits") / F.sum(s)
    return rows.agg(
        F.collect_list(entry).alias("classes"),
        average("accuracy", lambda c: acc).alias("accuracy"),
        average("macro avg", lambda c: F.avg(c)).alias("macro"),
        average("weighted avg", lambda c: F.sum(F.col(c) * s) / F.sum(s)).alias("weighted"),
    ).select(F.inline(F.concat("classes", F.array("accuracy", "macro", "weighted"))))


def metric_callback(df: DataFrame, logits: str = "logits", label: str = "label") -> DataFrame:
    """Accuracy and macro scores from a column of logits."""
    scored = df.select(F.col(label).alias("label"), argmax(F.col(logits)).alias("prediction"))
    return score(scored).select("accuracy", "f1_macro", "precision_macro", "recall_macro")


def cv_summary(df: DataFrame, metric: str = "f1_macro") -> DataFrame:
    """Mean and population standard deviation of the scores of the folds."""
    return df.agg(
        F.count(metric).alias("folds"), F.avg(metric).alias("mean"), F.stddev_pop(metric).alias("std")
    )


def similarity_summary(df: DataFrame, label: str = "label", sim: str = "sim_score") -> DataFrame:
    """Rows and highest, lowest and mean similarity per class; null is overall."""
    return df.rollup(label).agg(
        F.count("*").alias("rows"),
        F.max(sim).alias("max_sim"),
        F.min(sim).alias("min_sim"),
        F.avg(sim).alias("mean_sim"),
    )


def soft_vote(df: DataFrame, key: str, probs: str = "probs", n_classes: int | None = None) -> DataFrame:
    """Mean probability vector over the folds that scored a key.

    One average per class, so that rows are reduced before the one shuffle.
    """
    if n_classes is None:
        first = df.select(F.size(probs)).head()
        n_classes = first[0] if first else 0
    means = [F.avg(F.get(probs, F.lit(i))).alias(f"_p{i}") for i in range(n_classes)]
    voted = df.groupBy(key).agg(F.count("*").alias("_n"), *means)
    return voted.select(key, F.array(*[F.col(f"_p{i}") for i in range(n_classes)]).alias(probs))


def accuracy(df: DataFrame, y_true: str = "label", y_pred: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(y_true) == F.col(y_pred)).cast("double")).alias("accuracy"))


def weighted_mean_loss(df: DataFrame, loss: str, weight: str) -> DataFrame:
    """Mean of weighted losses: their sum over the sum of the weights."""
    return df.agg((F.sum(loss) / F.sum(weight)).alias("loss"))


def batch_mean_loss(df: DataFrame, loss: str = "loss", batch: str = "batch") -> DataFrame:
    """Mean over batches of the mean loss of each batch."""
    return df.groupBy(batch).agg(F.avg(loss).alias("l")).agg(
        F.avg("l").alias("loss"), F.count("*").alias("batches")
    )


def running_mean(
    df: DataFrame,
    group: str,
    order: str,
    loss: str,
    chunk: Column | None = None,
    out: str = "running_mean",
) -> DataFrame:
    """Mean of a value over the rows of its group up to and including this one."""
    result = running_by_chunk(
        df, [group], order, chunk, {"_sum": ("sum", F.col(loss)), "_n": ("count", F.col(loss))}
    )
    return result.withColumn(out, F.col("_sum").cast("double") / F.col("_n")).drop("_sum", "_n")
