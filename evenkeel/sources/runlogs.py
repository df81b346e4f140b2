"""Run logs: append, overwrite, nested summaries, and logs with ragged rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The layouts found in shared run logs, by number of fields.
EPOCH_LOG_LAYOUTS = {
    21: (
        "Timestamp", "Model Name", "Model Key", "epoch", "train_loss", "train_acc", "val_loss",
        "val_f1_macro", "val_f1_weighted", "Max Length", "Batch Size", "Total Epochs",
        "Learning Rate", "Weight Decay", "Early Stopping Patience", "Use Augmented",
        "Resampling Enabled", "Undersample Target", "Oversample Minimum", "Device", "Num GPUs",
    ),
    14: (
        "Timestamp", "Model Name", "Model Key", "epoch", "train_loss", "train_acc", "val_loss",
        "val_f1_macro", "val_f1_weighted", "Max Length", "Batch Size", "Learning Rate",
        "LORA_R", "Device",
    ),
    13: (
        "Timestamp", "Model Name", "Model Key", "epoch", "train_loss", "train_acc", "val_loss",
        "val_f1_macro", "val_f1_weighted", "Max Length", "Batch Size", "Learning Rate", "Device",
    ),
}
RESULT_LAYOUTS = {
    11: (
        "timestamp", "model_name", "epochs", "batch_size", "learning_rate", "max_length",
        "val_f1_macro", "test_f1_macro", "test_accuracy", "test_precision_macro", "test_recall_macro",
    ),
    12: (
        "timestamp", "model_key", "model_name", "epochs", "batch_size", "learning_rate", "max_length",
        "val_f1_macro", "test_f1_macro", "test_accuracy", "test_precision_macro", "test_recall_macro",
    ),
    14: (
        "timestamp", "model_key", "model_name", "epochs", "batch_size", "learning_rate", "max_length",
        "val_f1_macro", "val_precision_macro", "val_recall_macro", "test_f1_macro",
        "test_precision_macro", "test_recall_macro", "test_accuracy",
    ),
}
MISSING = "N/A"


def append_log(df: DataFrame, path: str) -> None:
    """Append rows to a log; columns are matched by name, and brought to the types that the log has already.

    A value that does not fit the type of its column fails the job.
    """
    try:
        known = {field.name: field.dataType for field in read_log(df.sparkSession, path).schema}
    except AnalysisException as err:
        if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        known = {}
    df = df.select(*[F.col(f"`{c}`").cast(known[c]).alias(c) if c in known else F.col(f"`{c}`") for c in df.columns])
    df.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Read a log whose parts may hold different columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def overwrite_log(df: DataFrame, path: str) -> None:
    """Replace a comparison table or an epoch log."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_ragged_log(spark: SparkSession, path: str, layouts: Mapping[int, Sequence[str]]) -> DataFrame:
    """Read a log whose rows follow several layouts under one header.

    The layout of a row is the one with its number of fields. Columns of the
    other layouts are null, and so are fields that say ``N/A``. Rows of an
    unknown width fail the job, because nothing could be said about them.
    """
    names = list(dict.fromkeys(name for layout in layouts.values() for name in layout))
    header_starts = {layout[0] for layout in layouts.values()}
    widest = max(layouts)
    line = F.col("value")
    cells = spark.read.text(path).where(F.trim(line) != "").select(
        F.from_csv(
            line,
            ", ".join(f"c{i} string" for i in range(widest + 1)),
            {"quote": '"', "escape": '"', "mode": "PERMISSIVE"},
        ).alias("cell"),
        # commas outside quotes separate the fields
        (F.size(F.split(F.regexp_replace(line, '"(?:[^"]|"")*"', ""), ",", -1))).alias("width"),
    )
    rows = cells.where(~F.coalesce(F.col("cell.c0"), F.lit("")).isin(*header_starts))

    def field(name: str):
        known = [(width, layout.index(name)) for width, layout in layouts.items() if name in layout]
        (width, at), *rest = known
        value = F.when(F.col("width") == width, F.col(f"cell.c{at}"))
        for width, at in rest:
            value = value.when(F.col("width") == width, F.col(f"cell.c{at}"))
        return F.when(value != MISSING, value).alias(name)

    checked = F.when(
        F.col("width").isin(*layouts), F.col("width")
    ).otherwise(F.raise_error(F.concat(F.lit("no layout with this many fields: "), F.col("width"))).cast("int"))
    return rows.select(checked.alias("n_fields"), *[field(name) for name in names])


def summary_table(
    comparison: DataFrame,
    config: Mapping[str, object],
    device: str = "cpu",
    gpus: int = 0,
    model: str = "Model",
    metric: str = "F1 (Macro)",
) -> DataFrame:
    """One nested row about a run: the models, the best one, its settings."""
    best = F.struct(F.col(metric), F.col(model))
    return comparison.agg(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.lit(device).alias("device"),
        F.lit(gpus).alias("gpus"),
        F.sort_array(F.collect_list(model)).alias("models_trained"),
        F.max_by(model, best).alias("best_model"),
        F.max(metric).alias("best_f1_macro"),
        F.struct(*[F.lit(value).alias(name) for name, value in config.items()]).alias("config"),
    )


def write_summary(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
