"""Label taxonomy, category mapping, strict casts, ids."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The six classes, and how the four intent classes of an external
# chat corpus map onto them.
LABEL_NAMES = {
    0: "Non-toxic",
    1: "Insults and Flaming",
    2: "Other Offensive Texts",
    3: "Hate and Harassment",
    4: "Threats",
    5: "Extremism",
}
INTENT_LABELS = {"O": 0, "I": 1, "E": 2, "A": 3}


def lookup(col: Column, mapping: Mapping) -> Column:
    """Value of ``mapping`` for a column, null where the key is unknown."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), col)


def label_name(col: Column, names: Mapping[int, str] = LABEL_NAMES) -> Column:
    return F.coalesce(lookup(col.cast("int"), names), F.lit("Unknown"))


def map_labels(
    df: DataFrame, col: str, mapping: Mapping[str, int] = INTENT_LABELS, out: str = "label"
) -> DataFrame:
    """Keep rows whose category is in ``mapping`` and add its label."""
    return df.where(F.col(col).isin(*mapping)).withColumn(out, lookup(F.col(col), mapping))


def strict_label(df: DataFrame, label: str = "label") -> DataFrame:
    """Cast a label to int; a null or non-integer label fails the job."""
    number = F.col(label).cast("double")
    value = (
        F.when(number.isNull(), F.raise_error(F.lit(f"{label} is missing")).cast("int"))
        .when(number != F.floor(number), F.raise_error(F.lit(f"{label} is no integer")).cast("int"))
        .otherwise(number.cast("int"))
    )
    return df.withColumn(label, value)


def prefix_ids(df: DataFrame, prefix: str, id_col: str, out: str = "index") -> DataFrame:
    """Mark where a row came from in its id, so that ids of sources never meet."""
    return df.withColumn(out, F.concat(F.lit(prefix), F.col(id_col).cast("string")))
