"""Text, label and prediction tables as delimited files."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.operators.joins import join_labels, union_sources
from evenkeel.session import cut_lineage

TEXT = T.StructType([T.StructField("index", T.StringType()), T.StructField("message", T.StringType())])
LABEL = T.StructType([T.StructField("index", T.StringType()), T.StructField("label", T.IntegerType())])


# Headers that are read side by side.
HEADERS_AT_ONCE = 16


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    sep: str = ",",
    na_values: Sequence[str] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Read delimited files with a header line each.

    ``schema`` names the wanted columns with their types; they are found by name
    in each file's own header, whatever their order there, and other columns of
    the file are not parsed. A file without a wanted column, or a value that does
    not fit its type, fails. ``na_values`` lists texts that stand for null.

    Quoted messages may hold line breaks, so a file is read whole by one task.
    Pass ``multi_line=False`` where messages are known to be single lines, and
    large files are then split.
    """
    wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
    )

    def value(field: T.StructField):
        text = F.col(f"`{field.name}`")
        if na_values:
            text = F.when(~text.isin(list(na_values)), text)
        return text.cast(field.dataType).alias(field.name)

    groups = _by_header(spark, reader, path if isinstance(path, str) else list(path))
    return union_sources(*[reader.csv(group).select(*[value(f) for f in wanted.fields]) for group in groups])


def _by_header(spark: SparkSession, reader, path: str | list[str]) -> list[str | list[str]]:
    """The files of a path, those with one header together; only the header of each file is read."""
    files = [unquote(name) for name in reader.csv(path).inputFiles()]
    if len(files) < 2:
        return [path]
    with ThreadPool(min(len(files), HEADERS_AT_ONCE)) as pool:
        headers = pool.map(inheritable_thread_target(spark)(lambda name: tuple(reader.csv(name).columns)), files)
    groups: dict[tuple, list[str]] = {}
    for name, header in zip(files, headers):
        groups.setdefault(header, []).append(name)
    return list(groups.values()) if len(groups) > 1 else [path]


def load_labeled(
    spark: SparkSession, text_path: str, label_path: str | None = None, **options
) -> DataFrame:
    """Texts with labels where a label file is there, else the texts alone.

    Callers test for ``"label" in df.columns``.
    """
    text = read_table(spark, text_path, TEXT, **options)
    if label_path is None:
        return text
    try:
        labels = read_table(spark, label_path, LABEL, **options)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return text
        raise
    return join_labels(text, labels)


def write_table(df: DataFrame, path: str, sep: str = ",", compression: str | None = None) -> None:
    """Write delimited files that :func:`read_table` gives back unchanged, but for empty texts, which come back null."""
    writer = (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)


def write_text_label(
    df: DataFrame, directory: str, names: tuple[str, str] = ("train_index_text.csv", "train_index_label.csv")
) -> tuple[str, str]:
    """Write one table as a text part and a label part, both from the same stored rows."""
    text_path, label_path = (f"{directory.rstrip('/')}/{name}" for name in names)
    rows = cut_lineage(df.select("index", "message", "label"))
    write_table(rows.select("index", "message"), text_path)
    write_table(rows.select("index", "label"), label_path)
    return text_path, label_path


def by_index(df: DataFrame, index: str = "index") -> DataFrame:
    """Ascending by id: numeric ids as numbers, prefixed ids after them as text."""
    number = F.expr(f"try_cast(`{index}` as bigint)")
    return df.orderBy(number.asc_nulls_last(), F.col(index).asc())


def write_predictions(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write ``(index, label)`` ascending by id, gzip-compressed if asked."""
    write_table(by_index(df.select("index", "label")), path, compression=compression)
