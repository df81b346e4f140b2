"""Registry, table access, and the SQL and settings that queries share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.session import spread

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        assert name not in REGISTRY, name
        REGISTRY[name] = Entry(fn, sql)
        return fn

    return register


class Tables:
    """The tables of one folder as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")

    @property
    def documents(self) -> DataFrame:
        """Long texts: costly per row, so spread over all cores."""
        return spread(self._spark.read.parquet(f"{self._dir}/documents.parquet"), "doc_id")

    def texts(self) -> DataFrame:
        """documents as (index, message)."""
        return self.documents.select(F.col("doc_id").cast("string").alias("index"), F.col("text").alias("message"))

    def classes(self) -> DataFrame:
        """labels as (index, label) with four classes of very different size."""
        return self.labels.select(
            F.col("doc_id").cast("string").alias("index"),
            (F.col("toxic") * 2 + F.col("quality")).cast("int").alias("label"),
        )

    def logits(self) -> DataFrame:
        """(vec_id, label, logits): all entries of an embedding folded into ten."""
        return self.embeddings.select("vec_id", "label", fold_every(F.col("embedding"), 10).alias("logits"))


def fold_every(vec: Column, n: int) -> Column:
    """Entry ``j`` is the sum of the entries at ``j``, ``j + n``, ``j + 2n``, …"""
    wide = vec.cast("array<double>")
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda j: F.aggregate(F.filter(wide, lambda x, i: i % n == j), F.lit(0.0), lambda acc, x: acc + x),
    )


def r6(col: Column | str) -> Column:
    return F.round(F.col(col) if isinstance(col, str) else col, 6)


# Neutral keyword rules, highest priority first.
RULES = ((5, "worthless|pathetic"), (4, "trash|scum"), (3, "idiot|moron|clown|stupid|loser"))

# --- SQL snippets -----------------------------------------------------------

SQL_WS = r"[\t-\r\x1c-\x20\x85\p{Z}]+"


def sql_squeeze(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{SQL_WS}', ' ', 'g'))"


def sql_normalize(col: str, lower: bool = False) -> str:
    text = f"replace(replace(coalesce({col}, ''), '#ERROR!', ''), '#NAME?', '')"
    return sql_squeeze(f"lower({text})" if lower else text)


def sql_clean(col: str) -> str:
    return sql_squeeze(rf"lower(regexp_replace(coalesce({col}, ''), '[^\p{{L}}\p{{N}}_\s?!'']', ' ', 'g'))")


def sql_keyword(col: str) -> str:
    cases = " ".join(f"WHEN regexp_matches({col}, '{pattern}', 'i') THEN {label}" for label, pattern in RULES)
    return f"CASE {cases} END"


def sql_hash(key: str, seed: str = "42") -> str:
    return f"md5('{seed}|' || {key})"


def sql_number(digest: str, digits: int = 15) -> str:
    return f"('0x' || substr({digest}, 1, {digits}))::BIGINT"


def sql_rank(key: str, by: str | None = None, hash_key: str | None = None) -> str:
    part = f"PARTITION BY {by} " if by else ""
    return f"row_number() OVER ({part}ORDER BY {sql_hash(hash_key or key)}, {key})"


SQL_WORDS = r"regexp_extract_all(lower(coalesce({0}, '')), '[\p{{L}}\p{{N}}_]{{2,}}')"


def sql_words(col: str) -> str:
    return SQL_WORDS.format(col)


def sql_grams(words: str) -> str:
    """One- and two-word grams of a list column."""
    return (
        f"list_concat({words}, list_transform(range(1, len({words})), "
        f"lambda i: {words}[i] || ' ' || {words}[i + 1]))"
    )


SQL_TEXTS = "SELECT doc_id::VARCHAR AS index, text AS message FROM documents"
SQL_CLASSES = "SELECT doc_id::VARCHAR AS index, (toxic * 2 + quality)::INTEGER AS label FROM labels"
SQL_LABELED = f"SELECT t.index, t.message, c.label FROM ({SQL_TEXTS}) t JOIN ({SQL_CLASSES}) c ON t.index = c.index"


def sql_fold_every(col: str, n: int) -> str:
    return (
        f"list_transform(range({n}), lambda j: list_sum(list_filter({col}::DOUBLE[], "
        f"lambda x, i: (i - 1) % {n} = j)))"
    )


SQL_LOGITS = f"SELECT vec_id, label, {sql_fold_every('embedding', 10)} AS logits FROM embeddings"
SQL_SOFTMAX = (
    "list_transform(logits, lambda x: exp(x - list_max(logits)) / "
    "list_sum(list_transform(logits, lambda y: exp(y - list_max(logits)))))"
)
SQL_PROBS = f"SELECT vec_id, label, logits, {SQL_SOFTMAX} AS probs FROM ({SQL_LOGITS})"
SQL_PRED = f"SELECT vec_id, label, list_position(logits, list_max(logits)) - 1 AS prediction FROM ({SQL_LOGITS})"
SQL_WEIGHTS = (
    "SELECT label, count(*) AS n, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight "
    "FROM embeddings GROUP BY label"
)
