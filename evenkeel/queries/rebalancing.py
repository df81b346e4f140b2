"""Exact samples, balancing, folds, splits, batches, synthetic rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.operators.joins import fold_parts, join_labels, union_sources
from evenkeel.operators.metrics import cv_summary
from evenkeel.operators.sampling import (
    assign_batches,
    balance_classes,
    hash_rank,
    oversample,
    reindex,
    source_mix,
    stratified_folds,
    stratified_split,
    undersample,
)
from evenkeel.operators.smote import smote
from evenkeel.queries.base import (
    SQL_CLASSES,
    SQL_LABELED,
    Tables,
    query,
    r6,
    sql_hash,
    sql_number,
    sql_rank,
)

_ORDER_RANK = sql_rank("o_orderkey", "o_orderstatus")


@query("hash_rank", f"SELECT o_orderkey, o_orderstatus, {_ORDER_RANK} AS rank FROM orders")
def _(spark, d):
    return hash_rank(Tables(spark, d).orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", by="o_orderstatus")


@query(
    "undersample",
    f"SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders QUALIFY {_ORDER_RANK} <= 400",
)
def _(spark, d):
    return undersample(Tables(spark, d).orders, 400, "o_orderkey", by="o_orderstatus").select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )


@query(
    "undersample_one_class",
    f"SELECT o_orderkey, o_orderstatus FROM orders QUALIFY o_orderstatus <> 'F' OR {_ORDER_RANK} <= 250",
)
def _(spark, d):
    return undersample(Tables(spark, d).orders, {"F": 250}, "o_orderkey", by="o_orderstatus").select(
        "o_orderkey", "o_orderstatus"
    )


@query("undersample_all", f"SELECT event_id, user_id, value FROM events QUALIFY {sql_rank('event_id')} <= 777")
def _(spark, d):
    return undersample(Tables(spark, d).events, 777, "event_id").select("event_id", "user_id", "value")


def sql_draws(sizes: str, label_text: str, n: str) -> str:
    """(label, draw, pick): which rank each draw picks, from a table (label, size)."""
    pick = sql_number(sql_hash(f"{label_text} || '|' || draw"))
    return (
        f"SELECT label, draw, {pick} % size + 1 AS pick FROM "
        f"(SELECT label, size, unnest(range({n})) AS draw FROM ({sizes}))"
    )


@query(
    "oversample",
    f"""WITH r AS (SELECT *, {_ORDER_RANK} AS rank FROM orders),
        dr AS ({sql_draws('SELECT o_orderstatus AS label, count(*) AS size FROM orders GROUP BY 1', 'label', '3000')})
        SELECT o_orderstatus, draw, o_orderkey FROM dr JOIN r ON r.o_orderstatus = dr.label AND r.rank = dr.pick""",
)
def _(spark, d):
    return oversample(Tables(spark, d).orders, 3000, "o_orderkey", "o_orderstatus").select(
        "o_orderstatus", "draw", "o_orderkey"
    )


_BALANCED_SQL = f"""WITH c AS ({SQL_LABELED}),
    r AS (SELECT *, {sql_rank('index', 'label')} AS rank, count(*) OVER (PARTITION BY label) AS size FROM c),
    dr AS ({sql_draws('SELECT label, count(*) AS size FROM c GROUP BY label HAVING label <> 1 AND count(*) < 100', 'label', '100')})
    SELECT index, label, message, NULL::BIGINT AS draw FROM r
      WHERE (label = 1 AND rank <= 120) OR (label <> 1 AND size >= 100)
    UNION ALL
    SELECT r.index, r.label, r.message, dr.draw FROM dr JOIN r ON r.label = dr.label AND r.rank = dr.pick"""


@query("balance_classes", f"SELECT index, label, draw, md5(message) AS text_md5 FROM ({_BALANCED_SQL})")
def _(spark, d):
    t = Tables(spark, d)
    df = join_labels(t.texts(), t.classes())
    return balance_classes(df, "index", majority=1, target=120, minimum=100).select(
        "index", "label", "draw", F.md5("message").alias("text_md5")
    )


_CHAT_SQL = "SELECT conv_id || '_' || turn AS index, text AS message, (role = 'assistant')::INTEGER AS label FROM conversations"

_MIX_SQL = f"""WITH m AS ({SQL_LABELED}), x AS ({_CHAT_SQL}),
    b AS (SELECT *, 0 AS source FROM m UNION ALL SELECT *, 1 FROM x),
    k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || source || ':' || index), source || ':' || index) AS rank
          FROM b WHERE label NOT IN (2, 3)),
    r AS (SELECT *, {sql_rank('index', 'label')} AS rank FROM m WHERE label IN (2, 3)),
    dr AS ({sql_draws('SELECT label, count(*) AS size FROM m WHERE label IN (2, 3) GROUP BY label', 'label', '60')})
    SELECT index, message, label, source, NULL::BIGINT AS draw FROM k WHERE label <> 0 OR rank <= 150
    UNION ALL
    SELECT r.index, r.message, r.label, 0, dr.draw FROM dr JOIN r ON r.label = dr.label AND r.rank = dr.pick"""


def mixed_sources(t: Tables):
    """Labelled documents and chat turns, mixed by class."""
    main = join_labels(t.texts(), t.classes())
    chat = t.conversations.select(
        F.concat_ws("_", "conv_id", "turn").alias("index"),
        F.col("text").alias("message"),
        (F.col("role") == "assistant").cast("int").alias("label"),
    )
    return source_mix(main, chat, "index", pooled={0: 150}, drawn={2: 60, 3: 60})


@query("source_mix", f"SELECT index, label, source, draw, md5(message) AS text_md5 FROM ({_MIX_SQL})")
def _(spark, d):
    return mixed_sources(Tables(spark, d)).select("index", "label", "source", "draw", F.md5("message").alias("text_md5"))


@query(
    "reindex",
    f"""WITH b AS (SELECT 0 AS source, doc_id::VARCHAR AS id, text FROM documents
                   UNION ALL SELECT 1, item_id::VARCHAR, text FROM benchmark)
        SELECT source, id, (row_number() OVER (ORDER BY source, {sql_hash('id')}, id) - 1)::VARCHAR AS index FROM b""",
)
def _(spark, d):
    t = Tables(spark, d)
    both = union_sources(
        t.documents.select(F.lit(0).alias("source"), F.col("doc_id").cast("string").alias("id")),
        t.benchmark.select(F.lit(1).alias("source"), F.col("item_id").cast("string").alias("id")),
    )
    return reindex(both, "id", "source")


def sql_folds(table: str, key: str, label: str, k: int) -> str:
    """Every column of ``table`` and its fold."""
    return (
        f"SELECT t.*, ((o.before + {sql_rank('t.' + key, 't.' + label)} - 1) % {k})::INTEGER AS fold FROM ({table}) t "
        f"JOIN (SELECT {label}, coalesce(sum(count(*)) OVER (ORDER BY {label} "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ({table}) GROUP BY {label}) o "
        f"ON t.{label} = o.{label}"
    )


_ORDER_FOLDS = sql_folds("SELECT o_orderkey, o_orderstatus FROM orders", "o_orderkey", "o_orderstatus", 5)


@query("stratified_folds", f"SELECT o_orderkey, o_orderstatus, fold FROM ({_ORDER_FOLDS})")
def _(spark, d):
    df = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus")
    return stratified_folds(df, "o_orderkey", "o_orderstatus", 5)


@query(
    "fold_parts",
    f"""SELECT 'train' AS part, o_orderstatus, count(*) AS rows FROM ({_ORDER_FOLDS}) WHERE fold <> 2 GROUP BY 2
        UNION ALL SELECT 'valid', o_orderstatus, count(*) FROM ({_ORDER_FOLDS}) WHERE fold = 2 GROUP BY 2""",
)
def _(spark, d):
    df = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus")
    train, valid = fold_parts(stratified_folds(df, "o_orderkey", "o_orderstatus", 5), 2)
    return (
        train.withColumn("part", F.lit("train"))
        .unionByName(valid.withColumn("part", F.lit("valid")))
        .groupBy("part", "o_orderstatus")
        .agg(F.count("*").alias("rows"))
    )


@query(
    "fold_sizes",
    f"""SELECT count(*) AS folds, round(avg(n), 6) AS mean, round(stddev_pop(n), 6) AS std FROM
        (SELECT fold, count(*) AS n FROM ({sql_folds(SQL_CLASSES, 'index', 'label', 5)}) GROUP BY fold)""",
)
def _(spark, d):
    folds = stratified_folds(Tables(spark, d).classes(), "index", "label", 5)
    sizes = folds.groupBy("fold").agg(F.count("*").alias("n"))
    return cv_summary(sizes, "n").select("folds", r6("mean").alias("mean"), r6("std").alias("std"))


@query(
    "assign_batches",
    f"SELECT index, (({sql_rank('index')}) - 1) // 32 AS batch FROM ({SQL_CLASSES})",
)
def _(spark, d):
    return assign_batches(Tables(spark, d).classes().select("index"), 32, "index")


def sql_split(table: str, key: str, label: str, share: str) -> str:
    """Every column of ``table`` and ``is_test``."""
    return f"""SELECT t.* EXCLUDE (rank_), t.rank_ <= q.quota AS is_test FROM
        (SELECT *, {sql_rank(key, label)} AS rank_ FROM ({table})) t
        JOIN (SELECT {label}, whole + (row_number() OVER (ORDER BY rest DESC, {label}) <= n_test - sum(whole) OVER ())::INTEGER AS quota
              FROM (SELECT {label}, n_test, (n * n_test) // total AS whole, (n * n_test) % total AS rest
                    FROM (SELECT {label}, n, total, ceil(round({share} * total, 9))::BIGINT AS n_test
                          FROM (SELECT {label}, count(*) AS n, (sum(count(*)) OVER ())::BIGINT AS total
                                FROM ({table}) GROUP BY {label})))) q
        ON t.{label} = q.{label}"""


@query(
    "stratified_split",
    f"SELECT o_orderkey, is_test FROM ({sql_split('SELECT o_orderkey, o_orderstatus FROM orders', 'o_orderkey', 'o_orderstatus', '0.1')})",
)
def _(spark, d):
    df = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus")
    return stratified_split(df, "o_orderkey", "o_orderstatus", 0.1).select("o_orderkey", "is_test")


# 13 hex digits are the 52 bits of an exact fraction
_GAP = sql_number(sql_hash("label || '|' || draw", "42g"), 13) + "::DOUBLE / 4503599627370496"

_SMOTE_SQL = f"""WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
    s AS (SELECT label, count(*) AS size FROM e GROUP BY label),
    kk AS (SELECT greatest(1, least(5, min(size) - 1)) AS k FROM s),
    r AS (SELECT e.*, {sql_rank('vec_id', 'label')} AS rank FROM e),
    nb AS (SELECT a.vec_id, b.vec_id AS nid,
             row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_sum(list_transform(range(1, len(a.x) + 1),
               lambda i: (a.x[i] - b.x[i]) * (a.x[i] - b.x[i]))), 9), b.vec_id) AS place
           FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id),
    dr AS (SELECT label, draw, size, {sql_number(sql_hash("label || '|' || draw"))} % size + 1 AS pick,
             {sql_number(sql_hash("label || '|' || draw", '42n'))} AS npick, {_GAP} AS u
           FROM (SELECT label, size, unnest(range(greatest(0, TARGET - size))) AS draw FROM s)),
    made AS (SELECT 'smote_' || dr.label || '_' || dr.draw AS id, dr.label, a.x AS x, b.x AS y, u
             FROM dr CROSS JOIN kk JOIN r a ON a.label = dr.label AND a.rank = dr.pick
             JOIN nb ON nb.vec_id = a.vec_id AND nb.place = npick % least(kk.k, dr.size - 1) + 1 JOIN e b ON b.vec_id = nb.nid),
    allv AS (SELECT vec_id::VARCHAR AS vec_id, label, x AS v, false AS synthetic FROM r WHERE rank <= TARGET
             UNION ALL SELECT id, label, list_transform(range(1, len(x) + 1), lambda i: x[i] + u * (y[i] - x[i])), true FROM made)
    SELECT vec_id, label, synthetic, round(list_sum(v), 6) AS total,
      round(list_sum(list_transform(v, lambda x: x * x)), 6) AS squares FROM allv"""


def _smote_query(target: int):
    def run(spark, d):
        df = smote(Tables(spark, d).embeddings, "vec_id", "label", "embedding", target)
        v = F.col("embedding")
        return df.select(
            "vec_id",
            "label",
            "synthetic",
            r6(F.aggregate(v, F.lit(0.0), lambda a, x: a + x)).alias("total"),
            r6(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)).alias("squares"),
        )

    return run


query("smote", _SMOTE_SQL.replace("TARGET", "300"))(_smote_query(300))
query("smote_with_undersampling", _SMOTE_SQL.replace("TARGET", "50"))(_smote_query(50))
