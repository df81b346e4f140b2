"""Whole jobs over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.operators.joins import join_labels, union_sources
from evenkeel.operators.metrics import class_distribution
from evenkeel.operators.models import forest, linear
from evenkeel.operators.sampling import stratified_split
from evenkeel.plans.augment import flag_augmentation, keyword_augmentation, mixed_augmentation, semantic_augmentation
from evenkeel.plans.prepare import check_dataset, prepare
from evenkeel.plans.training import (
    batch_inference,
    boosted_folds,
    compare,
    embedding_forest,
    fit_text_model,
    merged_linear,
    tfidf_folds,
    tfidf_forest,
)
from evenkeel.queries.base import (
    REGISTRY,
    RULES,
    SQL_LABELED,
    Tables,
    query,
    r6,
    sql_clean,
    sql_keyword,
    sql_normalize,
    sql_rank,
)
from evenkeel.queries.rebalancing import _CHAT_SQL, _MIX_SQL, sql_draws, sql_split
from evenkeel.queries.vectorising import SQL_SIMILAR_TEXTS, word_encoder
from evenkeel.session import cut_lineage, shared_dir
from evenkeel.sources.tables import load_labeled, read_table, write_table, write_text_label


# roles without a label are dropped by the mapping
_MIX_MAPPED_SQL = _MIX_SQL.replace(_CHAT_SQL, _CHAT_SQL + " WHERE role IN ('user', 'assistant')")


# what holds for any learner: each test text gets one label of the four
_VALID_SQL = "SELECT item_id::VARCHAR AS index, true AS valid FROM benchmark"


def _valid(predictions):
    return predictions.select("index", F.col("label").between(0, 3).alias("valid"))


def _labelled(t: Tables):
    return join_labels(t.texts(), t.classes())


def _chat(t: Tables):
    return t.conversations.withColumn("turn_id", F.concat_ws("_", "conv_id", "turn"))


def _test(t: Tables):
    return t.benchmark.select(F.col("item_id").cast("string").alias("index"), F.col("text").alias("message"))


def _saved(spark, df):
    """Write as text and label files and read both back."""
    return load_labeled(spark, *write_text_label(df, shared_dir(spark, "augmented")))


@query(
    "mixed_augmentation",
    f"""SELECT (row_number() OVER (ORDER BY source, md5('42|' || k), k) - 1)::VARCHAR AS index, label, md5(message) AS text_md5
        FROM (SELECT *, index || ':' || coalesce(draw::VARCHAR, '-') AS k FROM ({_MIX_MAPPED_SQL}))""",
)
def _(spark, d):
    t = Tables(spark, d)
    out = mixed_augmentation(
        _labelled(t), _chat(t), "turn_id", "text", "role", {"user": 0, "assistant": 1}, pooled={0: 150}, drawn={2: 60, 3: 60}
    )
    return _saved(spark, out).select("index", "label", F.md5("message").alias("text_md5"))


@query(
    "keyword_augmentation",
    f"""SELECT index, label, md5(message) AS text_md5 FROM ({SQL_LABELED}) UNION ALL
        SELECT 'doc_' || doc_id, label, md5(t) FROM
          (SELECT doc_id, {sql_keyword('text')} AS label, {sql_clean('text')} AS t FROM documents WHERE lang = 'en')
        WHERE label IS NOT NULL""",
)
def _(spark, d):
    t = Tables(spark, d)
    out = keyword_augmentation(_labelled(t), t.documents, "doc_id", "doc_", RULES, "text", "lang", "en")
    return _saved(spark, out).select("index", "label", F.md5("message").alias("text_md5"))


@query(
    "keyword_augmentation_classes",
    f"""SELECT label, count(*) AS count, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS percent FROM
        (SELECT label FROM ({SQL_LABELED}) UNION ALL SELECT {sql_keyword('text')} FROM documents) WHERE label IS NOT NULL GROUP BY label""",
)
def _(spark, d):
    t = Tables(spark, d)
    out = keyword_augmentation(_labelled(t), t.documents, "doc_id", "doc_", RULES, "text", None)
    return class_distribution(out, names=None).withColumn("percent", r6("percent"))


@query(
    "flag_augmentation",
    f"""WITH f AS (SELECT doc_id, toxic, quality, {sql_clean('text')} AS t FROM documents JOIN labels USING (doc_id)
                   WHERE toxic = 1 OR quality = 0),
        n AS (SELECT *, {sql_rank('doc_id')} - 1 AS n FROM f WHERE length(t) > 5)
        SELECT conv_id || '_' || turn AS index, (role = 'assistant')::INTEGER AS label, md5(text) AS text_md5 FROM conversations
        UNION ALL SELECT 'flag_' || n, CASE WHEN toxic = 1 THEN 4 WHEN regexp_matches(t, 'die|ung', 'i') THEN 5 ELSE 3 END, md5(t) FROM n""",
)
def _(spark, d):
    t = Tables(spark, d)
    corpus = join_labels(t.documents, t.labels, "doc_id").select(
        "doc_id", F.col("text").alias("comment_text"), F.col("toxic").alias("threat"), (1 - F.col("quality")).alias("identity_hate")
    )
    train = _chat(t).select(
        F.col("turn_id").alias("index"), F.col("text").alias("message"), (F.col("role") == "assistant").cast("int").alias("label")
    )
    out = flag_augmentation(train, corpus, "doc_id", "flag_", "die|ung")
    return _saved(spark, out).select("index", "label", F.md5("message").alias("text_md5"))


def _landed(df, wanted: str, sep: str):
    """A corpus as it lands: delimited files, read back by their headers."""
    path = shared_dir(df.sparkSession, "landed")
    write_table(df, path, sep=sep)
    return read_table(df.sparkSession, path, wanted, sep=sep)


_KEYWORD_SQL = REGISTRY["keyword_augmentation"].sql
_FLAG_SQL = REGISTRY["flag_augmentation"].sql
_MIXED_SQL = REGISTRY["mixed_augmentation"].sql


@query("keyword_augmentation_landed", _KEYWORD_SQL)
def _(spark, d):
    t = Tables(spark, d)
    corpus = _landed(t.documents.select("doc_id", "lang", "text", "source"), "doc_id bigint, text string, lang string", ";")
    out = keyword_augmentation(_labelled(t), corpus, "doc_id", "doc_", RULES, "text", "lang", "en")
    return _saved(spark, out).select("index", "label", F.md5("message").alias("text_md5"))


@query("flag_augmentation_landed", _FLAG_SQL)
def _(spark, d):
    t = Tables(spark, d)
    flags = join_labels(t.documents, t.labels, "doc_id").select(
        "doc_id", F.col("text").alias("comment_text"), F.col("toxic").alias("threat"), (1 - F.col("quality")).alias("identity_hate")
    )
    corpus = _landed(flags, "doc_id bigint, comment_text string, threat int, identity_hate int", ",")
    train = _chat(t).select(
        F.col("turn_id").alias("index"), F.col("text").alias("message"), (F.col("role") == "assistant").cast("int").alias("label")
    )
    out = flag_augmentation(train, corpus, "doc_id", "flag_", "die|ung")
    return _saved(spark, out).select("index", "label", F.md5("message").alias("text_md5"))


@query("mixed_augmentation_landed", _MIXED_SQL)
def _(spark, d):
    t = Tables(spark, d)
    chat = _landed(_chat(t).select("turn_id", "role", "text"), "turn_id string, text string, role string", ",")
    out = mixed_augmentation(
        _labelled(t), chat, "turn_id", "text", "role", {"user": 0, "assistant": 1}, pooled={0: 150}, drawn={2: 60, 3: 60}
    )
    return _saved(spark, out).select("index", "label", F.md5("message").alias("text_md5"))


def _near(t: Tables):
    return semantic_augmentation(
        _labelled(t), t.documents, _test(t), "doc_id", "near_", RULES, text="text", category=None, encoder=word_encoder
    )


@query(
    "semantic_augmentation",
    f"""SELECT index, label, md5(message) AS text_md5 FROM ({SQL_LABELED}) UNION ALL
        SELECT 'near_' || doc_id, label, md5(message) FROM ({SQL_SIMILAR_TEXTS})""",
)
def _(spark, d):
    out, _chosen = _near(Tables(spark, d))
    return out.select("index", "label", F.md5("message").alias("text_md5"))


@query(
    "semantic_augmentation_scores",
    f"SELECT 'near_' || doc_id AS index, label, round(sim, 6) AS sim_score FROM ({SQL_SIMILAR_TEXTS})",
)
def _(spark, d):
    _all, chosen = _near(Tables(spark, d))
    return chosen.select("index", "label", r6("sim_score").alias("sim_score"))


_PARTS_SQL = f"""WITH s AS ({sql_split(f"SELECT index, label, message FROM ({SQL_LABELED})", "index", "label", "0.2")}),
    c AS (SELECT index, label, message FROM s WHERE NOT is_test),
    r AS (SELECT *, {sql_rank('index', 'label')} AS rank, count(*) OVER (PARTITION BY label) AS size FROM c),
    dr AS ({sql_draws('SELECT label, count(*) AS size FROM c GROUP BY label HAVING label <> 1 AND count(*) < 100', 'label', '100')}),
    b AS (SELECT index, label, message FROM r WHERE (label = 1 AND rank <= 120) OR (label <> 1 AND size >= 100)
      UNION ALL SELECT r.index, r.label, r.message FROM dr JOIN r ON r.label = dr.label AND r.rank = dr.pick)"""


@query(
    "prepare",
    f"""{_PARTS_SQL},
        p AS (SELECT 'train' AS part, label, {sql_normalize('message')} AS m FROM b
          UNION ALL SELECT 'val', label, {sql_normalize('message')} FROM s WHERE is_test
          UNION ALL SELECT 'test', NULL, {sql_normalize('text')} FROM benchmark)
        SELECT part, label, count(*) AS count, sum(length(m))::BIGINT AS chars, max(md5(m)) AS last_md5,
          CASE WHEN part = 'train' THEN round(sum(count(*)) OVER (PARTITION BY part) / (count(*) OVER (PARTITION BY part) * count(*)), 6) END AS weight
        FROM p GROUP BY part, label""",
)
def _(spark, d):
    t = Tables(spark, d)
    split = cut_lineage(stratified_split(_labelled(t), "index", "label", 0.2), partition_by="is_test")
    train, val = (split.where(F.col("is_test") == held) for held in (False, True))

    def files(rows):
        return rows.select("index", "message"), rows.select("index", "label")

    done = prepare(files(train), files(val), _test(t), resample=True, majority=1, target=120, minimum=100)
    parts = [("train", done.train), ("val", done.val), ("test", done.test.withColumn("label", F.lit(None).cast("int")))]
    rows = union_sources(*[df.select(F.lit(name).alias("part"), "label", "message") for name, df in parts])
    sums = rows.groupBy("part", "label").agg(
        F.count("*").alias("count"), F.sum(F.length("message")).alias("chars"), F.max(F.md5("message")).alias("last_md5")
    )
    weights = done.weights.select(F.lit("train").alias("part"), "label", r6("weight").alias("weight"))
    return sums.join(weights, ["part", "label"], "left")


@query(
    "check_dataset",
    f"""SELECT label::VARCHAR AS item, count(*) AS rows FROM ({SQL_LABELED}) GROUP BY label
        UNION ALL SELECT 'text', count(*) FROM documents UNION ALL SELECT 'labels', count(*) FROM labels
        UNION ALL SELECT 'test', count(*) FROM benchmark""",
)
def _(spark, d):
    t = Tables(spark, d)
    report, classes = check_dataset(
        spark, {"text": t.texts, "labels": t.classes, "test": lambda: _test(t)}, "text", "labels"
    )
    return report.select(F.col("input").alias("item"), "rows").unionByName(
        classes.select(F.col("label").cast("string").alias("item"), F.col("count").alias("rows"))
    )


@query("tfidf_forest", _VALID_SQL)
def _(spark, d):
    t = Tables(spark, d)
    return _valid(tfidf_forest(_labelled(t), _test(t), trees=20, depth=8).predictions)


_HELD_SQL = sql_split(f"SELECT index, label FROM ({SQL_LABELED})", "index", "label", "0.1")


@query(
    "tfidf_forest_report",
    f"""WITH h AS (SELECT label FROM ({_HELD_SQL}) WHERE is_test)
        SELECT label::VARCHAR AS row, count(*) AS support, true AS valid FROM h GROUP BY label
        UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), (SELECT count(*) FROM h), true""",
)
def _(spark, d):
    t = Tables(spark, d)
    report = tfidf_forest(_labelled(t), _test(t), trees=10, depth=6).report
    valid = F.col("precision").between(0, 1) & F.col("recall").between(0, 1) & F.col("f1").between(0, 1)
    return report.where("support > 0").select("row", "support", valid.alias("valid"))


@query("embedding_forest", _VALID_SQL)
def _(spark, d):
    t = Tables(spark, d)
    return _valid(embedding_forest(_labelled(t), _test(t), trees=20, depth=8).predictions)


@query("tfidf_folds", _VALID_SQL)
def _(spark, d):
    t = Tables(spark, d)
    return _valid(tfidf_folds(_labelled(t), _test(t), k=3, estimator=linear(iterations=15)).predictions)


@query("tuned_folds", _VALID_SQL)
def _(spark, d):
    t = Tables(spark, d)
    return _valid(
        tfidf_folds(_labelled(t), _test(t), k=2, estimator=linear(iterations=15), tune=True).predictions
    )


@query("boosted_folds", _VALID_SQL)
def _(spark, d):
    t = Tables(spark, d)
    return _valid(boosted_folds(_labelled(t), _test(t), 4, k=5, rounds=4, rate=0.3, depth=3, patience=2).predictions)


@query("smote_boosted_folds", _VALID_SQL)
def _(spark, d):
    t = Tables(spark, d)
    return _valid(boosted_folds(_labelled(t), _test(t), 4, k=5, rounds=4, rate=0.3, depth=3, patience=2, smote_target=120).predictions)


@query("merged_linear", _VALID_SQL)
def _(spark, d):
    t = Tables(spark, d)
    return _valid(merged_linear(_labelled(t), _test(t), iterations=15).predictions)


@query("compare_and_predict", _VALID_SQL)
def _(spark, d):
    t = Tables(spark, d)
    split = stratified_split(_labelled(t), "index", "label", 0.3)
    result, predict_best = compare(
        split.where(~F.col("is_test")).drop("is_test"),
        split.where("is_test").drop("is_test"),
        {"linear": linear(iterations=10), "forest": forest(trees=8, depth=4)},
        directory=shared_dir(spark, "run"),
    )
    return _valid(predict_best(_test(t)))


@query("several_models", "SELECT unnest(['linear', 'strong_l2']) AS model, true AS valid")
def _(spark, d):
    t = Tables(spark, d)
    outer = stratified_split(_labelled(t), "index", "label", 0.2)
    test = outer.where("is_test").drop("is_test")
    inner = stratified_split(outer.where(~F.col("is_test")).drop("is_test"), "index", "label", 0.2)
    result, _best = compare(
        inner.where(~F.col("is_test")).drop("is_test"),
        inner.where("is_test").drop("is_test"),
        {"linear": linear(iterations=10), "strong_l2": linear(iterations=10, l2=1.0)},
        test=test,
    )
    scores = [F.col(c).between(0, 1) for c in ("val_f1_macro", "test_f1_macro", "test_accuracy")]
    return result.table.select("model", (scores[0] & scores[1] & scores[2]).alias("valid"))


@query("batch_inference", _VALID_SQL)
def _(spark, d):
    t = Tables(spark, d)
    path = shared_dir(spark, "model")
    fit_text_model(_labelled(t), path, iterations=20)
    return _valid(batch_inference(_test(t), path, shared_dir(spark, "scored")))


@query("inference_coverage", "SELECT item_id::VARCHAR AS index, true AS valid FROM benchmark")
def _(spark, d):
    t = Tables(spark, d)
    path = shared_dir(spark, "model")
    fit_text_model(_labelled(t), path, iterations=20)
    out = batch_inference(_test(t), path)
    return out.select("index", F.col("label").between(0, 3).alias("valid"))
