"""Probabilities, losses, confusion counts, reports, votes, multipliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.functions.vectors import apply_multipliers, argmax, cross_entropy, focal_loss, label_weight, softmax, weighted_ce
from evenkeel.operators.metrics import (
    accuracy,
    batch_mean_loss,
    classification_report,
    confusion,
    cv_summary,
    metric_callback,
    score,
    soft_vote,
    weighted_mean_loss,
    weights_map,
)
from evenkeel.operators.models import multiplier_scores, tune_multipliers
from evenkeel.operators.sampling import assign_batches, stratified_folds
from evenkeel.queries.base import (
    SQL_LOGITS,
    SQL_PRED,
    SQL_PROBS,
    SQL_WEIGHTS,
    Tables,
    fold_every,
    query,
    r6,
    sql_fold_every,
    sql_rank,
)
from evenkeel.queries.rebalancing import sql_folds


def predictions(t: Tables):
    return t.logits().select("vec_id", "label", argmax(F.col("logits")).alias("prediction"))


@query(
    "softmax",
    f"SELECT vec_id, unnest(range(10))::INTEGER AS class, round(unnest(probs), 6) AS p FROM ({SQL_PROBS})",
)
def _(spark, d):
    df = Tables(spark, d).logits().select("vec_id", softmax(F.col("logits")).alias("probs"))
    return df.select("vec_id", F.posexplode("probs").alias("class", "p")).withColumn("p", r6("p"))


@query("argmax", f"SELECT vec_id, prediction::INTEGER AS prediction FROM ({SQL_PRED})")
def _(spark, d):
    return predictions(Tables(spark, d)).select("vec_id", "prediction")


@query(
    "confusion",
    f"SELECT label AS y_true, prediction::INTEGER AS y_pred, count(*) AS n FROM ({SQL_PRED}) GROUP BY 1, 2",
)
def _(spark, d):
    return confusion(predictions(Tables(spark, d)))


@query(
    "confusion_lineitem",
    """SELECT l_returnflag AS y_true, CASE WHEN l_linestatus = 'O' THEN 'N' WHEN l_quantity > 25 THEN 'A' ELSE 'R' END AS y_pred,
         count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def _(spark, d):
    guess = F.when(F.col("l_linestatus") == "O", "N").when(F.col("l_quantity") > 25, "A").otherwise("R")
    return confusion(Tables(spark, d).lineitem.select("l_returnflag", guess.alias("guess")), "l_returnflag", "guess")


def _sql_per_class(pred: str) -> str:
    return f"""SELECT c AS class, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
        CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
        CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1, tp + fn AS support, tp
      FROM (SELECT c, (SELECT count(*) FROM p WHERE label = c AND prediction = c)::DOUBLE AS tp,
              (SELECT count(*) FROM p WHERE label <> c AND prediction = c)::DOUBLE AS fp,
              (SELECT count(*) FROM p WHERE label = c AND prediction <> c)::DOUBLE AS fn
            FROM (SELECT label AS c FROM p UNION SELECT prediction FROM p))"""


_REPORT_SQL = f"""WITH p AS ({SQL_PRED}), k AS ({_sql_per_class('p')})
    SELECT "row", round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support FROM (
      SELECT class::VARCHAR AS "row", precision, recall, f1, support FROM k
      UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM k
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM k
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
        sum(f1 * support) / sum(support), sum(support) FROM k)"""


@query("classification_report", _REPORT_SQL)
def _(spark, d):
    df = classification_report(predictions(Tables(spark, d)))
    return df.select("row", r6("precision").alias("precision"), r6("recall").alias("recall"), r6("f1").alias("f1"), "support")


_SCORE_SQL = f"""WITH p AS ({SQL_PRED}), k AS ({_sql_per_class('p')})
    SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(avg(precision), 6) AS precision_macro,
      round(avg(recall), 6) AS recall_macro, round(avg(f1), 6) AS f1_macro,
      round(sum(f1 * support) / sum(support), 6) AS f1_weighted, sum(support)::BIGINT AS rows FROM k"""


@query("score", _SCORE_SQL)
def _(spark, d):
    df = score(predictions(Tables(spark, d)))
    return df.select(*[r6(c).alias(c) for c in df.columns if c != "rows"], "rows")


@query("metric_callback", f"SELECT accuracy, f1_macro, precision_macro, recall_macro FROM ({_SCORE_SQL})")
def _(spark, d):
    df = metric_callback(Tables(spark, d).logits())
    return df.select(*[r6(c).alias(c) for c in df.columns])


@query("accuracy", f"SELECT round(avg((label = prediction)::INTEGER), 6) AS accuracy FROM ({SQL_PRED})")
def _(spark, d):
    return accuracy(predictions(Tables(spark, d))).select(r6("accuracy").alias("accuracy"))


_FOLD_F1 = f"""WITH p AS ({sql_folds(SQL_PRED, 'vec_id', 'label', 5)}),
    k AS (SELECT f.fold, f.c,
      (SELECT count(*) FROM p WHERE p.fold = f.fold AND label = f.c AND prediction = f.c)::DOUBLE AS tp,
      (SELECT count(*) FROM p WHERE p.fold = f.fold AND (label = f.c OR prediction = f.c) AND label <> prediction)::DOUBLE AS miss
      FROM (SELECT fold, label AS c FROM p UNION SELECT fold, prediction FROM p) f)
    SELECT fold, avg(2 * tp / (2 * tp + miss)) AS f1_macro FROM k GROUP BY fold"""


@query("fold_scores", f"SELECT fold, round(f1_macro, 6) AS f1_macro FROM ({_FOLD_F1})")
def _(spark, d):
    folds = stratified_folds(predictions(Tables(spark, d)), "vec_id", "label", 5)
    return score(folds, by=("fold",)).select("fold", r6("f1_macro").alias("f1_macro"))


@query(
    "cv_summary",
    f"SELECT count(*) AS folds, round(avg(f1_macro), 6) AS mean, round(stddev_pop(f1_macro), 6) AS std FROM ({_FOLD_F1})",
)
def _(spark, d):
    folds = stratified_folds(predictions(Tables(spark, d)), "vec_id", "label", 5)
    df = cv_summary(score(folds, by=("fold",)))
    return df.select("folds", r6("mean").alias("mean"), r6("std").alias("std"))


_VIEWS_SQL = f"""SELECT vec_id, 0 AS fold, logits FROM ({SQL_LOGITS})
    UNION ALL SELECT vec_id, 1, {sql_fold_every('list_reverse(embedding)', 10)} FROM embeddings"""
_VOTE_PROBS = (
    "list_transform(logits, lambda x: exp(x - list_max(logits)) / "
    "list_sum(list_transform(logits, lambda y: exp(y - list_max(logits)))))"
)


@query(
    "soft_vote",
    f"""SELECT vec_id, class, round(avg(p), 6) AS p FROM
        (SELECT vec_id, fold, unnest(range(10))::INTEGER AS class, unnest({_VOTE_PROBS}) AS p FROM ({_VIEWS_SQL}))
        GROUP BY vec_id, class""",
)
def _(spark, d):
    t = Tables(spark, d)
    one = t.logits().select("vec_id", softmax(F.col("logits")).alias("probs"))
    other = t.embeddings.select("vec_id", fold_every(F.reverse("embedding"), 10).alias("l")).select(
        "vec_id", softmax(F.col("l")).alias("probs")
    )
    votes = soft_vote(one.unionByName(other), "vec_id")
    return votes.select("vec_id", F.posexplode("probs").alias("class", "p")).withColumn("p", r6("p"))


_CE_SQL = f"""SELECT vec_id, p.label, w.weight, -ln(probs[p.label + 1]) AS raw, w.weight * -ln(probs[p.label + 1]) AS ce
    FROM ({SQL_PROBS}) p JOIN ({SQL_WEIGHTS}) w ON p.label = w.label"""


@query("weighted_ce", f"SELECT vec_id, round(ce, 6) AS ce FROM ({_CE_SQL})")
def _(spark, d):
    t = Tables(spark, d)
    probs = t.logits().select("vec_id", "label", softmax(F.col("logits")).alias("probs"))
    ce = weighted_ce(F.col("probs"), F.col("label"), weights_map(t.embeddings))
    return probs.select("vec_id", r6(ce).alias("ce"))


@query("weighted_mean_loss", f"SELECT round(sum(ce) / sum(weight), 6) AS loss FROM ({_CE_SQL})")
def _(spark, d):
    t = Tables(spark, d)
    weights = weights_map(t.embeddings)
    rows = t.logits().select(
        cross_entropy(F.col("logits"), F.col("label"), weights).alias("ce"),
        label_weight(F.col("label"), weights).alias("w"),
    )
    return weighted_mean_loss(rows, "ce", "w").select(r6("loss").alias("loss"))


@query("focal_loss", f"SELECT vec_id, round(power(1 - exp(-ce), 2) * ce, 6) AS loss FROM ({_CE_SQL})")
def _(spark, d):
    t = Tables(spark, d)
    ce = t.logits().select("vec_id", cross_entropy(F.col("logits"), F.col("label"), weights_map(t.embeddings)).alias("ce"))
    return ce.select("vec_id", r6(focal_loss(F.col("ce"))).alias("loss"))


@query(
    "focal_loss_reduced",
    f"""SELECT round(avg(power(1 - exp(-raw), 2) * raw), 6) AS mean_loss, round(sum(power(1 - exp(-raw), 2) * raw), 4) AS sum_loss
        FROM ({_CE_SQL})""",
)
def _(spark, d):
    ce = Tables(spark, d).logits().select(cross_entropy(F.col("logits"), F.col("label")).alias("ce"))
    loss = focal_loss(F.col("ce"))
    return ce.agg(r6(F.avg(loss)).alias("mean_loss"), F.round(F.sum(loss), 4).alias("sum_loss"))


@query(
    "batch_mean_loss",
    f"""SELECT round(avg(l), 6) AS loss, count(*) AS batches FROM (SELECT batch, avg(raw) AS l FROM
        (SELECT raw, (({sql_rank('vec_id')}) - 1) // 32 AS batch FROM ({_CE_SQL})) GROUP BY batch)""",
)
def _(spark, d):
    ce = Tables(spark, d).logits().select("vec_id", cross_entropy(F.col("logits"), F.col("label")).alias("loss"))
    df = batch_mean_loss(assign_batches(ce, 32, "vec_id"))
    return df.select(r6("loss").alias("loss"), "batches")


_M = (1.0, 0.8, 1.3, 1.0, 0.9, 1.1, 1.0, 0.7, 1.2, 1.05)
_M_SQL = "[" + ", ".join(str(m) for m in _M) + "]::DOUBLE[]"


@query(
    "apply_multipliers",
    f"""SELECT vec_id, (list_position(q, list_max(q)) - 1)::INTEGER AS prediction, round(list_max(q), 6) AS top FROM
        (SELECT vec_id, list_transform(probs, lambda x, i: x * ({_M_SQL})[i]) AS q FROM ({SQL_PROBS}))""",
)
def _(spark, d):
    df = Tables(spark, d).logits().select("vec_id", softmax(F.col("logits")).alias("probs"))
    df = df.select("vec_id", apply_multipliers(F.col("probs"), _M).alias("q"))
    return df.select("vec_id", argmax(F.col("q")).alias("prediction"), r6(F.array_max("q")).alias("top"))


_CANDIDATES = [[1.0] * 10, list(_M), [1.0 + 0.05 * i for i in range(10)], [1.5 - 0.1 * i for i in range(10)]]
_CAND_SQL = " UNION ALL ".join(
    f"SELECT {i} AS candidate, [{', '.join(repr(m) for m in c)}]::DOUBLE[] AS m" for i, c in enumerate(_CANDIDATES)
)


@query(
    "multiplier_scores",
    f"""WITH q AS (SELECT candidate, label, list_transform(probs, lambda x, i: x * m[i]) AS q FROM ({SQL_PROBS}) CROSS JOIN ({_CAND_SQL})),
        p AS (SELECT candidate, label, list_position(q, list_max(q)) - 1 AS prediction FROM q),
        side AS (SELECT candidate, label AS c, (label = prediction)::INTEGER AS tp, (label <> prediction)::INTEGER AS miss FROM p
                 UNION ALL SELECT candidate, prediction, 0, 1 FROM p WHERE label <> prediction),
        k AS (SELECT candidate, c, 2.0::DOUBLE * sum(tp) / (2 * sum(tp) + sum(miss)) AS f1 FROM side GROUP BY candidate, c)
        SELECT candidate::INTEGER AS candidate, round(avg(f1), 6) AS f1_macro FROM k GROUP BY candidate""",
)
def _(spark, d):
    df = Tables(spark, d).logits().select("label", softmax(F.col("logits")).alias("probs"))
    return multiplier_scores(df, _CANDIDATES).select("candidate", r6("f1_macro").alias("f1_macro"))


_FACTORS = (0.5, 0.7, 0.85, 0.95, 1.05, 1.2, 1.5, 2.0)
_TRIES_SQL = f"""SELECT 0 AS id, -1 AS c, 1.0::DOUBLE AS f UNION ALL
    SELECT 1 + c * {len(_FACTORS)} + i, c, ({list(_FACTORS)}::DOUBLE[])[i + 1] FROM range(10) a(c), range({len(_FACTORS)}) b(i)"""


# the best single step of the search
@query(
    "tune_multipliers",
    f"""WITH q AS (SELECT id, c, f, label, list_transform(probs, lambda x, i: CASE WHEN i - 1 = c THEN x * f ELSE x END) AS q
                  FROM ({SQL_PROBS}) CROSS JOIN ({_TRIES_SQL})),
        p AS (SELECT id, c, f, label, list_position(q, list_max(q)) - 1 AS prediction FROM q),
        side AS (SELECT id, label AS k, (label = prediction)::INTEGER AS tp, (label <> prediction)::INTEGER AS miss FROM p
                 UNION ALL SELECT id, prediction, 0, 1 FROM p WHERE label <> prediction),
        s AS (SELECT id, round(avg(f1), 12) AS f1 FROM
               (SELECT id, k, 2.0::DOUBLE * sum(tp) / (2 * sum(tp) + sum(miss)) AS f1 FROM side GROUP BY id, k) GROUP BY id),
        best AS (SELECT t.c, t.f, s.f1, (SELECT f1 FROM s WHERE id = 0) AS base FROM s JOIN ({_TRIES_SQL}) t ON s.id = t.id
                 ORDER BY s.f1 DESC, s.id LIMIT 1)
        SELECT k::INTEGER AS class, CASE WHEN k = c THEN f ELSE 1.0::DOUBLE END AS multiplier, round(f1, 6) AS f1_macro,
          round(base, 6) AS argmax_f1_macro FROM best, range(10) r(k)""",
)
def _(spark, d):
    df = Tables(spark, d).logits().select("label", softmax(F.col("logits")).alias("probs"))
    best, f1, base = tune_multipliers(df, 10, factors=_FACTORS, rounds=1)
    return spark.createDataFrame(
        [(i, float(m), round(f1, 6), round(base, 6)) for i, m in enumerate(best)],
        "class int, multiplier double, f1_macro double, argmax_f1_macro double",
    )


@query("tune_multipliers_fully", "SELECT unnest(range(10))::INTEGER AS class, true AS positive, true AS no_worse")
def _(spark, d):
    df = Tables(spark, d).logits().select("label", softmax(F.col("logits")).alias("probs"))
    best, f1, base = tune_multipliers(df, 10)
    return spark.createDataFrame(
        [(i, bool(m > 0), bool(f1 >= base)) for i, m in enumerate(best)],
        "class int, positive boolean, no_worse boolean",
    )
