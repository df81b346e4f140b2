"""Fitted models over the tables. Their numbers depend on Spark's learners, so the
SQL twins check what holds for any learner: which rows are scored, in which fold,
that probabilities sum to one and predictions are their largest. The tests hold
the learners themselves against small cases."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from evenkeel.functions.vectors import argmax
from evenkeel.operators.features import tfidf_fit
from evenkeel.operators.joins import join_labels
from evenkeel.operators.metrics import score
from evenkeel.operators.models import (
    boosted,
    forest,
    kfold_ensemble,
    linear,
    oof_predict,
    run_models,
)
from evenkeel.operators.sampling import stratified_split
from evenkeel.queries.base import SQL_LABELED, Tables, query, r6
from evenkeel.queries.rebalancing import sql_folds, sql_split
from evenkeel.session import cut_lineage


def embeddings_as_features(t: Tables):
    wide = F.col("embedding").cast("array<double>")
    return t.embeddings.select("vec_id", "label", array_to_vector(wide).alias("features"))


def vectors(t: Tables):
    """Embeddings as features, split into a training and a held-out part."""
    rows = embeddings_as_features(t)
    split = cut_lineage(stratified_split(rows, "vec_id", "label", 0.2), partition_by="is_test")
    return split.where(~F.col("is_test")).drop("is_test"), split.where("is_test").drop("is_test")


def _scored(model, df):
    out = model(df)
    return out.select(
        "vec_id",
        "label",
        (argmax(F.col("probs")) == F.col("prediction")).alias("agrees"),
        F.size("probs").alias("classes"),
        F.round(F.aggregate("probs", F.lit(0.0), lambda a, x: a + x), 6).alias("p_total"),
    )


_SPLIT_SQL = sql_split("SELECT vec_id, label FROM embeddings", "vec_id", "label", "0.2")
_SCORED_SQL = f"SELECT vec_id, label, true AS agrees, 10 AS classes, 1.0::DOUBLE AS p_total FROM ({_SPLIT_SQL}) WHERE is_test"


@query("forest", _SCORED_SQL)
def _(spark, d):
    train, held = vectors(Tables(spark, d))
    return _scored(forest(trees=20, depth=6)(train), held)


@query("linear", _SCORED_SQL)
def _(spark, d):
    train, held = vectors(Tables(spark, d))
    return _scored(linear(iterations=30)(train), held)


@query("boosted", _SCORED_SQL)
def _(spark, d):
    train, held = vectors(Tables(spark, d))
    return _scored(boosted(10, rounds=4, depth=3)(train, held), held)


@query("oof_predict", f"SELECT *, true AS valid FROM ({sql_folds('SELECT vec_id, label FROM embeddings', 'vec_id', 'label', 3)})")
def _(spark, d):
    train, held = vectors(Tables(spark, d))
    out = oof_predict(train.unionByName(held), "vec_id", "label", 3, linear(iterations=15))
    return out.select("vec_id", "label", "fold", F.col("prediction").between(0, 9).alias("valid"))


@query("kfold_ensemble", f"SELECT vec_id, true AS valid, true AS likely FROM ({_SPLIT_SQL}) WHERE is_test")
def _(spark, d):
    train, held = vectors(Tables(spark, d))
    done = kfold_ensemble(train, held, "vec_id", "label", 2, linear(iterations=15))
    return done.predictions.select(
        "vec_id", F.col("prediction").between(0, 9).alias("valid"), F.array_max("probs").between(0.1, 1.0).alias("likely")
    )


@query("kfold_scores", "SELECT 2 AS folds, true AS valid")
def _(spark, d):
    rows = cut_lineage(embeddings_as_features(Tables(spark, d)))
    done = kfold_ensemble(rows, None, "vec_id", "label", 2, forest(trees=10, depth=4))
    return done.summary.select(F.col("folds").cast("int").alias("folds"), (F.col("mean").between(0, 1) & F.col("std").between(0, 1)).alias("valid"))


@query(
    "run_models",
    "SELECT * FROM (VALUES ('linear', true, NULL), ('forest', true, NULL), "
    "('broken', false, 'this model cannot be fitted')) t(model, scored, error)",
)
def _(spark, d):
    train, held = vectors(Tables(spark, d))

    def broken(_train, _valid):
        raise RuntimeError("this model cannot be fitted")

    result = run_models(
        train, held, {"linear": linear(iterations=10), "forest": forest(trees=8, depth=4), "broken": broken}
    )
    return result.table.select("model", F.coalesce(F.col("val_f1_macro").between(0, 1), F.lit(False)).alias("scored"), "error")


@query(
    "tfidf_features_linear",
    f"SELECT count(*) AS rows, true AS better FROM ({SQL_LABELED})",
)
def _(spark, d):
    t = Tables(spark, d)
    docs = join_labels(t.texts(), t.classes())
    features = tfidf_fit(docs, "message")
    rows = features.transform(docs).select("index", "label", "features")
    model = linear(iterations=15)(rows)
    out = score(model(rows))
    # on its own training rows a class-weighted head is better than a guess
    return out.select("rows", (F.col("f1_macro") > 0.25).alias("better"))


@query(
    "model_probabilities",
    f"SELECT vec_id, true AS agrees, 10 AS classes, 1.0::DOUBLE AS p_total FROM ({_SPLIT_SQL}) WHERE is_test",
)
def _(spark, d):
    train, held = vectors(Tables(spark, d))
    out = linear(iterations=10)(train)(held)
    return out.select(
        "vec_id",
        (argmax(F.col("probs")) == F.col("prediction")).alias("agrees"),
        F.size("probs").alias("classes"),
        r6(F.aggregate("probs", F.lit(0.0), lambda a, x: a + x)).alias("p_total"),
    )


@query("oof_coverage", sql_folds("SELECT vec_id, label FROM embeddings", "vec_id", "label", 3))
def _(spark, d):
    out = oof_predict(embeddings_as_features(Tables(spark, d)), "vec_id", "label", 3, forest(trees=3, depth=3))
    return out.where(F.size("probs") == 10).select("vec_id", "label", "fold")


@query(
    "ensemble_coverage",
    f"SELECT vec_id, 10 AS classes, 1.0::DOUBLE AS p_total FROM ({_SPLIT_SQL}) WHERE is_test",
)
def _(spark, d):
    train, held = vectors(Tables(spark, d))
    done = kfold_ensemble(train, held, "vec_id", "label", 2, forest(trees=3, depth=3))
    return done.predictions.where(F.col("prediction").between(0, 9)).select(
        "vec_id", F.size("probs").alias("classes"), r6(F.aggregate("probs", F.lit(0.0), lambda a, x: a + x)).alias("p_total")
    )
