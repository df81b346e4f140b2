"""Whole training jobs: baseline, folds, ensembles, comparison, batch scoring.

All of them take ``(index, message, label)`` and give back predictions
``(index, label)`` with scores and a log row; nothing is written unless a path
is given.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions.text import timestamp_text
from evenkeel.operators.epochs import log_table
from evenkeel.operators.features import embed, tfidf_fit
from evenkeel.operators.metrics import classification_report, class_weights, score
from evenkeel.operators.models import (
    Comparison,
    Estimator,
    Fitted,
    epoch_log,
    forest,
    kfold_ensemble,
    kfold_in_one_pass,
    linear,
    run_models,
    score_batch,
    soft_trees,
    tune_multipliers,
    vote,
)
from evenkeel.operators.sampling import SEED, stratified_split
from evenkeel.operators.simplex import simplex_multipliers
from evenkeel.operators.smote import smote
from evenkeel.plans.prepare import clean_messages
from evenkeel.session import cut_lineage
from evenkeel.sources.runlogs import append_log, overwrite_log, summary_table, write_summary
from evenkeel.sources.tables import LABEL, read_table, write_predictions


@dataclass
class Run:
    """What a training job leaves behind."""

    predictions: DataFrame
    log: DataFrame
    report: DataFrame | None = None
    scores: DataFrame | None = None
    multipliers: list[float] | None = None
    probs: DataFrame | None = None

    def save(self, predictions_path: str | None = None, log_path: str | None = None) -> "Run":
        if predictions_path:
            write_predictions(self.predictions, predictions_path)
        if log_path:
            append_log(self.log, log_path)
        return self


def log_row(
    spark: SparkSession,
    model: str,
    f1_macro: float | None,
    f1_weighted: float | None = None,
    accuracy: float | None = None,
    **settings,
) -> DataFrame:
    """One row for the run log, with the settings that were in fact used."""
    row = spark.createDataFrame(
        [(model, accuracy, f1_macro, f1_weighted)],
        "model_name string, val_acc double, val_f1_macro double, val_f1_weighted double",
    ).withColumn("timestamp", timestamp_text())
    for name, value in settings.items():
        row = row.withColumn(name, F.lit(value))
    return row


def _labels(scored: DataFrame) -> DataFrame:
    return scored.select("index", F.col("prediction").alias("label"))


def with_embeddings(df: DataFrame, encoder: Callable | None = None, dim: int = 256, text: str = "message") -> DataFrame:
    """Texts with their vector as ML features, computed once and kept."""
    return cut_lineage(embed(df, text, encoder, dim)).withColumn("features", array_to_vector("vec"))


def _cleaned(df: DataFrame, lower: bool = False) -> DataFrame:
    """Training texts cleaned once and stored: the vocabulary and the features read them several times."""
    return cut_lineage(clean_messages(df, lower))


def _stored(features: PipelineModel, df: DataFrame) -> DataFrame:
    """Features of a table, made once: a learner passes over them several times."""
    names = [c for c in ("index", "label") if c in df.columns]
    return cut_lineage(features.transform(df).select(*names, "features"))


def tfidf_forest(
    train: DataFrame,
    test: DataFrame,
    trees: int = 500,
    depth: int = 30,
    test_size: float = 0.1,
    max_features: int = 10_000,
    seed: int = SEED,
    lower: bool = False,
) -> Run:
    """TF-IDF and a forest: scored on a hold-out part, then fitted on all rows.

    The vocabulary of the scored model comes from the training part only.
    """
    train, test = _cleaned(train, lower), clean_messages(test, lower)
    split = cut_lineage(stratified_split(train, "index", "label", test_size, seed), partition_by="is_test")
    part, held = split.where(~F.col("is_test")), split.where("is_test")
    fit = forest(trees=trees, depth=depth, seed=seed)
    features = tfidf_fit(part, "message", max_features=max_features)
    checked = cut_lineage(fit(_stored(features, part))(features.transform(held)).select("index", "label", "prediction"))
    scores = score(checked)
    features = tfidf_fit(train, "message", max_features=max_features)
    model = fit(_stored(features, train))
    got = scores.head()
    return Run(
        predictions=_labels(model(features.transform(test))),
        log=log_row(train.sparkSession, "tfidf-forest", got.f1_macro, got.f1_weighted, got.accuracy, trees=trees, depth=depth),
        report=classification_report(checked),
        scores=scores,
    )


def embedding_forest(
    train: DataFrame, test: DataFrame, encoder: Callable | None = None, trees: int = 300, depth: int = 20, dim: int = 256, seed: int = SEED
) -> Run:
    """Embeddings and a forest, reported on its own training rows."""
    rows, unseen = with_embeddings(train, encoder, dim), with_embeddings(test, encoder, dim)
    model = forest(trees=trees, depth=depth, seed=seed)(rows)
    checked = model(rows).select("index", "label", "prediction")
    scores = score(checked)
    got = scores.head()
    return Run(
        predictions=_labels(model(unseen)),
        log=log_row(train.sparkSession, "embedding-forest", got.f1_macro, got.f1_weighted, got.accuracy, trees=trees, depth=depth),
        report=classification_report(checked),
        scores=scores,
    )


def _folds_run(name: str, rows: DataFrame, unseen: DataFrame, k: int, estimator: Estimator, seed: int, tune: bool, prepare=None) -> Run:
    rows = rows.select(*[c for c in ("index", "label", "features", "vec") if c in rows.columns])
    done = kfold_ensemble(rows, unseen, "index", "label", k, estimator, seed, prepare)
    oof = cut_lineage(done.oof.select("index", "label", "fold", "probs", "prediction"))
    scores = score(oof, by=("fold",))
    mean = scores.agg(F.avg("f1_macro")).head()[0]
    multipliers = None
    predictions = done.predictions
    if tune:
        multipliers, mean, _ = tune_multipliers(oof, len(oof.select("probs").head()[0]))
        predictions = vote(unseen, done.models, multipliers)
    return Run(
        predictions=_labels(predictions),
        log=log_row(rows.sparkSession, name, mean, folds=k),
        scores=scores,
        multipliers=multipliers,
    )


def tfidf_folds(
    train: DataFrame, test: DataFrame, k: int = 5, estimator: Estimator | None = None, max_features: int = 10_000, seed: int = SEED, tune: bool = False
) -> Run:
    """Folds of a class-weighted linear head with a soft vote on the test set.

    With ``tune``, class multipliers are searched on the out-of-fold rows and
    applied to the vote.
    """
    train, test = _cleaned(train), clean_messages(test)
    features = tfidf_fit(train, "message", max_features=max_features)
    rows, unseen = features.transform(train), features.transform(test)
    return _folds_run("tfidf-folds", rows, unseen, k, estimator or linear(), seed, tune)


def tfidf_heads(
    train: DataFrame,
    test: DataFrame,
    n_classes: int,
    k: int = 5,
    max_features: int = 10_000,
    seed: int = SEED,
    tune: bool = False,
    **params,
) -> Run:
    """As :func:`tfidf_folds`, with the heads of all folds trained epoch by epoch in the same passes over the rows.

    With ``tune``, a simplex searches class multipliers on the out-of-fold rows. The log has one row per fold and epoch.
    ``params`` are those of :func:`evenkeel.operators.epochs.fit_epochs`.
    """
    train, test = _cleaned(train), clean_messages(test)
    features = tfidf_fit(train, "message", max_features=max_features)
    rows = features.transform(train).select("index", "label", "features")
    unseen = features.transform(test)
    done = kfold_in_one_pass(rows, None, "index", "label", k, n_classes, seed, **params)
    oof = cut_lineage(done.oof.select("index", "label", "fold", "probs", "prediction"))
    multipliers = simplex_multipliers(oof, n_classes)[0] if tune else None
    voted = vote(unseen, done.models, multipliers)
    log = log_table(train.sparkSession, [row for model in done.models for row in model.log], model_name="tfidf-heads")
    return Run(
        predictions=_labels(voted), log=log.withColumn("timestamp", timestamp_text()), scores=score(oof, by=("fold",)),
        multipliers=multipliers, probs=voted.select("index", "probs", "prediction"),
    )


def boosted_folds(
    train: DataFrame,
    test: DataFrame,
    n_classes: int,
    k: int = 5,
    encoder: Callable | None = None,
    dim: int = 256,
    seed: int = SEED,
    smote_target: int | None = None,
    **params,
) -> Run:
    """Embeddings and boosted trees of all classes at once in folds, averaged on the test set.

    ``params`` are those of :func:`evenkeel.operators.boosting.fit_soft_trees`; ``patience`` looks at the held-out fold.

    With ``smote_target`` the training part of each fold is brought to that many
    rows per class, else rows are weighted by class. Validation rows are never
    resampled.
    """
    rows, unseen = with_embeddings(train, encoder, dim), with_embeddings(test, encoder, dim)
    fit = soft_trees(n_classes, balanced=smote_target is None, key="index", seed=seed, **params)

    def resample(part: DataFrame) -> DataFrame:
        made = smote(part, "index", "label", "vec", smote_target, seed=seed)
        return cut_lineage(made).withColumn("features", array_to_vector("vec"))

    name = "boosted-folds" if smote_target is None else "smote-boosted-folds"
    return _folds_run(name, rows, unseen, k, fit, seed, False, resample if smote_target else None)


def merged_linear(train: DataFrame, test: DataFrame, max_features: int = 10_000, **params) -> Run:
    """A class-weighted linear head on all labelled rows, without validation."""
    train, test = _cleaned(train), clean_messages(test)
    features = tfidf_fit(train, "message", max_features=max_features)
    rows = _stored(features, train)
    model = linear(**params)(rows)
    acc = model(rows).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).head()[0]
    return Run(
        predictions=_labels(model(features.transform(test))),
        log=log_row(train.sparkSession, "merged-linear", None, None, None, train_acc=acc),
        scores=class_weights(train),
    )


def compare(
    train: DataFrame,
    val: DataFrame,
    estimators: Mapping[str, Estimator],
    test: DataFrame | None = None,
    max_features: int = 10_000,
    directory: str | None = None,
    config: Mapping[str, object] | None = None,
) -> tuple[Comparison, Callable[[DataFrame], DataFrame]]:
    """Fit every model, score on validation (and labelled test) rows, rank them.

    Gives back the comparison and a function that predicts with the best model.
    With ``directory``, the comparison table, the run summary and the epoch log are
    written.
    """
    train, val = _cleaned(train), clean_messages(val)
    features = tfidf_fit(train, "message", max_features=max_features)
    seen = None if test is None else _stored(features, clean_messages(test))
    result = run_models(_stored(features, train), _stored(features, val), estimators, test=seen)
    if directory:
        ok = result.table.where(F.col("error").isNull())
        table = ok.select(
            F.col("model").alias("Model"), F.col("val_f1_macro").alias("F1 (Macro)"), F.col("val_f1_weighted").alias("F1 (Weighted)")
        )
        overwrite_log(table, f"{directory}/model_comparison")
        settings = dict(config or {"max_features": max_features})
        write_summary(summary_table(table, settings), f"{directory}/training_summary")
        overwrite_log(epoch_log(train.sparkSession, result.fitted, **settings), f"{directory}/training_log")

    def predict_best(df: DataFrame) -> DataFrame:
        if result.best is None:
            raise ValueError("no model was fitted")
        best: Fitted = result.fitted[result.best]
        return _labels(best(features.transform(clean_messages(df))))

    return result, predict_best


def fit_text_model(train: DataFrame, path: str, max_features: int = 10_000, **params) -> PipelineModel:
    """Fit TF-IDF and the linear head and save them as one model."""
    train = _cleaned(train)
    features = tfidf_fit(train, "message", max_features=max_features)
    head = linear(**params)(_stored(features, train)).model
    model = PipelineModel([*features.stages, head])
    model.write().overwrite().save(path)
    return model


def batch_inference(test: DataFrame, model_path: str, output: str | None = None, compress: bool = True) -> DataFrame:
    """Score texts with a saved model and write ``(index, label)``."""
    scored = score_batch(test, model_path)
    out = _labels(scored)
    if output:
        write_predictions(out, output, compression="gzip" if compress else None)
        # what was written is read back, not scored again
        return read_table(test.sparkSession, output, LABEL, multi_line=False)
    return out
