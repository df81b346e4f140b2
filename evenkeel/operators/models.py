"""Estimators, fold ensembles, multiplier search, scoring.

An estimator here is a function ``(train, valid or None) -> Fitted``; a
:class:`Fitted` adds ``probs`` (array of class probabilities) and ``prediction``
to any DataFrame that has the feature column.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions.text import normalize_text, timestamp_text
from evenkeel.functions.vectors import apply_multipliers, argmax, label_weight
from evenkeel.operators.blocks import width_of
from evenkeel.operators.boosting import fit_soft_trees
from evenkeel.operators.epochs import fit_epochs
from evenkeel.operators.joins import fold_parts
from evenkeel.operators.metrics import cv_summary, score, score_counts, weights_map, with_sample_weights
from evenkeel.operators.sampling import SEED, stratified_folds
from evenkeel.session import count_by_label, cut_lineage

# Bytes of the rows that one task of a forest keeps and reads again.
FOREST_BYTES = 256 * 1024 * 1024


def in_threads(fn: Callable, items: Sequence, threads: int) -> list:
    """Start several Spark jobs side by side from driver threads."""
    if threads <= 1 or len(items) <= 1:
        return [fn(item) for item in items]
    with ThreadPool(min(threads, len(items))) as pool:
        return pool.map(inheritable_thread_target(fn), items)


def predict(df: DataFrame, model: Model, probs: str = "probs", prediction: str = "prediction") -> DataFrame:
    """Class probabilities as an array and the most probable class."""
    added = [model.getOrDefault(p) for p in ("rawPredictionCol", "probabilityCol", "predictionCol")] if model.hasParam(
        "probabilityCol"
    ) else ["rawPrediction", "probability", "prediction"]
    scored = model.transform(df)
    vector = vector_to_array(added[1])
    return (
        scored.withColumn("_p", vector)
        .drop(*added)
        .withColumn(probs, F.col("_p"))
        .withColumn(prediction, argmax(F.col("_p")))
        .drop("_p")
    )


@dataclass
class Fitted:
    """One multi-class model, one binary model per class, or a function that adds probabilities and prediction."""

    model: Model | None = None
    per_class: dict[int, Model | None] = field(default_factory=dict)
    n_classes: int = 0
    scorer: Callable[..., DataFrame] | None = None
    log: list[dict] = field(default_factory=list)

    def __call__(self, df: DataFrame, probs: str = "probs", prediction: str = "prediction") -> DataFrame:
        if self.scorer is not None:
            return self.scorer(df, probs, prediction)
        if self.model is not None:
            return predict(df, self.model, probs, prediction)
        kept = df.columns
        parts = []
        for c in range(self.n_classes):
            model = self.per_class.get(c)
            if model is None:
                parts.append(F.lit(0.0))
                continue
            df = model.transform(df).withColumn(f"_p{c}", F.get(vector_to_array(f"_prob{c}"), F.lit(1)))
            df = df.drop(f"_raw{c}", f"_prob{c}", f"_pred{c}")
            parts.append(F.col(f"_p{c}"))
        whole = reduce(lambda a, b: a + b, parts)
        share = [F.when(whole > 0, p / whole).otherwise(F.lit(1.0 / self.n_classes)) for p in parts]
        return df.select(*kept, F.array(*share).alias(probs)).withColumn(prediction, argmax(F.col(probs)))


Estimator = Callable[[DataFrame, "DataFrame | None"], Fitted]


def _weighted(train: DataFrame, label: str, balanced: bool) -> DataFrame:
    return with_sample_weights(train, label, "_weight") if balanced else train.withColumn("_weight", F.lit(1.0))


def _dealt(train: DataFrame, features: str) -> DataFrame:
    """Rows in so many tasks that what the forest keeps of one, an int per row and feature, is ``FOREST_BYTES`` at most."""
    rows = train.count()
    tasks = math.ceil(rows * 4 * width_of(train, features) / FOREST_BYTES)
    return train.repartition(tasks) if tasks > train.rdd.getNumPartitions() else train


def forest(
    features: str = "features",
    label: str = "label",
    trees: int = 500,
    depth: int = 20,
    balanced: bool = True,
    seed: int = SEED,
    **params,
) -> Estimator:
    """Random forest with balanced class weights.

    Spark's forest keeps rows with the bin of every feature, however sparse they are, and reads them once per group of
    nodes: a table is dealt into tasks by that size, not by the size of its files.
    """

    def fit(train: DataFrame, valid: DataFrame | None = None) -> Fitted:
        rows = _weighted(_dealt(train.select(features, label), features), label, balanced)
        return Fitted(
            RandomForestClassifier(
                featuresCol=features, labelCol=label, weightCol="_weight", numTrees=trees, maxDepth=depth, seed=seed, **params
            ).fit(rows.select(features, label, "_weight"))
        )

    return fit


def linear(
    features: str = "features",
    label: str = "label",
    weights: Mapping[int, float] | None = None,
    balanced: bool = True,
    l2: float = 0.01,
    iterations: int = 100,
    **params,
) -> Estimator:
    """A linear class head with class-weighted loss and L2 penalty."""
    def fit(train: DataFrame, valid: DataFrame | None = None) -> Fitted:
        if weights:
            train = train.withColumn("_weight", label_weight(F.col(label), weights))
        else:
            train = _weighted(train, label, balanced)
        return Fitted(
            LogisticRegression(
                featuresCol=features, labelCol=label, weightCol="_weight", family="multinomial",
                regParam=l2, elasticNetParam=0.0, maxIter=iterations, **params,
            ).fit(train.select(features, label, "_weight"))
        )

    return fit


def boosted(
    n_classes: int,
    features: str = "features",
    label: str = "label",
    rounds: int = 100,
    rate: float = 0.05,
    depth: int = 6,
    rows: float = 0.8,
    columns: float = 0.8,
    balanced: bool = True,
    tolerance: float = 0.01,
    seed: int = SEED,
    threads: int = 4,
) -> Estimator:
    """Boosted trees, one binary model per class, brought to a sum of one.

    With a validation part, boosting ends once its error no longer falls by
    ``tolerance``. A class without training rows has probability zero.
    """

    def fit(train: DataFrame, valid: DataFrame | None = None) -> Fitted:
        data = _weighted(train, label, balanced).select(features, label, "_weight", F.lit(False).alias("_valid"))
        if valid is not None:
            data = data.unionByName(
                valid.select(features, label, F.lit(1.0).alias("_weight"), F.lit(True).alias("_valid"))
            )
        data = data.persist()
        present = count_by_label(data.where(~F.col("_valid")), label)

        def one(c: int):
            if not present.get(c):
                return c, None
            learner = GBTClassifier(
                featuresCol=features, labelCol="_target", weightCol="_weight", maxIter=rounds, stepSize=rate,
                maxDepth=depth, subsamplingRate=rows, featureSubsetStrategy=str(columns), seed=seed,
            )
            learner = learner.setRawPredictionCol(f"_raw{c}").setProbabilityCol(f"_prob{c}").setPredictionCol(f"_pred{c}")
            if valid is not None:
                learner = learner.setParams(validationIndicatorCol="_valid", validationTol=tolerance)
            return c, learner.fit(data.withColumn("_target", (F.col(label) == c).cast("double")))

        try:
            models = dict(in_threads(one, range(n_classes), threads))
        finally:
            data.unpersist()
        return Fitted(per_class=models, n_classes=n_classes)

    return fit


def soft_trees(
    n_classes: int, features: str = "features", label: str = "label", balanced: bool = True, **params
) -> Estimator:
    """Boosted trees under one soft-probability objective, with patience on the validation loss.

    ``params`` are those of :func:`fit_soft_trees`.
    """

    def fit(train: DataFrame, valid: DataFrame | None = None) -> Fitted:
        model, log = fit_soft_trees(
            _weighted(train, label, balanced), valid, n_classes, features, label, weight="_weight", **params
        )
        return Fitted(n_classes=n_classes, scorer=model, log=[{"epoch": row["round"], **row} for row in log])

    return fit


def epoch_linear(n_classes: int, features: str = "features", label: str = "label", balanced: bool = True, **params) -> Estimator:
    """A linear class head trained epoch by epoch, with patience on the validation F1 and the best weights kept.

    ``params`` are those of :func:`fit_epochs`, ``loss`` among them.
    """

    def fit(train: DataFrame, valid: DataFrame | None = None) -> Fitted:
        weights = {"weights": weights_map(train, label)} if balanced and "weights" not in params else {}
        done = fit_epochs(train, valid, n_classes, features, label, **weights, **params)
        return Fitted(n_classes=n_classes, scorer=done.head, log=done.log)

    return fit


#: Columns of an epoch log; those that a learner does not report are null.
EPOCH_COLUMNS = ("train_loss", "train_acc", "val_loss", "val_acc", "val_f1_macro", "val_f1_weighted")


def epoch_log(spark: SparkSession, fitted: Mapping[str, Fitted], **settings) -> DataFrame:
    """Losses and scores per epoch of every model that reports them, with the settings of the run."""
    rows = []
    for name, model in fitted.items():
        found = model.log
        if isinstance(model.model, LogisticRegressionModel) and model.model.hasSummary:
            found = [{"epoch": i, "train_loss": float(x)} for i, x in enumerate(model.model.summary.objectiveHistory)]
        rows += [(name, row["epoch"], *[row.get(c) for c in EPOCH_COLUMNS]) for row in found]
    log = spark.createDataFrame(rows, ", ".join(["model_name string", "epoch int"] + [f"{c} double" for c in EPOCH_COLUMNS]))
    return log.withColumns({"timestamp": timestamp_text(), **{name: F.lit(v) for name, v in settings.items()}})


def with_folds(df: DataFrame, key: str, label: str, k: int, seed: int = SEED) -> DataFrame:
    """Assign folds and keep them in the shared folder, one part per fold.

    Every model reads the parts it trains on or scores, and no others.
    """
    return cut_lineage(stratified_folds(df, key, label, k, seed), partition_by="fold")


def fit_folds(
    folds: DataFrame, k: int, estimator: Estimator, prepare: Callable[[DataFrame], DataFrame] | None = None, threads: int = 2
) -> list[Fitted]:
    """One model per fold, trained on the other folds.

    ``prepare`` changes the training part only, for example by adding synthetic
    rows; the validation part stays as it is.
    """

    def one(i: int) -> Fitted:
        train, valid = fold_parts(folds, i)
        return estimator(prepare(train) if prepare else train, valid)

    return in_threads(one, range(k), threads)


def score_folds(folds: DataFrame, models: Sequence[Fitted]) -> DataFrame:
    """Each row scored by the model that did not see it in training."""
    parts = [model(folds.where(F.col("fold") == i)) for i, model in enumerate(models)]
    return reduce(lambda a, b: a.unionByName(b), parts)


def oof_predict(
    df: DataFrame, key: str, label: str, k: int, estimator: Estimator, seed: int = SEED, threads: int = 2
) -> DataFrame:
    """Out-of-fold ``probs`` and ``prediction`` for every row."""
    folds = with_folds(df, key, label, k, seed)
    return score_folds(folds, fit_folds(folds, k, estimator, threads=threads))


def vote(df: DataFrame, models: Sequence[Fitted], multipliers: Sequence[float] | None = None) -> DataFrame:
    """Mean of the probabilities of several models, row by row.

    Every model scores the same rows, so their probabilities become columns and
    are averaged in place; nothing is shuffled.
    """
    kept = df.columns
    names = [f"_vote{i}" for i in range(len(models))]
    for name, model in zip(names, models):
        df = model(df, probs=name, prediction="_one").drop("_one")
    mean = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), [F.col(n) for n in names])
    out = df.select(*kept, F.transform(mean, lambda p: p / float(len(models))).alias("probs"))
    chosen = F.col("probs") if multipliers is None else apply_multipliers(F.col("probs"), multipliers)
    return out.withColumn("prediction", argmax(chosen))


@dataclass
class Ensemble:
    models: list[Fitted]
    oof: DataFrame
    fold_scores: DataFrame
    summary: DataFrame
    predictions: DataFrame | None


def kfold_ensemble(
    train: DataFrame,
    test: DataFrame | None,
    key: str,
    label: str,
    k: int,
    estimator: Estimator,
    seed: int = SEED,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    threads: int = 2,
) -> Ensemble:
    """Stratified folds, one model each, scores per fold, mean vote on the test set."""
    folds = with_folds(train, key, label, k, seed)
    models = fit_folds(folds, k, estimator, prepare, threads)
    oof = score_folds(folds, models)
    fold_scores = score(oof, label, "prediction", by=("fold",))
    return Ensemble(
        models=models,
        oof=oof,
        fold_scores=fold_scores,
        summary=cv_summary(fold_scores),
        predictions=None if test is None else vote(test, models),
    )


def kfold_in_one_pass(
    train: DataFrame, test: DataFrame | None, key: str, label: str, k: int, n_classes: int, seed: int = SEED, **params
) -> Ensemble:
    """As :func:`kfold_ensemble` for linear heads, with the models of all folds fed by the same passes over the rows.

    Each pass reads every row once and adds it to the gradients of the folds that train on it; each row is scored once,
    by the head that did not see it. ``params`` are those of :func:`fit_epochs`.
    """
    folds = with_folds(train, key, label, k, seed)
    done = fit_epochs(folds, None, n_classes, label=label, fold="fold", folds=k, seed=seed, **params)
    models = [
        Fitted(n_classes=n_classes, scorer=done.single(m), log=[row for row in done.log if row["model"] == m]) for m in range(k)
    ]
    oof = done.head(folds)
    fold_scores = score(oof, label, "prediction", by=("fold",))
    return Ensemble(models, oof, fold_scores, cv_summary(fold_scores), None if test is None else vote(test, models))


def multiplier_scores(
    df: DataFrame, candidates: Sequence[Sequence[float]], label: str = "label", probs: str = "probs"
) -> DataFrame:
    """Macro F1 of each candidate vector of class multipliers.

    The candidates are a literal of the plan. Each row is classified under all
    of them in place, and only confusion counts per candidate are shuffled.
    """
    table = F.array(*[F.array(*[F.lit(float(m)) for m in c]) for c in candidates])
    classes = F.transform(table, lambda m: argmax(F.zip_with(F.col(probs), m, lambda p, w: p * w)))
    counts = (
        df.select(F.col(label).alias("y_true"), F.posexplode_outer(classes).alias("candidate", "y_pred"))
        .groupBy("candidate", "y_true", "y_pred")
        .agg(F.count("*").alias("n"))
    )
    return score_counts(counts, ("candidate",)).select("candidate", "f1_macro", "accuracy")


def tune_multipliers(
    df: DataFrame,
    n_classes: int,
    label: str = "label",
    probs: str = "probs",
    factors: Sequence[float] = (0.5, 0.7, 0.85, 0.95, 1.05, 1.2, 1.5, 2.0),
    rounds: int = 10,
) -> tuple[list[float], float, float]:
    """Class multipliers that raise macro F1 on out-of-fold rows.

    Coordinate search from all ones: each round tries every factor on every
    class in one job and keeps the best strict improvement, so the result is
    never worse than the plain argmax. Gives back the multipliers, their macro
    F1 and that of the argmax.
    """
    slim = df.select(label, probs).persist()
    try:
        best, best_f1, base_f1 = [1.0] * n_classes, None, None
        for _ in range(rounds):
            tries = [best] + [
                [m * f if c == i else m for i, m in enumerate(best)] for c in range(n_classes) for f in factors
            ]
            # one row per candidate; rounded, so that equal scores tie however they were added up
            scores = multiplier_scores(slim, tries, label, probs).collect()
            found = {r["candidate"]: round(r["f1_macro"], 12) for r in scores}
            if best_f1 is None:
                best_f1 = base_f1 = found[0]
            top = min(found, key=lambda c: (-found[c], c))
            if found[top] <= best_f1:
                break
            best, best_f1 = tries[top], found[top]
        return best, best_f1, base_f1
    finally:
        slim.unpersist()


def score_batch(
    df: DataFrame,
    model: str | PipelineModel,
    text: str = "message",
    key: str = "index",
    normalize: bool = True,
) -> DataFrame:
    """Normalise texts and score them with a saved model: ``(key, probs, prediction)``."""
    if isinstance(model, str):
        model = PipelineModel.load(model)
    if normalize:
        df = df.withColumn(text, normalize_text(F.col(text)))
    scored = model.transform(df)
    return scored.select(key, vector_to_array("probability").alias("probs")).withColumn(
        "prediction", argmax(F.col("probs"))
    )


@dataclass
class Comparison:
    table: DataFrame
    fitted: dict[str, Fitted]
    best: str | None


def run_models(
    train: DataFrame,
    val: DataFrame,
    estimators: Mapping[str, Estimator],
    label: str = "label",
    test: DataFrame | None = None,
) -> Comparison:
    """Fit every estimator, score it on the validation (and test) part, compare.

    An estimator that fails becomes a row with its error, and the others go on.
    """
    rows, fitted = [], {}
    names = ("f1_macro", "f1_weighted", "accuracy", "precision_macro", "recall_macro")
    for name, estimator in estimators.items():
        try:
            model = estimator(train, val)
            row = [name]
            for part in (val, test):
                got = score(model(part), label).head() if part is not None and label in part.columns else None
                row += [got[m] if got else None for m in names]
            rows.append((*row, None))
            fitted[name] = model
        except Exception as err:
            rows.append((name, *[None] * (2 * len(names)), str(err).splitlines()[0]))
    schema = ", ".join(
        ["model string"] + [f"val_{m} double" for m in names] + [f"test_{m} double" for m in names] + ["error string"]
    )
    table = train.sparkSession.createDataFrame(rows, schema).orderBy(F.col("val_f1_macro").desc_nulls_last(), "model")
    done = [r for r in rows if r[0] in fitted and r[1] is not None]
    best = min(done, key=lambda r: (-r[1], r[0]))[0] if done else None
    return Comparison(table, fitted, best)
