"""Trainers with a state of their own against plain versions."""

import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F

from evenkeel.operators import boosting, epochs
from evenkeel.operators.blocks import RowBlock, feature_parts
from evenkeel.operators.models import epoch_linear, epoch_log, kfold_in_one_pass, run_models, soft_trees

RNG = np.random.default_rng(11)
K, WIDTH = 3, 5
LABELS = np.arange(150) % K
X = np.round(RNG.normal(0, 1, (150, WIDTH)) + 0.8 * np.eye(K, WIDTH)[LABELS], 4)


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, int(LABELS[i]), i % 4, [float(x) for x in X[i]]) for i in range(150)]
    return spark.createDataFrame(data, "id int, label int, fold int, features array<double>").repartition(3)


def sparse(df):
    """The same features as sparse vectors, every third row dense."""
    made = F.udf(lambda i, v: Vectors.dense(v) if i % 3 == 0 else Vectors.sparse(WIDTH, [(j, x) for j, x in enumerate(v) if x]), VectorUDT())
    return df.withColumn("features", made("id", "features"))


# --- a plain epoch trainer ---------------------------------------------------


def plain_probs(z):
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def numeric_slope(loss, z, y, w):
    """Gradient by differences, one margin at a time."""
    out = np.zeros_like(z)
    for i in range(z.shape[0]):
        for k in range(z.shape[1]):
            up, down = z.copy(), z.copy()
            up[i, k] += 1e-6
            down[i, k] -= 1e-6
            out[i, k] = (loss(up, y, w)[0][i] - loss(down, y, w)[0][i]) / 2e-6
    return out


@pytest.mark.parametrize("loss", [epochs.cross_entropy_loss, epochs.focal_loss_of(2.0), epochs.focal_loss_of(0.5), epochs.focal_loss_of(0.0)])
def test_losses(loss):
    z, y, w = RNG.normal(0, 2, (12, 4)), np.arange(12) % 4, RNG.uniform(0.5, 2, 12)
    value, slope, share = loss(z, y, w)
    assert np.allclose(slope, numeric_slope(loss, z, y, w), atol=1e-6) and share.shape == (12,)
    ce = -w * np.log(plain_probs(z)[np.arange(12), y])
    if loss is epochs.cross_entropy_loss:
        assert np.allclose(value, ce) and np.allclose(share, w)
    sure = np.array([[800.0, 0.0, 0.0, 0.0]])
    assert all(np.isfinite(a).all() for a in loss(sure, np.array([0]), np.ones(1)) + loss(sure, np.array([1]), np.ones(1)))


def plain_epochs(x, y, part, heads, weights, loss, n_epochs, rate, schedule, kind, decay, patience):
    """Each head by itself, full batches."""
    out = []
    for m in range(heads):
        w, b = np.zeros((x.shape[1], K)), np.zeros(K)
        moments, best, waited, kept, log = [np.zeros_like(w), np.zeros_like(b), np.zeros_like(w), np.zeros_like(b)], 0.0, 0, None, []
        tr, va = part != m, part == m
        cw = np.array([weights.get(int(c), 1.0) for c in y])
        for e in range(n_epochs):
            now = rate * (1 - e / n_epochs) if schedule == "linear" else rate
            z = x[tr] @ w + b
            value, slope, share = loss(z, y[tr], cw[tr])
            gw, gb = x[tr].T @ slope / share.sum(), slope.sum(0) / share.sum()
            acc = (z.argmax(1) == y[tr]).mean()
            if kind == "adamw":
                for i, g in ((0, gw), (1, gb)):
                    moments[i] = 0.9 * moments[i] + 0.1 * g
                    moments[i + 2] = 0.999 * moments[i + 2] + 0.001 * g * g
                gw, gb = (moments[i] / (1 - 0.9 ** (e + 1)) / (np.sqrt(moments[i + 2] / (1 - 0.999 ** (e + 1))) + 1e-8) for i in (0, 1))
            w, b = w * (1 - now * decay) - now * gw, b - now * gb
            zv = x[va] @ w + b
            lv, _, sv = loss(zv, y[va], cw[va])
            said = zv.argmax(1)
            f1 = []
            for c in sorted(set(y[va]) | set(said)):
                tp = ((said == c) & (y[va] == c)).sum()
                f1.append(2 * tp / ((said == c).sum() + (y[va] == c).sum()))
            macro = float(np.mean(f1))
            if macro > best:
                best, waited, kept = macro, 0, (w.copy(), b.copy())
            else:
                waited += 1
            log.append((e + 1, value.sum() / share.sum(), acc, lv.sum() / sv.sum(), (said == y[va]).mean(), macro))
            if waited >= patience:
                break
        out.append((kept or (w, b), log))
    return out


@pytest.mark.parametrize("settings", [
    dict(rate=0.5, schedule="constant", optimiser="sgd", decay=0.0, patience=2, epochs=12),
    dict(rate=0.05, schedule="linear", optimiser="adamw", decay=0.1, patience=3, epochs=6),
])
@pytest.mark.parametrize("focal", [False, True])
@pytest.mark.parametrize("kind", ["array", "vector"])
def test_epochs_equal_plain_version(rows, settings, focal, kind):
    loss = epochs.focal_loss_of(2.0) if focal else epochs.cross_entropy_loss
    weights = {0: 2.0, 2: 0.5}
    df = sparse(rows) if kind == "vector" else rows
    done = epochs.fit_epochs(df, None, K, loss=loss, weights=weights, fold="fold", folds=4, **settings)
    s = settings
    want = plain_epochs(X, LABELS, np.arange(150) % 4, 4, weights, loss, s["epochs"], s["rate"], s["schedule"], s["optimiser"], s["decay"], s["patience"])
    for m, ((w, b), log) in enumerate(want):
        assert np.allclose(done.head.weights[:, m], w, atol=1e-9) and np.allclose(done.head.bias[m], b, atol=1e-9)
        got = [(r["epoch"], r["train_loss"], r["train_acc"], r["val_loss"], r["val_acc"], r["val_f1_macro"]) for r in done.log if r["model"] == m]
        assert np.allclose(got, log, atol=1e-9)
    scored = {r.id: r for r in done.head(df).collect()}
    for i in range(150):
        (w, b), _ = want[i % 4]
        assert np.allclose(scored[i].probs, plain_probs((X[i] @ w + b)[None])[0], atol=1e-9)
        assert scored[i].prediction == int(np.argmax(scored[i].probs))


def test_one_head_and_batches(rows):
    train, valid = rows.where("fold > 0"), rows.where("fold = 0")
    done = epochs.fit_epochs(train, valid, K, rate=0.3, schedule="constant", optimiser="sgd", decay=0.0, epochs=1)
    folds = epochs.fit_epochs(rows, None, K, rate=0.3, schedule="constant", optimiser="sgd", decay=0.0, epochs=1, fold="fold", folds=4)
    assert np.allclose(done.head.weights[:, 0], folds.head.weights[:, 0], atol=1e-12)
    many = epochs.fit_epochs(train, valid, K, rate=0.3, epochs=8, batches=4, key="id")
    assert many.log[-1]["train_loss"] < many.log[0]["train_loss"] and max(r["val_f1_macro"] for r in many.log) > 0.5
    with pytest.raises(ValueError):
        epochs.fit_epochs(train, valid, K, batches=2)
    # nothing held out: the last weights stay, nothing stops
    alone = epochs.fit_epochs(train, None, K, rate=0.3, schedule="constant", optimiser="sgd", decay=0.0, epochs=1)
    assert alone.log[0]["val_loss"] is None and np.allclose(alone.head.weights, done.head.weights)


def test_rows_that_take_no_part(spark, rows):
    odd = spark.createDataFrame([(900, None, 0, [1.0] * 5), (901, 7, 1, [1.0] * 5), (902, 1, 2, None)], rows.schema)
    a = epochs.fit_epochs(rows, None, K, fold="fold", folds=4, epochs=2)
    b = epochs.fit_epochs(rows.union(odd), None, K, fold="fold", folds=4, epochs=2)
    assert np.allclose(a.head.weights, b.head.weights)
    assert {r.id: r.probs for r in b.head(odd).collect()}[902] is None
    empty = epochs.fit_epochs(rows.limit(0), None, K, epochs=2)
    assert empty.head.weights.shape == (0, 1, K) and len(empty.log) == 2


def test_a_callers_loss(rows):
    """Only the first class counts: a loss that no learner of Spark's has."""

    def only_first(margins, labels, weights):
        ce, slope, share = epochs.cross_entropy_loss(margins, labels, weights)
        own = (labels == 0).astype(float)
        return ce * own, slope * own[:, None], share * own

    own = epoch_linear(K, balanced=False, loss=only_first, epochs=10, rate=0.5)(rows, None)
    weighed = epochs.fit_epochs(rows, None, K, weights={1: 0.0, 2: 0.0}, epochs=10, rate=0.5)
    assert np.allclose(own.scorer.weights, weighed.head.weights) and {r.prediction for r in own(rows.where("label = 0")).collect()} == {0}


def test_kfold_in_one_pass(rows):
    done = kfold_in_one_pass(rows, rows, "id", "label", 3, K, epochs=5, rate=0.3)
    assert done.oof.count() == 150 and done.fold_scores.count() == 3 and done.summary.head()["mean"] > 0.5
    mean = {}
    for model in done.models:
        for r in model(rows).collect():
            mean[r.id] = mean.get(r.id, 0) + np.array(r.probs) / 3
    assert all(np.allclose(mean[r.id], r.probs) for r in done.predictions.collect())


# --- a plain booster ---------------------------------------------------------


def plain_trees(x, y, w, held, edges, n, rate, depth, l2, least_weight, patience=None):
    """Row by row and node by node."""
    z, models, losses = np.zeros((len(y), K)), [], []
    for _ in range(n):
        p = plain_probs(z)
        slopes, curves = (p - np.eye(K)[y]) * w[:, None], np.maximum(2 * p * (1 - p), 1e-16) * w[:, None]
        trees = []
        for k in range(K):
            def split(members, level, k=k):
                g, h = slopes[members, k].sum(), curves[members, k].sum()
                best = None
                if level < depth:
                    for f in range(x.shape[1]):
                        for border in edges[f]:
                            left = [i for i in members if x[i, f] < border]
                            gl, hl = slopes[left, k].sum(), curves[left, k].sum()
                            if hl < least_weight or h - hl < least_weight:
                                continue
                            gain = gl**2 / (hl + l2) + (g - gl) ** 2 / (h - hl + l2) - g**2 / (h + l2)
                            if gain > 1e-12 and (best is None or gain > best[0] + 1e-12):
                                best = (gain, f, border, left)
                if best is None:
                    return -rate * g / (h + l2)
                _, f, border, left = best
                rest = sorted(set(members) - set(left))
                return f, border, split(left, level + 1), split(rest, level + 1)

            trees.append(split([i for i in range(len(y)) if not held[i]], 0))
        models.append(trees)

        def value(tree, row):
            while isinstance(tree, tuple):
                f, border, low, high = tree
                tree = low if row[f] < border else high
            return tree

        z = z + np.array([[value(t, row) for t in trees] for row in x])
        p = plain_probs(z)[np.arange(len(y)), y]
        losses.append((-(np.log(p) * w)[~held].sum() / w[~held].sum(), -(np.log(p) * w)[held].sum() / w[held].sum()))
        best_at = int(np.argmin([v for _, v in losses]))
        if patience and len(losses) - 1 - best_at >= patience:
            return losses, sum(np.array([[value(t, row) for t in trees] for row in x]) for trees in models[: best_at + 1])
    return losses, z


EDGES = [[-1.0, -0.5, 0.0, 0.5, 1.0]] * 4 + [[0.25]]


@pytest.mark.parametrize(("depth", "cells"), [(1, 1 << 23), (3, 1 << 23), (3, 100)])
def test_trees_equal_plain_version(rows, depth, cells, monkeypatch):
    monkeypatch.setattr(boosting, "CELLS", cells)
    monkeypatch.setattr(boosting, "CUT_ROUNDS", 2)
    weight = np.where(LABELS == 1, 2.0, 1.0)
    held = np.arange(150) % 4 == 0
    data = rows.withColumn("w", F.when(F.col("label") == 1, 2.0).otherwise(1.0))
    model, log = boosting.fit_soft_trees(
        data.where("fold > 0"), data.where("fold = 0").withColumn("w", F.lit(9.0)), K, weight="w", edges=EDGES,
        rounds=3, rate=0.3, depth=depth, rows=1.0, columns=1.0, least_weight=1.0,
    )
    losses, z = plain_trees(X, LABELS, np.where(held, 1.0, weight), held, EDGES, 3, 0.3, depth, 1.0, 1.0)
    assert np.allclose([(r["train_loss"], r["val_loss"]) for r in log], losses, atol=1e-9)
    got = {r.id: r for r in model(sparse(rows)).collect()}
    for i in range(150):
        assert np.allclose(got[i].probs, plain_probs(z[i : i + 1])[0], atol=1e-9)
        assert got[i].prediction == int(np.argmax(got[i].probs))


def test_patience(rows):
    held = np.arange(150) % 4 == 0
    losses, z = plain_trees(X, LABELS, np.ones(150), held, EDGES, 30, 2.0, 2, 0.1, 0.1, patience=2)
    model, log = boosting.fit_soft_trees(
        rows.where("fold > 0"), rows.where("fold = 0"), K, edges=EDGES, rounds=30, rate=2.0, depth=2, rows=1.0, columns=1.0,
        l2=0.1, least_weight=0.1, patience=2,
    )
    assert 2 < len(log) == len(losses) < 30 and len(model.rounds) == len(log) - 2
    got = {r.id: r.probs for r in model(rows).collect()}
    assert all(np.allclose(got[i], plain_probs(z[i : i + 1])[0], atol=1e-9) for i in range(150))


def test_samples_of_rows_and_columns(rows):
    model, log = boosting.fit_soft_trees(rows, None, K, key="id", rounds=6, rate=0.3, depth=2, rows=0.5, columns=0.4, bins=8)
    same, again = boosting.fit_soft_trees(rows.repartition(7), None, K, key="id", rounds=6, rate=0.3, depth=2, rows=0.5, columns=0.4, bins=8)
    assert all(math.isclose(a["train_loss"], b["train_loss"]) for a, b in zip(log, again))
    assert log[-1]["train_loss"] < log[0]["train_loss"] and log[0]["val_loss"] is None
    marks = np.arange(10_000, dtype=np.int64) * 7_777_777
    drawn = boosting._drawn(marks, 3, 42, 0.3)
    assert 0.27 < drawn.mean() < 0.33 and (drawn != boosting._drawn(marks, 4, 42, 0.3)).any()


def test_odd_values(spark):
    nan = float("nan")
    data = [(i, i % 2, [float(i % 2), nan if i % 3 else 0.5]) for i in range(40)] + [(90, None, [0.0, 0.0]), (91, 0, None), (92, 5, [1.0, 1.0])]
    df = spark.createDataFrame(data, "id int, label int, features array<double>")
    model, log = boosting.fit_soft_trees(df, None, 2, rounds=3, rate=0.5, depth=2, rows=1.0, columns=1.0, bins=4)
    got = {r.id: r for r in model(df).collect()}
    assert all(got[i].prediction == i % 2 for i in range(40)) and got[91].probs is None
    none, log = boosting.fit_soft_trees(df.limit(0), None, 2, rounds=3)
    assert log == [] and none.rounds == []


def test_estimators_and_their_log(spark, rows):
    train, valid = rows.where("fold > 0"), rows.where("fold = 0")
    result = run_models(train, valid, {
        "trees": soft_trees(K, rounds=3, rate=0.3, depth=2, patience=2, key="id"), "head": epoch_linear(K, epochs=4, rate=0.3),
    })
    assert all(r.error is None and r.val_f1_macro > 0.4 for r in result.table.collect())
    log = {(r.model_name, r.epoch): r for r in epoch_log(spark, result.fitted, batch_size=1).collect()}
    assert {n for n, _ in log} == {"trees", "head"} and all(r.val_loss is not None for r in log.values())
    best = max(r.val_f1_macro for (n, _), r in log.items() if n == "head")
    assert math.isclose(best, {r.model: r.val_f1_macro for r in result.table.collect()}["head"])


def test_blocks(spark):
    rows = [(0, Vectors.sparse(4, [1, 3], [1.0, 2.0])), (1, Vectors.dense([1.0, 2.0, 3.0, 4.0])), (2, Vectors.sparse(4, [], []))]
    df = spark.createDataFrame(rows, ["i", "features"]).coalesce(1).orderBy("i")
    indices, values = feature_parts(df, "features")
    table = df.select(indices.alias("a"), values.alias("b")).toArrow().combine_chunks()
    block = RowBlock(table.column("a").combine_chunks(), table.column("b").combine_chunks(), 4)
    dense = np.array([[0, 1, 0, 2], [1, 2, 3, 4], [0, 0, 0, 0.0]])
    w, slopes = RNG.normal(0, 1, (4, 6)), RNG.normal(0, 1, (3, 6))
    assert np.allclose(block.margins(w), dense @ w) and np.allclose(block.gradient(slopes), dense.T @ slopes)
