"""A linear class head trained epoch by epoch, under any loss, for several folds in one pass over the rows.

The weights live on the driver and go out with each step. A step reads the rows of one batch, each task adds up the
gradient of its rows, and the sums of the tasks are added up by Spark. After each epoch the validation rows are scored;
the weights of the best epoch are kept, and training ends when ``patience`` epochs brought nothing better.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.vectors import argmax, label_weight
from evenkeel.operators.blocks import ARRAY_ROWS, RowBlock, array_rows, feature_parts, summed, width_of
from evenkeel.operators.sampling import SEED
from evenkeel.session import cut_lineage

#: ``(margins, labels, weights) -> (loss per row, gradient by margin, what a row counts in the mean)``
Loss = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def softmax_rows(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _cross_entropy(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    shifted = margins - margins.max(axis=1, keepdims=True)
    rows = np.arange(len(labels))
    loss = weights * (np.log(np.exp(shifted).sum(axis=1)) - shifted[rows, labels])
    slope = softmax_rows(margins)
    slope[rows, labels] -= 1.0
    return loss, slope * weights[:, None]


def cross_entropy_loss(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray):
    """Weighted cross-entropy, averaged by weight."""
    return *_cross_entropy(margins, labels, weights), weights


def focal_loss_of(gamma: float = 2.0) -> Loss:
    """Focal loss of a cross-entropy that carries its class weight, averaged over rows."""

    def loss(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray):
        ce, slope = _cross_entropy(margins, labels, weights)
        sure = np.exp(-ce)
        left = 1.0 - sure
        # of a row that is certain already nothing is left, whatever gamma is
        change = left**gamma + gamma * ce * sure * np.where(left > 0, left, 1.0) ** (gamma - 1.0) * (left > 0)
        return left**gamma * ce, slope * change[:, None], np.ones(len(labels))

    return loss


@dataclass
class LinearHead:
    """Weights of one or more linear class heads; a row with ``fold`` is scored by the head of that number."""

    weights: np.ndarray  # features, heads, classes
    bias: np.ndarray  # heads, classes
    features: str = "features"
    fold: str | None = None

    def __call__(self, df: DataFrame, probs: str = "probs", prediction: str = "prediction") -> DataFrame:
        held = df.sparkSession.sparkContext.broadcast((self.weights, self.bias))

        @F.arrow_udf("array<double>")
        def score(indices: pa.Array, values: pa.Array, fold: pa.Array) -> pa.Array:
            weights, bias = held.value
            width, heads, classes = weights.shape
            block = RowBlock(indices, values, width)
            margins = (block.margins(weights.reshape(width, heads * classes)) + bias.ravel()).reshape(block.n, heads, classes)
            own = margins[np.arange(block.n), np.asarray(fold, np.int64)]
            flat = softmax_rows(own).ravel()
            offsets = pa.array(np.arange(0, len(flat) + 1, classes), pa.int32())
            rows = pa.ListArray.from_arrays(offsets, pa.array(flat))
            return rows if values.null_count == 0 else rows.take(
                pa.array(np.where(np.asarray(values.is_valid()), np.arange(block.n), 0), mask=np.asarray(values.is_null()))
            )

        indices, values = feature_parts(df, self.features)
        number = F.col(self.fold).cast("int") if self.fold else F.lit(0)
        # not to be computed a second time by a filter on the prediction
        scored = df.withColumn(probs, score.asNondeterministic()(indices, values, number))
        return scored.withColumn(prediction, argmax(F.col(probs)))


@dataclass
class Trained:
    """The heads of the best epochs, and a log of every epoch of every head."""

    head: LinearHead
    log: list[dict]

    def single(self, m: int) -> LinearHead:
        return LinearHead(self.head.weights[:, m : m + 1], self.head.bias[m : m + 1], self.head.features)


LOG_COLUMNS = (
    "model int, epoch int, learning_rate double, train_loss double, train_acc double, val_loss double, val_acc double, "
    "val_f1_macro double, val_f1_weighted double, is_best boolean, stopped boolean"
)


def f1_scores(confusion: np.ndarray) -> tuple[float, float, float]:
    """Accuracy, macro and weighted F1 of a table of true by predicted classes; absent classes do not count."""
    hits, true, said = np.diag(confusion), confusion.sum(axis=1), confusion.sum(axis=0)
    there = true + said > 0
    f1 = np.divide(2 * hits, true + said, out=np.zeros(len(hits)), where=there)
    return hits.sum() / confusion.sum(), f1[there].mean(), (f1 * true).sum() / true.sum()


class _Steps:
    """Gradient and validation jobs over the stored rows."""

    def __init__(self, rows: DataFrame, width: int, heads: int, classes: int, loss: Loss):
        self.rows, self.width, self.heads, self.classes, self.loss = rows, width, heads, classes, loss
        self.context = rows.sparkSession.sparkContext

    def _run(self, rows: DataFrame, weights: np.ndarray, bias: np.ndarray, shape: int, add) -> np.ndarray:
        held = self.context.broadcast((weights, bias))
        width, heads, classes = self.width, self.heads, self.classes

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w, b = held.value
            total = np.zeros(shape)
            for batch in batches:
                block = RowBlock(batch.column("indices"), batch.column("values"), width)
                margins = (block.margins(w.reshape(width, heads * classes)) + b.ravel()).reshape(block.n, heads, classes)
                labels, part, weight = (np.asarray(batch.column(c)) for c in ("label", "part", "weight"))
                add(total, block, margins, labels, part, weight)
            yield from array_rows(total)

        slim = rows.select("label", "weight", "part", "indices", "values")
        # as many sums as tasks are added up, so there is no use in more tasks than cores
        slim = slim.coalesce(self.context.defaultParallelism)
        try:
            return summed(slim.mapInArrow(task, ARRAY_ROWS), (shape,))
        finally:
            held.unpersist()

    def gradient(self, batch: int, weights: np.ndarray, bias: np.ndarray):
        """Gradient of all weights, of the bias, and per head loss, count and hits, of the rows that train it."""
        width, heads, classes, loss = self.width, self.heads, self.classes, self.loss
        n_w, n_b = width * heads * classes, heads * classes

        def add(total, block, margins, labels, part, weight):
            slopes = np.zeros((block.n, heads, classes))
            stats = total[n_w + n_b :].reshape(heads, 4)
            for m in range(heads):
                own = part != m
                if not own.any():
                    continue
                losses, slope, share = loss(margins[own, m], labels[own], weight[own])
                slopes[own, m] = slope
                hits = (margins[own, m].argmax(axis=1) == labels[own]).sum()
                stats[m] += losses.sum(), share.sum(), hits, own.sum()
            total[:n_w] += block.gradient(slopes.reshape(block.n, -1)).ravel()
            total[n_w : n_w + n_b] += slopes.sum(axis=0).ravel()

        rows = self.rows.where(F.col("batch") == batch)
        got = self._run(rows, weights, bias, n_w + n_b + 4 * heads, add)
        return got[:n_w].reshape(weights.shape), got[n_w : n_w + n_b].reshape(bias.shape), got[n_w + n_b :].reshape(heads, 4)

    def validate(self, weights: np.ndarray, bias: np.ndarray):
        """Confusion counts, and sums of loss and count, of the held-out rows of each head."""
        heads, classes, loss = self.heads, self.classes, self.loss
        n_c = heads * classes * classes

        def add(total, block, margins, labels, part, weight):
            counts, stats = total[:n_c].reshape(heads, classes, classes), total[n_c:].reshape(heads, 2)
            for m in range(heads):
                own = part == m
                if not own.any():
                    continue
                losses, _, share = loss(margins[own, m], labels[own], weight[own])
                np.add.at(counts[m], (labels[own], margins[own, m].argmax(axis=1)), 1.0)
                stats[m] += losses.sum(), share.sum()

        got = self._run(self.rows.where(F.col("part") < heads), weights, bias, n_c + 2 * heads, add)
        return got[:n_c].reshape(heads, classes, classes), got[n_c:].reshape(heads, 2)


class _Optimiser:
    """Plain gradient steps, or Adam with decoupled weight decay."""

    def __init__(self, kind: str, decay: float, shapes: list[tuple]):
        if kind not in ("sgd", "adamw"):
            raise ValueError(f"unknown optimiser {kind}")
        self.kind, self.decay, self.t = kind, decay, 0
        self.first, self.second = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]

    def step(self, values: list[np.ndarray], slopes: list[np.ndarray], rate: float) -> list[np.ndarray]:
        self.t += 1
        out = []
        for i, (value, slope) in enumerate(zip(values, slopes)):
            decayed = value * (1 - rate * self.decay) if i == 0 else value  # the bias does not decay
            if self.kind == "adamw":
                self.first[i] = 0.9 * self.first[i] + 0.1 * slope
                self.second[i] = 0.999 * self.second[i] + 0.001 * slope * slope
                mean, spread = self.first[i] / (1 - 0.9**self.t), self.second[i] / (1 - 0.999**self.t)
                slope = mean / (np.sqrt(spread) + 1e-8)
            out.append(decayed - rate * slope)
        return out


def training_rows(
    df: DataFrame, part, n_classes: int, features: str, label: str, weights: Mapping[int, float] | None, batches: int, key: str | None, seed: int
) -> DataFrame:
    """``label, weight, part, indices, values`` stored by batch; rows without a class or features are left out."""
    indices, values = feature_parts(df, features)
    cast = F.col(label).cast("int")
    batch = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(batches)).cast("int") if batches > 1 else F.lit(0)
    rows = df.select(
        cast.alias("label"), F.coalesce(label_weight(cast, weights), F.lit(1.0)).alias("weight"), part.cast("int").alias("part"),
        indices.alias("indices"), values.alias("values"), batch.alias("batch"),
    )
    known = F.col("label").between(0, n_classes - 1) & F.col("values").isNotNull() & F.col("part").isNotNull()
    return cut_lineage(rows.where(known), partition_by="batch")


def fit_epochs(
    train: DataFrame,
    valid: DataFrame | None,
    n_classes: int,
    features: str = "features",
    label: str = "label",
    loss: Loss = cross_entropy_loss,
    weights: Mapping[int, float] | None = None,
    epochs: int = 10,
    rate: float = 0.1,
    schedule: str = "linear",
    optimiser: str = "adamw",
    decay: float = 0.01,
    patience: int = 3,
    batches: int = 1,
    key: str | None = None,
    fold: str | None = None,
    folds: int = 1,
    seed: int = SEED,
) -> Trained:
    """Train linear heads from zero weights by ``epochs`` passes of ``batches`` steps each.

    One head is trained on ``train`` and checked on ``valid``. With ``fold`` there is one head per fold, trained on the
    rows of the other folds and checked on its own, all in the same passes over ``train``. A batch holds the rows whose
    ``key`` hashes to it, and the order of batches changes with the epoch. ``schedule`` is ``constant`` or ``linear``
    (falling to zero over all steps). ``weights`` are per class, 1 where absent. An epoch is better if its macro F1 on the
    validation rows beats zero and all epochs before; a head stops after ``patience`` epochs in a row that are not, and
    keeps the weights of its best one (those of the last one if none was, or if nothing is held out). Rows without a
    label below ``n_classes`` or without features take no part.
    """
    if batches > 1 and key is None:
        raise ValueError("more than one batch needs a key")
    if schedule not in ("constant", "linear"):
        raise ValueError(f"unknown schedule {schedule}")
    if fold:
        heads, everything, part = folds, train, F.col(fold)
    else:
        heads = 1
        names = list(dict.fromkeys([features, label, *([key] if key else [])]))
        everything = train.select(*names, F.lit(1).alias("_part"))
        if valid is not None:
            everything = everything.unionByName(valid.select(*names, F.lit(0).alias("_part")))
        part = F.col("_part")
    width = width_of(everything, features)
    rows = training_rows(everything, part, n_classes, features, label, weights, batches, key, seed)
    steps = _Steps(rows, width, heads, n_classes, loss)

    w, b = np.zeros((width, heads, n_classes)), np.zeros((heads, n_classes))
    kept_w, kept_b = w.copy(), b.copy()
    update = _Optimiser(optimiser, decay, [w.shape, b.shape])
    best, waited, active = np.zeros(heads), np.zeros(heads, int), np.ones(heads, bool)
    order, log, taken = np.random.default_rng(seed), [], 0
    for epoch in range(1, epochs + 1):
        seen, mean_losses, first_rate = np.zeros((heads, 4)), [], None
        for batch in order.permutation(batches).tolist():
            now = rate * (1 - taken / (epochs * batches)) if schedule == "linear" else rate
            first_rate = now if first_rate is None else first_rate
            taken += 1
            slope_w, slope_b, stats = steps.gradient(batch, w, b)
            seen += stats
            mean_losses.append(np.divide(stats[:, 0], stats[:, 1], out=np.full(heads, np.nan), where=stats[:, 1] > 0))
            share = np.where(stats[:, 1] > 0, stats[:, 1], 1.0)
            new_w, new_b = update.step([w, b], [slope_w / share[:, None], slope_b / share[:, None]], now)
            w[:, active], b[active] = new_w[:, active], new_b[active]
        counts, held = steps.validate(w, b)
        for m in np.flatnonzero(active).tolist():
            losses = [x[m] for x in mean_losses if not np.isnan(x[m])]
            row = {
                "model": m, "epoch": epoch, "learning_rate": float(first_rate), "train_loss": float(np.mean(losses)) if losses else None,
                "train_acc": float(seen[m, 2] / seen[m, 3]) if seen[m, 3] else None, "val_loss": None, "val_acc": None,
                "val_f1_macro": None, "val_f1_weighted": None, "is_best": False, "stopped": False,
            }
            if counts[m].sum():
                accuracy, macro, weighted = f1_scores(counts[m])
                row.update(val_loss=float(held[m, 0] / held[m, 1]), val_acc=float(accuracy), val_f1_macro=float(macro), val_f1_weighted=float(weighted))
                row["is_best"] = bool(macro > best[m])
                waited[m] = 0 if row["is_best"] else waited[m] + 1
                row["stopped"] = bool(waited[m] >= patience)
                best[m] = max(best[m], macro)
            if row["is_best"] or best[m] == 0:
                kept_w[:, m], kept_b[m] = w[:, m], b[m]
            active[m] = not row["stopped"]
            log.append(row)
        if not active.any():
            break
    return Trained(LinearHead(kept_w, kept_b, features, fold), log)


def log_table(spark, log: list[dict], **settings) -> DataFrame:
    """The epochs of a training as a table, with the settings of the run."""
    names = [c.split()[0] for c in LOG_COLUMNS.split(", ")]
    table = spark.createDataFrame([tuple(row[n] for n in names) for row in log], LOG_COLUMNS)
    return table.withColumns({name: F.lit(value) for name, value in settings.items()}) if settings else table
