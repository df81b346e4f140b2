"""Boosted trees under one multi-class objective, grown level by level from distributed histograms.

A round grows one tree per class, all in the same jobs. For a level, each task adds up slopes and curvatures of its rows
by class, node, feature and bin; the sums of the tasks are added up by Spark, piece by piece, and each piece looks for the
best split of its features. One split per class and node reaches the driver. Training ends when the loss of the
validation rows has not fallen for ``patience`` rounds, and the rounds up to the best one are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.vectors import argmax
from evenkeel.operators.blocks import ARRAY_ROWS, array_rows, summed
from evenkeel.operators.epochs import softmax_rows
from evenkeel.operators.sampling import SEED
from evenkeel.session import cut_lineage

# Numbers of a histogram that a task holds, numbers that travel in one row, and values that are scored at a time.
CELLS, PIECE, SCORED = 1 << 23, 1 << 14, 1 << 22
# Rounds after which the margins of the rows are stored anew.
CUT_ROUNDS = 16
# A bin is one byte.
MOST_BINS = 256
LEAST_CURVATURE = 1e-16

#: ``(margins, labels, weights) -> (slopes, curvatures)``, each of rows by classes
Objective = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def softmax_objective(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy of the softmax, with twice the diagonal of its second derivative."""
    p = softmax_rows(margins)
    curvature = np.maximum(2.0 * p * (1.0 - p), LEAST_CURVATURE)
    p[np.arange(len(labels)), labels] -= 1.0
    return p * weights[:, None], curvature * weights[:, None]


def as_array(df: DataFrame, features: str) -> Column:
    """A vector column, dense or sparse, as an array of doubles."""
    if isinstance(df.schema[features].dataType, VectorUDT):
        return vector_to_array(features)
    return F.col(features).cast("array<double>")


def quantile_edges(df: DataFrame, features: str, bins: int = 64, accuracy: int = 10_000) -> list[list[float]]:
    """Per feature up to ``bins - 1`` ascending borders, each between two bins, at approximate quantiles of all rows."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    values = df.select(F.posexplode(as_array(df, features)).alias("feature", "x")).where(~F.isnan("x"))
    rows = values.groupBy("feature").agg(F.percentile_approx("x", shares, F.lit(accuracy)).alias("e")).collect()
    found = {r["feature"]: sorted(set(r["e"])) for r in rows}
    return [found.get(i, []) for i in range(max(found, default=-1) + 1)]


@dataclass
class Round:
    """Complete binary trees, one per class: split feature (-1 for a leaf), border, its bin, and leaf value by node."""

    feature: np.ndarray
    border: np.ndarray
    cut: np.ndarray
    value: np.ndarray


def _leaves(rows: np.ndarray, feature: np.ndarray, limit: np.ndarray, right) -> np.ndarray:
    """The node at which each row ends up in one tree; ``right(x, limit)`` says which rows go right."""
    node, at = np.zeros(len(rows), np.int64), np.arange(len(rows))
    while True:
        f = feature[node]
        go = f >= 0
        if not go.any():
            return node
        chosen = rows[at, np.maximum(f, 0)]
        node = np.where(go, 2 * node + 1 + right(chosen, limit[node]), node)


def _by_bin(x, cut):
    return x > cut


def _by_value(x, border):
    return ~(x < border)  # no number goes right


def margins_of(rounds: list[Round], rows: np.ndarray, classes: int, binned: bool) -> np.ndarray:
    out = np.zeros((len(rows), classes))
    for r in rounds:
        for k in range(classes):
            limit, right = (r.cut[k], _by_bin) if binned else (r.border[k], _by_value)
            out[:, k] += r.value[k][_leaves(rows, r.feature[k], limit, right)]
    return out


@dataclass
class SoftTrees:
    """A fitted model: adds class probabilities and the most probable class to any table with the features."""

    rounds: list[Round]
    classes: int
    width: int
    features: str = "features"

    def __call__(self, df: DataFrame, probs: str = "probs", prediction: str = "prediction") -> DataFrame:
        held = df.sparkSession.sparkContext.broadcast(self.rounds)
        classes, width = self.classes, self.width

        @F.arrow_udf("array<double>")
        def score(values: pa.Array) -> pa.Array:
            parts = [pa.array([], pa.list_(pa.float64()))]
            for at in range(0, len(values), step := max(1, SCORED // max(1, width))):
                some = values.slice(at, step)
                there = np.asarray(some.is_valid())
                rows = some.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(int(there.sum()), width)
                p = np.zeros((len(some), classes))
                p[there] = softmax_rows(margins_of(held.value, rows, classes, False))
                offsets = pa.array(np.arange(0, p.size + 1, classes), pa.int32())
                parts.append(pa.ListArray.from_arrays(offsets, pa.array(p.ravel()), mask=pa.array(~there)))
            return pa.concat_arrays(parts)

        # not to be computed a second time by a filter on the prediction
        scored = df.withColumn(probs, score.asNondeterministic()(as_array(df, self.features)))
        return scored.withColumn(prediction, argmax(F.col(probs)))


def _drawn(marks: np.ndarray, round_: int, seed: int, share: float) -> np.ndarray:
    """Which rows a round uses: a mix of the row's mark and the round, below the share."""
    if share >= 1:
        return np.ones(len(marks), bool)
    x = marks.view(np.uint64) ^ np.uint64(((seed << 32) + round_ * 0x9E3779B97F4A7C15) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53) < share


@dataclass
class Settings:
    rounds: int = 100
    rate: float = 0.05
    depth: int = 6
    rows: float = 0.8
    columns: float = 0.8
    l2: float = 1.0
    least_weight: float = 1.0
    least_gain: float = 0.0
    patience: int | None = None
    seed: int = SEED


class _Grower:
    """The stored rows of one training, and the jobs over them."""

    def __init__(self, table: DataFrame, edges: list[list[float]], classes: int, settings: Settings, objective: Objective):
        self.table, self.edges, self.classes, self.s, self.objective = table, edges, classes, settings, objective
        self.width, self.bins = len(edges), max((len(e) for e in edges), default=0) + 1
        self.context, self.recent = table.sparkSession.sparkContext, []

    def _batch(self):
        """A function that reads a batch in a task: bins, margins by now, labels, weights, marks, held out."""
        width, classes, recent = self.width, self.classes, list(self.recent)

        def read(batch: pa.RecordBatch):
            n = batch.num_rows
            bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(n, width)
            margins = batch.column("margins").flatten().to_numpy().reshape(n, classes)
            others = (np.asarray(batch.column(c)) for c in ("label", "weight", "mark", "valid"))
            return bins, margins + margins_of(recent, bins, classes, True), *others

        return read

    def level(self, tree: Round, depth: int, number: int, allowed: np.ndarray) -> list:
        """The best split of each class and node of one level: ``(class, node, feature, cut, gain, gl, hl, g, h)``."""
        nodes = 1 << depth
        per_feature = self.classes * nodes * self.bins * 2
        at_once = max(1, CELLS // per_feature)
        found: dict = {}
        for low in range(0, self.width, at_once):
            high = min(self.width, low + at_once)
            for row in self._level(tree, depth, number, allowed, low, high):
                key = (row["k"], row["node"])
                if key not in found or (-row["gain"], row["feature"]) < (-found[key]["gain"], found[key]["feature"]):
                    found[key] = row
        return list(found.values())

    def _level(self, tree, depth, number, allowed, low, high) -> list:
        read, objective, s = self._batch(), self.objective, self.s
        classes, bins, nodes = self.classes, self.bins, 1 << depth
        first, features = nodes - 1, high - low
        piece = max(1, PIECE // (nodes * bins * 2))

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((classes, 2, features, nodes * bins))
            for batch in batches:
                bin_of, margins, labels, weights, marks, valid = read(batch)
                use = ~valid & _drawn(marks, number, s.seed, s.rows)
                if not use.any():
                    continue
                bin_of, labels = bin_of[use], labels[use]
                slopes = objective(margins[use], labels, weights[use])
                for k in range(classes):
                    node = _leaves(bin_of, tree.feature[k], tree.cut[k], _by_bin) - first
                    here = node >= 0
                    place = node[here] * bins
                    for f in range(features):
                        cell = place + bin_of[here, low + f]
                        for i in range(2):
                            total[k, i, f] += np.bincount(cell, slopes[i][here, k], nodes * bins)
            for k in range(classes):
                for at in range(0, features, piece):
                    some = total[k, :, at : at + piece]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int32()), pa.array([low + at], pa.int32()), pa.array([some.ravel()], pa.list_(pa.float64()))],
                        ["k", "first", "values"],
                    )

        def best(table: pa.Table) -> pa.Table:
            k, begin = table.column("k")[0].as_py(), table.column("first")[0].as_py()
            held = table.column("values").combine_chunks().flatten().to_numpy()
            slope, curve = held.reshape(table.num_rows, -1).sum(axis=0).reshape(2, -1, nodes, bins)
            gl, hl = np.cumsum(slope, axis=2), np.cumsum(curve, axis=2)
            g, h = gl[:, :, -1:], hl[:, :, -1:]
            gr, hr = g - gl, h - hl
            gain = gl**2 / (hl + s.l2) + gr**2 / (hr + s.l2) - g**2 / (h + s.l2)
            good = (hl >= s.least_weight) & (hr >= s.least_weight) & allowed[k, begin : begin + len(slope), None, None]
            gain = np.where(good & (hl > 0) & (hr > 0), gain, -1.0)
            gain[:, :, -1] = -1.0
            rows = []
            for node in range(nodes):
                # of equal gains the first feature, then the first bin
                f, cut = divmod(int(np.argmax(gain[:, node])), bins)
                at = (f, node, cut)
                rows.append((k, node, begin + f, cut, gain[at], gl[at], hl[at], g[f, node, 0], h[f, node, 0]))
            return pa.Table.from_arrays([pa.array(c) for c in zip(*rows)], schema=pa.schema(
                [(n, pa.int32()) for n in ("k", "node", "feature", "cut")] + [(n, pa.float64()) for n in ("gain", "gl", "hl", "g", "h")]))

        slim = self.table.coalesce(self.context.defaultParallelism)
        pieces = slim.mapInArrow(task, "k int, first int, values array<double>")
        splits = pieces.groupBy("k", "first").applyInArrow(
            best, "k int, node int, feature int, cut int, gain double, gl double, hl double, g double, h double")
        row = F.struct("feature", "cut", "gain", "gl", "hl", "g", "h")
        top = splits.groupBy("k", "node").agg(F.max_by(row, F.struct("gain", -F.col("feature"))).alias("r"))
        return top.select("k", "node", "r.*").collect()

    def grow(self, number: int, allowed: np.ndarray) -> Round:
        """One tree per class."""
        s, size = self.s, (1 << (self.s.depth + 1)) - 1
        shape = (self.classes, size)
        tree = Round(np.full(shape, -1, np.int64), np.zeros(shape), np.zeros(shape, np.int64), np.zeros(shape))

        def leaf(k, node, g, h):
            tree.value[k, node] = -s.rate * g / (h + s.l2) if h > 0 else 0.0

        open_nodes = {(k, 0) for k in range(self.classes)}
        for depth in range(s.depth):
            first = (1 << depth) - 1
            following = set()
            for r in self.level(tree, depth, number, allowed):
                k, node = r["k"], r["node"] + first
                if (k, node) not in open_nodes:
                    continue
                if depth == 0:
                    leaf(k, node, r["g"], r["h"])
                if r["gain"] <= s.least_gain:
                    continue
                tree.feature[k, node], tree.cut[k, node] = r["feature"], r["cut"]
                tree.border[k, node] = self.edges[r["feature"]][r["cut"]]
                leaf(k, 2 * node + 1, r["gl"], r["hl"])
                leaf(k, 2 * node + 2, r["g"] - r["gl"], r["h"] - r["hl"])
                following |= {(k, 2 * node + 1), (k, 2 * node + 2)}
            open_nodes = following
            if not open_nodes:
                break
        return tree

    def add(self, tree: Round) -> None:
        """Margins grow by a round; from time to time they are stored."""
        self.recent.append(tree)
        if len(self.recent) < CUT_ROUNDS:
            return
        read, names = self._batch(), self.table.columns

        def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                margins = read(batch)[1]
                offsets = pa.array(np.arange(0, margins.size + 1, margins.shape[1]), pa.int32())
                at = names.index("margins")
                yield batch.set_column(at, batch.schema.field(at).name, pa.ListArray.from_arrays(offsets, pa.array(margins.ravel())))

        self.table = cut_lineage(self.table.mapInArrow(move, self.table.schema))
        self.recent = []

    def losses(self) -> np.ndarray:
        """Sums of loss and weight of the training rows, and of the validation rows."""
        read = self._batch()

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, 2))
            for batch in batches:
                _, margins, labels, weights, _, valid = read(batch)
                p = softmax_rows(margins)[np.arange(len(labels)), labels]
                loss = -np.log(np.maximum(p, np.finfo(float).tiny)) * weights
                for i, some in enumerate((~valid, valid)):
                    total[i] += loss[some].sum(), weights[some].sum()
            yield from array_rows(total)

        return summed(self.table.coalesce(self.context.defaultParallelism).mapInArrow(task, ARRAY_ROWS), (2, 2))


def binned_rows(df: DataFrame, edges: list[list[float]], features: str, label: str, classes: int, weight: Column, valid: Column, mark: Column) -> DataFrame:
    """Rows with one byte per feature, zero margins, label, weight, mark and whether they are held out; stored."""
    width = len(edges)
    borders = [np.array(e, np.float64) for e in edges]
    wanted = df.select(
        as_array(df, features).alias("x"), F.col(label).cast("int").alias("label"), weight.cast("double").alias("weight"),
        mark.alias("mark"), valid.alias("valid"),
    ).where(F.col("label").between(0, classes - 1) & F.col("x").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, width)
            bins = np.empty((n, width), np.uint8)
            for f in range(width):
                bins[:, f] = np.searchsorted(borders[f], x[:, f], "right")
            margins = pa.ListArray.from_arrays(pa.array(np.arange(0, n * classes + 1, classes), pa.int32()), pa.array(np.zeros(n * classes)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row.tobytes() for row in bins], pa.binary()), margins, *(batch.column(c) for c in ("label", "weight", "mark", "valid"))],
                ["bins", "margins", "label", "weight", "mark", "valid"],
            )

    schema = "bins binary, margins array<double>, label int, weight double, mark bigint, valid boolean"
    return cut_lineage(wanted.mapInArrow(run, schema))


def fit_soft_trees(
    train: DataFrame,
    valid: DataFrame | None,
    n_classes: int,
    features: str = "features",
    label: str = "label",
    weight: str | None = None,
    key: str | None = None,
    edges: list[list[float]] | None = None,
    bins: int = 64,
    objective: Objective = softmax_objective,
    **settings,
) -> tuple[SoftTrees, list[dict]]:
    """Fit boosted trees to all classes at once; the model and a log of the losses of every round.

    ``edges`` are the borders between bins per feature, by default ``bins`` approximate quantiles of the training rows.
    A value goes left of a border if it is smaller; no number goes right. Each round uses the share ``rows`` of the rows
    (drawn by ``key``, or by the features without one) and, per tree, the share ``columns`` of the features. A node is
    split where that raises the gain above ``least_gain`` and leaves ``least_weight`` of curvature on both sides. With
    ``patience`` and validation rows, training ends after so many rounds in a row without a lower validation loss, and
    the rounds after the best one are dropped. Rows without a label below ``n_classes`` or without features take no part.
    """
    s = Settings(**settings)
    if edges is None:
        edges = quantile_edges(train, features, bins)
    if max((len(e) for e in edges), default=0) >= MOST_BINS:
        raise ValueError(f"a feature has more than {MOST_BINS} bins")
    names = list(dict.fromkeys(c for c in (features, label, weight, key) if c))
    rows = train.select(*names, F.lit(False).alias("_valid"))
    if valid is not None:
        held = valid.withColumn(weight, F.lit(1.0)) if weight else valid
        rows = rows.unionByName(held.select(*names, F.lit(True).alias("_valid")))
    mark = F.xxhash64(F.col(key)) if key else F.xxhash64(as_array(rows, features))
    table = binned_rows(rows, edges, features, label, n_classes, F.col(weight) if weight else F.lit(1.0), F.col("_valid"), mark)

    grower = _Grower(table, edges, n_classes, s, objective)
    width, chooser = len(edges), np.random.default_rng(s.seed)
    trees, log, best, best_at = [], [], np.inf, 0
    for number in range(s.rounds if width else 0):
        allowed = np.ones((n_classes, width), bool)
        if s.columns < 1:
            allowed[:] = False
            for k in range(n_classes):
                allowed[k, chooser.choice(width, max(1, int(width * s.columns)), replace=False)] = True
        tree = grower.grow(number, allowed)
        trees.append(tree)
        grower.add(tree)
        (train_loss, train_n), (valid_loss, valid_n) = grower.losses()
        row = {
            "round": number + 1, "train_loss": float(train_loss / train_n) if train_n else None,
            "val_loss": float(valid_loss / valid_n) if valid_n else None,
        }
        log.append(row)
        if row["val_loss"] is None or row["val_loss"] < best:
            best, best_at = row["val_loss"] if row["val_loss"] is not None else best, number + 1
        elif s.patience and number + 1 - best_at >= s.patience:
            break
    kept = trees[:best_at] if s.patience and valid is not None else trees
    return SoftTrees(kept, n_classes, width, features), log
