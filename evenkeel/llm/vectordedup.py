"""Near duplicates among vectors of one label: exact comparison tile by tile, leading principal components first.

Unit vectors are turned into the basis of their principal components, which changes no cosine, so the first few numbers
of a vector hold most of its length. A task holds two tiles of one label. Strips of them are compared by a matrix product
over the leading dimensions; what the dimensions left out can still add to a cosine is at most the product of the two
suffix norms. A strip is done when no pair can reach the threshold any more; when few can, the next dimensions are summed
up for those pairs alone. Sums near the threshold are decided on the vectors as they were given.

Equal vectors of one label collapse to one row before anything is compared. A task gives back how much each of its rows
is linked with and a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import settle
from evenkeel.llm.components import components
from evenkeel.llm.neighbours import usable

THRESHOLD = 0.93
#: Bytes of the vectors of a tile; a task holds two tiles, and the turned vectors of both.
TILE_BYTES = 16 << 20
#: Rows of a strip of either tile, dimensions summed up at a time, and the share of pairs that goes on alone.
ROWS, COLUMNS, STEP, FEW = 512, 2048, 16, 0.05
#: Sums closer than this to the threshold are computed again from the vectors as they were given.
SLACK = 1e-9
#: Length of vectors up to which a basis is fitted (its second moments reach the driver); longer ones keep their own order.
FITTED = 2048
#: A vector is hot if more than one row in so many has it; there are fewer hot vectors than this.
HOT = 512


def _matrix(column, n: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled first, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def principal_basis(classes: DataFrame) -> tuple[int, np.ndarray | None]:
    """The commonest length of vectors, and the basis of its principal components as columns, the largest first.

    The second moments of all unit vectors of that length are summed up in the tasks and then across them by Spark;
    ``dim * dim`` numbers reach the driver, whatever the number of rows. Other lengths are compared in the given order.
    """
    common = classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").head()
    if common is None or common["dim"] > FITTED:
        return 0, None
    dim = common["dim"]

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            if batch.num_rows:
                x = _unit(_matrix(batch.column("v"), batch.num_rows))
                total += x.T @ x
        rows = pa.array(np.arange(dim), pa.int32())
        yield pa.RecordBatch.from_arrays([rows, pa.array(list(total), pa.list_(pa.float64()))], ["i", "m"])

    parts = classes.where(F.col("dim") == dim).select("v").mapInArrow(moments, "i int, m array<double>")
    sums = parts.select("i", F.posexplode("m").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).toArrow()
    matrix = np.zeros((dim, dim))
    matrix[sums.column("i").to_numpy(), sums.column("j").to_numpy()] = sums.column("x").to_numpy()
    _, basis = np.linalg.eigh((matrix + matrix.T) / 2)
    return dim, np.ascontiguousarray(basis[:, ::-1])


def _suffix_norms(turned: np.ndarray, cuts: list[int]) -> np.ndarray:
    """Norm of what is left of each row from each cut on."""
    squares = turned * turned
    return np.sqrt(np.stack([squares[:, c:].sum(axis=1) for c in cuts]))


def linked_pairs(a: np.ndarray, b: np.ndarray, a_unit: np.ndarray, b_unit: np.ndarray, threshold: float, inside: bool):
    """``(rows of a, rows of b)`` of the links, strip by strip; ``a`` and ``b`` are turned, ``*_unit`` as given.

    Within one tile each pair is met once, the smaller row first.
    """
    dim = a.shape[1]
    cuts = list(range(STEP, dim, STEP)) + [dim]
    a_rest, b_rest = _suffix_norms(a, cuts), _suffix_norms(b, cuts)
    goal = threshold - SLACK
    for i in range(0, len(a), ROWS):
        for j in range(0, len(b), COLUMNS):
            if inside and j + COLUMNS <= i:
                continue
            x, y = a[i : i + ROWS], b[j : j + COLUMNS]
            rest_x, rest_y = a_rest[:, i : i + ROWS], b_rest[:, j : j + COLUMNS]
            sums, done, rows = np.zeros((len(x), len(y))), 0, None
            for step, cut in enumerate(cuts):
                if rows is None:
                    sums += x[:, done:cut] @ y[:, done:cut].T
                    alive = sums + np.outer(rest_x[step], rest_y[step]) >= goal
                    if inside:
                        alive &= np.arange(i, i + len(x))[:, None] < np.arange(j, j + len(y))
                    left = np.count_nonzero(alive)
                    if left <= FEW * alive.size or cut == dim:
                        rows, columns = np.nonzero(alive)
                        sums = sums[rows, columns]
                else:
                    sums = sums + np.einsum("ij,ij->i", x[rows, done:cut], y[columns, done:cut])
                    stay = sums + rest_x[step, rows] * rest_y[step, columns] >= goal
                    rows, columns, sums = rows[stay], columns[stay], sums[stay]
                done = cut
                if rows is not None and not len(rows):
                    break
            if rows is None or not len(rows):
                continue
            near = np.flatnonzero(sums <= threshold + SLACK)
            for some in np.array_split(near, -(-len(near) // 65536) or 1):
                sums[some] = np.einsum("ij,ij->i", a_unit[i + rows[some]], b_unit[j + columns[some]])
            links = sums >= threshold
            yield i + rows[links], j + columns[links]


class SpanningForest:
    """Keeps of the links it is given those that join what was not joined before."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.links: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        while True:
            u, v = self.label[x], self.label[y]
            new = u != v
            if not new.any():
                return
            x, y, u, v = x[new], y[new], u[new], v[new]
            high, low = np.maximum(u, v), np.minimum(u, v)
            order = np.lexsort((low, high))
            first = order[np.flatnonzero(np.diff(high[order], prepend=-1))]
            # every label is hung below one smaller label, so no link closes a ring
            self.links.append((x[first], y[first]))
            parent = np.arange(len(self.label))
            parent[high[first]] = low[first]
            while True:
                up = parent[parent]
                if np.array_equal(up, parent):
                    break
                parent = up
            self.label = parent[self.label]


def _classes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows with the key of their class of equal vectors, and the classes, numbered."""
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"),
        F.col(label_col).alias("label"),
    )
    takes_part = usable(F.col("v")) & F.col("label").isNotNull()
    rows = settle(rows.withColumn("v", F.when(takes_part, F.col("v"))).withColumn("h", F.when(takes_part, F.struct(
        F.xxhash64("label", "v").alias("a"), F.xxhash64(F.lit(1), "v", "label").alias("b")))))
    classes = rows.where("h IS NOT NULL").groupBy("h").agg(
        F.any_value("label").alias("label"), F.any_value("v").alias("v"), F.count(F.lit(1)).alias("n"),
        F.min("vec_id").alias("least_id"),
    )
    # the number is stored with the row, so it stays what it was
    numbered = classes.withColumn("c", F.monotonically_increasing_id()).withColumn("dim", F.size("v"))
    return rows.select("vec_id", "h"), settle(numbered)


def _tiles(classes: DataFrame, tile_bytes: int) -> DataFrame:
    """Each class once for every pair of tiles of its label and length that its own tile belongs to."""
    most = F.greatest(F.lit(1), F.floor(F.lit(tile_bytes) / (8 * F.col("dim"))))
    sizes = classes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / F.first(most)).cast("int").alias("tiles"))
    keys = [F.col("label").eqNullSafe(F.col("of_label")), F.col("dim") == F.col("of_dim")]
    sizes = settle(sizes.select(F.col("label").alias("of_label"), F.col("dim").alias("of_dim"), "tiles"))
    joined = classes.join(sizes, keys[0] & keys[1])
    own = joined.select("label", "dim", "c", "v", "n", "tiles", F.pmod(F.xxhash64("c"), F.col("tiles")).cast("int").alias("t"))
    every = own.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("o"))
    return every.select("label", "dim", F.least("t", "o").alias("p"), F.greatest("t", "o").alias("q"),
                        (F.col("t") > F.col("o")).alias("side"), "c", "v", "n")


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    threshold: float = THRESHOLD, tile_bytes: int = TILE_BYTES,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors``.

    Two rows link where their labels are equal and not null and the cosine of their vectors, in double precision, is
    ``threshold`` or more (which must be positive); vectors of different lengths never link. ``n_links`` counts the other rows a row links with,
    ``component_id`` is the smallest id that can be reached, its own included, and ``kept`` says whether that is its own.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing and are kept. Rows of
    one id stay rows of their own. A row without an id counts as a link and is passed over when the smallest id is
    sought; it is kept where its component has no id at all. Other columns, whatever their names, are not read; an empty
    table gives no rows. Work grows with the square of a label's distinct vectors, spread over pairs of tiles.
    """
    if not threshold > 0:
        raise ValueError("the threshold must be positive")
    rows, classes = _classes(vectors, id_col, vector_col, label_col)
    fitted, basis = principal_basis(classes)

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        inside = table.column("p")[0] == table.column("q")[0]
        units = _unit(_matrix(table.column("v"), len(side)))
        turned = units @ basis if units.shape[1] == fitted else units
        # rows with like leading numbers in one strip
        order = np.lexsort((turned[:, 0], side))
        side, units, turned = side[order], units[order], turned[order]
        c, n = table.column("c").to_numpy()[order], table.column("n").to_numpy()[order]
        split = len(side) if inside else int(np.count_nonzero(~side))
        low = slice(0, split)
        high = low if inside else slice(split, len(side))
        begin = high.start
        degree, forest = np.zeros(len(side), np.int64), SpanningForest(len(side))
        for x, y in linked_pairs(turned[low], turned[high], units[low], units[high], threshold, inside):
            y = y + begin
            np.add.at(degree, x, n[y])
            np.add.at(degree, y, n[x])
            forest.add(x, y)
        linked = np.flatnonzero(degree)
        x = np.concatenate([a for a, _ in forest.links] or [np.zeros(0, np.int64)])
        y = np.concatenate([b for _, b in forest.links] or [np.zeros(0, np.int64)])
        nothing = pa.nulls(len(linked), pa.int64())
        return pa.table({
            "c": pa.chunked_array([pa.array(c[linked]), pa.array(c[x])], pa.int64()),
            "other": pa.chunked_array([nothing, pa.array(c[y])], pa.int64()),
            "links": pa.chunked_array([pa.array(degree[linked]), pa.nulls(len(x), pa.int64())], pa.int64()),
        })

    keys = ("label", "dim", "p", "q")
    found = settle(_tiles(classes, tile_bytes).groupBy(*keys).applyInArrow(run, "c bigint, other bigint, links bigint"))
    degrees = found.where("links IS NOT NULL").groupBy("c").agg(F.sum("links").alias("links"))
    roots = components(found.where("other IS NOT NULL"), "c", "other")
    placed = classes.select("h", "c", "n", "least_id").join(degrees, "c", "left").join(
        roots.select(F.col("node").alias("c"), "root"), "c", "left"
    ).select("h", "n", "least_id", F.coalesce("root", "c").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    least = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    known = settle(placed.join(least, "root").select("h", "n", "n_links", "component_id"))

    alone = rows.where("h IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    joined = _joined(rows.where("h IS NOT NULL"), known).unionByName(alone)
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull())
    return joined.withColumn("kept", kept)


def _joined(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows with what is known of their class; the few classes that many rows have are sent to the rows."""
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    is_hot = F.col("n") * HOT > total
    hot = known.where(is_hot).select(F.col("h").alias("hot_h"), F.col("n_links").alias("hot_links"), F.col("component_id").alias("hot_id"))
    marked = rows.join(F.broadcast(hot), F.col("h") == F.col("hot_h"), "left")
    of_hot = marked.where("hot_h IS NOT NULL").select("vec_id", F.col("hot_links").alias("n_links"), F.col("hot_id").alias("component_id"))
    others = marked.where("hot_h IS NULL").select("vec_id", "h").join(known.where(~is_hot), "h")
    return of_hot.unionByName(others.select("vec_id", "n_links", "component_id"))
