"""Near duplicates by 64-bit SimHash: exact comparison tile by tile, spanning links, components.

Texts become fingerprints where they lie. Equal fingerprints collapse to one row before anything is compared, so a group
of exact copies costs one row per task. Distinct fingerprints are dealt into tiles by their population count, further
split by a hash to a bounded number of rows, and a pair of tiles meets only where their counts differ by no more than the
radius. A task holds one pair of tiles and gives back a spanning forest of the links it finds, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import settle, without
from evenkeel.llm.components import components

SEED = 42
BITS = 64
#: Distinct fingerprints in a tile, about; a task holds two tiles (a few MB).
TILE_ROWS = 1 << 18
_COUNT_AT_ONCE = 4096
_ROWS, _COLUMNS = 64, 512
#: Where the counts of each of the eight bytes begin, and which bits a byte has.
_PLACE = np.arange(0, 2048, 256)
_BIT_OF = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes, shingle: int) -> int:
    """The fingerprint of one UTF-8 text: a bit is set if it is set in over half of the shingle hashes."""
    found = text.lower().split()  # both only touch ASCII letters and ASCII white space
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(found) > shingle:
        starts, ends = starts[: len(found) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _COUNT_AT_ONCE):
        some = zip(starts[at : at + _COUNT_AT_ONCE].tolist(), ends[at : at + _COUNT_AT_ONCE].tolist())
        digests = b"".join([xxhash.xxh64_digest(joined[i:j], SEED) for i, j in some])
        byte = np.frombuffer(digests, np.uint8).reshape(-1, 8)
        seen = np.bincount((byte + _PLACE).ravel(), minlength=2048).reshape(8, 256)
        set_bits += (seen @ _BIT_OF).ravel()
    return int.from_bytes(np.packbits(2 * set_bits > len(starts)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 4) -> DataFrame:
    """``(doc_id, fp)`` per row, ``fp`` as a signed bigint; a null text counts as empty and has fingerprint zero."""
    wanted = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column("body")
            fps = pa.array((fingerprint(x.as_py() or b"", shingle) for x in bodies), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fps], ["doc_id", "fp"])

    kind = dict(wanted.dtypes)["doc_id"]
    return wanted.mapInArrow(run, f"doc_id {kind}, fp bigint")


class _Forest:
    """Union of labels; says which links joined two trees."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = int(self.parent[x])
        return x

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up


def _quarters(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.ascontiguousarray(fps).view("<u2").reshape(-1, 4)).astype(np.int16)


def _ordered(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted so that neighbours have like population counts in each 16-bit quarter, which makes small tiles skippable."""
    parts = _quarters(fps)
    order = np.lexsort((parts[:, 2], parts[:, 0], parts[:, 0] + parts[:, 1]))
    return fps[order], parts[order]


def _boxes(parts: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(0, len(parts), step)
    return np.minimum.reduceat(parts, at), np.maximum.reduceat(parts, at)


def spanning_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Links within ``radius`` bits between two tiles (or inside one), reduced to a spanning forest.

    Small tiles of the two are skipped where the population counts of their quarters differ by more than the radius
    in sum, which no pair of rows in them can make up for.
    """
    inside = right is None
    a, a_parts = _ordered(left)
    b, b_parts = (a, a_parts) if inside else _ordered(right)
    if not len(a) or not len(b):
        return []
    shift = 0 if inside else len(a)
    forest, links = _Forest(len(a) + (0 if inside else len(b))), []
    label = np.arange(len(forest.parent))
    a_low, a_high = _boxes(a_parts, _ROWS)
    b_low, b_high = _boxes(b_parts, _COLUMNS)
    for i in range(len(a_low)):
        rows = a[i * _ROWS : (i + 1) * _ROWS, None]
        gap = np.maximum(b_low - a_high[i], 0) + np.maximum(a_low[i] - b_high, 0)
        for j in np.flatnonzero(gap.sum(axis=1) <= radius).tolist():
            if inside and (j + 1) * _COLUMNS <= i * _ROWS:
                continue
            differ = np.bitwise_count(rows ^ b[None, j * _COLUMNS : (j + 1) * _COLUMNS])
            if differ.min() > radius:
                continue
            x, y = np.nonzero(differ <= radius)
            x, y = x + i * _ROWS, y + j * _COLUMNS + shift
            new = label[x] != label[y]
            if not new.any():
                continue
            x, y = x[new], y[new]
            _, first = np.unique(np.stack((label[x], label[y])), axis=1, return_index=True)
            for p, q in zip(x[first].tolist(), y[first].tolist()):
                u, v = forest.find(p), forest.find(q)
                if u != v:
                    forest.parent[max(u, v)] = min(u, v)
                    links.append((int(a[p]), int(b[q - shift])))
            label = forest.roots()
    return links


def _tiles(distinct: DataFrame, radius: int, tile_rows: int) -> DataFrame:
    """Each distinct fingerprint once per pair of tiles it belongs to: ``(p, s, q, t, side, fp)``.

    ``(p, s)`` is the tile with the smaller (or equal) population count, ``(q, t)`` the other; the number of tiles of a
    count follows from the 65 row counts that reach the driver.
    """
    pop = F.bit_count("fp")
    counts = {r["p"]: r["n"] for r in distinct.groupBy(pop.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    split = F.array(*[F.lit(-(-counts.get(p, 0) // tile_rows)) for p in range(BITS + 1)])
    rows = distinct.select("fp", pop.alias("c")).select(
        "fp", "c", F.pmod(F.xxhash64("fp"), F.get(split, F.col("c"))).cast("int").alias("k")
    )

    def others(low: Column, high: Column, make) -> Column:
        def of(q: Column) -> Column:
            n = F.get(split, q)
            return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda t: make(q.cast("int"), t.cast("int"))))

        spans = F.when(low <= high, F.transform(F.sequence(low, high), lambda q: F.coalesce(of(q), none)))
        return F.flatten(F.coalesce(spans, F.array().cast(f"array<array<{kind}>>")))

    kind = "struct<p:int,s:int,q:int,t:int,side:int>"
    none = F.array().cast(f"array<{kind}>")

    def pair(p, s, q, t, side) -> Column:
        return F.struct(
            p.alias("p"), s.alias("s"), q.alias("q"), t.alias("t"), F.lit(side).alias("side")
        )

    c, k = F.col("c"), F.col("k")
    top = F.least(c + radius, F.lit(BITS))
    bottom = F.greatest(c - radius, F.lit(0))
    own = F.transform(F.sequence(F.lit(0), F.get(split, c) - 1), lambda t: F.when(
        t.cast("int") >= k, pair(c, k, c, t.cast("int"), 0)).otherwise(pair(c, t.cast("int"), c, k, 1)))
    above = others(c + 1, top, lambda q, t: pair(c, k, q, t, 0))
    below = others(bottom, c - 1, lambda q, t: pair(q, t, c, k, 1))
    return rows.select("fp", F.explode(F.concat(own, above, below)).alias("x")).select("x.*", "fp")


def links(distinct: DataFrame, radius: int = 4, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``(a, b)``: spanning links between the distinct fingerprints of ``distinct.fp``; every link is exact."""

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        fps = table.column("fp").to_numpy().view(np.uint64)
        inside = table.column("p")[0] == table.column("q")[0] and table.column("s")[0] == table.column("t")[0]
        found = spanning_links(fps[side == 0], None if inside else fps[side == 1], radius)
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return _tiles(distinct, radius, tile_rows).groupBy("p", "s", "q", "t").applyInArrow(run, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row of ``docs``.

    Documents link where their fingerprints differ in at most ``radius`` bits; ``component_id`` is the smallest id that
    can be reached over links, the document's own included. Null, empty and blank texts share the fingerprint zero and so
    are linked. Fewer words than a shingle count as one shingle. Rows with the same id stay rows of their own. A null
    id keeps its row and is passed over when the smallest id is sought (null if there is no other). Other columns,
    whatever their names, are not read. An empty table gives an empty result.
    """
    prints = settle(fingerprints(docs, id_col, text_col, shingle))
    distinct = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    roots = components(links(distinct, radius, tile_rows), "a", "b")
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    least = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    known = settle(placed.join(least, "root").select("fp", "component_id"))
    return prints.join(known, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with their own columns, of each group of near duplicates the document with the smallest id.

    Rows of one id stay or go together; they stay if one of them is the first of its group. Rows without an id stay.
    """
    found = near_duplicates(docs, id_col, text_col, **settings)
    later = found.groupBy("doc_id").agg(F.min((F.col("doc_id") > F.col("component_id")).cast("int")).alias("later"))
    return without(docs, id_col, later.where("later = 1").select("doc_id"))


def as_hex(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
