"""Fill-in-middle by displacement scatter.

The texts of an Arrow batch lie one after the other in one byte buffer. One scan of it finds the ends of all units and
with them the cuts of every document. Each of a document's three parts moves by one distance, so a difference array with
three entries a document, summed up along the buffer, gives every byte its shift; bytes are scattered to their place plus
shift, and the marks to what is left between them. Restoring is the inverse: the parts are found between the marks, and
the same kind of sum says for each byte of the text where in the output it is gathered from.

The buffer is walked in tiles of ``TILE`` bytes with the sum carried from tile to tile, so beside the batch itself a task
holds a tile's worth of shifts, however long a text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 42
#: Marks before the prefix, the suffix and the middle, and what share of texts is changed, and of these suffix first.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
RATE, SUFFIX_FIRST = 50, 80
FORMS = ("plain", "psm", "spm")
#: The input parts (0 prefix, 1 middle, 2 suffix) and their marks, in the order they have in the output.
ORDERS = {"psm": ((0, PREFIX), (2, SUFFIX), (1, MIDDLE)), "spm": ((2, SUFFIX), (0, PREFIX), (1, MIDDLE))}
_MARK = 3
#: Bytes of the buffer that are shifted at a time, and bytes of texts that are worked on at a time (or one longer text).
TILE, GROUP = 1 << 20, 1 << 22

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def unit_ends(buffer: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Where units end (exclusive), ascending: after each word, and after white space that ends a text."""
    last = np.zeros(len(buffer) + 1, bool)
    last[stops[stops > starts] - 1] = True
    found = []
    for at in range(0, len(buffer), TILE):
        space = _SPACE[buffer[at : at + TILE + 1]]
        n = min(TILE, len(buffer) - at)
        before_space = np.zeros(n, bool)
        before_space[: len(space) - 1] = space[1 : n + 1]
        found.append(np.flatnonzero((~space[:n] & before_space) | last[at : at + n]) + at + 1)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _walk(places: np.ndarray, shifts: np.ndarray, total: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(first byte, shift of each byte)`` tile by tile; from ``places[i]`` on the shift is ``shifts[i]``.

    ``places`` ascends; of parts that begin at one byte the last one holds it.
    """
    change = np.diff(shifts, prepend=0)
    carried = 0
    for at in range(0, total, TILE):
        n = min(TILE, total - at)
        low, high = np.searchsorted(places, [at, at + n])
        steps = np.zeros(n, np.int64)
        np.add.at(steps, places[low:high] - at, change[low:high])
        steps[0] += carried
        moved = np.cumsum(steps)
        carried = moved[-1]
        yield at, moved


def _mark_starts(buffer: np.ndarray, letters: bytes) -> np.ndarray:
    """Where a mark of one of the letters stands in the buffer."""
    if len(buffer) < _MARK:
        return np.zeros(0, np.int64)
    is_letter = np.zeros(256, bool)
    is_letter[list(letters)] = True
    return np.flatnonzero((buffer[:-2] == ord("<")) & is_letter[buffer[1:-1]] & (buffer[2:] == ord(">")))


def _points(buffer: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Code points of each span of the buffer."""
    first = np.flatnonzero((buffer & 0xC0) != 0x80)
    return np.searchsorted(first, high) - np.searchsorted(first, low)


def transform(buffer: np.ndarray, bounds: np.ndarray, draws: np.ndarray, rate: int, suffix_first: int) -> dict:
    """Cuts, forms and output bytes of the texts ``buffer[bounds[i]:bounds[i + 1]]``; ``draws`` has four numbers a text."""
    starts, stops = bounds[:-1], bounds[1:]
    ends = unit_ends(buffer, starts, stops)
    first = np.searchsorted(ends, starts, "right")
    n = np.searchsorted(ends, stops, "right") - first
    a, b = draws[:, 0] % (n + 1), draws[:, 1] % (n + 1)
    padded = np.concatenate(([0], ends))  # the end before a text's first unit is another text's, so it is set apart
    cuts = [np.where(c > 0, padded[first + c], starts) for c in (np.minimum(a, b), np.maximum(a, b))]
    marks = _mark_starts(buffer, b"PSM")
    inside = np.searchsorted(marks, np.maximum(stops - _MARK + 1, starts)) > np.searchsorted(marks, starts)
    plain = (stops == starts) | inside | (draws[:, 2] % 100 >= rate)
    form = np.where(plain, 0, np.where(draws[:, 3] % 100 < suffix_first, 2, 1))

    edges = np.stack([starts, cuts[0], cuts[1], stops])
    sizes = np.diff(edges, axis=0)
    out_sizes = stops - starts + np.where(plain, 0, 3 * _MARK)
    out_bounds = np.concatenate(([0], np.cumsum(out_sizes)))
    target = np.empty_like(sizes)
    target[:] = edges[:3] - starts + out_bounds[:-1]
    output = np.empty(int(out_bounds[-1]), np.uint8)
    for k, name in enumerate(FORMS[1:], 1):
        some = np.flatnonzero(form == k)
        at = out_bounds[some]
        for part, mark in ORDERS[name]:
            for i, byte in enumerate(mark):
                output[at + i] = byte
            target[part, some] = at + _MARK
            at = at + _MARK + sizes[part, some]
    for at, moved in _walk(edges[:3].T.ravel(), (target - edges[:3]).T.ravel(), len(buffer)):
        output[np.arange(at, at + len(moved)) + moved] = buffer[at : at + len(moved)]
    return {
        "n": n, "form": form, "output": output, "bounds": out_bounds,
        "prefix_chars": _points(buffer, edges[0], edges[1]), "middle_chars": _points(buffer, edges[1], edges[2]),
    }


def restore(buffer: np.ndarray, bounds: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of the texts that the outputs ``buffer[bounds[i]:bounds[i + 1]]`` were made from.

    A text that is not plain holds no mark of its own, so its three marks are those that were put in.
    """
    starts, stops = bounds[:-1], bounds[1:]
    marks = _mark_starts(buffer, b"PSM")
    first = np.searchsorted(marks, starts)
    low, high = np.tile(starts, (3, 1)), np.tile(starts, (3, 1))
    high[0] = stops
    for k, name in enumerate(FORMS[1:], 1):
        some = np.flatnonzero(form == k)
        at = [marks[first[some] + i] for i in range(3)] + [stops[some]]
        for i, (part, _) in enumerate(ORDERS[name]):
            low[part, some], high[part, some] = at[i] + _MARK, at[i + 1]
    sizes = high - low
    out_bounds = np.concatenate(([0], np.cumsum(sizes.sum(axis=0))))
    begins = out_bounds[:-1] + np.concatenate((np.zeros((1, len(starts)), np.int64), np.cumsum(sizes, axis=0)[:2]))
    text = np.empty(int(out_bounds[-1]), np.uint8)
    for at, moved in _walk(begins.T.ravel(), (low - begins).T.ravel(), len(text)):
        text[at : at + len(moved)] = buffer[np.arange(at, at + len(moved)) + moved]
    return text, out_bounds


def _groups(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``GROUP`` bytes, or of one longer row."""
    begin, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > GROUP:
            yield begin, i
            begin, held = i, 0
        held += size
    if len(sizes):
        yield begin, len(sizes)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, and where each row begins and ends in them."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    buffer = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buffer[offsets[0] : offsets[-1]], offsets - offsets[0]


def _texts(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.string(), len(bounds) - 1, buffers)


def _draws(id_col: Column, seed: int) -> list[Column]:
    """The first four groups of eight digits of the sha256 of the seed and the id; a null id counts as no digits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = RATE, suffix_first: int = SUFFIX_FIRST,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` per row of ``docs``, in any order.

    A text is cut into ``n`` units, each a word with the white space before it, or white space that ends the text. Two
    draws by id choose the ends of prefix and middle among the ``n + 1`` places between units. Form is ``plain`` for
    texts that are null, empty or hold a mark, and for ``100 - rate`` per cent of the others; ``suffix_first`` per cent of
    the rest are ``spm``, the others ``psm``. Lengths count code points and are null for plain texts, whose output is
    the text itself (empty for null). Rows without an id draw as from no digits; repeated ids draw alike, row by row.
    Texts of any length are moved whole. Other columns, whatever their names, are not read; no rows give no rows.
    """
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body")
    wanted = docs.select(F.col(id_col).alias("doc_id"), body, *_draws(F.col(id_col), seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lengths = np.diff(_bytes_of(whole.column("body"))[1])
            for low, high in _groups(lengths):
                batch = whole.slice(low, high - low)
                buffer, bounds = _bytes_of(batch.column("body"))
                draws = np.stack([batch.column(f"h{i}").to_numpy() for i in range(1, 5)], axis=1)
                done = transform(buffer, bounds, draws, rate, suffix_first)
                plain = done["form"] == 0
                columns = [
                    batch.column("doc_id"), pa.array(done["n"], pa.int64()),
                    pa.DictionaryArray.from_arrays(pa.array(done["form"], pa.int32()), pa.array(FORMS)).cast(pa.string()),
                    pa.array(done["prefix_chars"], pa.int64(), mask=plain), pa.array(done["middle_chars"], pa.int64(), mask=plain),
                    _texts(done["output"], done["bounds"]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = dict(wanted.dtypes)["doc_id"]
    return wanted.mapInArrow(
        run, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    )


def restored(outputs: DataFrame, output_col: str = "output", form_col: str = "form", name: str = "restored") -> DataFrame:
    """``outputs`` with the text that each output was made from, by its form alone; a null output gives the empty text."""
    body = F.coalesce(F.col(output_col), F.lit("")).cast("binary")
    number = F.coalesce(F.array_position(F.array(*[F.lit(f) for f in FORMS]), F.col(form_col)) - 1, F.lit(0)).cast("int")

    @F.arrow_udf("string")
    def back(bodies: pa.Array, forms: pa.Array) -> pa.Array:
        parts = [pa.array([], pa.string())]
        numbers = forms.to_numpy(zero_copy_only=False)
        for low, high in _groups(np.diff(_bytes_of(bodies)[1])):
            buffer, bounds = _bytes_of(bodies.slice(low, high - low))
            parts.append(_texts(*restore(buffer, bounds, numbers[low:high])))
        return pa.concat_arrays(parts)

    return outputs.withColumn(name, back(body, number))
