"""Periodic runs of words by block convolution at dyadic scales.

At scale ``B`` the words are cut into blocks of ``B``. A run of period ``q`` from ``B`` to ``2B - 1`` and exponent four or
more holds a whole block together with its next occurrence, which begins ``q`` words later, so the blocks are looked for
in the windows of ``2B`` words that follow them. For all blocks at once a number theoretic transform correlates block
and window; with the sums of squares this gives the squared differences at each of the ``B`` distances, in exact integers
modulo a prime. Zero mismatches leave zero, and each such distance seeds an extension that compares words to both sides,
so a residue that is zero by chance (of a sum beyond the prime) is found out, and what is reported is exact.

Words of a run of that exponent occur four times or more in their text; blocks that hold a rarer word are passed over.
Texts of like length are worked on together, with a border between them that equals no word.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run is at least this long, in words and in periods.
LEAST, EXPONENT = 6, 4
#: A prime of the form 15 * 2**27 + 1 and a generator of its residues: transforms of up to 2**27 entries.
PRIME, GENERATOR = 2013265921, 31
#: Words that may be worked on together (or one longer text), and entries that are transformed at a time.
GROUP_WORDS, SLAB = 1 << 18, 1 << 18


def _mod(x: np.ndarray) -> np.ndarray:
    return x - x // np.uint64(PRIME) * np.uint64(PRIME)


def _powers(root: int, n: int) -> np.ndarray:
    """``root ** 0 .. root ** (n - 1)``, by doubling."""
    out = np.ones(1, np.uint64)
    step = root
    while len(out) < n:
        out = np.concatenate((out, _mod(out * np.uint64(step))))
        step = step * step % PRIME
    return out[:n]


class Transform:
    """Number theoretic transforms of rows of ``size`` entries, a power of two.

    The forward one leaves its result in bit-reversed order and the backward one takes it so; nothing is reordered.
    """

    def __init__(self, size: int):
        root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
        self.size, self.scale = size, np.uint64(pow(size, PRIME - 2, PRIME))
        self.forth = _powers(root, max(1, size // 2))
        self.back = _powers(pow(root, PRIME - 2, PRIME), max(1, size // 2))

    def forward(self, rows: np.ndarray) -> np.ndarray:
        x, half = rows, self.size // 2
        while half:
            pairs = x.reshape(len(rows), -1, 2, half)
            a, b = pairs[:, :, 0], pairs[:, :, 1]
            turn = self.forth[:: self.size // (2 * half)][:half]
            x = np.stack((_mod(a + b), _mod((a + np.uint64(PRIME) - b) * turn)), axis=2).reshape(rows.shape)
            half //= 2
        return x

    def backward(self, rows: np.ndarray) -> np.ndarray:
        x, half = rows, 1
        while half < self.size:
            pairs = x.reshape(len(rows), -1, 2, half)
            a, b = pairs[:, :, 0], _mod(pairs[:, :, 1] * self.back[:: self.size // (2 * half)][:half])
            x = np.stack((_mod(a + b), _mod(a + np.uint64(PRIME) - b)), axis=2).reshape(rows.shape)
            half *= 2
        return _mod(x * self.scale)


def squared_differences(blocks: np.ndarray, windows: np.ndarray, ntt: Transform) -> np.ndarray:
    """Sum of squared differences of each block to its window at the first ``B`` places, modulo the prime.

    Blocks have ``B`` entries and windows ``2B``; a cyclic correlation of ``2B`` entries does not wrap at those places.
    """
    size = blocks.shape[1]
    turned = np.zeros_like(windows)
    turned[:, 0] = blocks[:, 0]
    turned[:, 2 * size - np.arange(1, size)] = blocks[:, 1:]
    both = ntt.backward(_mod(ntt.forward(turned) * ntt.forward(windows)))[:, :size]
    squares = np.zeros((len(windows), 2 * size + 1), np.uint64)
    np.cumsum(_mod(windows * windows), axis=1, out=squares[:, 1:])
    own = _mod(blocks * blocks).sum(axis=1, keepdims=True)
    there = squares[:, size : 2 * size] - squares[:, :size]
    return _mod(_mod(own + there) + np.uint64(2 * PRIME) - 2 * both)


def _agree(ids: np.ndarray, i: int, period: int, step: int) -> int:
    """How many words from ``i`` on in direction ``step`` equal the word one period later; compared in growing strips."""
    n, count, width = len(ids) - period, 0, 32
    while True:
        if step > 0:
            low, high = i + count, min(n, i + count + width)
            same = ids[low:high] == ids[low + period : high + period]
        else:
            low, high = max(0, i - count - width + 1), i - count + 1
            same = (ids[low:high] == ids[low + period : high + period])[::-1]
        if low >= high:
            return count
        wrong = np.flatnonzero(~same)
        if len(wrong):
            return count + int(wrong[0])
        count += high - low
        width *= 2


def _prime_factors(n: int) -> Iterator[int]:
    p = 2
    while p * p <= n:
        if n % p == 0:
            yield p
            while n % p == 0:
                n //= p
        p += 1
    if n > 1:
        yield n


class _Found:
    """Runs found so far, and for each word the period and end of the first run found that covers it."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.runs = ids, []
        self.period, self.end = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)

    def extend(self, starts: np.ndarray, distances: np.ndarray, size: int) -> None:
        """Seeds: the ``size`` words at a start seem to occur again at the distance."""
        order = np.lexsort((starts, distances))
        starts, distances = starts[order], distances[order]
        # inside a known run a multiple of its period gives nothing but the same run
        known = self.period[starts]
        covered = (known > 0) & (distances % np.maximum(known, 1) == 0) & (starts + distances + size <= self.end[starts])
        last, upto = 0, 0
        for i, d in zip(starts[~covered].tolist(), distances[~covered].tolist()):
            if d == last and i < upto:
                continue
            q = self.period[i]
            if q and d % q == 0 and i + d + size <= self.end[i]:
                continue
            ahead = _agree(self.ids, i, d, 1)
            if ahead < size:
                continue
            first, upto, last = i - _agree(self.ids, i - 1, d, -1), i + ahead, d
            length = upto + d - first
            if length < max(LEAST, EXPONENT * d):
                continue
            if any(_agree(self.ids, first, d // p, 1) >= length - d // p for p in _prime_factors(d)):
                continue
            self.runs.append((first, length, d))
            free = np.flatnonzero(self.period[first : first + length] == 0) + first
            self.period[free], self.end[free] = d, first + length


def find_runs(ids: np.ndarray, frequent: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run in an array of word numbers (0 is a border, equal to nothing).

    ``frequent`` says which words occur ``EXPONENT`` times in their text, ``longest`` is the number of words of the
    longest text. Word numbers are below the prime. Sorted by start and period.
    """
    n = len(ids)
    ids = ids.copy()
    borders = np.flatnonzero(ids == 0)
    ids[borders] = int(ids.max(initial=0)) + 1 + np.arange(len(borders))
    found = _Found(ids)
    rare = np.concatenate(([0], np.cumsum(~frequent)))
    # numbers below the prime in any order do, so distinct words stay distinct
    values = np.concatenate((ids.astype(np.uint64), np.zeros(4, np.uint64)))
    size = 1
    while EXPONENT * size <= longest:
        ntt = Transform(2 * size)
        starts = np.arange(0, n - 2 * size + 1, size)
        # a run holds the block and at least its next occurrence, so no rare word and no border lies in the first 2B
        starts = starts[rare[starts + 2 * size] == rare[starts]]
        places = np.arange(3 * size)
        for at in range(0, len(starts), max(1, SLAB // (2 * size))):
            some = starts[at : at + max(1, SLAB // (2 * size))]
            cut = values[np.minimum(some[:, None] + places, len(values) - 1)]
            zero = squared_differences(cut[:, :size], cut[:, size:], ntt) == 0
            block, shift = np.nonzero(zero)
            begin, distance = some[block], size + shift
            inside = begin + distance + size <= n
            found.extend(begin[inside], distance[inside], size)
        size *= 2
    return sorted(set(found.runs), key=lambda r: (r[0], r[2]))


def planted(words: list, doc_id) -> list:
    """The words of every tenth document by id from some word on repeated with a period; other documents as they are.

    A null id counts as no digits, whose checksum is zero.
    """
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[: n - a]


def _group_runs(texts: list[list]) -> Iterator[tuple[list, list]]:
    """Runs and kept words of each of some texts, found together."""
    parts, bases, longest = [], [], 0
    frequent = []
    base = 0
    for words in texts:
        number: dict = {}
        ids = np.fromiter((number.setdefault(w, len(number) + 1) for w in words), np.int64, len(words))
        parts += [ids, np.zeros(1, np.int64)]
        frequent += [np.bincount(ids, minlength=1)[ids] >= EXPONENT, np.zeros(1, bool)]
        bases.append(base)
        base += len(words) + 1
        longest = max(longest, len(words))
    runs = find_runs(np.concatenate(parts), np.concatenate(frequent), longest)
    of = np.searchsorted(bases, [r[0] for r in runs], "right") - 1
    per_text: list[list] = [[] for _ in texts]
    for (start, length, period), i in zip(runs, of.tolist()):
        per_text[i].append((start - bases[i], length, period))
    for words, own in zip(texts, per_text):
        kept = words
        if own:
            dropped = np.zeros(len(words) + 1, np.int64)
            for start, length, period in own:
                dropped[start + period] += 1
                dropped[start + length] -= 1
            kept = [words[i] for i in np.flatnonzero(np.cumsum(dropped)[:-1] == 0)]
        yield own, kept


def _groups(sizes: list[int]) -> Iterator[list[int]]:
    """Rows by ascending length, cut where the words come to ``GROUP_WORDS`` or lengths have grown fourfold."""
    some, held, least = [], 0, 0
    for i in sorted(range(len(sizes)), key=sizes.__getitem__):
        if some and (held + sizes[i] > GROUP_WORDS or sizes[i] > 4 * max(least, 64)):
            yield some
            some, held = [], 0
        if not some:
            least = sizes[i]
        some.append(i)
        held += sizes[i] + 1
    if some:
        yield some


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Callable[[list, object], list] | None = None,
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` per row of ``docs``, in any order.

    Words are what stands between ASCII white space, numbered from 0. A run is a stretch of smallest period ``period``
    (words so far apart are equal) that no neighbouring word extends, of at least ``LEAST`` words and ``EXPONENT``
    periods. ``runs`` is an array of ``(start, length, period)`` by start and then period; ``collapsed`` joins the words
    by one space, without those that a run contains after its first period. ``rewrite`` may change the words of a
    document, given with its id, before runs are sought. Null and empty texts have no words, no runs and an empty
    ``collapsed``. Rows with one id, or none, stay rows of their own. Texts of any length are searched whole. Other
    columns, whatever their names, are not read; no rows give no rows.
    """
    wanted = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("body"))
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column("doc_id")
            bodies = batch.column("body")
            # words can be no more than half of the bytes, so groups are cut before any text is split
            for rows in _groups([(size or 0) // 2 for size in pc.binary_length(bodies).to_pylist()]):
                own = doc_ids.take(pa.array(rows))
                texts = [(bodies[i].as_py() or b"").split() for i in rows]
                if rewrite:
                    texts = [rewrite(words, i) for words, i in zip(texts, own.to_pylist())]
                found = list(_group_runs(texts))
                columns = [
                    own, pa.array([len(words) for words in texts], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs] for runs, _ in found], run_type),
                    pa.array([b" ".join(kept).decode() for _, kept in found], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    kind = dict(wanted.dtypes)["doc_id"]
    runs = "array<struct<start: bigint, length: bigint, period: bigint>>"
    return wanted.mapInArrow(run, f"doc_id {kind}, n_words bigint, runs {runs}, collapsed string")
