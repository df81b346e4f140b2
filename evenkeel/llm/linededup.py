"""Line dedup as an exact set-similarity join: rare tokens first, prefixes, positions, lengths, then the true Jaccard.

The tokens of a line are its distinct five-word shingles; a line of fewer words has one token, the whole sequence of its
words. Copies of a line collapse to the first one before lines are compared. Tokens are ordered by rarity: how often their
first word occurs in all lines, which no token passes, by a table of fixed size of counts of words by hash, and then by
the token's own hash, one order for the whole corpus. Two lines of a Jaccard similarity of 0.8 share a token among the rarest fifth
of either (the prefix), so only prefixes are shuffled, by token, as three numbers, and tokens that a single line has are
dropped there.

The lines of a token are numbered, earliest first. Every line is held against the first one, which settles large groups
of variants in a number of pairs that is linear in their size; lines that are still open against the second and third,
then the fourth to the seventh, and so on. Lengths, positions and a parity bit map of the tokens rule out most pairs
inside the join; what is left is decided by the tokens.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.functions.binding import let, with_costly
from evenkeel.llm.common import fresh, line_words, oddly_spaced, settle, written

SHINGLE, SIMILARITY = 5, 0.8
#: Entries of the table of word counts by hash, and the steps of rarity it is cut into.
BUCKETS, STEPS_PER_DOUBLING = 1 << 16, 4
#: Bits of a token number below its step of rarity.
HASH_BITS = 57
#: Positions of lines that are sent to every executor at most (some 16 bytes each); more go by a shuffle.
FETCH_AT_ONCE = 2_000_000
#: Words of 64 bits of a line's bit map.
MAP = 4
_MAPS = tuple(f"bits{w}" for w in range(MAP))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, body, odd``, once per text: what is computed beside a generator is computed for each of its rows."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    return texts.withColumn("odd", oddly_spaced(F.col("body")))


def _all_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, pos, line, odd`` of every line that has a word."""
    lines = _texts(docs, id_col, text_col).select("doc_id", F.posexplode(F.split("body", "\n")).alias("pos", "line"), "odd")
    return lines.where((F.col("line") != "") & (~F.col("odd") | F.col("line").rlike(r"[^\x20\x09-\x0D]")))


def _identity() -> list[Column]:
    """Two hashes that stand for a line's text."""
    return [F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g")]


def rarity(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> list[int]:
    """A step of rarity for each hash bucket of words: how many quarter doublings above the mean its count is, 0 at least."""
    lines = _all_lines(docs, id_col, text_col)
    words = lines.select(F.explode(line_words(F.col("line"), F.col("odd"))).alias("w"))
    rows = words.groupBy(F.pmod(F.xxhash64("w"), F.lit(buckets)).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {r["b"]: r["n"] for r in rows}
    mean = max(1.0, sum(counts.values()) / buckets)
    return [min(62, max(0, int(STEPS_PER_DOUBLING * math.log2(max(1, counts.get(b, 0)) / mean)))) for b in range(buckets)]


def tokens_of(found: Column, steps: list[int]) -> Column:
    """The distinct tokens of a line, given as words, as numbers that sort by rarity and then hash; in no order.

    A word's number has its step of rarity above its hash, and a token's number the step of its first word.
    """
    table = F.split(F.lit(",".join(map(str, steps))), ",").cast("array<bigint>")
    low = (1 << HASH_BITS) - 1

    def number(word: Column) -> Column:
        # a short hash is cheaper to compute twice than to bind to a name for each word
        step = F.get(table, F.pmod(F.xxhash64(word), F.lit(len(steps))).cast("int"))
        return F.shiftleft(step, HASH_BITS).bitwiseOR(F.xxhash64(word).bitwiseAND(F.lit(low)))

    def shingles(numbers: Column) -> Column:
        def token(first: Column, i: Column) -> Column:
            five = [first] + [F.get(numbers, i + j) for j in range(1, SHINGLE)]
            return first.bitwiseAND(F.lit(~low)).bitwiseOR(F.xxhash64(*five).bitwiseAND(F.lit(low)))

        # a line of fewer words has one token, of the words there are
        return F.slice(F.transform(numbers, token), F.lit(1), F.greatest(F.size(numbers) - (SHINGLE - 1), F.lit(1)))

    return F.array_distinct(let(F.transform(found, number), shingles))


def _tokens(lines: DataFrame, steps: list[int]) -> DataFrame:
    return with_costly(lines, tokens=tokens_of(line_words(F.col("line"), F.col("odd")), steps))


def _prefix(similarity: float) -> Column:
    """The rarest tokens that a similar line must share one of, in order."""
    n = F.size("tokens")
    return F.slice(F.sort_array("tokens"), F.lit(1), (n - F.ceil(n * similarity - 1e-9) + 1).cast("int"))


def _place(doc: str = "doc_id", pos: str = "pos") -> Column:
    """What lines are ordered by; lines of documents without an id come last."""
    return F.struct(F.col(doc).isNull().alias("none"), F.col(doc).alias("doc_id"), F.col(pos).alias("pos"))


def _may_match(similarity: float) -> Column:
    """Length, positional and bit filter of ``x`` and ``y`` at their shared token: could the rest still reach the overlap?"""
    both = F.col("x_n") + F.col("y_n")
    needed = F.ceil(both * (similarity / (1 + similarity)) - 1e-9)
    rest = F.least(F.col("x_n") - F.col("x_i"), F.col("y_n") - F.col("y_i"))
    before = F.least(F.col("x_i"), F.col("y_i"))
    differ = F.lit(0)
    for m in _MAPS:
        differ = differ + F.bit_count(F.col(f"x_{m}").bitwiseXOR(F.col(f"y_{m}")))
    return (
        (F.least("x_n", "y_n") >= F.ceil(F.greatest("x_n", "y_n") * similarity - 1e-9)) & (before + rest >= needed)
        & (differ <= both * ((1 - similarity) / (1 + similarity)) + 1e-9)
    )


def _bit_maps(tokens: Column) -> dict[str, Column]:
    """The parities of tokens by hash: a token that only one of two lines has changes one bit."""
    one = F.lit(1).cast("bigint")

    def parity(some: Column) -> Column:
        flip = lambda a, t: a.bitwiseXOR(F.call_function("shiftleft", one, t.bitwiseAND(F.lit(63)).cast("int")))
        return F.aggregate(some, F.lit(0).cast("bigint"), flip)

    def part(w: int) -> Column:
        return F.filter(tokens, lambda t: F.shiftright(t, 6).bitwiseAND(F.lit(MAP - 1)) == w)

    return {m: parity(part(w)) for w, m in enumerate(_MAPS)}


def _only(df: DataFrame, places: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of ``df`` whose place is in the one column of ``places`` (or is not); few places are sent to the rows."""
    if places.count() <= FETCH_AT_ONCE:
        places = F.broadcast(places)
    return df.join(places, F.col("place") == F.col(places.columns[0]), how)


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The lines ``y`` of the pairs whose Jaccard similarity with ``x`` is high enough."""
    xs, ys = (settle(pairs.select(F.col(c).alias("wanted")).distinct()) for c in ("x", "y"))
    x = _only(sets, xs).select(F.col("place").alias("x"), F.col("tokens").alias("x_tokens"))
    y = _only(sets, ys).select(F.col("place").alias("y"), F.col("tokens").alias("y_tokens"))
    both = pairs.join(x, "x").join(y, "y")
    shared = F.size(F.array_intersect("x_tokens", "y_tokens"))
    either = F.size("x_tokens") + F.size("y_tokens") - shared
    return both.where(shared >= F.lit(similarity) * either - 1e-9).select("y").distinct()


def _fetched(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame, steps: list[int]) -> DataFrame:
    """``place, h, tokens`` of the lines in ``wanted.place``, from the documents that have one."""
    places = wanted.select("place.none", F.col("place.doc_id").alias("of"), "place.pos").groupBy("none", "of").agg(
        F.collect_set("pos").alias("at")
    )
    if wanted.count() <= FETCH_AT_ONCE:
        places = F.broadcast(places)
    texts = _texts(docs, id_col, text_col)
    here = texts.join(places.drop("none"), F.col("doc_id").eqNullSafe(F.col("of")))
    lines = here.select("doc_id", F.posexplode(F.split("body", "\n")).alias("pos", "line"), "at", "odd")
    lines = lines.where(F.array_contains("at", F.col("pos"))).drop("at")
    # of rows with one id another line may stand at the place
    known = lines.select(_place().alias("place"), "line", "odd", *_identity()).join(
        wanted.select("place", "h", "g"), ["place", "h", "g"], "left_semi")
    found = _tokens(known, steps).select("place", "h", "tokens")
    repeated = docs.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").head(1)
    without_id = docs.where(F.col(id_col).isNull()).head(1)
    # a place can be met twice only where ids are repeated
    return found.dropDuplicates(["place"]) if repeated or without_id else found


def _matched(rows: DataFrame, sets: DataFrame, similarity: float) -> DataFrame | None:
    """Places of the lines that an earlier line is similar to; ``rows`` has a line's number ``k`` under each token.

    Numbers 1, 2 to 3, 4 to 7 and so on are tried in turn by the lines that are still open.
    """
    gone, first, open_rows = None, 1, rows.where("k > 1")
    while True:
        last = 2 * first - 1
        x = rows.where(F.col("k").between(first, last)).select(
            "token", F.col("place").alias("x"), F.col("k").alias("x_k"), *[F.col(c).alias(f"x_{c}") for c in ("n", "i", *_MAPS)])
        y = open_rows.select(
            "token", F.col("place").alias("y"), F.col("k").alias("y_k"), *[F.col(c).alias(f"y_{c}") for c in ("n", "i", *_MAPS)])
        found = x.join(y, "token").where((F.col("x_k") < F.col("y_k")) & (F.col("x") < F.col("y")) & _may_match(similarity))
        pairs = settle(found.select("x", "y").distinct())
        if pairs.head(1):
            close = settle(_verified(pairs, sets, similarity))
            gone = close if gone is None else gone.unionByName(close)
            open_rows = _only(open_rows, close, "left_anti")
        open_rows = written(open_rows.where(F.col("k") > last + 1), "open")
        if not open_rows.head(1):
            return gone
        first = last + 1


def repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, buckets: int = BUCKETS,
) -> DataFrame:
    """``doc_id, compared, removed``: per id the number of lines that took part, and the positions to take out, sorted.

    Lines are what stands between line breaks, positions count from 0. A line takes part if it has a word; it
    goes if an earlier line, by id and then position, has a Jaccard similarity of ``similarity`` or more with it, equal
    lines included, whether that line stays or not. Lines of fewer than five words are similar only if their words are
    the same. Blank lines stay. Ids without lines, as those of null and empty texts, have no row. Of rows with one id,
    lines at one position are one line if they are equal, and stay or go together if they are not. Documents without an
    id are one document after all others. Other columns, whatever their names, are not read. An empty table gives no rows.
    """
    steps = rarity(docs, id_col, text_col, buckets)
    every = _all_lines(docs, id_col, text_col)
    lines = written(every.select("doc_id", "pos", *_identity()), "lines")
    prefixes = _tokens(every.select("line", "odd", F.xxhash64("line").alias("h")), steps).select("h", _prefix(similarity).alias("prefix"))
    entries = prefixes.select("h", F.posexplode("prefix").alias("i", "token"))
    # a token of several lines: told from its least and largest line where its rows lie, in the one exchange they need
    of_token = Window.partitionBy("token")
    spans = entries.withColumns({"least": F.min("h").over(of_token), "largest": F.max("h").over(of_token)})
    shared = written(spans.where("least != largest").select("token", "h", "i").distinct(), "shared")
    few = lines.join(shared.select("h").distinct(), "h", "left_semi")
    classes = settle(few.groupBy("h", "g").agg(F.min(_place()).alias("place")))
    sets = written(_fetched(docs, id_col, text_col, classes, steps).withColumns({"n": F.size("tokens"), **_bit_maps(F.col("tokens"))}), "sets")
    by_token = Window.partitionBy("token").orderBy("place")
    rows = written(shared.join(sets.drop("tokens"), "h").select(
        "token", "place", "n", "i", *_MAPS, F.row_number().over(by_token).alias("k")), "rows")
    gone = _matched(rows, sets, similarity)

    kept = lines.groupBy("h", "g").agg(F.min(_place()).alias("place")).select("place")
    if gone is not None:
        kept = kept.join(gone, F.col("place") == F.col("y"), "left_anti")
    marked = lines.select("doc_id", "pos", F.lit(0).alias("stays")).unionByName(
        kept.select("place.doc_id", "place.pos", F.lit(1).alias("stays")))
    per_line = marked.repartition("doc_id").groupBy("doc_id", "pos").agg(F.max("stays").alias("stays"))
    return per_line.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("compared"),
        F.sort_array(F.collect_list(F.when(F.col("stays") == 0, F.col("pos")))).alias("removed"),
    )


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with their own columns and repeated lines taken out of the texts, per ``repeated_lines``.

    A text that loses no line stays as it is, a null text null. A document whose text had lines and loses all of them, or
    keeps none but blank ones, goes.
    """
    found = settle(repeated_lines(docs, id_col, text_col, similarity).where(F.size("removed") > 0))
    of, removed, kept = (fresh(docs, name) for name in ("of_id", "removed", "kept_text"))
    gone = found.select(F.col("doc_id").alias(of), F.col("removed").alias(removed))
    held = found.agg(F.coalesce(F.sum(F.size("removed") + 4), F.lit(0))).first()[0]
    if held <= FETCH_AT_ONCE:
        gone = F.broadcast(gone)
    joined = docs.join(gone, F.col(id_col).eqNullSafe(F.col(of)), "left")
    left = F.array_join(F.filter(F.split(text_col, "\n"), lambda _, i: ~F.array_contains(removed, i)), "\n")
    out = joined.withColumn(kept, F.when(F.col(removed).isNotNull(), left).otherwise(F.col(text_col)))
    stays = F.col(removed).isNull() | F.col(kept).rlike(r"[^\x20\x09-\x0D]")
    return out.where(stays).select(*[F.col(kept).alias(c) if c == text_col else F.col(c) for c in docs.columns])
