"""Text cleaning, rule labels and word n-grams as column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenkeel.functions.binding import let

# The artefacts a spreadsheet export leaves in chat text, the
# characters that count as white space, the characters that cleaning keeps, and
# the shape of a word.
SHEET_ARTEFACTS = ("#ERROR!", "#NAME?")
WHITESPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]+"
NOT_KEPT = r"[^\p{L}\p{N}_\s?!']"
WORD = r"[\p{L}\p{N}_]{2,}"
# Letters beyond ASCII that a search that folds case takes for i, s or k.
FOLD_TO_ASCII = "\u0130\u0131\u017f\u212a"
_PLAIN = re.compile(r"[A-Za-z]+(?:\|[A-Za-z]+)*")


def as_text(col: Column) -> Column:
    """Cast to string; a missing value becomes the empty string."""
    return F.coalesce(col.cast("string"), F.lit(""))


def squeeze(col: Column) -> Column:
    """One blank between words, none at the ends."""
    return F.trim(F.regexp_replace(col, WHITESPACE, " "))


def normalize_text(col: Column, lower: bool = False) -> Column:
    """Drop spreadsheet artefacts and squeeze white space."""
    text = as_text(col)
    for artefact in SHEET_ARTEFACTS:
        text = F.replace(text, F.lit(artefact), F.lit(""))
    return squeeze(F.lower(text) if lower else text)


def clean_text(col: Column) -> Column:
    """Lower-case text of word characters, ``?``, ``!`` and ``'`` only."""
    return squeeze(F.lower(F.regexp_replace(as_text(col), NOT_KEPT, " ")))


def contains_any(col: Column, pattern: str) -> Column:
    """Case-insensitive search that folds all of Unicode."""
    return col.rlike("(?iu)" + pattern)


def _rule_search(text: Column, low: Column, folds: Column, pattern: str) -> Column:
    """:func:`contains_any`; alternatives of ASCII letters are looked for as plain strings in the lower-cased text."""
    if not _PLAIN.fullmatch(pattern):
        return contains_any(text, pattern)
    plain = reduce(lambda a, b: a | b, [F.contains(low, F.lit(word)) for word in pattern.lower().split("|")])
    return F.when(folds, contains_any(text, pattern)).otherwise(plain)


def keyword_class(col: Column, rules: Sequence[tuple[int, str]]) -> Column:
    """Label of the first rule whose pattern occurs in the text, else null.

    ``rules`` holds ``(label, pattern)`` in order of priority. Patterns are
    searched anywhere, also inside longer words. The text and its lower-cased
    form are computed once for all rules; a text with a letter beyond ASCII that
    folds into ASCII is searched by pattern.
    """

    def search(bound: Column) -> Column:
        text, low, folds = (bound[name] for name in ("text", "low", "folds"))
        chain = F
        for label, pattern in rules:
            chain = chain.when(_rule_search(text, low, folds, pattern), F.lit(label))
        return chain

    def folded(text: Column) -> Column:
        odd = reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in FOLD_TO_ASCII])
        return F.struct(text.alias("text"), F.lower(text).alias("low"), odd.alias("folds"))

    return let(col.cast("string"), lambda text: let(folded(text), search))


def flag_class(
    text: Column,
    threat: Column,
    hate: Column,
    pattern: str,
    threat_label: int = 4,
    hate_label: int = 3,
    keyword_label: int = 5,
) -> Column:
    """Label from two flags, with the hate rows split by a keyword search.

    Rows with neither flag get null. ``text`` is the cleaned text.
    """
    hate_only = (hate == 1) & (threat == 0)
    return (
        F.when(threat == 1, F.lit(threat_label))
        .when(hate_only & contains_any(text, pattern), F.lit(keyword_label))
        .when(hate_only, F.lit(hate_label))
    )


def words(col: Column) -> Column:
    """Lower-cased words of two or more characters."""
    return F.regexp_extract_all(F.lower(as_text(col)), F.lit(WORD), F.lit(0))


def ngrams(tokens: Column, lo: int = 1, hi: int = 2) -> Column:
    """Word n-grams of ``lo`` to ``hi`` words from an array of words."""

    def build(w: Column) -> Column:
        gram, sizes = w, []
        for n in range(1, hi + 1):
            if n > 1:
                shifted = F.slice(w, F.lit(n), F.size(w))
                gram = F.zip_with(gram, shifted, lambda a, b: F.concat(a, F.lit(" "), b))
            if n >= lo:
                sizes.append(F.array_compact(gram) if n > 1 else gram)
        return sizes[0] if len(sizes) == 1 else F.concat(*sizes)

    return let(tokens, build)


def term_counts(terms: Column) -> Column:
    """``array<struct<term, tf>>`` in order of the terms, from an array of terms.

    The terms are sorted and the places where a new one starts are kept, so
    counting them stays within the row.
    """

    def starts(s: Column) -> Column:
        return F.array_compact(F.transform(s, lambda term, i: F.when(~term.eqNullSafe(F.get(s, i - 1)), i)))

    def count(s: Column, at: Column) -> Column:
        return F.transform(
            at,
            lambda first, j: F.struct(
                F.get(s, first).alias("term"), (F.coalesce(F.get(at, j + 1), F.size(s)) - first).alias("tf")
            ),
        )

    return let(F.sort_array(terms), lambda s: let(starts(s), lambda at: count(s, at)))


def timestamp_text(col: Column | None = None) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; the present moment if no column is given."""
    return F.date_format(F.current_timestamp() if col is None else col, "yyyy-MM-dd HH:mm:ss")
