"""Personal data by weak supervision: labelers vote on spans, expectation-maximisation weighs them, a classifier decides.

Patterns find candidate spans in every whole text. For each kind of data five labelers vote on a candidate: its strict
pattern, a validity check, a gazetteer, words around it that point to the kind, and words that speak against it.
How often each pattern of votes occurs, a table of at most a few thousand rows however large the corpus, is all
that leaves the executors. Expectation-maximisation finds from it how far each labeler can be trusted, without
any label; its posteriors train a logistic span classifier on votes and shape, which goes back into the plan as one
expression. Spans of the strict patterns are always kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.binding import let, with_costly

KINDS = ("email", "ip", "card", "phone")

# Strict patterns. They find what the plain ones of the docstring of ``base_spans`` find, in time linear in the text:
# possessive, and tried inside a run of their first characters only where the match before has ended.
_LOCAL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++"
_DIGIT = r"(?:(?<![0-9])|\G)"
STRICT = {
    "email": _LOCAL + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _DIGIT + r"[0-9]++(?:\.[0-9]++){3}",
    "card": _DIGIT + r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Wider patterns, for what the labelers vote on: spelled-out addresses, other separators, no country code.
_NAME, _DOT = r"[A-Za-z0-9-]++", r"(?:[ ]?(?:\(dot\)|\[dot\])[ ]?|[ ]dot[ ])"
WIDE = {
    "email": _LOCAL + rf"(?:[ ]?(?:\(at\)|\[at\])[ ]?{_NAME}(?:(?:{_DOT}|\.){_NAME})++|[ ]at[ ]{_NAME}(?:{_DOT}{_NAME})++)",
    "ip": _DIGIT + r"[0-9]{1,3}+(?:(?:\[\.\]|\(\.\)|,)[0-9]{1,3}+){3}(?![0-9])",
    "card": _DIGIT + r"[0-9]{4}+(?:[./_][0-9]{4}+){3}(?![0-9])",
    "phone": r"(?<![0-9+().-])(?:00[1-9]|\(?0?[0-9]{3}\)?)[ .-][0-9][ ().0-9-]{5,14}[0-9](?![0-9])",
}
GAZETTEER = {
    "email": r"(?i)\b(?:com|org|net|edu|gov|info|de|fr|es|uk|eu|io)$",
    "ip": r"^(?:10|127|172|192)\D",
    "card": r"^(?:4|5[1-5]|3[47]|6011|65)",
    "phone": r"^\D*(?:1|33|34|39|44|49|00)",
}
CUES = {
    "email": r"(?i)mail|contact|write|kontakt|correo|courriel",
    "ip": r"(?i)\bip\b|host|server|address|adresse",
    "card": r"(?i)card|visa|karte|carte|tarjeta|credit",
    "phone": r"(?i)tel|phone|call|mobile|fax|cell|ruf",
}
AGAINST = r"(?i)version|token|price|isbn|order|serial|release|[#$%=]\s*$"
LABELERS = ("strict", "valid", "gazetteer", "cue", "against")
AROUND = 40
#: Rounds of expectation-maximisation, and of gradient steps of the classifier, over the table of votes.
EM_ROUNDS, STEPS = 50, 400
THRESHOLD = 0.5


def _before(values: Column, first: int, merge: Callable[[Column, Column], Column]) -> Column:
    """What the entries before each entry merge to, from ``first`` on; in blocks, so that a million entries are no square of work."""
    block = 256
    empty = F.array().cast("array<bigint>")
    start = F.lit(first).cast("bigint")

    def scan(a: Column) -> Column:
        state = F.struct(start.alias("at"), empty.alias("out"))
        return F.aggregate(
            a, state, lambda s, x: F.struct(merge(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")),
            lambda s: s["out"],
        )

    def whole(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, start, merge))
        return let(scan(totals), lambda base: F.flatten(
            F.transform(blocks, lambda b, i: F.transform(scan(b), lambda v: merge(v, F.get(base, i))))))

    def cut(a: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(a) - 1, F.lit(block)), lambda s: F.slice(a, s + 1, F.lit(block)))

    return let(values, lambda a: F.when(F.size(a) > 0, let(cut(a), whole)).otherwise(empty))


def _larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _smaller(a: Column, b: Column) -> Column:
    return F.least(a, b)


def _clear_of(wide: Column, base: Column) -> Column:
    """The spans of ``wide`` that share no character with one of ``base``, by one pass over both in the order of their starts.

    A span is met by one that begins before it if the furthest end so far lies behind its start, and by one that begins
    in it if the next start ahead lies before its end.
    """
    far = 1 << 62

    def event(s: Column, place: Column) -> Column:
        return F.struct(s["start"].alias("start"), place.alias("place"), s["end"].alias("end"))

    def pick(x: Column) -> Column:
        every = x["every"]
        reach = _before(F.transform(every, lambda e: F.when(e["place"] < 0, e["end"]).otherwise(F.lit(0).cast("bigint"))), 0, _larger)
        starts = F.transform(every, lambda e: F.when(e["place"] < 0, e["start"]).otherwise(F.lit(far)))
        ahead = F.reverse(_before(F.reverse(starts), far, _smaller))

        def free(y: Column) -> Column:
            places = F.transform(every, lambda e, i: F.when(
                (e["place"] >= 0) & (F.get(y["reach"], i) <= e["start"]) & (F.get(y["ahead"], i) >= e["end"]), e["place"]))
            return F.transform(F.filter(places, lambda p: p.isNotNull()), lambda p: F.get(x["wide"], p))

        return let(F.struct(reach.alias("reach"), ahead.alias("ahead")), free)

    def both(w: Column) -> Column:
        events = F.concat(F.transform(base, lambda s: event(s, F.lit(-1))), F.transform(w, event))
        return F.when(F.size(w) > 0, let(F.struct(F.sort_array(events).alias("every"), w.alias("wide")), pick)).otherwise(w)

    return let(wide, both)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(x: Column) -> Column:
    """Whether 14 to 19 digits pass the checksum."""
    digits = F.filter(F.split(F.reverse(_digits(x)), ""), lambda c: c != "")
    doubled = F.transform(digits, lambda c, i: F.when(i % 2 == 1, c.cast("int") * 2 - F.when(c >= "5", 9).otherwise(0)).otherwise(c.cast("int")))
    return F.length(_digits(x)).between(14, 19) & (F.aggregate(doubled, F.lit(0), lambda a, v: a + v) % 10 == 0)


def _octets(x: Column) -> Column:
    """Whether the four numbers are at most 255; zeros before them count for nothing."""
    parts = F.transform(F.regexp_extract_all(x, F.lit("[0-9]+"), F.lit(0)), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda x: F.length(x) > 0,
    "ip": _octets,
    "card": _luhn,
    "phone": lambda x: F.length(_digits(x)).between(10, 15),
}
#: What a text must hold for a pattern to be tried at all.
NEEDS = {"email": "@", "phone": "+"}


def _found(body: Column, pattern: str, keep: Callable[[Column], Column] | None, needs: str | None) -> Column:
    """Matches as ``(start, end, hit, left, right)``, by code points, from the pieces between them."""
    kind = "array<struct<start:bigint,end:bigint,hit:string,left:string,right:string>>"

    def of(x: Column) -> Column:
        pieces, hits = x["pieces"], x["hits"]
        gaps = F.transform(F.slice(pieces, F.lit(1), F.size(hits)), lambda p: F.length(p).cast("bigint"))
        widths = F.zip_with(gaps, hits, lambda g, h: g + F.length(h))

        def place(before: Column) -> Column:
            def span(h: Column, i: Column) -> Column:
                # the gap before this hit alone: an expression over all gaps would be computed anew for each hit
                start = F.get(before, i) + F.length(F.get(pieces, i))
                return F.struct(
                    start.alias("start"), (start + F.length(h)).alias("end"), h.alias("hit"),
                    F.right(F.get(pieces, i), F.lit(AROUND)).alias("left"),
                    F.left(F.get(pieces, i + 1), F.lit(AROUND)).alias("right"),
                )

            return F.transform(hits, span)

        return let(_before(widths, 0, lambda a, w: a + w), place)

    both = F.struct(F.split(body, pattern).alias("pieces"), F.regexp_extract_all(body, F.lit(pattern), F.lit(0)).alias("hits"))
    spans = let(both, of)
    if keep:
        spans = F.filter(spans, lambda s: keep(s["hit"]))
    here = body.contains(needs) if needs else body.rlike(pattern)
    return F.when(here, spans).otherwise(F.array().cast(kind)).cast(kind)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, email, ip, card, phone``: the matches of the strict patterns that pass their check, leftmost first.

    email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``; ip four numbers of at most 255; card 14 to 19
    digits that pass the Luhn checksum; phone a plus and 10 to 15 digits.
    """
    texts = _texts(docs, id_col, text_col)
    return with_costly(
        texts, **{k: _found(F.col("body"), STRICT[k], VALID[k], NEEDS.get(k)) for k in KINDS}
    )


def _with_candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    based = base_spans(docs, id_col, text_col)

    def free(kind: str) -> Column:
        # what lies in a base span, of any kind, is not looked at again
        plain = [F.transform(F.col(k), lambda s: F.struct(s["start"], s["end"])) for k in KINDS]
        return _clear_of(_found(F.col("body"), WIDE[kind], None, None), F.concat(*plain))

    return with_costly(based, **{f"wide_{k}": free(k) for k in KINDS})


def _votes(kind: str, s: Column, strict: bool) -> dict[str, Column]:
    """1 for, 0 against; ``shape`` is the number of digits, up to 15, and whether there are separators."""
    digits = F.length(_digits(s["hit"]))
    return {
        "strict": F.lit(int(strict)),
        "valid": VALID[kind](s["hit"]).cast("int"),
        "gazetteer": s["hit"].rlike(GAZETTEER[kind]).cast("int"),
        "cue": s["left"].rlike(CUES[kind]).cast("int"),
        "against": (~s["left"].rlike(AGAINST)).cast("int"),
        "shape": (F.least(digits, F.lit(15)) * 2 + s["hit"].rlike(r"[ ()./_-]").cast("int")).cast("int"),
    }


def _ballot(kind: str, strict: bool) -> Callable[[Column], Column]:
    return lambda s: F.struct(F.lit(kind).alias("kind"), *[v.alias(c) for c, v in _votes(kind, s, strict).items()])


def vote_table(candidates: DataFrame) -> DataFrame:
    """``kind, strict, valid, gazetteer, cue, against, shape, n``: how often each pattern of votes occurs."""
    rows = []
    for k in KINDS:
        for name, strict in ((k, True), (f"wide_{k}", False)):
            rows.append(F.transform(F.col(name), _ballot(k, strict)))
    return (
        candidates.select(F.explode(F.concat(*rows)).alias("v")).select("v.*")
        .groupBy("kind", *LABELERS, "shape").agg(F.count(F.lit(1)).alias("n"))
    )


@dataclass
class SpanModel:
    """Reliabilities ``(right on true spans, right on others)`` per kind and labeler, and the classifier's weights."""

    reliability: dict[str, dict[str, tuple[float, float]]]
    weights: dict[str, dict[str, float]]


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _inputs(row: dict) -> dict[str, float]:
    return {"bias": 1.0, **{c: float(row[c]) for c in LABELERS}, "digits": (row["shape"] // 2) / 15, "separated": float(row["shape"] % 2)}


def fit(table: list[dict], anchored: bool = True) -> SpanModel:
    """Expectation-maximisation over vote patterns, then a logistic fit to its posteriors; both per kind.

    Spans of the strict pattern are kept in any case, so if ``anchored`` they count as true throughout.

    The table is bounded by the number of vote patterns, so this runs on the driver. A kind without candidates
    has no weights, and no span of it is added.
    """
    reliability, weights = {}, {}
    for kind in KINDS:
        rows = sorted((r for r in table if r["kind"] == kind), key=lambda r: [r[c] for c in (*LABELERS, "shape")])
        if not rows:
            continue
        # votes of the majority start the rounds; one pseudo-count on each side keeps every rate inside (0, 1)
        post = [sum(r[c] for c in LABELERS) / len(LABELERS) for r in rows]
        rates: dict[str, tuple[float, float]] = {}
        for _ in range(EM_ROUNDS):
            if anchored:
                post = [1.0 if r["strict"] else p for r, p in zip(rows, post)]
            true = sum(p * r["n"] for p, r in zip(post, rows))
            false = sum((1 - p) * r["n"] for p, r in zip(post, rows))
            prior = (true + 1) / (true + false + 2)
            for c in LABELERS:
                hit = sum(p * r["n"] for p, r in zip(post, rows) if r[c])
                miss = sum((1 - p) * r["n"] for p, r in zip(post, rows) if not r[c])
                rates[c] = (max(0.5, (hit + 1) / (true + 2)), max(0.5, (miss + 1) / (false + 2)))
            post = []
            for r in rows:
                odds = math.log(prior / (1 - prior))
                for c in LABELERS:
                    a, b = rates[c]
                    odds += math.log(a / (1 - b + 1e-9)) if r[c] else math.log((1 - a + 1e-9) / b)
                post.append(_sigmoid(odds))
        reliability[kind] = dict(rates)
        names = list(_inputs(rows[0]))
        w = dict.fromkeys(names, 0.0)
        whole = sum(r["n"] for r in rows)
        for _ in range(STEPS):
            slope = dict.fromkeys(names, 0.0)
            for r, p in zip(rows, post):
                x = _inputs(r)
                off = (_sigmoid(sum(w[c] * x[c] for c in names)) - p) * r["n"] / whole
                for c in names:
                    slope[c] += off * x[c]
            for c in names:
                w[c] -= 2.0 * (slope[c] + 1e-4 * w[c])
        weights[kind] = w
    return SpanModel(reliability, weights)


def _accepted(kind: str, model: SpanModel) -> Callable[[Column], Column]:
    def decide(s: Column) -> Column:
        if kind not in model.weights:
            return F.lit(False)
        w, votes = model.weights[kind], _votes(kind, s, False)
        odds = F.lit(w["bias"]) + F.floor(votes["shape"] / 2) / 15 * w["digits"] + votes["shape"] % 2 * w["separated"]
        for c in LABELERS:
            odds = odds + votes[c] * w[c]
        return odds > math.log(THRESHOLD / (1 - THRESHOLD))

    return decide


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: SpanModel | None = None) -> DataFrame:
    """``doc_id, base, spans`` per document, both arrays of ``(start, rank, end)``, sorted; ``rank`` counts ``KINDS`` from 0.

    ``base`` holds the strict matches, ``spans`` those and what the classifier adds. A null or empty text has none. Rows
    with the same id are searched one by one, a null id stays null. Other columns, whatever their names, are not
    read. An empty table gives no rows. Without ``model`` one is fitted to the votes in all of ``docs`` first.
    """
    found = _with_candidates(docs, id_col, text_col)
    if model is None:
        model = fit([r.asDict() for r in vote_table(found).collect()])
    kind = "array<struct<start:bigint,rank:int,end:bigint>>"

    def plain(name: str, rank: int, keep=None) -> Column:
        spans = F.filter(F.col(name), keep) if keep else F.col(name)
        return F.transform(spans, lambda s: F.struct(s["start"], F.lit(rank).alias("rank"), s["end"])).cast(kind)

    base = F.concat(*[plain(k, i) for i, k in enumerate(KINDS)])
    more = F.concat(*[plain(f"wide_{k}", i, _accepted(k, model)) for i, k in enumerate(KINDS)])
    return found.select("doc_id", F.sort_array(base).alias("base"), F.sort_array(F.concat(base, more)).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ",")
