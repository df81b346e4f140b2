"""Mixing to target weights: iterative proportional fitting of token weights, then a calibrated sample of documents.

Tokens are summed per cell of source, language and topic before anything is shuffled. Raking scales the cells in turn
until the sums of each dimension meet its targets, on that small table alone, with windows over one dimension at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import WORD, fresh, settle, uniform

DIMENSIONS = ("source", "lang", "topic")
#: First pattern that is found names the topic; ``prose`` otherwise.
TOPICS = (
    ("licence", "(?i)licen[cs]ed?|rights reserved"),
    ("contact", r"@[A-Za-z0-9-]+\.|\+[0-9] "),
    ("table", r"[|]"),
)
#: A dimension's target share is its natural share to this power, scaled to a sum of one.
FLATTEN = 0.7
ROUNDS = 12
_ROUNDS_AT_ONCE = 4
SEED = "mix"
#: Cells that are sent to every executor at most (some 60 bytes each); more are joined by a shuffle.
CELLS = 200_000


def topic_of(text: Column, topics=TOPICS) -> Column:
    out = F.lit("prose")
    for name, pattern in reversed(topics):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def _cells(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0")


def flat_targets(cells: DataFrame, power: float = FLATTEN) -> dict[str, DataFrame]:
    """``(value, share)`` per dimension: natural shares of tokens, flattened."""
    out = {}
    for d in DIMENSIONS:
        raised = cells.groupBy(F.col(d).alias("value")).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("raised"))
        out[d] = raised.select("value", (F.col("raised") / F.sum("raised").over(Window.partitionBy(F.lit(0)))).alias("share"))
    return out


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` with ``weight``: tokens scaled so that each dimension's sums approach its target shares of the total.

    A value without a target keeps its share of the weight as it is. Values that only a target names change nothing.
    """
    total = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()["n"]
    state = cells
    for d in DIMENSIONS:
        goal = targets[d].select(F.col("value").alias(f"of_{d}"), (F.col("share") * F.lit(float(total))).alias(f"goal_{d}"))
        state = state.join(goal, F.col(d).eqNullSafe(F.col(f"of_{d}")), "left").drop(f"of_{d}")
    state = settle(state.withColumn("weight", F.col("tokens").cast("double")))
    for done in range(rounds):
        for d in DIMENSIONS:
            now = F.sum("weight").over(Window.partitionBy(d))
            scaled = F.col("weight") * F.col(f"goal_{d}") / now
            state = state.withColumn("weight", F.when(F.col(f"goal_{d}").isNotNull() & (now > 0), scaled).otherwise(F.col("weight")))
        if (done + 1) % _ROUNDS_AT_ONCE == 0 or done + 1 == rounds:
            state = settle(state)
    return state.select(*DIMENSIONS, "tokens", "weight")


def tagged(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str, topics=TOPICS) -> DataFrame:
    """``doc_id, source, lang, topic, n_tokens`` of every whole text; a null text has no tokens."""
    body = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.col(lang_col).cast("string").alias("lang"), topic_of(body, topics).alias("topic"),
        F.regexp_count(body, F.lit(WORD)).cast("bigint").alias("n_tokens"),
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
    targets: dict[str, DataFrame] | None = None, topics=TOPICS, rounds: int = ROUNDS, seed: str = SEED,
) -> DataFrame:
    """``doc_id, source, lang, topic, n_tokens, probability, weight, kept`` per document.

    A cell's raked weight over its tokens says how much of it is wanted. Where that is below one the document is kept
    with this probability; otherwise it is kept and ``weight`` says how often it counts. Sums of ``weight`` times tokens
    over kept documents so meet the targets in expectation. The draw depends on id and seed alone: rows with one
    id are kept or left out together, and a null id draws as the empty text. Null sources and languages are values of
    their own. A text without tokens is kept, as it has no weight to change. Other columns, whatever their names, are
    not read. An empty table gives no rows. ``targets`` maps each dimension to ``(value, share)``.
    """
    base = settle(tagged(docs, id_col, text_col, source_col, lang_col, topics))
    cells = settle(_cells(base))
    raked = rake(cells, targets or flat_targets(cells), rounds)
    ratio = raked.select(*[F.col(d).alias(f"of_{d}") for d in DIMENSIONS], (F.col("weight") / F.col("tokens")).alias("ratio"))
    match = [F.col(d).eqNullSafe(F.col(f"of_{d}")) for d in DIMENSIONS]
    wanted = F.when(F.col("n_tokens") > 0, F.coalesce("ratio", F.lit(1.0))).otherwise(F.lit(1.0))
    return (
        base.join(ratio, match[0] & match[1] & match[2], "left")
        .withColumn("wanted", wanted)
        .select(
            "doc_id", *DIMENSIONS, "n_tokens", F.least("wanted", F.lit(1.0)).alias("probability"),
            F.greatest("wanted", F.lit(1.0)).alias("weight"),
            (uniform(F.col("doc_id"), seed) < F.col("wanted")).alias("kept"),
        )
    )


def repeat_mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
    targets: dict[str, DataFrame] | None = None, topics=TOPICS, rounds: int = ROUNDS, seed: str = SEED,
) -> DataFrame:
    """``docs`` with their own columns, each row as often as the mix wants it: its tokens meet the targets in expectation.

    Of a ratio of raked weight to tokens the whole part is the number of copies, and the draw of ``mix`` decides on one
    more. So a row whose ratio is below one stays or goes as it does there. A row without tokens stays once, and a row
    without an id at least once, as it cannot be told from others.
    """
    base = settle(tagged(docs, id_col, text_col, source_col, lang_col, topics))
    cells = settle(_cells(base))
    names = {c: fresh(docs, c) for c in ("of_source", "of_lang", "of_topic", "ratio", "copies", "copy")}
    raked = rake(cells, targets or flat_targets(cells), rounds)
    ratio = settle(raked.select(
        *[F.col(d).alias(names[f"of_{d}"]) for d in DIMENSIONS], (F.col("weight") / F.col("tokens")).alias(names["ratio"])
    ))
    if ratio.limit(CELLS + 1).count() <= CELLS:
        ratio = F.broadcast(ratio)
    body = F.coalesce(F.col(text_col), F.lit(""))
    match = (
        F.col(source_col).cast("string").eqNullSafe(F.col(names["of_source"]))
        & F.col(lang_col).cast("string").eqNullSafe(F.col(names["of_lang"]))
        & topic_of(body, topics).eqNullSafe(F.col(names["of_topic"]))
    )
    wanted = F.when(body.rlike(WORD), F.coalesce(names["ratio"], F.lit(1.0))).otherwise(F.lit(1.0))
    whole = F.floor(wanted)
    copies = whole + (uniform(F.col(id_col), seed) < wanted - whole).cast("bigint")
    copies = F.when(F.col(id_col).isNull(), F.greatest(copies, F.lit(1))).otherwise(copies).cast("int")
    counted = docs.join(ratio, match, "left").withColumn(names["copies"], copies).where(F.col(names["copies"]) > 0)
    return counted.withColumn(names["copy"], F.explode(F.array_repeat(F.lit(0), F.col(names["copies"])))).select(*docs.columns)
