"""Larger and better balanced training sets from external corpora.

Each function takes DataFrames and gives back ``(index, message, label)``; the
caller writes it with :func:`evenkeel.sources.tables.write_text_label`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.binding import with_costly
from evenkeel.functions.labels import INTENT_LABELS, map_labels, prefix_ids
from evenkeel.functions.text import as_text, clean_text, flag_class, keyword_class
from evenkeel.operators.features import embed
from evenkeel.operators.joins import union_sources
from evenkeel.operators.ranking import top_n_per_class
from evenkeel.operators.sampling import SEED, hash_rank, reindex, source_mix
from evenkeel.operators.similarity import max_cosine
from evenkeel.session import cut_lineage

# Fixed value: rows taken per class when candidates are chosen by similarity.
SIMILAR_PER_CLASS = {3: 800, 4: 200, 5: 50}
# Fixed value: cleaned messages of this many characters or fewer are dropped.
SHORTEST = 5


def mixed_augmentation(
    train: DataFrame,
    chat: DataFrame,
    chat_id: str,
    text: str = "utterance",
    category: str = "intentClass",
    mapping: Mapping[str, int] = INTENT_LABELS,
    pooled: Mapping | None = None,
    drawn: Mapping | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Relabel a chat corpus by its categories, mix it in by class, number anew.

    Sampling and numbering see ids and labels only; the texts are joined to the
    rows that were taken. Rows that share an id are told apart by their texts.
    """
    extra = map_labels(chat, category, mapping).select(
        F.col(chat_id).cast("string").alias("index"), F.col(text).alias("message"), "label"
    )
    train, extra = (rows.withColumn("_row", F.xxhash64("message")) for rows in (train, extra))
    keys = [cut_lineage(rows.select("index", "_row", "label")) for rows in (train, extra)]
    mixed = source_mix(*keys, "index", pooled=pooled, drawn=drawn, seed=seed)
    # a row is known by its source, its id there, and the draw that took it
    mixed = cut_lineage(
        mixed.withColumn("_key", F.concat_ws(":", "index", F.coalesce(F.col("draw").cast("string"), F.lit("-"))))
    )
    taken = cut_lineage(reindex(mixed, "_key", "source", out="_new", seed=seed).select("index", "_row", "label", "source", "_new"))
    parts = [
        rows.select("index", "_row", "message").dropDuplicates(["index", "_row"])
        .join(taken.where(F.col("source") == i).drop("source"), ["index", "_row"])
        for i, rows in enumerate((train, extra))
    ]
    return union_sources(*parts).select(F.col("_new").alias("index"), "message", "label")


def keyword_candidates(
    corpus: DataFrame, id_col: str, prefix: str, rules: Sequence[tuple[int, str]], text: str = "full_text"
) -> DataFrame:
    """Rows that a keyword rule hits, cleaned, with marked ids."""
    labelled = with_costly(
        corpus.select(id_col, as_text(F.col(text)).alias("_text")), label=keyword_class(F.col("_text"), rules)
    )
    hits = labelled.where(F.col("label").isNotNull())
    return prefix_ids(hits, prefix, id_col).select("index", clean_text(F.col("_text")).alias("message"), "label")


def keyword_augmentation(
    train: DataFrame,
    corpus: DataFrame,
    id_col: str,
    prefix: str,
    rules: Sequence[tuple[int, str]],
    text: str = "full_text",
    category: str | None = "category_id",
    keep=0,
) -> DataFrame:
    """Add the rows of a corpus that keyword rules label as a minority class."""
    if category is not None:
        corpus = corpus.where(F.col(category) == keep)
    return union_sources(
        train.select("index", "message", "label"), keyword_candidates(corpus, id_col, prefix, rules, text)
    )


def flag_augmentation(
    train: DataFrame,
    corpus: DataFrame,
    id_col: str,
    prefix: str,
    pattern: str,
    text: str = "comment_text",
    threat: str = "threat",
    hate: str = "identity_hate",
    seed: int = SEED,
) -> DataFrame:
    """Add the rows of a flag corpus as threats, hate, or keyword hits among hate."""
    flagged = corpus.where((F.col(threat) == 1) | ((F.col(hate) == 1) & (F.col(threat) == 0)))
    cleaned = with_costly(flagged.select(id_col, threat, hate, text), message=clean_text(F.col(text)))
    rows = cleaned.where(F.length("message") > SHORTEST).select(
        id_col,
        "message",
        flag_class(F.col("message"), F.col(threat), F.col(hate), pattern).alias("label"),
    )
    numbered = hash_rank(rows, id_col, seed, rank="_n").withColumn("_n", F.col("_n") - 1)
    return union_sources(
        train.select("index", "message", "label"),
        prefix_ids(numbered, prefix, "_n").select("index", "message", "label"),
    )


def semantic_augmentation(
    train: DataFrame,
    corpus: DataFrame,
    test: DataFrame,
    id_col: str,
    prefix: str,
    rules: Sequence[tuple[int, str]],
    n_per_class: Mapping[int, int] = SIMILAR_PER_CLASS,
    text: str = "full_text",
    category: str | None = "category_id",
    keep=0,
    encoder: Callable | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Add the keyword hits that lie closest to the test texts.

    Gives back the enlarged training set and the chosen rows with their
    similarity.
    """
    if category is not None:
        corpus = corpus.where(F.col(category) == keep)
    cands = embed(keyword_candidates(corpus, id_col, prefix, rules, text), "message", encoder)
    ref = embed(test.select("index", clean_text(F.col("message")).alias("message")), "message", encoder)
    scored = max_cosine(cands, ref, "vec", "index").drop("vec")
    chosen = top_n_per_class(scored, "label", "sim_score", dict(n_per_class), "index")
    return union_sources(train.select("index", "message", "label"), chosen.drop("sim_score")), chosen
