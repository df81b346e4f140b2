"""TF-IDF, fixed-length encoding, and text embeddings."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    HashingTF,
    Normalizer,
    SQLTransformer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.text import WORD, ngrams, term_counts, words
from evenkeel.session import SMALL_ROWS, cut_lineage, small_side


# Entries of the table that tells frequent words from rare ones.
WORD_BUCKETS = 1 << 17


def gram_counts(text: str, lo: int, hi: int) -> Column:
    return term_counts(ngrams(words(F.col(text)), lo, hi))


def _rows_of(df: DataFrame, *keys: str) -> DataFrame:
    """One row per term of ``terms``.

    The outer form is used because Spark puts a filter on the size of the array
    below the plain one, and with it computes the array a second time.
    """
    return df.select(*keys, F.inline_outer("terms")).where(F.col("term").isNotNull())


def _gram_stats(df: DataFrame, tokens: Column, lo: int, hi: int) -> DataFrame:
    """``term, df, cf`` of the n-grams of an array of words; a missing word leaves out the n-grams it would be in.

    The terms of a row are sorted: a term counts for its row where the one before is another.
    """
    grams = df.select(F.sort_array(ngrams(tokens, lo, hi)).alias("terms"))
    each = grams.select("terms", F.posexplode_outer("terms").alias("at", "term")).where(F.col("term").isNotNull())
    first = (F.col("at") == 0) | (F.get("terms", F.col("at") - 1) != F.col("term"))
    return each.groupBy("term").agg(F.count_if(first).alias("df"), F.count("*").alias("cf"))


def _without_rare(tokens: Column, stats: DataFrame, chosen: DataFrame, max_features: int) -> Column:
    """The words with null for those that no chosen n-gram can hold.

    An n-gram occurs at most as often as each of its words, and ``max_features`` chosen words leave no place for a term
    that occurs less often than the last of them. Words are told by a hash of theirs: a rare word that has the hash of
    a frequent one stays, and its n-grams are counted for nothing.
    """
    last = chosen.agg(F.count("*").alias("n"), F.min("cf").alias("cf")).head()
    if last.n < max_features:
        return tokens

    def bucket(word: Column) -> Column:
        return F.pmod(F.xxhash64(word), F.lit(WORD_BUCKETS)).cast("int")

    frequent = {r[0] for r in stats.where(F.col("cf") >= last.cf).select(bucket(F.col("term"))).distinct().collect()}
    flags = ",".join("1" if b in frequent else "0" for b in range(WORD_BUCKETS))
    table = F.split(F.lit(flags), ",").cast("array<tinyint>")
    return F.transform(tokens, lambda w: F.when(F.get(table, bucket(w)) == 1, w))


def tfidf_vocabulary(
    df: DataFrame,
    text: str,
    max_features: int = 10_000,
    min_df: int = 2,
    max_df: float = 0.9,
    lo: int = 1,
    hi: int = 2,
) -> DataFrame:
    """Terms with document frequency and idf, most frequent first.

    A term must occur in at least ``min_df`` documents and in at most the share
    ``max_df`` of them. Of these the ``max_features`` with the most occurrences
    stay, ties by term. idf is ``ln((1 + n) / (1 + df)) + 1``. Columns ``term``,
    ``df``, ``cf``, ``idf``.

    Where single words are terms, they are counted first, and longer n-grams only
    if their words are frequent enough for them to be among the terms that stay.
    """
    n_docs = df.count()

    def most(stats: DataFrame) -> DataFrame:
        fit = stats.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df * n_docs)))
        return fit.orderBy(F.col("cf").desc(), F.col("term").asc()).limit(max_features)

    tokens = words(F.col(text))
    if lo == 1 and hi > 1:
        single = cut_lineage(_gram_stats(df, tokens, 1, 1))
        chosen = most(single)
        longer = _gram_stats(df, _without_rare(tokens, single, chosen, max_features), 2, hi)
        top = most(chosen.unionByName(longer))
    else:
        top = most(_gram_stats(df, tokens, lo, hi))
    return top.withColumn("idf", F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0)


def tfidf_fit(df: DataFrame, text: str, out: str = "features", **vocabulary) -> PipelineModel:
    """A saved-model-ready transformer from text to unit-length TF-IDF vectors.

    The vocabulary comes from :func:`tfidf_vocabulary` and is ordered by term.
    The transformer works within the row and shuffles nothing.
    """
    lo, hi = vocabulary.get("lo", 1), vocabulary.get("hi", 2)
    terms = sorted(
        tfidf_vocabulary(df, text, **vocabulary).select("term", "idf").collect(), key=lambda r: r["term"]
    )
    if not terms:
        raise ValueError("no term is left after the document frequency limits")
    count = CountVectorizerModel.from_vocabulary([r["term"] for r in terms], inputCol="_grams", outputCol="_tf")
    return PipelineModel(
        [
            *_gram_stages(text, lo, hi),
            count,
            ElementwiseProduct(
                scalingVec=Vectors.dense([r["idf"] for r in terms]), inputCol="_tf", outputCol="_tfidf"
            ),
            Normalizer(p=2.0, inputCol="_tfidf", outputCol=out),
            SQLTransformer(statement="SELECT * EXCEPT (_grams, _tf, _tfidf) FROM __THIS__"),
        ]
    )


def _gram_stages(text: str, lo: int, hi: int) -> list[SQLTransformer]:
    pattern = WORD.replace("\\", "\\\\")
    parts, gram = [], "w"
    for n in range(1, hi + 1):
        if n > 1:
            gram = f"zip_with({gram}, slice(w, {n}, size(w)), (a, b) -> concat(a, ' ', b))"
        if n >= lo:
            parts.append(f"array_compact({gram})")
    found = f"regexp_extract_all(lower(coalesce(`{text}`, '')), '{pattern}', 0)"
    # the words are bound to w once per row
    grams = f"get(transform(array({found}), w -> concat({', '.join(parts)})), 0)"
    return [SQLTransformer(statement=f"SELECT *, {grams} AS _grams FROM __THIS__")]


def tfidf_transform(df: DataFrame, model: PipelineModel) -> DataFrame:
    return model.transform(df)


def tfidf_terms(df: DataFrame, key: str, text: str, vocabulary: DataFrame, lo: int = 1, hi: int = 2) -> DataFrame:
    """TF-IDF in long form: one row per document and term, unit length per document.

    Terms are matched against the vocabulary where they are made; what is
    shuffled is the matched terms of a document, to bring it to unit length.
    """
    grams = df.select(key, gram_counts(text, lo, hi).alias("terms"))
    matched = _rows_of(grams, key).join(small_side(vocabulary.select("term", "idf")), "term").select(
        key, "term", (F.col("tf") * F.col("idf")).alias("w")
    )
    # a document holds at most as many terms as the vocabulary
    return (
        matched.groupBy(key)
        .agg(F.collect_list(F.struct("term", "w")).alias("t"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("n"))
        .select(key, "n", F.inline("t"))
        .select(key, "term", (F.col("w") / F.col("n")).alias("tfidf"))
    )


# Ids that every vocabulary starts with.
PAD_ID, START_ID, END_ID, UNKNOWN_ID = 0, 1, 2, 3
_FIRST_ID = 4


def word_vocabulary(df: DataFrame, text: str, size: int = 30_000) -> DataFrame:
    """The most frequent words with ids from 4 upwards, ties by word."""
    tokens = df.select(F.explode_outer(words(F.col(text))).alias("word")).where(F.col("word").isNotNull())
    counts = tokens.groupBy("word").agg(F.count("*").alias("n"))
    top = counts.orderBy(F.col("n").desc(), F.col("word").asc()).limit(size)
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("n").desc(), F.col("word").asc())
    # ``size`` rows at most are numbered
    return top.select("word", (F.row_number().over(order) + (_FIRST_ID - 1)).cast("int").alias("id"))


def encode_sequences(
    df: DataFrame, text: str, vocabulary: DataFrame, max_length: int = 64, max_words: int = SMALL_ROWS
) -> DataFrame:
    """Add ``input_ids`` and ``attention_mask`` of exactly ``max_length`` entries.

    Start id, word ids, end id, padding; longer texts are truncated. A vocabulary
    of at most ``max_words`` is held by every task as a dict, so a text is encoded
    where it lies. A larger one is joined to the words of the texts, with the same
    result: what is shuffled is one row per word that a sequence has room for.
    """
    room = max_length - 2
    tokens = F.slice(words(F.col(text)), 1, room)
    rows = vocabulary.select("word", "id").limit(max_words + 1).collect()
    if len(rows) > max_words:
        coded = _joined_ids(df, tokens, vocabulary)
    else:
        ids = df.sparkSession.sparkContext.broadcast({r["word"]: r["id"] for r in rows})

        @F.pandas_udf(T.ArrayType(T.IntegerType()))
        def to_ids(found: pd.Series) -> pd.Series:
            known = ids.value
            return found.map(lambda ts: [known.get(t, UNKNOWN_ID) for t in ts])

        coded = df.withColumn("_ids", to_ids(tokens))

    body = F.col("_ids")
    used = F.size(body) + 2
    return (
        coded.withColumn(
            "input_ids",
            F.concat(
                F.array(F.lit(START_ID)), body, F.array(F.lit(END_ID)),
                F.array_repeat(F.lit(PAD_ID), F.lit(max_length) - used),
            ),
        )
        .withColumn(
            "attention_mask",
            F.concat(F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), F.lit(max_length) - used)),
        )
        .drop("_ids")
    )


def _joined_ids(df: DataFrame, tokens: Column, vocabulary: DataFrame) -> DataFrame:
    """Add the ids of an array of words by a join; rows are known by a number that is stored with them."""
    rows = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    each = rows.select("_row", F.posexplode(tokens).alias("_at", "word")).join(vocabulary.select("word", "id"), "word", "left")
    place = F.struct("_at", F.coalesce("id", F.lit(UNKNOWN_ID)).cast("int").alias("id"))
    ids = each.groupBy("_row").agg(F.sort_array(F.collect_list(place)).alias("_found"))
    found = rows.join(ids, "_row", "left").withColumn(
        "_ids", F.coalesce(F.transform("_found", lambda p: p["id"]), F.array().cast("array<int>"))
    )
    return found.drop("_row", "_found")


def embed(
    df: DataFrame,
    text: str,
    encoder: Callable[[], Callable[[Sequence[str]], np.ndarray]] | None = None,
    dim: int = 256,
    out: str = "vec",
) -> DataFrame:
    """Add one vector per text.

    ``encoder`` is a function without arguments that loads a model and gives
    back a function from a list of texts to a matrix. It is called once per
    task. Without an encoder, words are hashed into ``dim`` counts and brought
    to unit length inside the JVM.
    """
    if encoder is None:
        hashed = HashingTF(numFeatures=dim, inputCol="_words", outputCol="_tf").transform(
            df.withColumn("_words", words(F.col(text)))
        )
        unit = Normalizer(p=2.0, inputCol="_tf", outputCol="_unit").transform(hashed)
        return unit.withColumn(out, vector_to_array("_unit")).drop("_words", "_tf", "_unit")

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = encoder()
        for batch in batches:
            yield pd.Series(list(np.asarray(run(batch.fillna("").tolist()), dtype=np.float64)))

    # not to be computed a second time by a filter on the vector
    return df.withColumn(out, encode.asNondeterministic()(F.col(text)))
