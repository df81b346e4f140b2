"""TF-IDF, embeddings, similarity."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from evenkeel.functions.binding import with_costly
from evenkeel.functions.text import clean_text, keyword_class
from evenkeel.functions.vectors import l2_normalise
from evenkeel.operators.approximate import hashed_nearest, listed_nearest
from evenkeel.operators.batches import map_batches, map_column
from evenkeel.operators.features import embed, tfidf_fit, tfidf_terms, tfidf_transform, tfidf_vocabulary
from evenkeel.operators.metrics import similarity_summary
from evenkeel.operators.sampling import stratified_split
from evenkeel.operators.similarity import max_cosine, nearest, select_similar
from evenkeel.queries.base import RULES, Tables, query, r6, sql_clean, sql_grams, sql_keyword, sql_words
from evenkeel.queries.rebalancing import sql_split
from evenkeel.session import cut_lineage

_TF_SQL = f"""tf AS (SELECT doc_id, term, count(*) AS tf FROM
      (SELECT doc_id, unnest({sql_grams('w')}) AS term FROM (SELECT doc_id, {sql_words('text')} AS w FROM documents)) GROUP BY doc_id, term),
    vocab AS (SELECT term, df, cf, ln((1 + n) / (1.0::DOUBLE + df)) + 1 AS idf FROM
      (SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM tf GROUP BY term) CROSS JOIN (SELECT count(*) AS n FROM documents)
      WHERE df >= 2 AND df <= 0.9::DOUBLE * n QUALIFY row_number() OVER (ORDER BY cf DESC, term) <= 10000)"""


@query("tfidf_vocabulary", f"WITH {_TF_SQL} SELECT term, df, cf, round(idf, 6) AS idf FROM vocab")
def _(spark, d):
    return tfidf_vocabulary(Tables(spark, d).documents, "text").withColumn("idf", r6("idf"))


def _tfidf_sql(table: str, key: str) -> str:
    return f"""WITH {_TF_SQL},
      q AS (SELECT {key}, term, count(*) AS tf FROM
        (SELECT {key}, unnest({sql_grams('w')}) AS term FROM (SELECT {key}, {sql_words('text')} AS w FROM {table})) GROUP BY {key}, term),
      m AS (SELECT {key}, term, tf * idf AS w FROM q JOIN vocab USING (term))
      SELECT {key}, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY {key})), 6) AS tfidf FROM m"""


@query("tfidf_test_set", _tfidf_sql("benchmark", "item_id"))
def _(spark, d):
    t = Tables(spark, d)
    vocab = tfidf_vocabulary(t.documents, "text")
    return tfidf_terms(t.benchmark, "item_id", "text", vocab).withColumn("tfidf", r6("tfidf"))


@query(
    "tfidf_documents",
    f"""SELECT doc_id, count(*) AS terms, round(sum(tfidf), 4) AS total, round(max(tfidf), 4) AS top
        FROM ({_tfidf_sql('documents', 'doc_id').replace('round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6)', 'w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))')})
        GROUP BY doc_id""",
)
def _(spark, d):
    docs = Tables(spark, d).documents
    vectors = tfidf_transform(docs.select("doc_id", "text"), tfidf_fit(docs, "text"))
    # the entries of the sparse vector as they are stored, not a dense copy
    rows = with_costly(vectors, x=F.filter(F.unwrap_udt("features")["values"], lambda v: v != 0))
    return rows.where(F.size("x") > 0).select(
        "doc_id",
        F.size("x").cast("bigint").alias("terms"),
        F.round(F.aggregate("x", F.lit(0.0), lambda a, v: a + v), 4).alias("total"),
        F.round(F.array_max("x"), 4).alias("top"),
    )


@query(
    "l2_normalise",
    """SELECT vec_id, round(list_max(list_transform(x, lambda v: v / sqrt(list_sum(list_transform(x, lambda u: u * u))))), 6) AS top
       FROM (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings)""",
)
def _(spark, d):
    x = l2_normalise(F.col("embedding").cast("array<double>"))
    return Tables(spark, d).embeddings.select("vec_id", r6(F.array_max(x)).alias("top"))


_SIM_SQL = f"""WITH s AS ({sql_split('SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings', 'vec_id', 'label', '0.2')})
    SELECT a.vec_id, a.label, round(max(list_cosine_similarity(a.x, b.x)), 12) AS sim FROM s a CROSS JOIN s b
    WHERE NOT a.is_test AND b.is_test GROUP BY a.vec_id, a.label"""


def _scored(t: Tables, **bounds):
    """Training rows with their similarity to the held-out rows."""
    split = stratified_split(t.embeddings, "vec_id", "label", 0.2)
    return max_cosine(
        split.where(~F.col("is_test")), split.where("is_test"), "embedding", "vec_id", **bounds
    )


@query("max_cosine", f"SELECT vec_id, round(sim, 6) AS sim_score FROM ({_SIM_SQL})")
def _(spark, d):
    return _scored(Tables(spark, d)).select("vec_id", r6("sim_score").alias("sim_score"))


@query("max_cosine_by_blocks", f"SELECT vec_id, round(sim, 6) AS sim_score FROM ({_SIM_SQL})")
def _(spark, d):
    # a bound of zero takes the way meant for large reference sets
    return _scored(Tables(spark, d), max_ref_rows=0).select("vec_id", r6("sim_score").alias("sim_score"))


@query(
    "similarity_summary",
    f"""SELECT label, count(*) AS rows, round(max(sim), 6) AS max_sim, round(min(sim), 6) AS min_sim, round(avg(sim), 6) AS mean_sim
        FROM ({_SIM_SQL}) GROUP BY ROLLUP (label)""",
)
def _(spark, d):
    df = similarity_summary(_scored(Tables(spark, d)))
    return df.select("label", "rows", *[r6(c).alias(c) for c in ("max_sim", "min_sim", "mean_sim")])


_N = {0: 12, 1: 5, 2: 30}


@query(
    "select_similar",
    f"""SELECT vec_id, label, round(sim, 6) AS sim_score FROM ({_SIM_SQL}) WHERE label IN (0, 1, 2)
        QUALIFY row_number() OVER (PARTITION BY label ORDER BY sim DESC, vec_id) <= CASE label WHEN 0 THEN 12 WHEN 1 THEN 5 ELSE 30 END""",
)
def _(spark, d):
    split = stratified_split(Tables(spark, d).embeddings, "vec_id", "label", 0.2)
    df = select_similar(split.where(~F.col("is_test")), split.where("is_test"), _N, "vec_id", "label", "embedding")
    return df.select("vec_id", "label", r6("sim_score").alias("sim_score"))


@query(
    "nearest_in_class",
    """SELECT vec_id, label, nid, place FROM (SELECT a.vec_id, a.label, b.vec_id AS nid,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_sum(list_transform(range(1, len(a.x) + 1),
           lambda i: (a.x[i] - b.x[i]) * (a.x[i] - b.x[i]))), 9), b.vec_id) - 1 AS place
       FROM (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings) a
       JOIN (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings) b ON a.label = b.label AND a.vec_id <> b.vec_id) WHERE place < 5""",
)
def _(spark, d):
    e = Tables(spark, d).embeddings
    # blocks smaller than a class, so that classes are split
    close = nearest(e, e, "vec_id", "vec_id", "embedding", 5, by="label", skip_self=True, block_rows=40)
    return close.select(
        "vec_id", "label", F.posexplode(F.transform("neighbors", lambda n: n.id)).alias("place", "nid")
    ).withColumn("place", F.col("place").cast("bigint"))


@query(
    "embed_hashed",
    f"SELECT doc_id, 64 AS dim, (len({sql_words('text')}) > 0)::INTEGER::DOUBLE AS length FROM documents",
)
def _(spark, d):
    df = embed(Tables(spark, d).documents.select("doc_id", "text"), "text", dim=64)
    squares = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    return df.select("doc_id", F.size("vec").alias("dim"), r6(F.sqrt(squares)).alias("length"))


def letter_encoder():
    """Counts of the letters a to z per text: a stand-in for a loaded model."""

    def run(texts):
        return np.array([[text.count(chr(97 + i)) for i in range(26)] for text in texts], dtype=float)

    return run


WORD_DIM = 64


def word_encoder():
    """Counts of the words of a cleaned text by a hash of theirs: letters, digits and marks of every language count."""
    import hashlib

    place: dict[str, int] = {}

    def of(word: str) -> int:
        if word not in place:
            place[word] = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % WORD_DIM
        return place[word]

    def run(texts):
        out = np.zeros((len(texts), WORD_DIM))
        for row, text in zip(out, texts):
            np.add.at(row, [of(word) for word in text.split(" ") if word], 1.0)
        return out

    return run


@query(
    "embed_with_encoder",
    """SELECT doc_id, list_transform(range(26), lambda i: len(text) - len(replace(text, chr((97 + i)::INTEGER), '')))[5]::DOUBLE AS e_count,
         list_sum(list_transform(range(26), lambda i: len(text) - len(replace(text, chr((97 + i)::INTEGER), ''))))::DOUBLE AS letters
       FROM documents""",
)
def _(spark, d):
    df = embed(Tables(spark, d).documents.select("doc_id", "text"), "text", encoder=letter_encoder)
    return df.select(
        "doc_id", F.get("vec", F.lit(4)).alias("e_count"), F.aggregate("vec", F.lit(0.0), lambda a, x: a + x).alias("letters")
    )


@query(
    "map_batches",
    """SELECT doc_id, length(text) - length(replace(text, ' ', '')) AS blanks, length(text) > 1000 AS is_long FROM documents""",
)
def _(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "text")
    counted = map_column(docs, "text", lambda t: t.str.count(" "), "bigint", "blanks")
    return map_batches(
        counted, lambda b: b["text"].str.len().gt(1000).to_frame("is_long"), "is_long boolean", remove_columns=["text"]
    )


# word counts by hash as a list, the SQL form of the encoder above
def sql_hashed_words(text: str) -> str:
    words = f"list_filter(string_split({text}, ' '), lambda w: w <> '')"
    cells = f"list_transform({words}, lambda w: ('0x' || substr(md5(w), 1, 8))::BIGINT % {WORD_DIM})"
    return f"list_transform(range({WORD_DIM}), lambda j: len(list_filter({cells}, lambda c: c = j))::DOUBLE)"


SQL_SIMILAR_TEXTS = f"""WITH h AS MATERIALIZED (SELECT doc_id, label, message, list_filter(string_split(message, ' '), lambda w: w <> '') AS w FROM
        (SELECT doc_id, {sql_keyword('text')} AS label, {sql_clean('text')} AS message FROM documents) WHERE label IS NOT NULL),
      hv AS MATERIALIZED (SELECT h.doc_id, h.label, h.message, list(coalesce(n, 0)::DOUBLE ORDER BY j) AS v FROM h CROSS JOIN range({WORD_DIM}) r(j)
        LEFT JOIN (SELECT doc_id, ('0x' || substr(md5(w), 1, 8))::BIGINT % {WORD_DIM} AS c, count(*) AS n FROM (SELECT doc_id, unnest(w) AS w FROM h)
          GROUP BY ALL) c ON c.doc_id = h.doc_id AND c.c = j GROUP BY h.doc_id, h.label, h.message),
      rv AS MATERIALIZED (SELECT {sql_hashed_words('message')} AS v FROM (SELECT {sql_clean('text')} AS message FROM benchmark))
    SELECT doc_id, label, message, sim FROM
      (SELECT c.doc_id, c.label, c.message, round(max(coalesce(list_cosine_similarity(c.v, r.v), 0)), 12) AS sim
       FROM hv c CROSS JOIN rv r GROUP BY c.doc_id, c.label, c.message)
    QUALIFY row_number() OVER (PARTITION BY label ORDER BY sim DESC, 'near_' || doc_id) <= CASE label WHEN 3 THEN 800 WHEN 4 THEN 200 ELSE 50 END"""


@query("select_similar_texts", f"SELECT 'near_' || doc_id AS index, label, round(sim, 6) AS sim_score FROM ({SQL_SIMILAR_TEXTS})")
def _(spark, d):
    t = Tables(spark, d)
    found = with_costly(t.documents.select("doc_id", "text"), label=keyword_class(F.col("text"), RULES)).where(
        F.col("label").isNotNull()
    )
    # ties go by the marked id, as text
    cands = found.select(F.concat(F.lit("near_"), "doc_id").alias("index"), clean_text(F.col("text")).alias("message"), "label")
    ref = embed(t.benchmark.select(clean_text(F.col("text")).alias("message")), "message", word_encoder)
    df = select_similar(embed(cands, "message", word_encoder), ref, {3: 800, 4: 200, 5: 50}, "index")
    return df.select("index", "label", r6("sim_score").alias("sim_score"))


# the five documents of the same language, and of all, whose words are most like a benchmark passage or a labelled text
@query("nearest_hashed")
def _(spark, d):
    t = Tables(spark, d)
    docs = embed(t.documents.select(F.col("doc_id").alias("id"), "text"), "text", dim=WORD_DIM)
    asked = embed(t.benchmark.select(F.col("item_id").cast("bigint").alias("item"), "text"), "text", dim=WORD_DIM)
    found, _recall, _tables = hashed_nearest(asked, docs, "item", "id", "vec", 5)
    return found.select("item", F.posexplode("neighbors").alias("place", "n")).select("item", "place", "n.id", r6("n.dist").alias("dist"))


@query("nearest_listed")
def _(spark, d):
    t = Tables(spark, d)
    # both sides read the vectors: texts are encoded once
    docs = cut_lineage(embed(t.documents.select("doc_id", "lang", "text"), "text", dim=WORD_DIM).drop("text"))
    asked = docs.join(t.labels.select("doc_id"), "doc_id", "left_semi")
    found, _recall, _lists = listed_nearest(asked, docs, "doc_id", "doc_id", "vec", 5, "lang", "cosine", skip_self=True)
    return found.select("doc_id", F.posexplode("neighbors").alias("place", "n")).select("doc_id", "place", "n.id", r6("n.dist").alias("dist"))
