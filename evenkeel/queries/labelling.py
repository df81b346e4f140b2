"""Scans, joins, text functions, rule labels, class counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.functions.binding import with_costly
from evenkeel.functions.labels import map_labels, prefix_ids, strict_label
from evenkeel.functions.text import (
    clean_text,
    contains_any,
    flag_class,
    keyword_class,
    ngrams,
    normalize_text,
    term_counts,
    timestamp_text,
    words,
)
from evenkeel.operators.features import encode_sequences, word_vocabulary
from evenkeel.operators.joins import join_labels, merge_splits, union_sources
from evenkeel.operators.metrics import (
    class_distribution,
    class_weights,
    profile_inputs,
    split_counts,
    with_sample_weights,
)
from evenkeel.queries.base import (
    RULES,
    SQL_CLASSES,
    SQL_LABELED,
    Tables,
    query,
    r6,
    sql_clean,
    sql_grams,
    sql_keyword,
    sql_normalize,
    sql_words,
)
from evenkeel.session import shared_dir
from evenkeel.sources.tables import LABEL, load_labeled, read_table, write_predictions, write_table, write_text_label

_EVENT_LABELS = {"view": 0, "click": 1, "error": 2, "purchase": 3}


@query("join_labels", f"SELECT index, label, md5(message) AS text_md5 FROM ({SQL_LABELED})")
def _(spark, d):
    t = Tables(spark, d)
    return join_labels(t.texts(), t.classes()).select("index", "label", F.md5("message").alias("text_md5"))


@query(
    "join_labels_null_safe",
    """SELECT t.conv_id, t.turn, l.n FROM conversations t
       JOIN (SELECT nullif(conv_id % 7, 0) AS k, count(*) AS n FROM conversations GROUP BY 1) l
       ON nullif(t.conv_id % 7, 0) IS NOT DISTINCT FROM l.k""",
)
def _(spark, d):
    conv = Tables(spark, d).conversations.withColumn("k", F.expr("nullif(conv_id % 7, 0)"))
    sizes = conv.groupBy("k").agg(F.count("*").alias("n"))
    return join_labels(conv, sizes, on="k", null_safe=True).select("conv_id", "turn", "n")


@query(
    "normalize_text",
    f"SELECT doc_id, md5({sql_normalize('text')}) AS text_md5, length({sql_normalize('text')}) AS n FROM documents",
)
def _(spark, d):
    df = Tables(spark, d).documents.select("doc_id", normalize_text(F.col("text")).alias("t"))
    return df.select("doc_id", F.md5("t").alias("text_md5"), F.length("t").cast("bigint").alias("n"))


@query(
    "normalize_text_lower",
    f"SELECT conv_id, turn, md5({sql_normalize('text', lower=True)}) AS text_md5 FROM conversations",
)
def _(spark, d):
    return Tables(spark, d).conversations.select(
        "conv_id", "turn", F.md5(normalize_text(F.col("text"), lower=True)).alias("text_md5")
    )


@query("clean_text", f"SELECT doc_id, md5({sql_clean('text')}) AS text_md5 FROM documents")
def _(spark, d):
    return Tables(spark, d).documents.select("doc_id", F.md5(clean_text(F.col("text"))).alias("text_md5"))


@query(
    "min_length",
    f"SELECT doc_id, length(t) AS n FROM (SELECT doc_id, {sql_clean('text')} AS t FROM documents) WHERE length(t) > 5",
)
def _(spark, d):
    df = with_costly(Tables(spark, d).documents, t=clean_text(F.col("text")))
    return df.where(F.length("t") > 5).select("doc_id", F.length("t").cast("bigint").alias("n"))


@query(
    "keyword_class",
    f"SELECT doc_id, label FROM (SELECT doc_id, {sql_keyword('text')} AS label FROM documents) WHERE label IS NOT NULL",
)
def _(spark, d):
    df = with_costly(Tables(spark, d).documents, label=keyword_class(F.col("text"), RULES))
    return df.where(F.col("label").isNotNull()).select("doc_id", "label")


_FLAG_SQL = f"""SELECT doc_id, CASE WHEN toxic = 1 THEN 4
         WHEN quality = 0 AND toxic = 0 AND regexp_matches(t, 'die|ung', 'i') THEN 5
         WHEN quality = 0 AND toxic = 0 THEN 3 END AS label, t
       FROM (SELECT doc_id, toxic, quality, {sql_clean('text')} AS t FROM documents JOIN labels USING (doc_id))"""


@query("flag_class", f"SELECT doc_id, label FROM ({_FLAG_SQL}) WHERE label IS NOT NULL AND length(t) > 5")
def _(spark, d):
    t = Tables(spark, d)
    df = with_costly(join_labels(t.documents, t.labels, "doc_id"), t=clean_text(F.col("text")))
    hate = F.when(F.col("quality") == 0, 1).otherwise(0)
    found = with_costly(df, label=flag_class(F.col("t"), F.col("toxic"), hate, "die|ung"))
    return found.where(F.col("label").isNotNull() & (F.length("t") > 5)).select("doc_id", "label")


@query(
    "flag_predicate",
    """SELECT toxic, quality, count(*) AS rows FROM labels
       WHERE toxic = 1 OR (quality = 1 AND toxic = 0) GROUP BY ALL""",
)
def _(spark, d):
    flags = Tables(spark, d).labels
    keep = (F.col("toxic") == 1) | ((F.col("quality") == 1) & (F.col("toxic") == 0))
    return flags.where(keep).groupBy("toxic", "quality").agg(F.count("*").alias("rows"))


@query(
    "map_labels",
    """SELECT event_id, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'error' THEN 2 ELSE 3 END AS label
       FROM events WHERE event_type IN ('view', 'click', 'error', 'purchase')""",
)
def _(spark, d):
    return map_labels(Tables(spark, d).events, "event_type", _EVENT_LABELS).select("event_id", "label")


@query("strict_label", "SELECT vec_id, label::INTEGER AS label FROM embeddings")
def _(spark, d):
    df = Tables(spark, d).embeddings.select("vec_id", F.col("label").cast("double").alias("label"))
    return strict_label(df)


@query("prefix_ids", "SELECT 'chat_' || event_id AS index, user_id FROM events")
def _(spark, d):
    return prefix_ids(Tables(spark, d).events, "chat_", "event_id").select("index", "user_id")


@query("timestamp_text", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def _(spark, d):
    return Tables(spark, d).events.select("event_id", timestamp_text(F.col("ts")).alias("at"))


@query(
    "ngrams",
    f"""SELECT doc_id, len(g)::BIGINT AS n, md5(array_to_string(g, '|')) AS grams_md5
        FROM (SELECT doc_id, {sql_grams('w')} AS g FROM (SELECT doc_id, {sql_words('text')} AS w FROM documents))""",
)
def _(spark, d):
    df = Tables(spark, d).documents.select("doc_id", ngrams(words(F.col("text"))).alias("grams"))
    return df.select(
        "doc_id", F.size("grams").cast("bigint").alias("n"), F.md5(F.array_join("grams", "|")).alias("grams_md5")
    )


@query(
    "term_counts",
    f"""SELECT doc_id, count(*) AS terms, max(tf) AS max_tf,
          md5(string_agg(term || ':' || tf, '|' ORDER BY term)) AS terms_md5
        FROM (SELECT doc_id, term, count(*) AS tf FROM
               (SELECT doc_id, unnest({sql_grams('w')}) AS term FROM (SELECT doc_id, {sql_words('text')} AS w FROM documents))
              GROUP BY doc_id, term) GROUP BY doc_id""",
)
def _(spark, d):
    df = with_costly(Tables(spark, d).documents.select("doc_id", "text"), terms=term_counts(ngrams(words(F.col("text")))))
    joined = F.array_join(F.transform("terms", lambda t: F.concat(t.term, F.lit(":"), t.tf.cast("string"))), "|")
    return df.where(F.size("terms") > 0).select(
        "doc_id",
        F.size("terms").cast("bigint").alias("terms"),
        F.array_max(F.transform("terms", lambda t: t.tf)).cast("bigint").alias("max_tf"),
        F.md5(joined).alias("terms_md5"),
    )


_VOCAB_SQL = f"""SELECT word, 3 + row_number() OVER (ORDER BY n DESC, word) AS id FROM
      (SELECT word, count(*) AS n FROM (SELECT unnest({sql_words('text')}) AS word FROM documents) GROUP BY word)
      QUALIFY row_number() OVER (ORDER BY n DESC, word) <= 30000"""


@query("word_vocabulary", f"SELECT word, id::INTEGER AS id FROM ({_VOCAB_SQL})")
def _(spark, d):
    return word_vocabulary(Tables(spark, d).documents, "text")


@query(
    "encode_sequences",
    f"""WITH vocab AS ({_VOCAB_SQL}),
      tokens AS (SELECT doc_id, {sql_words('text')} AS w FROM documents),
      body AS (SELECT doc_id, w[i] AS word, i FROM tokens, unnest(range(1, 63)) r(i) WHERE i <= len(w)),
      ids AS (SELECT b.doc_id, string_agg(coalesce(v.id, 3), ',' ORDER BY i) AS s, count(*) AS n
              FROM body b LEFT JOIN vocab v ON b.word = v.word GROUP BY b.doc_id)
      SELECT t.doc_id, coalesce(n, 0) + 2 AS used,
        md5('1,' || coalesce(s || ',', '') || '2' || repeat(',0', (62 - coalesce(n, 0))::INTEGER)) AS ids_md5
      FROM tokens t LEFT JOIN ids ON t.doc_id = ids.doc_id""",
)
def _(spark, d):
    t = Tables(spark, d)
    df = encode_sequences(t.documents, "text", word_vocabulary(t.documents, "text"), max_length=64)
    return df.select(
        "doc_id",
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("bigint").alias("used"),
        F.md5(F.array_join(F.transform("input_ids", lambda i: i.cast("string")), ",")).alias("ids_md5"),
    )


_NAMES = "CASE label WHEN 0 THEN 'Non-toxic' WHEN 1 THEN 'Insults and Flaming' WHEN 2 THEN 'Other Offensive Texts' WHEN 3 THEN 'Hate and Harassment' WHEN 4 THEN 'Threats' WHEN 5 THEN 'Extremism' ELSE 'Unknown' END"


@query(
    "class_distribution",
    f"""SELECT label, n AS count, round(n * 100.0::DOUBLE / sum(n) OVER (), 6) AS percent, {_NAMES} AS name FROM
        (SELECT label, count(*) AS n FROM ({SQL_LABELED}) GROUP BY label)""",
)
def _(spark, d):
    t = Tables(spark, d)
    return class_distribution(join_labels(t.texts(), t.classes())).withColumn("percent", r6("percent"))


@query(
    "class_distribution_all",
    f"""SELECT label, coalesce(n, 0) AS count FROM (SELECT unnest(range(6))::INTEGER AS label)
        LEFT JOIN (SELECT label, count(*) AS n FROM ({SQL_CLASSES}) GROUP BY label) USING (label)""",
)
def _(spark, d):
    return class_distribution(Tables(spark, d).classes(), names=None, all_labels=range(6)).select("label", "count")


@query(
    "class_weights",
    """SELECT l_returnflag AS label, count(*) AS count,
         round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight FROM lineitem GROUP BY 1""",
)
def _(spark, d):
    df = Tables(spark, d).lineitem.select(F.col("l_returnflag").alias("label"))
    return class_weights(df).withColumn("weight", r6("weight"))


@query(
    "sample_weights",
    f"""WITH c AS ({SQL_CLASSES}), w AS (SELECT label, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight FROM c GROUP BY label)
        SELECT c.index, c.label, round(w.weight, 6) AS weight FROM c JOIN w USING (label)""",
)
def _(spark, d):
    return with_sample_weights(Tables(spark, d).classes()).select("index", "label", r6("weight").alias("weight"))


@query(
    "split_counts",
    "SELECT 'train' AS split, count(*) AS rows FROM documents UNION ALL SELECT 'test', count(*) FROM benchmark "
    "UNION ALL SELECT 'chat', count(*) FROM conversations",
)
def _(spark, d):
    t = Tables(spark, d)
    return split_counts({"train": t.documents, "test": t.benchmark, "chat": t.conversations})


@query(
    "profile_inputs",
    "SELECT 'text' AS input, true AS readable, count(*) AS rows FROM documents UNION ALL "
    "SELECT 'labels', true, count(*) FROM labels UNION ALL SELECT 'test', true, count(*) FROM benchmark UNION ALL "
    "SELECT 'absent', false, NULL",
)
def _(spark, d):
    t = Tables(spark, d)
    return profile_inputs(
        spark,
        {
            "text": lambda: t.documents,
            "labels": lambda: t.labels,
            "test": lambda: t.benchmark,
            "absent": lambda: spark.read.parquet(f"{d}/no_such_table.parquet"),
        },
    ).drop("error")


@query(
    "union_sources",
    "SELECT 'd' || doc_id AS index, md5(text) AS text_md5, lang FROM documents UNION ALL "
    "SELECT 'b' || item_id, md5(text), NULL FROM benchmark",
)
def _(spark, d):
    t = Tables(spark, d)
    docs = prefix_ids(t.documents, "d", "doc_id").select("index", F.md5("text").alias("text_md5"), "lang")
    items = prefix_ids(t.benchmark, "b", "item_id").select("index", F.md5("text").alias("text_md5"))
    return union_sources(docs, items)


@query(
    "merge_splits",
    f"""SELECT label, count(*) AS rows, sum(length(message))::BIGINT AS chars FROM
        ({SQL_LABELED} UNION ALL SELECT 'v' || conv_id || '_' || turn, text, (role = 'assistant')::INTEGER FROM conversations)
        GROUP BY label""",
)
def _(spark, d):
    t = Tables(spark, d)
    train = join_labels(t.texts(), t.classes())
    val = t.conversations.select(
        F.concat(F.lit("v"), F.col("conv_id"), F.lit("_"), F.col("turn")).alias("index"),
        F.col("text").alias("message"),
        (F.col("role") == "assistant").cast("int").alias("label"),
    )
    return merge_splits(train, val).groupBy("label").agg(
        F.count("*").alias("rows"), F.sum(F.length("message")).alias("chars")
    )


# --- delimited files: written from the tables and read back -----------------


@query("text_label_files", f"SELECT index, label, md5(message) AS text_md5 FROM ({SQL_LABELED})")
def _(spark, d):
    t = Tables(spark, d)
    labeled = join_labels(t.texts(), t.classes())
    text_path, label_path = write_text_label(labeled, shared_dir(spark, "text-label"))
    return load_labeled(spark, text_path, label_path).select("index", "label", F.md5("message").alias("text_md5"))


@query("text_without_labels", "SELECT item_id::VARCHAR AS index, md5(text) AS text_md5, false AS labeled FROM benchmark")
def _(spark, d):
    items = Tables(spark, d).benchmark.select(F.col("item_id").cast("string").alias("index"), F.col("text").alias("message"))
    path = shared_dir(spark, "text")
    write_table(items, path)
    got = load_labeled(spark, path, path + "-no-labels")
    return got.select("index", F.md5("message").alias("text_md5"), F.lit("label" in got.columns).alias("labeled"))


@query(
    "semicolon_file",
    "SELECT conv_id, turn, md5(text) AS text_md5 FROM conversations WHERE role = 'user'",
)
def _(spark, d):
    chat = Tables(spark, d).conversations.select(
        (F.col("role") != "user").cast("int").alias("category_id"), F.col("text").alias("full_text"), "conv_id", "turn"
    )
    path = shared_dir(spark, "chat")
    write_table(chat, path, sep=";")
    got = read_table(spark, path, "category_id int, full_text string, conv_id bigint, turn bigint", sep=";")
    return got.where(F.col("category_id") == 0).select("conv_id", "turn", F.md5("full_text").alias("text_md5"))


@query(
    "flag_file",
    """SELECT doc_id::VARCHAR AS id, md5(text) AS text_md5, toxic AS threat, 1 - quality AS identity_hate
       FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 OR (quality = 0 AND toxic = 0)""",
)
def _(spark, d):
    t = Tables(spark, d)
    flags = join_labels(t.documents, t.labels, "doc_id").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("comment_text"),
        F.col("toxic").alias("threat"),
        (1 - F.col("quality")).alias("identity_hate"),
    )
    path = shared_dir(spark, "flags")
    write_table(flags, path)
    got = read_table(spark, path, "id string, comment_text string, threat int, identity_hate int")
    keep = (F.col("threat") == 1) | ((F.col("identity_hate") == 1) & (F.col("threat") == 0))
    return got.where(keep).select("id", F.md5("comment_text").alias("text_md5"), "threat", "identity_hate")


@query(
    "na_values",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS kind FROM events",
)
def _(spark, d):
    rows = Tables(spark, d).events.select(
        "event_id", F.when(F.col("event_type") == "error", "N/A").otherwise(F.col("event_type")).alias("kind")
    )
    path = shared_dir(spark, "na")
    write_table(rows, path)
    got = read_table(spark, path, "event_id bigint, kind string", na_values=["N/A", "nan", "null"], multi_line=False)
    return got.select("event_id", normalize_text(F.col("kind")).alias("kind"))


@query("predictions_file", "SELECT doc_id::VARCHAR AS index, (toxic * 2 + quality)::INTEGER AS label FROM labels")
def _(spark, d):
    path = shared_dir(spark, "predictions")
    write_predictions(Tables(spark, d).classes(), path, compression="gzip")
    return read_table(spark, path, LABEL)


@query("keyword_on_raw_and_clean", f"""SELECT count(*) AS rows, count({sql_keyword('text')}) AS raw_hits,
    count({sql_keyword('t')}) AS clean_hits FROM (SELECT text, {sql_clean('text')} AS t FROM documents)""")
def _(spark, d):
    df = Tables(spark, d).documents.select("text", clean_text(F.col("text")).alias("t"))
    return df.agg(
        F.count("*").alias("rows"),
        F.count(keyword_class(F.col("text"), RULES)).alias("raw_hits"),
        F.count(keyword_class(F.col("t"), RULES)).alias("clean_hits"),
    )


@query(
    "columns_and_rows_by_filter",
    """SELECT lang, count(*) AS rows FROM documents WHERE lang IN ('en', 'de') AND regexp_matches(text, 'die', 'i') GROUP BY lang""",
)
def _(spark, d):
    df = Tables(spark, d).documents
    return df.where(F.col("lang").isin("en", "de") & contains_any(F.col("text"), "die")).groupBy("lang").agg(
        F.count("*").alias("rows")
    )


@query("unigrams", f"SELECT doc_id, len({sql_words('text')})::BIGINT AS n FROM documents")
def _(spark, d):
    return Tables(spark, d).documents.select("doc_id", F.size(ngrams(words(F.col("text")), 1, 1)).cast("bigint").alias("n"))
