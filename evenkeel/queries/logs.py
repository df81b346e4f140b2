"""Run logs: early stopping, running values, best runs, log files."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.operators.metrics import running_mean, similarity_summary
from evenkeel.operators.ranking import best_run, compare_models, early_stopping, top_n_per_class
from evenkeel.queries.base import Tables, query, r6
from evenkeel.session import shared_dir
from evenkeel.sources.runlogs import (
    append_log,
    overwrite_log,
    read_log,
    read_ragged_log,
    summary_table,
    write_summary,
)
from evenkeel.sources.tables import by_index


@query(
    "early_stopping",
    """WITH p AS (SELECT user_id, event_id, value, row_number() OVER w AS pos,
                   coalesce(max(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
                 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
        q AS (SELECT *, value > greatest(prior, 0) AS better FROM p),
        s AS (SELECT *, pos - coalesce(max(CASE WHEN better THEN pos END) OVER (PARTITION BY user_id ORDER BY pos), 0) AS since FROM q),
        e AS (SELECT user_id, coalesce(min(CASE WHEN since >= 5 THEN pos END), max(pos)) AS epochs_run FROM s GROUP BY user_id)
        SELECT e.user_id, max(CASE WHEN better THEN event_id END) AS best_epoch, max(CASE WHEN better THEN value END) AS best_metric,
          max(CASE WHEN since >= 5 AND pos = epochs_run THEN event_id END) AS stop_epoch, e.epochs_run
        FROM s JOIN e ON s.user_id = e.user_id AND s.pos <= e.epochs_run GROUP BY e.user_id, e.epochs_run""",
)
def _(spark, d):
    return early_stopping(Tables(spark, d).events, "user_id", "event_id", "value", patience=5)


# exact decimals, so that the order of the additions does not matter
@query(
    "running_mean",
    """SELECT event_id, event_type, (sum(value::DECIMAL(18, 2)) OVER w)::DOUBLE / count(*) OVER w AS running_mean FROM events
       WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def _(spark, d):
    rows = Tables(spark, d).events.select("event_id", "event_type", F.col("value").cast("decimal(18,2)").alias("value"))
    return running_mean(rows, "event_type", "event_id", "value").select("event_id", "event_type", "running_mean")


@query(
    "running_accuracy",
    """SELECT event_id, round(avg((event_type = 'click')::INTEGER) OVER (PARTITION BY user_id % 3 ORDER BY ts
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS share FROM events""",
)
def _(spark, d):
    df = Tables(spark, d).events.select(
        "event_id", "ts", (F.col("user_id") % 3).alias("g"), (F.col("event_type") == "click").cast("double").alias("hit")
    )
    return running_mean(df, "g", "ts", "hit", out="share").select("event_id", r6("share").alias("share"))


@query(
    "best_run",
    """SELECT event_type, event_id, user_id, value FROM events
       QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) = 1""",
)
def _(spark, d):
    df = Tables(spark, d).events.select("event_type", "event_id", "user_id", "value")
    return best_run(df, "event_type", "value", tie=["event_id"])


@query(
    "compare_models",
    "SELECT event_type AS model, round(avg(value), 6) AS f1_macro, round(max(value), 6) AS f1_weighted FROM events GROUP BY 1",
)
def _(spark, d):
    df = Tables(spark, d).events.groupBy(F.col("event_type").alias("model")).agg(
        r6(F.avg("value")).alias("f1_macro"), r6(F.max("value")).alias("f1_weighted")
    )
    return compare_models(df, "f1_macro")


@query(
    "top_n_per_class",
    """SELECT event_id, label, value FROM
        (SELECT event_id, value, CASE event_type WHEN 'view' THEN 3 WHEN 'click' THEN 4 WHEN 'error' THEN 5 END AS label FROM events)
       WHERE label IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY label ORDER BY value DESC, event_id) <= CASE label WHEN 3 THEN 800 WHEN 4 THEN 200 ELSE 50 END""",
)
def _(spark, d):
    label = F.when(F.col("event_type") == "view", 3).when(F.col("event_type") == "click", 4).when(F.col("event_type") == "error", 5)
    df = Tables(spark, d).events.select("event_id", "value", label.alias("label"))
    return top_n_per_class(df, "label", "value", {3: 800, 4: 200, 5: 50}, "event_id")


@query(
    "value_summary",
    """SELECT event_type, count(*) AS rows, max(value) AS max_sim, min(value) AS min_sim, round(avg(value), 6) AS mean_sim
       FROM events GROUP BY ROLLUP (event_type)""",
)
def _(spark, d):
    df = similarity_summary(Tables(spark, d).events, "event_type", "value")
    return df.withColumn("mean_sim", r6("mean_sim"))


@query("sort_by_id", "SELECT o_orderkey::VARCHAR AS index, o_orderstatus AS label FROM orders")
def _(spark, d):
    return by_index(Tables(spark, d).orders.select(F.col("o_orderkey").cast("string").alias("index"), F.col("o_orderstatus").alias("label")))


@query(
    "append_log",
    """SELECT event_type AS model, count(*) AS rows, round(avg(value), 6) AS f1, NULL::BIGINT AS folds FROM events GROUP BY 1
       UNION ALL SELECT lang, count(*), NULL, count(DISTINCT source) FROM documents GROUP BY 1""",
)
def _(spark, d):
    t, path = Tables(spark, d), shared_dir(spark, "log")
    append_log(
        t.events.groupBy(F.col("event_type").alias("model")).agg(F.count("*").alias("rows"), r6(F.avg("value")).alias("f1")), path
    )
    append_log(
        t.documents.groupBy(F.col("lang").alias("model")).agg(F.count("*").alias("rows"), F.countDistinct("source").alias("folds")), path
    )
    return read_log(spark, path).select("model", "rows", "f1", "folds")


_LAYOUTS = {
    4: ("timestamp", "model_name", "epochs", "val_f1_macro"),
    5: ("timestamp", "model_key", "model_name", "epochs", "val_f1_macro"),
    6: ("timestamp", "model_key", "model_name", "epochs", "val_f1_macro", "test_f1_macro"),
}


@query(
    "read_ragged_log",
    """SELECT CASE event_type WHEN 'view' THEN 4 WHEN 'error' THEN 6 ELSE 5 END AS n_fields, 'run ' || event_id AS timestamp,
         CASE WHEN event_type <> 'view' THEN event_type || ', "raw"' END AS model_key, 'user-' || user_id AS model_name,
         (user_id % 9)::VARCHAR AS epochs, CASE WHEN event_type <> 'click' THEN round(value * 100)::BIGINT::VARCHAR END AS val_f1_macro,
         CASE WHEN event_type = 'error' THEN event_id::VARCHAR END AS test_f1_macro FROM events""",
)
def _(spark, d):
    kind, path = F.col("event_type"), shared_dir(spark, "ragged")
    name = F.concat(F.lit("user-"), F.col("user_id"))
    key = F.concat(F.lit('"'), kind, F.lit(', ""raw"""'))
    head = F.concat(F.lit("run "), F.col("event_id"))
    epochs = (F.col("user_id") % 9).cast("string")
    score = F.when(kind == "click", "N/A").otherwise(F.round(F.col("value") * 100).cast("bigint").cast("string"))
    line = (
        F.when(kind == "view", F.concat_ws(",", head, name, epochs, score))
        .when(kind == "error", F.concat_ws(",", head, key, name, epochs, score, F.col("event_id")))
        .otherwise(F.concat_ws(",", head, key, name, epochs, score))
    )
    Tables(spark, d).events.select(line.alias("value")).write.text(path)
    return read_ragged_log(spark, path, _LAYOUTS)


@query(
    "run_summary",
    """SELECT string_agg(model, ',' ORDER BY model) AS models_trained, arg_max(model, f1) AS best_model, max(f1) AS best_f1_macro,
         64 AS max_length FROM (SELECT event_type AS model, round(avg(value), 6) AS f1 FROM events GROUP BY 1)""",
)
def _(spark, d):
    scores = Tables(spark, d).events.groupBy(F.col("event_type").alias("Model")).agg(r6(F.avg("value")).alias("F1 (Macro)"))
    path = shared_dir(spark, "summary")
    write_summary(summary_table(scores, {"max_length": 64, "batch_size": 32, "epochs": 30, "learning_rate": 2e-5}), path)
    got = spark.read.json(path)
    return got.select(
        F.array_join("models_trained", ",").alias("models_trained"),
        "best_model",
        "best_f1_macro",
        F.col("config.max_length").cast("int").alias("max_length"),
    )


@query("overwrite_log", "SELECT event_type AS model, count(*) AS rows FROM events GROUP BY 1")
def _(spark, d):
    t, path = Tables(spark, d), shared_dir(spark, "comparison")
    overwrite_log(t.documents.groupBy(F.col("lang").alias("model")).agg(F.count("*").alias("rows")), path)
    overwrite_log(t.events.groupBy(F.col("event_type").alias("model")).agg(F.count("*").alias("rows")), path)
    return spark.read.schema("model string, rows bigint").option("header", True).csv(path)
