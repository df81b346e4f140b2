import weakref

import pytest
from pyspark.sql import functions as F

from evenkeel.operators.batches import map_batches, map_column


@pytest.mark.parametrize("name", ["map_column", "map_batches"])
def test_finished_batches_are_let_go(spark, name):
    """24 batches of 4 MB: a worker that keeps all that a ``str`` accessor ties up ends with 23 earlier ones."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.range(0, 24, 1, 1).select("id", F.repeat(F.lit("a b "), 1 << 20).alias("text"))
    seen = []

    def held(text):
        text.str.count(" ")
        alive = sum(ref() is not None for ref in seen)
        seen.append(weakref.ref(text))
        return text.str.len() * 0 + alive

    before = spark.conf.get(setting)
    spark.conf.set(setting, "1")
    try:
        if name == "map_column":
            done = map_column(docs, "text", held, "bigint", "alive")
        else:
            done = map_batches(docs, lambda b: held(b["text"]).to_frame("alive"), "alive bigint", remove_columns=["text"])
        rows = done.select("id", "alive").collect()
    finally:
        spark.conf.set(setting, before)
    assert sorted(r["id"] for r in rows) == list(range(24))
    assert max(r["alive"] for r in rows) <= 8
