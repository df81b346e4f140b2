"""Bounded batches on the way to Python, and what they leave as it was."""

import pyarrow as pa
import pytest

from evenkeel.llm.common import settle, small_batches

NAME = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def setting(spark):
    before = spark.conf.get(NAME)
    yield spark.conf
    spark.conf.set(NAME, before)


def test_texts_reach_python_in_small_batches(spark):
    def size(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], ["n", "rows"])

    texts = spark.range(0, 3000, 1, 1).selectExpr("repeat('some text ', 1000) AS body")
    sizes = settle(texts.mapInArrow(size, "n bigint, rows bigint")).collect()
    assert sum(r.rows for r in sizes) == 3000
    assert len(sizes) >= 7 and max(r.n for r in sizes) < 5 << 20


def test_the_sessions_bound_comes_back(spark, setting):
    before = setting.get(NAME)
    with small_batches(spark):
        assert setting.get(NAME) == str(4 << 20)
    assert setting.get(NAME) == before
    with pytest.raises(ValueError), small_batches(spark):
        raise ValueError
    assert setting.get(NAME) == before


@pytest.mark.parametrize("lower", ["1m", "65536", "65536b", "64kb"])
def test_a_lower_bound_stays(spark, setting, lower):
    setting.set(NAME, lower)
    with small_batches(spark):
        assert setting.get(NAME) == lower
    assert setting.get(NAME) == lower
