"""No row lost and none too many: nulls, repeated ids, many classes, files that disagree."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenkeel.functions.vectors import weighted_ce
from evenkeel.operators import running
from evenkeel.operators.metrics import classification_report
from evenkeel.operators.ranking import early_stopping
from evenkeel.operators.running import running_by_chunk
from evenkeel.operators.sampling import stratified_folds, stratified_split, undersample
from evenkeel.operators.similarity import max_cosine
from evenkeel.plans.prepare import prepare
from evenkeel.sources.runlogs import append_log, read_log, read_ragged_log
from evenkeel.sources.tables import load_labeled


def test_running_values_with_nulls(spark):
    rows = [("a", 1, 1.0), ("a", 20_001, 2.0), ("a", None, 50.0), (None, 1, 4.0), (None, 30_000, 8.0), (None, None, 9.0)]
    df = spark.createDataFrame(rows, "g string, o bigint, v double")
    got = running_by_chunk(df, ["g"], "o", None, {"s": ("sum", F.col("v")), "n": ("count", F.col("v"))}).collect()
    want = {("a", 1): (1.0, 1), ("a", 20_001): (3.0, 2), ("a", None): (None, None)}
    want |= {(None, 1): (4.0, 1), (None, 30_000): (12.0, 2), (None, None): (None, None)}
    assert {(r.g, r.o): (r.s, r.n) for r in got} == want and len(got) == len(rows)


def test_ragged_log_keeps_rows_with_an_empty_first_field(spark, tmp_path):
    (tmp_path / "log.csv").write_text("time,loss\n,0.5\nnow,0.25\n")
    got = read_ragged_log(spark, str(tmp_path / "log.csv"), {2: ("time", "loss")}).collect()
    assert sorted((r.time or "", r.loss) for r in got) == [("", "0.5"), ("now", "0.25")]


def test_log_keeps_its_types(spark, tmp_path):
    path = str(tmp_path / "log")
    append_log(spark.createDataFrame([(1, "a")], "epoch bigint, model string"), path)
    append_log(spark.createDataFrame([("2", 0.5)], "epoch string, loss double"), path)
    append_log(spark.createDataFrame([(3, "c")], "epoch int, model string"), path)
    got = read_log(spark, path)
    assert dict(got.dtypes) == {"epoch": "bigint", "model": "string", "loss": "double"}
    assert sorted(r.epoch for r in got.collect()) == [1, 2, 3]
    with pytest.raises(Exception):
        append_log(spark.createDataFrame([("x",)], "epoch string"), path)


def test_label_file_is_read_like_the_text_file(spark, tmp_path):
    (tmp_path / "t.csv").write_text("index;message\n1;a, b\n")
    (tmp_path / "l.csv").write_text("index;label\n1;3\n")
    got = load_labeled(spark, str(tmp_path / "t.csv"), str(tmp_path / "l.csv"), sep=";").collect()
    assert [(r["index"], r.message, r.label) for r in got] == [("1", "a, b", 3)]


def test_loss_of_a_zero_probability(spark):
    df = spark.createDataFrame([([0.0, 1.0], 0), ([0.0, 1.0], 1), ([0.0, 1.0], 2)], "p array<double>, y int")
    got = [r[0] for r in df.select(weighted_ce(F.col("p"), F.col("y"))).collect()]
    assert got[0] == pytest.approx(-np.log(np.finfo(float).tiny)) and got[1] == 0 and got[2] is None


@pytest.mark.parametrize("n", [0, 1, 3, 9, 11, 12, 20])
def test_repeated_keys_give_no_more_rows(spark, n):
    rows = [(f"k{i % 3}", lab, i) for lab in (0, 1) for i in range(6)]
    df = spark.createDataFrame(rows, "id string, label int, i int").repartition(3)
    assert undersample(df, n, "id").count() == min(n, 12)
    by = undersample(df, {0: n}, "id", by="label").groupBy("label").count().collect()
    assert {r.label: r["count"] for r in by} == {lab: c for lab, c in ((0, min(n, 6)), (1, 6)) if c}
    again = undersample(df.repartition(1), n, "id").collect()
    assert sorted(again) == sorted(undersample(df, n, "id").collect())


def test_thousands_of_classes(spark):
    df = spark.range(9000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 3000).alias("label"))
    folds = stratified_folds(df, "id", "label", 3).groupBy("label", "fold").count()
    assert folds.count() == 9000 and folds.where("count != 1").count() == 0
    split = stratified_split(df, "id", "label", 0.1)
    assert split.where("is_test").count() == 900 and split.count() == 9000


def test_repeated_ids_are_prepared_once(spark):
    text = spark.createDataFrame([("1", "x"), ("1", "y"), ("1", "y"), ("2", "z")], "index string, message string")
    labels = spark.createDataFrame([("1", 0), ("2", 1)], "index string, label int")
    empty = (text.limit(0), labels.limit(0))
    for resample in (False, True):
        got = prepare((text, labels), empty, text, resample=resample, target=100, minimum=1).train.collect()
        assert sorted((r["index"], r.message, r.label) for r in got) == [("1", "x", 0), ("1", "y", 0), ("1", "y", 0), ("2", "z", 1)]


def test_max_cosine_ways_agree(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (None, [1.0, 1.0]), (None, None), (2, [0.0, 0.0]), (3, None)]
    df = spark.createDataFrame(rows, "k int, vec array<double>")
    ref = spark.createDataFrame([(9, [2.0, 0.0]), (9, None), (8, [0.5, 0.0])], "k int, vec array<double>")
    want = sorted([(1, 1.0), (1, 0.0), (None, round(2**-0.5, 12)), (None, None), (2, 0.0), (3, None)], key=repr)
    for bounds in ({}, {"max_ref_rows": 0}, {"max_ref_bytes": 0}):
        got = max_cosine(df, ref, "vec", "k", **bounds)
        assert got.columns == ["k", "vec", "sim_score"]
        assert sorted(((r.k, r.sim_score) for r in got.collect()), key=repr) == want


@pytest.mark.parametrize("step", [1, 1_700_000_000_007])
def test_chunks_follow_rows_not_values(spark, monkeypatch, step):
    monkeypatch.setattr(running, "CHUNK_ROWS", 50)
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), (F.col("id") * step).alias("o"), F.lit(1.0).alias("v"))
    chunks = running.with_chunks(df, ["g"], "o").groupBy("g", "_chunk").count().collect()
    assert len(chunks) == 20 and max(r["count"] for r in chunks) <= 60
    got = running_by_chunk(df, ["g"], "o", None, {"s": ("sum", F.col("v"))}).collect()
    assert sorted((r.g, r.o // step, r.s) for r in got) == sorted((i % 2, i, float(i // 2 + 1)) for i in range(1000))


def test_a_metric_that_is_no_number_is_no_improvement(spark):
    rows = [("r", 1, 0.5), ("r", 2, float("nan")), ("r", 3, 0.6), ("r", 4, None)]
    (got,) = early_stopping(spark.createDataFrame(rows, "run string, epoch int, f1 double"), "run", "epoch", "f1", 5).collect()
    assert (got.best_epoch, got.best_metric, got.epochs_run) == (3, 0.6, 4)


def test_missing_predictions_are_misses(spark):
    rows = [(0, 0), (0, None), (1, 1), (None, 1)]
    got = classification_report(spark.createDataFrame(rows, "label int, prediction int")).collect()
    assert {r.row: (r.precision, r.recall, r.support) for r in got if r.row in ("0", "1")} == {"0": (1.0, 0.5, 2), "1": (1.0, 1.0, 1)}
    assert len(got) == 5 and {r.support for r in got if "a" in r.row} == {3}


@pytest.mark.parametrize("outlier", [1e12, -1e15])
def test_chunks_with_outliers(spark, monkeypatch, outlier):
    """One far value leaves the other rows in chunks of their own."""
    monkeypatch.setattr(running, "CHUNK_ROWS", 50)
    rows = [("a", float(i), 1) for i in range(2000)] + [("a", outlier, 1)] + [("b", float(i * i), 1) for i in range(400)] + [("c", 1.0, 1)]
    df = spark.createDataFrame(rows + [(None, 3.0, 1), ("a", None, 1)], "g string, o double, v int")
    sizes = {}
    for r in running.with_chunks(df, ["g"], "o").groupBy("g", "_chunk").count().collect():
        sizes.setdefault(r.g, []).append(r["count"])
    assert len(sizes["a"]) > 30 and max(sizes["a"]) <= 110 and len(sizes["b"]) > 5 and max(sizes["b"]) <= 110
    got = {(r.g, r.o): r.s for r in running_by_chunk(df, ["g"], "o", None, {"s": ("sum", F.col("v"))}).collect()}
    assert got["a", 1999.0] == 2000 + (outlier < 0) and got["b", 399.0 * 399] == 400 and got["a", None] is None and got[None, 3.0] == 1
