import math

import pytest
from pyspark.sql import functions as F

from evenkeel.functions.labels import label_name, map_labels, prefix_ids, strict_label
from evenkeel.functions.vectors import (
    apply_multipliers,
    argmax,
    cross_entropy,
    focal_loss,
    l2_normalise,
    softmax,
    weighted_ce,
)
from evenkeel.operators.joins import join_labels, union_sources
from evenkeel.operators.metrics import (
    batch_mean_loss,
    class_distribution,
    class_weights,
    classification_report,
    cv_summary,
    profile_inputs,
    running_mean,
    score,
    soft_vote,
    with_sample_weights,
)
from evenkeel.operators.models import multiplier_scores, tune_multipliers
from evenkeel.operators.ranking import best_run, compare_models, early_stopping, top_n_per_class


def one(df):
    return df.head().asDict()


def test_join_multiplies_and_drops(spark):
    text = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3"), (None, "4")], "index string, message string")
    label = spark.createDataFrame([("a", 0), ("a", 1), ("c", 2), (None, 3)], "index string, label int")
    assert join_labels(text, label).count() == 4
    got = join_labels(text, label, null_safe=True)
    assert got.count() == 5 and got.columns == ["index", "message", "label"]


def test_labels(spark):
    df = spark.createDataFrame([("1", "O"), ("2", "A"), ("3", "?")], "id string, c string")
    assert {(r.id, r.label) for r in map_labels(df, "c").collect()} == {("1", 0), ("2", 3)}
    names = spark.range(7).select(label_name(F.col("id"))).collect()
    assert names[5][0] == "Extremism" and names[6][0] == "Unknown"
    assert one(prefix_ids(df, "p_", "id"))["index"] == "p_1"
    for bad in (None, 1.5):
        with pytest.raises(Exception):
            strict_label(spark.createDataFrame([(bad,)], "label double")).collect()


def test_distribution_and_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(2,)] * 2 + [(None,)], "label int")
    got = {r.label: (r["count"], r.percent, r.name) for r in class_distribution(df, all_labels=range(3)).collect()}
    assert got[0] == (6, 75.0, "Non-toxic") and got[1][0] == 0
    weights = {r.label: r.weight for r in class_weights(df).collect()}
    assert weights == {0: 8 / 12, 2: 2.0}
    assert {r.weight for r in with_sample_weights(df).collect()} == {8 / 12, 2.0, None}


def test_scores_over_all_classes_that_occur(spark):
    pairs = [(0, 0), (0, 0), (0, 1), (1, 1), (2, 0), (1, 3)]
    df = spark.createDataFrame(pairs, "label int, prediction int")
    got = one(score(df))
    f1 = {0: 2 * 2 / (4 + 1 + 1), 1: 2 / (2 + 1 + 1), 2: 0.0, 3: 0.0}
    assert math.isclose(got["f1_macro"], sum(f1.values()) / 4)
    assert math.isclose(got["accuracy"], 0.5)
    assert math.isclose(got["f1_weighted"], (3 * f1[0] + 2 * f1[1]) / 6)
    report = {r.row: r for r in classification_report(df).collect()}
    assert report["3"].support == 0 and report["2"].recall == 0.0
    assert math.isclose(report["macro avg"].f1, got["f1_macro"]) and math.isclose(report["accuracy"].f1, 0.5)


@pytest.mark.parametrize("pairs,expected", [([(0, 0), (1, 1)], 1.0), ([(0, 1), (1, 0)], 0.0)])
def test_perfect_and_all_wrong(spark, pairs, expected):
    assert one(score(spark.createDataFrame(pairs, "label int, prediction int")))["f1_macro"] == expected


def test_probability_algebra(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0], 1), ([1000.0, 0.0, -1000.0], 0)], "l array<double>, y int")
    got = df.select(softmax("l" and F.col("l")).alias("p"), argmax(F.col("l")).alias("c")).collect()
    assert [r.c for r in got] == [1, 0]
    assert all(math.isclose(sum(r.p), 1.0) for r in got)
    ce = df.select(cross_entropy(F.col("l"), F.col("y")).alias("a"), weighted_ce(softmax(F.col("l")), F.col("y")).alias("b"))
    first = ce.head()
    assert math.isclose(first.a, first.b) and math.isclose(first.a, math.log(2 + math.exp(-2)))
    weighted = df.select(focal_loss(cross_entropy(F.col("l"), F.col("y"), {0: 1.0, 1: 2.0}))).head()[0]
    base = 2 * math.log(2 + math.exp(-2))
    assert math.isclose(weighted, (1 - math.exp(-base)) ** 2 * base)
    moved = df.select(argmax(apply_multipliers(F.col("l"), [9.0, 1.0, 2.0]))).head()[0]
    assert moved == 0
    unit = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>").select(l2_normalise(F.col("v"))).collect()
    assert [list(r[0]) for r in unit] == [[0.6, 0.8], [0.0, 0.0]]


def test_soft_vote_and_cv(spark):
    df = spark.createDataFrame([(1, 0, [1.0, 0.0]), (1, 1, [0.0, 1.0]), (2, 0, [0.3, 0.7])], "k int, fold int, probs array<double>")
    assert {r.k: list(r.probs) for r in soft_vote(df, "k").collect()} == {1: [0.5, 0.5], 2: [0.3, 0.7]}
    got = one(cv_summary(spark.createDataFrame([(0.2,), (0.4,)], "f1_macro double")))
    assert math.isclose(got["mean"], 0.3) and math.isclose(got["std"], 0.1)


def test_batch_mean_is_not_row_mean(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 8.0)], "batch int, loss double")
    assert one(batch_mean_loss(df))["loss"] == 5.0


def test_running_mean_over_chunks(spark):
    df = spark.createDataFrame([("g", i, float(i)) for i in range(1, 31)] + [("h", 5, 2.0)], "g string, i int, x double")
    got = {(r.g, r.i): r.running_mean for r in running_mean(df, "g", "i", "x", chunk=F.floor(F.col("i") / 7)).collect()}
    assert got == {("g", i): (i + 1) / 2 for i in range(1, 31)} | {("h", 5): 2.0}


CURVE = [0.57, 0.56, 0.60, 0.68, 0.67, 0.59, 0.62, 0.62, 0.676, 0.99]


@pytest.mark.parametrize("width", [1, 3, 100])
def test_early_stopping(spark, width):
    rows = [("a", i + 1, f) for i, f in enumerate(CURVE)]
    rows += [("zero", i + 1, 0.0) for i in range(7)]
    rows += [("tie", i + 1, 0.5) for i in range(4)]
    df = spark.createDataFrame(rows, "run string, epoch int, f1 double")
    chunk = F.floor(F.col("epoch") / width)
    got = {r.run: r for r in early_stopping(df, "run", "epoch", "f1", 5, chunk=chunk).collect()}
    assert (got["a"].best_epoch, got["a"].best_metric, got["a"].stop_epoch) == (4, 0.68, 9)
    assert (got["zero"].best_epoch, got["zero"].stop_epoch) == (None, 5)
    assert (got["tie"].best_epoch, got["tie"].stop_epoch, got["tie"].epochs_run) == (1, None, 4)


def test_best_run_and_comparison(spark):
    rows = [("m", "t2", 0.41), ("m", "t1", 0.40), ("n", "t3", 0.9), ("n", "t0", 0.9), ("o", "t9", None)]
    df = spark.createDataFrame(rows, "model string, at string, f1 double")
    assert {(r.model, r.at) for r in best_run(df, "model", "f1", tie=["at"]).collect()} == {("m", "t2"), ("n", "t0")}
    assert [r.model for r in compare_models(df, "f1").collect()] == ["n", "n", "m", "m", "o"]


def test_top_n(spark):
    rows = [(i, i % 2 + 3, float(i // 4)) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, label int, s double")
    got = top_n_per_class(df, "label", "s", {3: 3, 4: 1, 5: 9}, "id", rank="place")
    assert sorted((r.label, r.place, r.id) for r in got.collect()) == [(3, 1, 36), (3, 2, 38), (3, 3, 32), (4, 1, 37)]


def test_multipliers_never_lower_the_score(spark):
    rows = [(0, [0.6, 0.4]), (0, [0.7, 0.3]), (1, [0.55, 0.45]), (1, [0.52, 0.48]), (1, [0.2, 0.8])]
    df = spark.createDataFrame(rows, "label int, probs array<double>")
    best, f1, base = tune_multipliers(df, 2)
    assert f1 == 1.0 and base < f1
    again = {r.candidate: r.f1_macro for r in multiplier_scores(df, [best, [1.0, 1.0]]).collect()}
    assert math.isclose(again[0], f1) and math.isclose(again[1], base)


def test_union_and_profile(spark, tmp_path):
    a = spark.createDataFrame([(1, "x")], "id int, t string")
    b = spark.createDataFrame([(1,), (1,)], "id int")
    assert sorted((r.id, r.t or "") for r in union_sources(a, b).collect()) == [(1, ""), (1, ""), (1, "x")]
    report = profile_inputs(spark, {"ok": lambda: a, "gone": lambda: spark.read.parquet(str(tmp_path / "no"))})
    got = {r.input: r for r in report.collect()}
    assert got["ok"].rows == 1 and not got["gone"].readable and got["gone"].error


def test_no_number_is_no_score(spark):
    nan = float("nan")
    df = spark.createDataFrame([("x", nan, 0, 1), ("y", 0.5, 0, 2), ("z", None, 0, 3), ("w", 0.9, 0, 4)], "model string, f1 double, label int, id int")
    assert [r.model for r in compare_models(df, "f1").collect()] == ["w", "y", "x", "z"]
    assert {r.model for r in top_n_per_class(df, "label", "f1", {0: 2}, "id").collect()} == {"w", "y"}
    assert [r.model for r in best_run(df, "label", "f1").collect()] == ["w"]
