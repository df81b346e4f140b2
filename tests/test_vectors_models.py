import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from evenkeel.operators.features import (
    embed,
    encode_sequences,
    tfidf_fit,
    tfidf_terms,
    tfidf_vocabulary,
    word_vocabulary,
)
from evenkeel.operators.models import (
    boosted,
    fit_folds,
    forest,
    kfold_ensemble,
    linear,
    oof_predict,
    run_models,
    vote,
    with_folds,
)
from evenkeel.operators.similarity import (
    BLOCK_BYTES,
    _closest,
    _distances,
    _smallest,
    block_count,
    max_cosine,
    nearest,
    select_similar,
)
from evenkeel.operators.smote import smote
from evenkeel.plans.training import batch_inference, compare, fit_text_model, tfidf_folds

RNG = np.random.default_rng(7)


@pytest.fixture(scope="module")
def points(spark):
    rows = [(i, i % 3, [float(x) for x in RNG.normal(i % 3, 0.4, 4)]) for i in range(90)]
    rows += [(90, 0, [0.0] * 4), (91, 1, list(rows[1][2])), (92, 1, [-x for x in rows[1][2]])]
    return spark.createDataFrame(rows, "id int, label int, vec array<double>")


@pytest.fixture(params=["true", "false"])
def coalescing(spark, request):
    """With and without merging of small shuffle partitions."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield
    spark.conf.set(name, before)


def brute_cosine(a, b):
    a, b = np.array(a), np.array(b)
    na, nb = np.linalg.norm(a, axis=1, keepdims=True), np.linalg.norm(b, axis=1, keepdims=True)
    return (np.divide(a, na, where=na > 0, out=np.zeros_like(a)) @ np.divide(b, nb, where=nb > 0, out=np.zeros_like(b)).T).max(1)


@pytest.mark.parametrize("bounds", [{}, {"max_ref_rows": 0}, {"max_ref_bytes": 10}])
def test_max_cosine(points, bounds, coalescing, monkeypatch):
    monkeypatch.setattr("evenkeel.operators.similarity.LEAST_BLOCK_ROWS", 11)
    monkeypatch.setattr("evenkeel.operators.similarity.STRIP_CELLS", 100)
    ref = points.where("id % 2 = 0")
    got = {r.id: r.sim_score for r in max_cosine(points, ref, "vec", "id", **bounds).collect()}
    rows = points.collect()
    want = brute_cosine([r.vec for r in rows], [r.vec for r in rows if r.id % 2 == 0])
    for r, w in zip(rows, want):
        assert math.isclose(got[r.id], w, abs_tol=1e-9)
    # nothing is similar to the zero vector
    assert got[90] == 0.0


def test_max_cosine_with_empty_reference(points):
    assert max_cosine(points, points.limit(0), "vec", "id").where("sim_score is not null").count() == 0


@pytest.mark.parametrize("block_rows", [7, 50, None])
def test_nearest_equals_brute_force(points, block_rows, coalescing):
    got = {r.id: [n.id for n in r.neighbors] for r in nearest(
        points, points, "id", "id", "vec", 3, by="label", skip_self=True, block_rows=block_rows
    ).collect()}
    rows = points.collect()
    for a in rows:
        mates = sorted(
            (round(sum((x - y) ** 2 for x, y in zip(a.vec, b.vec)), 9), b.id) for b in rows if b.label == a.label and b.id != a.id
        )
        assert got[a.id] == [i for _, i in mates[:3]]


def test_smallest_entries_with_ties():
    d = np.array([[0.0, 0.0, 0.0, 1.0], [np.inf, 2.0, 1.0, 1.0], [np.inf] * 4, [3.0, 2.0, 1.0, 0.0]])
    rows, cols = _smallest(d, 2)
    assert list(zip(rows, cols)) == [(0, 0), (0, 1), (1, 2), (1, 3), (3, 3), (3, 2)]


@pytest.mark.parametrize("unit", [False, True])
@pytest.mark.parametrize("size", [1, 3, 63, 200, 1000])
def test_closest_equals_smallest_of_all(size, unit):
    rng = np.random.default_rng(size)
    x, y = rng.integers(-2, 3, (50, 3)).astype(float), rng.integers(-2, 3, (size, 3)).astype(float)
    if unit:
        x, y = (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9) for m in (x, y))
    own = rng.random((50, size)) < 0.1
    for bad in (False, True):
        if bad:
            y[0] = np.nan
        for k in (1, 5):
            d = _distances(x, y, unit)
            d[own] = np.inf
            want = _smallest(d, k)
            rows, cols, dist = _closest(x, y, unit, k, own)
            assert (rows.tolist(), cols.tolist()) == (want[0].tolist(), want[1].tolist())
            assert dist.tolist() == d[want].tolist()


def test_small_blocks_do_not_multiply_rows(spark):
    """Rows go to as many blocks as keep the cores busy, not to one per ``block_rows`` of their class."""
    df = spark.range(4000).selectExpr("id", "0 AS label", "array(cast(id AS double)) AS vec")
    found = nearest(df, df, "id", "id", "vec", 2, by="label", skip_self=True, block_rows=10)
    each = {r.id: [n.id for n in r.neighbors] for r in found.collect()}
    assert each == {i: sorted((i - 1, i + 1)) if 0 < i < 3999 else [1, 2] if i == 0 else [3998, 3997] for i in range(4000)}
    sent = spark.range(400_000).groupBy().agg(block_count(F.count("*"), 64, 10, 16).alias("n"))
    assert sent.head().n == math.ceil(400_000 / (BLOCK_BYTES // 512))
    assert spark.range(4000).agg(block_count(F.count("*"), 64, 10, 16).alias("n")).head().n == 6
    assert spark.range(40).agg(block_count(F.count("*"), 64, 10, 16).alias("n")).head().n == 4


def test_select_similar(points):
    ref = points.where("label = 2")
    got = select_similar(points.where("label < 2"), ref, {0: 4, 1: 2}, "id")
    assert sorted(r.label for r in got.collect()) == [0, 0, 0, 0, 1, 1]


DOCS = ["the cat sat", "the cat ran", "a dog ran far", "the dog sat", "the end", "cat cat cat dog", "", None, "the", "the sun"]


def test_tfidf_equals_plain_python(spark):
    df = spark.createDataFrame(list(enumerate(DOCS)), "id int, t string")
    vocab = {r.term: r for r in tfidf_vocabulary(df, "t", max_features=5, min_df=2, max_df=0.5).collect()}
    assert set(vocab) == {"cat", "dog", "ran", "sat", "the cat"}  # "the" is in six of ten
    assert (vocab["cat"].df, vocab["cat"].cf) == (3, 5)
    assert math.isclose(vocab["cat"].idf, math.log(11 / 4) + 1)
    long = {(r.id, r.term): r.tfidf for r in tfidf_terms(df, "id", "t", tfidf_vocabulary(df, "t", 5, 2, 0.5)).collect()}
    cat, dog = 3 * vocab["cat"].idf, vocab["dog"].idf
    assert math.isclose(long[5, "cat"], cat / math.hypot(cat, dog))
    model = tfidf_fit(df, "t", max_features=5, min_df=2, max_df=0.5)
    dense = {r.id: list(r.v) for r in model.transform(df).select("id", vector_to_array("features").alias("v")).collect()}
    for i in range(len(DOCS)):
        for j, term in enumerate(sorted(vocab)):
            assert math.isclose(dense[i][j], long.get((i, term), 0.0), abs_tol=1e-12)


def test_encoding(spark):
    df = spark.createDataFrame([(0, "aa bb aa cc"), (1, ""), (2, "aa zz")], "id int, t string")
    vocab = word_vocabulary(df.where("id = 0"), "t", 2)
    got = {r.id: (r.input_ids, r.attention_mask) for r in encode_sequences(df, "t", vocab, max_length=5).collect()}
    assert got[0] == ([1, 4, 5, 4, 2], [1, 1, 1, 1, 1])
    assert got[1] == ([1, 2, 0, 0, 0], [1, 1, 0, 0, 0])
    assert got[2] == ([1, 4, 3, 2, 0], [1, 1, 1, 1, 0])
    wide = {r.id: (r.input_ids, r.attention_mask) for r in encode_sequences(df, "t", vocab, max_length=5, max_words=1).collect()}
    assert wide == got


def test_embed_with_own_encoder(spark):
    df = spark.createDataFrame([(0, "aab"), (1, None)], "id int, t string")
    got = {r.id: list(r.vec) for r in embed(df, "t", encoder=lambda: lambda ts: [[t.count("a"), len(t)] for t in ts]).collect()}
    assert got == {0: [2.0, 3.0], 1: [0.0, 0.0]}


@pytest.fixture(scope="module")
def rows(points):
    return points.where("id < 90").withColumn("features", array_to_vector("vec"))


@pytest.mark.parametrize(
    "estimator",
    [forest(trees=15, depth=4), linear(iterations=30), boosted(3, rounds=5, depth=3), boosted(4, rounds=2, depth=2)],
)
def test_estimators(rows, estimator):
    out = estimator(rows.where("id >= 30"), rows.where("id < 30"))(rows.where("id < 30")).collect()
    assert len(out) == 30
    assert all(math.isclose(sum(r.probs), 1.0) for r in out)
    assert all(r.prediction == int(np.argmax(r.probs)) for r in out)
    assert sum(r.prediction == r.label for r in out) >= 20


def test_weighted_linear(rows):
    out = linear(weights={0: 1.0, 1: 1.0, 2: 50.0}, balanced=False)(rows)(rows)
    assert out.where("prediction = 2").count() >= 30


def test_out_of_fold_covers_every_row_once(rows):
    out = oof_predict(rows, "id", "label", 3, linear(iterations=20))
    assert sorted(r.id for r in out.collect()) == list(range(90))


def test_validation_rows_never_reach_the_resampler(rows):
    folds = with_folds(rows, "id", "label", 3)
    seen = []

    def prepare(part):
        made = smote(part, "id", "label", "vec", 40)
        seen.append(({r.id for r in made.where("not synthetic").collect()}, part))
        return made.withColumn("features", array_to_vector("vec"))

    fit_folds(folds, 3, linear(iterations=5), prepare, threads=1)
    for fold, (ids, _) in enumerate(seen):
        held = {str(r.id) for r in folds.where(F.col("fold") == fold).collect()}
        assert not ids & held and len(ids) + len(held) == 90


def test_ensemble_votes(rows):
    done = kfold_ensemble(rows, rows, "id", "label", 2, linear(iterations=20))
    assert done.fold_scores.count() == 2
    assert done.summary.head().folds == 2
    assert done.predictions.count() == 90
    parts = [m(rows).select("id", "probs").collect() for m in done.models]
    mean = {r.id: np.array(r.probs) / 2 for r in parts[0]}
    for r in parts[1]:
        mean[r.id] = mean[r.id] + np.array(r.probs) / 2
    for r in done.predictions.collect():
        assert np.allclose(mean[r.id], r.probs)
    forced = vote(rows, done.models, [0.0, 0.0, 1.0])
    assert {r.prediction for r in forced.collect()} == {2}


def test_failing_model_becomes_a_row(rows):
    def broken(_train, _valid):
        raise RuntimeError("no")

    result = run_models(rows, rows, {"bad": broken, "good": linear(iterations=10)}, test=rows)
    got = {r.model: r for r in result.table.collect()}
    assert result.best == "good" and got["bad"].error == "no" and got["good"].error is None
    assert got["good"].test_accuracy == got["good"].val_accuracy


def test_text_jobs(spark, tmp_path):
    words = ["red apple", "green pear", "blue sky"]
    data = [(str(i), f"{words[i % 3]} number {i % 7}", i % 3) for i in range(60)]
    train = spark.createDataFrame(data, "index string, message string, label int")
    test = spark.createDataFrame([("9", "a red   apple"), ("10", "blue sky #ERROR!")], "index string, message string")
    run = tfidf_folds(train, test, k=2, estimator=linear(iterations=20), tune=True)
    assert {(r["index"], r.label) for r in run.predictions.collect()} == {("9", 0), ("10", 2)}
    assert run.scores.count() == 2 and len(run.multipliers) == 3
    run.save(str(tmp_path / "p"), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).head().val_f1_macro == 1.0
    strong = {"weak": linear(iterations=5, l2=5.0), "good": linear(iterations=20)}
    result, predict_best = compare(train, train, strong, directory=str(tmp_path / "run"), config={"batch_size": 32})
    assert {(r["index"], r.label) for r in predict_best(test).collect()} == {("9", 0), ("10", 2)}
    epochs = spark.read.option("header", True).csv(str(tmp_path / "run" / "training_log"))
    assert {r.model_name for r in epochs.collect()} == {"weak", "good"} and epochs.head().batch_size == "32"
    assert spark.read.json(str(tmp_path / "run" / "training_summary")).head().models_trained == ["good", "weak"]
    path = str(tmp_path / "model")
    fit_text_model(train, path)
    out = batch_inference(test, path, str(tmp_path / "scored"))
    assert {(r["index"], r.label) for r in out.collect()} == {("9", 0), ("10", 2)}


def test_forest_rows_are_dealt_by_what_is_kept_of_them(spark, monkeypatch):
    from evenkeel.operators import models

    rows = [(i % 2, [float(i % 2), float(i)]) for i in range(64)]
    df = spark.createDataFrame(rows, "label int, x array<double>").coalesce(1)
    df = df.select("label", array_to_vector("x").alias("features"))
    assert models._dealt(df, "features").rdd.getNumPartitions() == 1
    monkeypatch.setattr(models, "FOREST_BYTES", 64 * 2 * 4 // 5)
    dealt = models._dealt(df, "features")
    assert dealt.rdd.getNumPartitions() == 6 and dealt.count() == 64
    found = forest(trees=3, depth=2)(df)(df).select("label", "prediction").collect()
    assert all(r.label == r.prediction for r in found)


def _vocabulary_by_hand(texts, max_features, hi, min_df=2, max_df=0.9):
    cf, df = {}, {}
    for text in texts:
        found = text.split() if text else []
        grams = [" ".join(found[i : i + n]) for n in range(1, hi + 1) for i in range(len(found) - n + 1)]
        for g in grams:
            cf[g] = cf.get(g, 0) + 1
        for g in set(grams):
            df[g] = df.get(g, 0) + 1
    fit = [g for g in cf if min_df <= df[g] <= max_df * len(texts)]
    return [(g, df[g], cf[g]) for g in sorted(fit, key=lambda g: (-cf[g], g))[:max_features]]


@pytest.mark.parametrize("max_features, hi", [(5, 2), (20, 2), (20, 3), (60, 2), (100_000, 2)])
def test_vocabulary_counts_no_ngrams_of_rare_words(spark, monkeypatch, max_features, hi):
    """Words in every text, frequent words with ties, and 3000 words that occur once; the terms are as counted by hand."""
    from evenkeel.operators import features

    draw = np.random.default_rng(3)
    texts = [None, "", "aa aa aa"]
    for i in range(300):
        common = [f"c{int(c)}" for c in draw.zipf(1.3, 20) % 40]
        texts.append(" ".join(["aa", "aa", *common[:10], *[f"rare{i}x{j}" for j in range(10)], *common[10:]]))
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    frames = []
    plain = features._gram_stats
    monkeypatch.setattr(features, "_gram_stats", lambda *args: frames.append(plain(*args)) or frames[-1])
    found = [(r.term, r.df, r.cf) for r in tfidf_vocabulary(docs, "text", max_features=max_features, hi=hi).collect()]
    assert found == _vocabulary_by_hand(texts, max_features, hi)
    if max_features <= 20:
        # by hand some 3000 n-grams of each length have a rare word; a few share their hash with a frequent one
        assert frames[1].where(F.col("term").contains("rare")).count() < 30


def test_folds_clean_texts_once(spark, monkeypatch):
    """The vocabulary and the features read stored texts; cleaning them again for each reading is most of the work."""
    from evenkeel.plans import training

    rows = [(str(i), f"  word{i % 3}   more{i % 2} #ERROR! text", i % 2) for i in range(40)]
    train = spark.createDataFrame(rows, "index string, message string, label int")
    test = train.select("index", "message").limit(4)
    read = []
    plain = training.tfidf_fit
    monkeypatch.setattr(training, "tfidf_fit", lambda df, *args, **named: read.append(df) or plain(df, *args, **named))
    done = training.tfidf_folds(train, test, k=2, estimator=linear(iterations=3), tune=True)
    assert done.predictions.count() == 4 and len(done.multipliers) == 2
    assert "regexp_replace" not in read[0]._jdf.queryExecution().optimizedPlan().toString()
    assert {r.message for r in read[0].collect()} == {f"word{i} more{j} text" for i in range(3) for j in range(2)}
