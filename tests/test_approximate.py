"""Searches with a measured recall, the simplex, and a caller's own model, against plain versions."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenkeel.operators import approximate, similarity
from evenkeel.operators.approximate import hashed_nearest, listed_nearest
from evenkeel.operators.epochs import f1_scores
from evenkeel.operators.served import served
from evenkeel.operators.similarity import max_cosine
from evenkeel.operators.simplex import candidate_confusions, simplex_multipliers, walk
from evenkeel.operators.smote import smote
from evenkeel.queries import REGISTRY, vectorising

RNG = np.random.default_rng(23)
CENTRES = RNG.normal(0, 1, (25, 12))
POINTS = CENTRES[np.arange(900) % 25] + RNG.normal(0, 0.15, (900, 12))


@pytest.fixture(scope="module")
def points(spark):
    rows = [(i, i % 3, [float(x) for x in POINTS[i]]) for i in range(900)]
    return spark.createDataFrame(rows, "id int, label int, vec array<double>").repartition(4)


def brute(k, group=None, metric="cosine"):
    unit = POINTS / np.linalg.norm(POINTS, axis=1, keepdims=True)
    d = 1 - unit @ unit.T if metric == "cosine" else ((POINTS[:, None] - POINTS[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    if group is not None:
        d[group[:, None] != group[None]] = np.inf
    return [set(row[:k].tolist()) for row in np.argsort(d, axis=1)]


def share(found, want):
    rows = {r.id: {n.id for n in r.neighbors} for r in found.collect()}
    assert rows.keys() == set(range(900)) and all(len(v) == len(want[0]) for v in rows.values())
    return np.mean([len(rows[i] & want[i]) / len(want[i]) for i in rows])


def test_hashed_nearest(points, monkeypatch):
    monkeypatch.setattr(approximate, "BUCKET_ROWS", 30)
    found, recall, tables = hashed_nearest(points, points, "id", "id", "vec", 5, skip_self=True)
    assert tables is not None and recall >= 0.9
    assert share(found, brute(5)) >= 0.85


def test_hashed_nearest_falls_back(points, monkeypatch):
    """Buckets too small for any table to help: the exact search is taken."""
    monkeypatch.setattr(approximate, "TABLES", (1, 2))
    found, recall, tables = hashed_nearest(points, points, "id", "id", "vec", 5, skip_self=True, bits=30)
    assert tables is None and share(found, brute(5)) == 1.0


def test_listed_nearest(points):
    group = np.arange(900) % 3
    found, recall, lists = listed_nearest(points, points, "id", "id", "vec", 4, "label", skip_self=True)
    assert lists is not None and recall >= 0.9
    assert share(found, brute(4, group, "l2")) >= 0.85


def test_listed_nearest_takes_more_lists(spark, monkeypatch):
    """Where the steps fall short, more lists of a group that has many are searched, and not all rows."""
    monkeypatch.setattr(approximate, "PROBES", (1,))
    monkeypatch.setattr(approximate, "MOST_SHARE", 1, raising=False)
    spread = np.random.default_rng(5).normal(0, 1, (300, 12))
    df = spark.createDataFrame([(i, 0, [float(x) for x in v]) for i, v in enumerate(spread)], "id int, label int, vec array<double>")
    found, recall, lists = listed_nearest(df, df, "id", "id", "vec", 4, "label", skip_self=True)
    assert lists in (4, 8, 16) and recall >= 0.9
    d = ((spread[:, None] - spread[None]) ** 2).sum(2) + np.diag(np.full(300, np.inf))
    rows = {r.id: {n.id for n in r.neighbors} for r in found.collect()}
    assert len(rows) == 300 and np.mean([len(near & set(d[i].argsort()[:4].tolist())) / 4 for i, near in rows.items()]) >= 0.85


def test_listed_nearest_falls_back(points, monkeypatch):
    monkeypatch.setattr(approximate, "PROBES", (1,))
    monkeypatch.setattr(approximate, "MOST_SHARE", 0)
    found, recall, lists = listed_nearest(points, points, "id", "id", "vec", 4, "label", "cosine", 1.0, skip_self=True)
    assert lists is None and recall == 1.0 and share(found, brute(4, np.arange(900) % 3)) == 1.0


@pytest.mark.parametrize("unit", [True, False])
def test_in_lists_by_blocks(spark, monkeypatch, unit):
    """Lists cut into blocks, in many tasks, give what whole lists do; a row without an id is not passed over as the same."""
    rows = [("a", i % 3, None if i == 50 else f"n{i:03d}", [float(x) for x in POINTS[i % 120]]) for i in range(240)]
    left, right = (spark.createDataFrame(rows, "g string, _list int, id string, vec array<double>").repartition(3) for _ in range(2))
    left = left.withColumn("_place", F.lit(2))

    def found():
        out = approximate._merged_lists(approximate._in_lists(left, right, 4, unit, True), "id", 4)
        return {r.id: [(n.id, round(n.dist, 8)) for n in r.neighbors] for r in out.collect()}

    whole = found()
    assert len(whole) == 240 and all(len({n for n, _ in near}) == 4 for near in whole.values())
    assert whole[None][:2] == [(None, 0.0), ("n170", 0.0)] and all(i not in [n for n, _ in near] for i, near in whole.items() if i)
    monkeypatch.setattr(approximate, "TASK_BYTES", 1000)
    monkeypatch.setattr(approximate, "STRIP_CELLS", 500)
    monkeypatch.setattr(similarity, "BLOCK_BYTES", 30 * 8 * 12)
    assert found() == whole


def test_keys_that_repeat(spark):
    """Rows that come twice get their neighbours once."""
    rows = [(i % 40, "x", [float(x) for x in POINTS[i % 40]]) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, g string, vec array<double>")
    found, _, _ = listed_nearest(df, df, "id", "id", "vec", 3, "g", "cosine", skip_self=True)
    assert {r.id for r in found.collect()} == set(range(40)) and found.count() == 40


def test_closest_unit():
    x, y = (approximate._unit(m) for m in (POINTS[:60], np.concatenate([POINTS, POINTS[:300], np.zeros((2, 12))])))
    own = (np.arange(60), np.arange(60))
    want, got = similarity._closest(x, y, True, 7, own), approximate._closest_unit(x, y, y.astype(np.float32), 7, own)
    assert all(np.array_equal(a, b) for a, b in zip(want[:2], got[:2])) and np.allclose(want[2], got[2], atol=2e-12)
    few = approximate._closest_unit(x[:2], y[:2], y[:2].astype(np.float32), 7, (np.arange(2), np.arange(2)))
    assert few[0].tolist() == [0, 1] and few[1].tolist() == [1, 0]


def test_texts_are_encoded_once(spark, tmp_path, monkeypatch):
    """Both sides of the search read stored vectors, and not the texts again."""
    texts = [(i, ("en", "de")[i % 2], " ".join(f"word{(i * j) % 17}" for j in range(9))) for i in range(60)]
    spark.createDataFrame(texts, "doc_id bigint, lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i,) for i in range(0, 60, 3)], "doc_id bigint").write.parquet(str(tmp_path / "labels.parquet"))
    seen = []
    monkeypatch.setattr(vectorising, "listed_nearest", lambda left, right, *a, **k: seen.extend([left, right]) or listed_nearest(left, right, *a, **k))
    out = REGISTRY["nearest_listed"].run(spark, str(tmp_path)).collect()
    assert len({r.doc_id for r in out}) == 20 and len(out) == 100
    assert len(seen) == 2 and not any("documents.parquet" in f for df in seen for f in df.inputFiles())


def test_copies_fill_one_bucket(spark):
    """A third of the rows are one vector: they share every bucket and list, and are searched all the same."""
    rows = [(i, 0, [1.0, 2.0, 3.0] if i % 3 == 0 else [float(x) for x in RNG.normal(0, 1, 3)]) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, label int, vec array<double>")
    for found, recall, _ in (
        hashed_nearest(df, df, "id", "id", "vec", 3, skip_self=True), listed_nearest(df, df, "id", "id", "vec", 3, "label", skip_self=True),
    ):
        got = {r.id: [n.dist for n in r.neighbors] for r in found.collect()}
        assert len(got) == 600 and all(got[i] == [0.0] * 3 for i in range(0, 600, 3)) and recall >= 0.9


def test_rows_without_vectors(spark):
    df = spark.createDataFrame([(1, 0, [1.0, 0.0]), (2, 0, None), (3, None, [1.0, 0.1]), (4, 0, [0.0, 0.0])], "id int, label int, vec array<double>")
    found, _, _ = hashed_nearest(df, df, "id", "id", "vec", 1, skip_self=True)
    assert {r.id: r.neighbors[0].id for r in found.collect()}[1] == 3
    found, _, _ = listed_nearest(df, df, "id", "id", "vec", 1, "label", skip_self=True)
    assert {r.id: r.neighbors[0].id for r in found.collect()} == {1: 4, 4: 1}
    assert hashed_nearest(df, df.limit(0), "id", "id", "vec", 1)[0].count() == 0


def test_max_cosine_with_recall(points, monkeypatch):
    monkeypatch.setattr(approximate, "BUCKET_ROWS", 30)
    ref = points.where("id % 2 = 0")
    exact = {r.id: r.sim_score for r in max_cosine(points, ref, "vec", "id", max_ref_rows=0).collect()}
    got = {r.id: r.sim_score for r in max_cosine(points, ref, "vec", "id", max_ref_rows=0, recall=0.9).collect()}
    assert got.keys() == exact.keys() and all(got[i] <= exact[i] + 1e-9 for i in got)
    assert np.mean([abs(got[i] - exact[i]) < 1e-9 for i in got]) >= 0.85


def test_smote_with_recall(points):
    few = points.where("label < 2 OR id < 60")
    made = smote(few, "id", "label", "vec", 400, recall=0.9)
    assert {r.label: r["count"] for r in made.groupBy("label").count().collect()} == {0: 400, 1: 400, 2: 400}
    near = [r.vec for r in made.where("synthetic").collect()]
    assert len(near) == 580 and all(np.abs(POINTS - v).sum(1).min() < 12 for v in near)


# --- the simplex -------------------------------------------------------------


def plain_simplex(f, start, steps, tolerance=1e-4):
    """One point at a time, as in the textbooks."""
    pts = [np.array(start, float)]
    for i in range(len(start)):
        p = np.array(start, float)
        p[i] = p[i] * 1.05 if p[i] else 0.00025
        pts.append(p)
    val = [f(p) for p in pts]
    for _ in range(steps):
        order = sorted(range(len(pts)), key=lambda i: val[i])
        pts, val = [pts[i] for i in order], [val[i] for i in order]
        if max(np.abs(p - pts[0]).max() for p in pts[1:]) <= tolerance and max(abs(v - val[0]) for v in val[1:]) <= tolerance:
            break
        c = np.mean(pts[:-1], axis=0)
        r = c + (c - pts[-1])
        fr = f(r)
        if fr < val[0]:
            e = c + 2 * (c - pts[-1])
            new = (e, f(e)) if f(e) < fr else (r, fr)
        elif fr < val[-2]:
            new = (r, fr)
        elif fr < val[-1]:
            o = c + 0.5 * (c - pts[-1])
            new = (o, f(o)) if f(o) <= fr else None
        else:
            i = c - 0.5 * (c - pts[-1])
            new = (i, f(i)) if f(i) < val[-1] else None
        if new:
            pts[-1], val[-1] = new
        else:
            for i in range(1, len(pts)):
                pts[i] = pts[0] + 0.5 * (pts[i] - pts[0])
                val[i] = f(pts[i])
    best = min(range(len(pts)), key=lambda i: val[i])
    return pts[best], val[best]


def test_walk_equals_plain_version():
    def banana(p):
        return (1 - p[0]) ** 2 + 100 * (p[1] - p[0] ** 2) ** 2 + p[2] ** 2

    for steps in (5, 40, 400):
        want = plain_simplex(banana, [-1.0, 2.0, 0.0], steps)
        got = walk(lambda ps: np.array([banana(p) for p in ps]), [-1.0, 2.0, 0.0], steps)
        assert np.allclose(got[0], want[0]) and np.isclose(got[1], want[1])
    assert np.allclose(got[0], [1, 1, 0], atol=1e-2)


def test_simplex_multipliers(spark):
    y = np.array([0] * 200 + [1] * 40 + [2] * 20)
    p = np.array([0.6, 0.25, 0.15]) + np.eye(3)[y] * 0.25 + RNG.uniform(0, 0.3, (260, 3))
    p /= p.sum(1, keepdims=True)
    rows = [(int(a), [float(x) for x in b]) for a, b in zip(y, p)] + [(None, [0.3, 0.3, 0.4]), (1, None), (7, [0.1, 0.2, 0.7])]
    df = spark.createDataFrame(rows, "label int, probs array<double>").repartition(3)

    def f1(m):
        counts = np.zeros((3, 3))
        np.add.at(counts, (y, (p * m).argmax(1)), 1)
        return -round(float(f1_scores(counts)[1]), 12)

    assert [-round(float(f1_scores(c)[1]), 12) for c in candidate_confusions(df, np.array([[1.0, 1, 1], [1, 2, 3]]))] == [f1([1, 1, 1]), f1([1, 2, 3])]
    best, value, base = simplex_multipliers(df, 3, steps=25)
    want = plain_simplex(f1, [1.0] * 3, 25)
    assert np.allclose(best, want[0]) and value == -want[1] and base == -f1([1, 1, 1]) and value >= base


# --- a caller's model --------------------------------------------------------


def test_served(spark, tmp_path):
    (tmp_path / "model.json").write_text(json.dumps([[1.0, -1.0], [0.5, 2.0]]))

    def load(content):
        weights = np.array(json.loads(content))
        log = tmp_path / "loads"
        log.mkdir(exist_ok=True)
        (log / str(np.random.default_rng().integers(1 << 60))).write_text("")

        def model(columns):
            x = np.stack([columns["a"].to_numpy(zero_copy_only=False), columns["b"].to_numpy(zero_copy_only=False)], axis=1)
            z = np.exp(x @ weights)
            return z / z.sum(1, keepdims=True)

        return model

    df = spark.range(500).select("id", (F.col("id") / 500).alias("a"), (1 - F.col("id") / 250).alias("b"), F.lit("kept").alias("note"))
    out = served(df.repartition(30), load, str(tmp_path / "model.json"), ["a", "b"], batch_rows=7).collect()
    assert len(out) == 500 and {r.note for r in out} == {"kept"}
    for r in out:
        z = np.exp(np.array([r.a, r.b]) @ np.array([[1.0, -1.0], [0.5, 2.0]]))
        assert np.allclose(r.probs, z / z.sum()) and r.prediction == int(np.argmax(z))
    assert len(list((tmp_path / "loads").iterdir())) <= 8 < 30  # once a worker, not once a task

    with pytest.raises(Exception, match="the model gave"):
        served(df, lambda content: lambda columns: np.zeros((3, 2)), b"", ["a"]).collect()
