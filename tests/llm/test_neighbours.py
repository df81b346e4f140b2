import numpy as np
import pytest

from evenkeel.llm import neighbours


def brute(ids, vectors, k):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[i]
        rows = [j for j in np.lexsort((ids, -np.round(score, 12))) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in rows]
    return out


@pytest.mark.parametrize(("block", "query_block"), [(1 << 15, 1 << 15), (150, 4)])
def test_recall_and_exact_scores(spark, sf_dir, block, query_block):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    local = table.toPandas()
    want = brute(local.vec_id.to_numpy(), np.stack(local.embedding).astype(float), 5)
    got = {}
    for r in neighbours.nearest(table, table.where("vec_id % 50 = 0"), block=block, query_block=query_block).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert got.keys() == want.keys()
    found = sum(len({v for v, _ in got[q].values()} & {v for v, _ in want[q]}) for q in want)
    assert found >= 0.9 * sum(map(len, want.values()))
    scores = {q: dict(rows) for q, rows in want.items()}
    for q, rows in got.items():
        assert sorted(rows) == [1, 2, 3, 4, 5]
        assert all(abs(s - scores[q][v]) < 1e-12 for v, s in rows.values() if v in scores[q])


def test_clusters(spark):
    """Where near and far differ, few vectors are verified, and the near ones are found."""
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((60, 32))
    vectors = centres[np.arange(3000) % 60] + 0.15 * rng.standard_normal((3000, 32))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    index, right, seen = neighbours.SortedProjections(unit, neighbours.PROJECTIONS), 0, 0
    for i in range(0, 3000, 100):
        far = np.linalg.norm(unit - unit[i], axis=1)
        rows, _ = index.search(unit[i], 6, lambda r, far=far: far[r])
        seen += len(rows)
        right += len(set(rows[np.argsort(far[rows])][:6].tolist()) & set(np.argsort(far)[:6].tolist()))
    assert right >= 0.9 * 30 * 6 and seen < 30 * 3000 / 4


def test_ties_nulls_and_few_candidates(spark):
    rows = [
        (0, [1.0, 0.0]), (7, [2.0, 0.0]), (3, [5.0, 0.0]), (50, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [1.0, None]),
        (8, [float("inf"), 1.0]), (9, []), (10, [1.0, 0.0, 0.0]), (100, [float("nan"), 0.0]), (None, [3.0, 0.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = neighbours.nearest(table, table.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [
        (0, 1, 3, 1.0), (0, 2, 7, 1.0), (0, 3, None, 1.0), (0, 4, 50, 0.0),
        (50, 1, 0, 0.0), (50, 2, 3, 0.0), (50, 3, 7, 0.0), (50, 4, None, 0.0),
    ]


def test_components_of_any_size(spark):
    """Cosines do not depend on how long vectors are, up to the ends of the range of doubles."""
    rng = np.random.default_rng(8)
    plain = rng.standard_normal((120, 6))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(plain * 10.0 ** rng.choice([-300, -200, 0, 200, 300], 120)[:, None])]
    rows += [(1000, [5e-324, 0.0, 0.0, 0.0, 0.0, 0.0]), (1001, [1e308] * 6)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    vectors = np.vstack([plain, np.eye(6)[0], np.ones(6)])
    ids = np.array([r[0] for r in rows])
    want = brute(ids, vectors, 130)
    got = {}
    for r in neighbours.nearest(table, table.where("vec_id % 50 = 0"), k=130).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    assert got.keys() == want.keys()
    for q, rows in want.items():
        assert got[q] == pytest.approx(dict(rows), abs=1e-12)
