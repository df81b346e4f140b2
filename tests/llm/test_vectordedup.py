"""Near duplicates among vectors against all pairs."""

import numpy as np
import pytest

from evenkeel.llm import vectordedup


def brute(rows, threshold=0.93):
    """``(vec_id, n_links, component_id, kept)`` per row, by all pairs and their closure."""
    def good(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(x for x in v)

    n = len(rows)
    links = [set() for _ in rows]
    for i in range(n):
        for j in range(i):
            a, b = rows[i][1], rows[j][1]
            if rows[i][2] is None or rows[i][2] != rows[j][2] or not good(a) or not good(b) or len(a) != len(b):
                continue
            a, b = (np.array(v) / np.abs(v).max() for v in (a, b))
            if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                links[i].add(j), links[j].add(i)
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        seen, open_rows = {i}, [i]
        while open_rows:
            new = links[open_rows.pop()] - seen
            seen |= new
            open_rows += new
        least = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
        out.append((vec_id, len(links[i]), least, least is None or vec_id == least))
    return sorted(out, key=repr)


def found(spark, rows, **settings):
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(4)
    return sorted((tuple(r) for r in vectordedup.near_duplicates(table, **settings).collect()), key=repr)


@pytest.mark.parametrize("tile_bytes", [1 << 24, 8 * 24 * 40])
def test_equals_all_pairs(spark, tile_bytes, monkeypatch):
    monkeypatch.setattr(vectordedup, "ROWS", 16)
    monkeypatch.setattr(vectordedup, "COLUMNS", 24)
    monkeypatch.setattr(vectordedup, "STEP", 5)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((30, 24)) * np.linspace(3, 0.2, 24)
    rows = []
    for i in range(400):
        v = centres[i % 30] + rng.standard_normal(24) * rng.choice([0.0, 0.1, 0.3, 0.5])
        rows.append((i * 7 % 400, [float(x) for x in v * rng.choice([1.0, 1e-150, 1e150])], int(rng.integers(0, 3))))
    want = brute(rows)
    assert found(spark, rows, tile_bytes=tile_bytes) == want
    assert any(0 < r[1] for r in want) and any(not r[1] for r in want)


def test_copies_and_edges(spark):
    copy = [1.0, 2.0, 3.0]
    rows = [(i, copy, 1) for i in range(200)] + [(1000, [2.0, 4.0, 6.0], 1), (1001, copy, 2), (1002, copy, None)]
    rows += [(3, copy, 1), (None, copy, 1), (None, [5.0, 0.0, 0.0], 4), (None, [5.0, 0.1, 0.0], 4)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 3, 1), (2003, [1.0, None, 3.0], 1), (2004, [float("inf"), 1.0, 1.0], 1)]
    rows += [(2005, [float("nan"), 1.0, 1.0], 1), (2006, [1.0, 2.0], 1), (2007, [1.0, 2.0], 1), (2008, [-1.0, -2.0, -3.0], 1)]
    assert found(spark, rows) == brute(rows)


def test_chain_across_tiles(spark):
    """Each vector is near the next one only; one component spans many tiles."""
    angle = np.arange(120) * 0.3
    rows = [(500 - i, [float(np.cos(a)), float(np.sin(a)), 0.01 * i], 0) for i, a in enumerate(angle[:11])]
    assert found(spark, rows, tile_bytes=8 * 3 * 2) == brute(rows)


def test_leading_dimensions_rule_out(monkeypatch):
    """Where the first components hold most of the length, few pairs are summed up to the end."""
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((600, 64)) * np.concatenate((np.full(8, 4.0), np.full(56, 0.1)))
    units = vectordedup._unit(vectors)
    pairs = sum(len(x) for x, _ in vectordedup.linked_pairs(units, units, units, units, 0.93, True))
    cosines = np.triu(units @ units.T, 1)
    assert pairs == (cosines >= 0.93).sum()
    rest = vectordedup._suffix_norms(units, [16])[0]
    alive = np.triu(units[:, :16] @ units[:, :16].T + np.outer(rest, rest) >= 0.93, 1).sum()
    assert alive < 0.05 * 600 * 300


def test_forest():
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 300, 500), rng.integers(0, 300, 500)
    forest = vectordedup.SpanningForest(300)
    for at in range(0, 500, 50):
        forest.add(x[at : at + 50], y[at : at + 50])
    label = np.arange(300)
    for _ in range(300):
        np.minimum.at(label, x, label[y])
        np.minimum.at(label, y, label[x])
    assert (forest.label == label).all()
    assert sum(len(a) for a, _ in forest.links) == 300 - len(set(label.tolist()))


def test_threshold(spark):
    with pytest.raises(ValueError):
        vectordedup.near_duplicates(spark.range(1), threshold=0.0)
