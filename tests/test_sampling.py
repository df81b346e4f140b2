import pytest
from pyspark.sql import functions as F

from evenkeel.operators.sampling import (
    assign_batches,
    balance_classes,
    hash_rank,
    holdout_sizes,
    oversample,
    reindex,
    source_mix,
    stratified_folds,
    stratified_split,
    undersample,
)
from evenkeel.operators.smote import neighbor_count, smote

SIZES = {0: 100, 1: 5, 2: 2, 3: 1}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(f"{lab}_{i}", lab, [float(i), float(lab), (i * 7) % 5 / 2.0]) for lab, n in SIZES.items() for i in range(n)]
    return spark.createDataFrame(data, "id string, label int, vec array<double>")


def sizes(df, col="label"):
    return {r[0]: r[1] for r in df.groupBy(col).count().collect()}


def test_hash_rank_is_dense(rows):
    got = hash_rank(rows, "id", by="label").groupBy("label").agg(
        F.count("*").alias("n"), F.min("rank").alias("lo"), F.max("rank").alias("hi"), F.countDistinct("rank").alias("d")
    )
    assert {r.label: (r.lo, r.hi, r.d) for r in got.collect()} == {k: (1, n, n) for k, n in SIZES.items()}


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_buckets_do_not_change_results(rows, digits):
    base = {tuple(r) for r in hash_rank(rows, "id", by="label").select("id", "rank").collect()}
    assert {tuple(r) for r in hash_rank(rows, "id", by="label", hex_digits=digits).select("id", "rank").collect()} == base
    some = {r.id for r in undersample(rows, 30, "id", by="label").collect()}
    assert {r.id for r in undersample(rows, 30, "id", by="label", hex_digits=digits).collect()} == some


@pytest.mark.parametrize("n", [0, 1, 2, 5, 99, 100, 101])
def test_undersample_sizes(rows, n):
    assert sizes(undersample(rows, n, "id", by="label")) == {k: min(v, n) for k, v in SIZES.items() if min(v, n)}
    assert undersample(rows, n, "id").count() == min(n, 108)


def test_undersample_takes_lowest_ranks(rows):
    ranked = {r.id for r in hash_rank(rows, "id", by="label").where("rank <= 7").collect()}
    assert {r.id for r in undersample(rows, 7, "id", by="label").collect()} == ranked


def test_undersample_named_classes_keeps_others(rows):
    assert sizes(undersample(rows, {0: 10, 1: 0}, "id", by="label")) == {0: 10, 2: 2, 3: 1}


def test_seed_matters(rows):
    one = {r.id for r in undersample(rows, 20, "id", by="label", seed=1).collect()}
    two = {r.id for r in undersample(rows, 20, "id", by="label", seed=2).collect()}
    assert one != two


def test_oversample(rows):
    got = oversample(rows, 300, "id", "label")
    assert sizes(got) == dict.fromkeys(SIZES, 300)
    drawn = got.where("label = 0").select("id").distinct().count()
    assert 85 <= drawn <= 100  # 300 draws of 100 rows hit about 95 of them
    assert got.select("label", "draw").distinct().count() == 1200


def test_oversample_over_several_chunks(rows):
    assert sizes(oversample(rows, {3: 25_001}, "id", "label")) == {3: 25_001}


def test_balance(rows):
    got = balance_classes(rows, "id", majority=0, target=40, minimum=5)
    assert sizes(got) == {0: 40, 1: 5, 2: 5, 3: 5}
    assert {r.label for r in got.where("draw is not null").collect()} == {2, 3}
    same = balance_classes(rows, "id", majority=0, target=1000, minimum=1)
    assert sizes(same) == SIZES


def test_source_mix(rows):
    extra = rows.where("label < 2")
    got = source_mix(rows, extra, "id", pooled={0: 150}, drawn={2: 7, 9: 3})
    assert sizes(got) == {0: 150, 1: 10, 2: 7, 3: 1}
    assert got.where("label = 2 and source = 1").count() == 0
    shrunk = source_mix(rows, extra, "id", pooled={0: 20}, drawn={1: 3})
    assert sizes(shrunk) == {0: 20, 1: 3, 2: 2, 3: 1}


def test_reindex_is_dense_by_source(rows):
    got = reindex(rows, "id", "label", out="index")
    assert sorted(int(r["index"]) for r in got.collect()) == list(range(108))
    assert got.where("label = 3").head()["index"] == "107"


@pytest.mark.parametrize("k", [2, 5])
def test_folds(rows, k):
    got = stratified_folds(rows, "id", "label", k)
    assert got.count() == 108
    by = {(r.label, r.fold): r["count"] for r in got.groupBy("label", "fold").count().collect()}
    for lab, n in SIZES.items():
        parts = [by.get((lab, f), 0) for f in range(k)]
        assert sum(parts) == n and max(parts) - min(parts) <= 1
    total = [sum(v for (_, f), v in by.items() if f == i) for i in range(k)]
    assert max(total) - min(total) <= 1


def test_split(rows):
    assert sum(holdout_sizes(SIZES, 0.1).values()) == 11
    got = stratified_split(rows, "id", "label", 0.1)
    assert got.where("is_test").count() == 11 and got.count() == 108
    assert sizes(got.where("is_test")) == {k: v for k, v in holdout_sizes(SIZES, 0.1).items() if v}


def test_batches(rows):
    got = sizes(assign_batches(rows, 16, "id"), "batch")
    assert got == {i: 16 for i in range(6)} | {6: 12}


@pytest.mark.parametrize("partitions", ["1", "4", "64"])
def test_partitioning_does_not_change_results(spark, rows, partitions):
    def run():
        folds = {(r.id, r.fold) for r in stratified_folds(rows, "id", "label", 5).collect()}
        over = sorted((r.id, r.draw) for r in oversample(rows, 50, "id", "label").collect())
        made = sorted((r.id, tuple(round(x, 9) for x in r.vec)) for r in smote(rows, "id", target=20).collect())
        return folds, over, made

    before = spark.conf.get("spark.sql.shuffle.partitions")
    base = run()
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        assert run() == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_smote(rows):
    assert neighbor_count({0: 10, 1: 1}, 5) == 1
    assert neighbor_count({0: 10, 1: 4}, 5) == 3
    got = smote(rows, "id", target=20, k=5)
    assert sizes(got) == dict.fromkeys(SIZES, 20)
    real = {r.id: r for r in rows.collect()}
    for r in got.collect():
        if not r.synthetic:
            assert list(real[r.id].vec) == list(r.vec)
        else:
            assert r.id.startswith("smote_")
            mates = [x.vec for x in real.values() if x.label == r.label]
            for j, value in enumerate(r.vec):
                assert min(m[j] for m in mates) - 1e-9 <= value <= max(m[j] for m in mates) + 1e-9
    single = got.where("label = 3 and synthetic").select("vec").distinct().collect()
    assert [list(r.vec) for r in single] == [[0.0, 3.0, 0.0]]


def test_smote_by_small_blocks_is_the_same(rows):
    def run(**kw):
        return sorted((r.id, tuple(round(x, 9) for x in r.vec)) for r in smote(rows, "id", target=110, **kw).collect())

    assert run() == run(block_rows=9)
