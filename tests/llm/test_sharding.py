import collections
import zlib

from evenkeel.llm import sharding


def check(rows, got, slack):
    texts = dict(rows)
    assert sorted(r.doc_id for r in got) == sorted(texts)
    sizes, slots, at = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    for r in got:
        body = (texts[r.doc_id] or "").encode()
        assert r.size == len(body) + 1 and r.text_crc32 == zlib.crc32(body)
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        at[body].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) <= slack, sizes
    return at


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    at = check(rows, sharding.balanced_shards(docs.repartition(4)).collect(), 0.05 * sum(len((t or "").encode()) for _, t in rows) / 8)
    assert sum(len(s) > 1 for s in at.values()) <= 0.02 * len(at)


def test_hot_group_and_pairs(spark):
    rows = [(i, "one text of a third of all rows") for i in range(700)] + [(1000 + i, f"pair number {i // 2}") for i in range(600)]
    rows += [(2000 + i, f"a text of its own {i}") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    at = check(rows, sharding.balanced_shards(docs).collect(), 60)
    assert len(at[rows[0][1].encode()]) < 8  # larger than a shard: over as few as hold it
    pairs = [s for t, s in at.items() if t.startswith(b"pair")]
    assert sum(len(s) > 1 for s in pairs) <= 0.1 * len(pairs)
