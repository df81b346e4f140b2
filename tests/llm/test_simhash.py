import random

import numpy as np
import pytest
import xxhash

from evenkeel.llm import simhash
from evenkeel.llm.components import components


def plain_fingerprint(text, k=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in lowered).split(" ") if w]
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    bits = 0
    for b in range(64):
        if 2 * sum(xxhash.xxh64_intdigest(g.encode(), 42) >> b & 1 for g in grams) > len(grams):
            bits |= 1 << b
    return bits


def plain_groups(prints, ids, radius=4):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(ids))]


@pytest.mark.parametrize("text", ["", "  ", "One", "A b C d", "Ünïcode É a b c\x85d e", "x\x1cy z\x0bw v u t", "a b c d " * 3000])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode(), 4) & (2**64 - 1) == plain_fingerprint(text)


@pytest.mark.parametrize("tile_rows", [7, 1 << 18])
def test_against_brute_force(spark, sf_dir, tile_rows):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    table = docs.select("doc_id", "text").toPandas()
    prints = [plain_fingerprint(t) for t in table.text]
    want = dict(zip(table.doc_id, zip(prints, plain_groups(prints, list(table.doc_id)))))
    got = simhash.near_duplicates(docs.repartition(5), tile_rows=tile_rows).withColumn("hex", simhash.as_hex(simhash.F.col("fp")))
    assert {r.doc_id: (int(r.hex, 16), r.component_id) for r in got.collect()} == want


def test_spanning_links_of_dense_and_chained_prints():
    rng = random.Random(3)
    prints = []
    for _ in range(30):  # groups in which each print is near the one before, and not the first
        at = rng.getrandbits(64)
        for _ in range(12):
            prints.append(at)
            at ^= sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
    prints = sorted(set(prints))
    array = np.array(prints, np.uint64)
    want = plain_groups(prints, list(range(len(prints))))
    links = simhash.spanning_links(array, None, 4)
    assert len(links) == len(prints) - len(set(want))
    half = simhash.spanning_links(array[::2], None, 4) + simhash.spanning_links(array[1::2], None, 4)
    half += simhash.spanning_links(array[::2], array[1::2], 4)
    for found in (links, half):
        at = {p: i for i, p in enumerate(prints)}
        parent = list(range(len(prints)))
        for a, b in found:
            x, y = at[a], at[b]
            old, new = max(parent[x], parent[y]), min(parent[x], parent[y])
            parent = [new if p == old else p for p in parent]
        assert parent == want


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)] + [(100, 100), (None, 3), (101, 100)]
    got = components(spark.createDataFrame(chain + star, "a bigint, b bigint"), "a", "b")
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    rows = got.collect()
    assert {r.node: r.root for r in rows} == want and len(rows) == len(want)


def test_keep_first(spark):
    rows = [(3, "the same words here"), (1, "the same words here"), (2, "quite another text stands here"), (None, "the same words here")]
    got = simhash.keep_first(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted((r.doc_id for r in got.collect()), key=repr) == [1, 2, None]
