import random
import zlib

import pytest
from pyspark.sql import functions as F

from evenkeel.llm import toxicity


def distance(a, b):
    """Insertions, deletions, changes and swaps of neighbours, none of them touched twice."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_against_distances():
    rng = random.Random(7)
    word = lambda a, b: "".join(rng.choice("abc") for _ in range(rng.randint(a, b)))
    terms = sorted({word(5, 11) for _ in range(25)})
    trie = toxicity.FuzzyTrie(terms)
    hits = 0
    for _ in range(3000):
        if rng.random() < 0.5:
            w = word(3, 12)
        else:
            w = list(rng.choice(terms))
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice("abc")
                if rng.random() < 0.3:
                    del w[rng.randrange(len(w))]
            w = "".join(w)
        want = any(distance(w, t) <= (2 if len(t) >= toxicity.FUZZY_TWICE_FROM else 1) for t in terms)
        hits += want
        assert trie.accepts(w) == want, w
    assert hits > 300


def test_quoted():
    words = 'he called them "fools" today and then left for home in the rain you fools'.split()
    assert toxicity.quoted(words, 3) and not toxicity.quoted(words, 14)


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(1)
    common = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    insults = ["grubblenose", "muckworm", "snivelpot", "foulbrain"]
    rows, labels = [], []
    for i in range(900):
        words = [rng.choice(common) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.2
        if toxic:
            bad = rng.choice(insults)
            if rng.random() < 0.25:
                at = rng.randrange(1, len(bad) - 1)
                bad = bad[:at] + bad[at + 1 :]
            words.insert(rng.randrange(len(words)), bad + rng.choice(("", ".", "!")))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out_accuracy_and_blindness(planted):
    docs, labels = planted
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i, r in got.items() if r.held_out} == set(held)
    assert sum(got[i].predicted == truth[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {r.doc_id: r.score for r in toxicity.toxicity(docs, flipped).collect()} == {i: r.score for i, r in got.items()}


def test_a_group_of_copies_does_not_fill_the_lexicon(spark):
    """Copies of one toxic text speak once: its everyday words are no terms, and rarer terms of other texts are found."""
    rng = random.Random(3)
    common = ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(200)]
    once = ["once" + w for w in common]  # words that the copied text alone holds
    rows = [(i, " ".join(once)) for i in range(400)]
    rows += [(400 + i, " ".join([*rng.sample(common, 12), "muckworm" if i % 6 == 0 else "meadow"])) for i in range(600)]
    labels = [(i, int(i < 400 or i % 6 == 4)) for i, _ in rows]  # 400 % 6 is 4
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    known = docs.join(marks, "doc_id").select(F.col("doc_id").alias("label_id"), F.col("text").alias("body"), "toxic")
    stems, words, _ = toxicity._lexicon(toxicity._one_of_copies(known).select("body", "toxic"))
    assert words == ["muckworm"] and all("muckworm".startswith(s) for s in stems)


def test_many_and_long_terms(spark):
    """No number of terms is too large, none is too long, and all hits of a text count."""
    terms = [f"q{i:04d}zz" + "x" * (60 if i % 2 else 0) for i in range(2500)]
    rows = [(i, " ".join(terms[(i % 50) * 50 : (i % 50 + 1) * 50])) for i in range(400)]
    rows = [(i, t + f" no{i}") for i, t in rows] + [(1000 + i, f"calm words of {i}") for i in range(2400)]
    train = spark.createDataFrame([(t, int(i < 1000)) for i, t in rows], "body string, toxic int")
    stems, words, counts = toxicity._lexicon(train)
    assert set(terms) <= set(words)
    assert toxicity.Matcher(toxicity.Model(stems, words)).counts(" ".join(terms)) == (12, 0, 0, 0)
