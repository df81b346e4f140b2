"""Cleaning and rules on awkward strings, against texts written by hand and Unicode categories."""

import itertools
import re
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evenkeel.functions.text import (
    clean_text,
    flag_class,
    keyword_class,
    ngrams,
    normalize_text,
    term_counts,
    words,
)

TEXTS = [
    None,
    "",
    " ",
    "#ERROR! hello #NAME? there",
    "#NAME?#ERROR!",
    "tab\there\vand\x1cthere\x85end",
    "no break em　wide   line",
    "Café ÀÉÎ naïve Straße",
    "नमस्ते दुनिया कि",
    "don't STOP?! now... (really) [ok] a_b 42",
    "null",
    "NA",
    "  lead and trail  ",
    "emoji 😀 and zero​width",
    "line\r\nbreak\n\nend",
    "x" * 40_000 + " tail",
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")


def collect(df, col):
    return [r[0] for r in df.orderBy("id").select(col).collect()]


# what the texts above become, written by hand
NORMAL = [
    "", "", "", "hello there", "", "tab here and there end", "no break em wide line", "Café ÀÉÎ naïve Straße", "नमस्ते दुनिया कि",
    "don't STOP?! now... (really) [ok] a_b 42", "null", "NA", "lead and trail", "emoji 😀 and zero\u200bwidth", "line break end",
    "x" * 40_000 + " tail",
]
CLEANED = [
    "", "", "", "error! hello name? there", "name? error!", "tab here and there end", "no break em wide line",
    "café àéî naïve straße", "\u0928\u092e\u0938 \u0924 \u0926 \u0928 \u092f \u0915", "don't stop?! now really ok a_b 42", "null", "na",
    "lead and trail", "emoji and zero width", "line break end", "x" * 40_000 + " tail",
]


def in_word(char):
    """Letters and numbers of any script, and the low line."""
    return unicodedata.category(char)[0] in "LN" or char == "_"


def is_space(char):
    """Separators of any kind, and the control characters that part words or lines."""
    return unicodedata.category(char)[0] == "Z" or char in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85"


def parted(text, keep):
    """The stretches of characters that are kept."""
    return ["".join(run) for kept, run in itertools.groupby(text, keep) if kept]


def test_normalize(texts):
    assert collect(texts, normalize_text(F.col("t"))) == NORMAL
    assert collect(texts, normalize_text(F.col("t"), lower=True)) == [t.lower() for t in NORMAL]


def test_clean(texts):
    assert collect(texts, clean_text(F.col("t"))) == CLEANED


def test_every_settled_character(spark):
    """All characters of Unicode 3.2, which Python and every JVM agree on."""
    known = [c for c in range(1, 0x110000) if unicodedata.ucd_3_2_0.category(chr(c)) not in ("Cn", "Cs")]
    raw = [f"Aa{chr(c)}bB {chr(c)}" for c in known]
    df = spark.createDataFrame(pa.table({"id": known, "t": raw})).repartition(8)
    rows = df.select(
        "t", clean_text(F.col("t")).alias("c"), normalize_text(F.col("t"), True).alias("n"), words(F.col("t")).alias("w")
    )
    for t, cleaned, normal, found in rows.toArrow().to_pandas().itertuples(index=False):
        assert cleaned == " ".join(parted(t, lambda c: in_word(c) or c in "?!'")).lower()
        assert normal == " ".join(parted(t.lower(), lambda c: not is_space(c)))
        assert list(found) == [w for w in parted(t.lower(), in_word) if len(w) > 1]


def test_words_and_grams(texts):
    def grams(text):
        w = [x for x in parted((text or "").lower(), in_word) if len(x) > 1]
        return [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    assert collect(texts, ngrams(words(F.col("t")), 1, 3)) == [grams(t) for t in TEXTS]


def test_term_counts(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, ["z"])], "id int, g array<string>")
    got = {r.id: [tuple(x) for x in r.t] for r in df.select("id", term_counts(F.col("g")).alias("t")).collect()}
    assert got == {1: [("a", 1), ("b", 2)], 2: [], 3: [("z", 1)]}


def test_keyword_priority_and_folding(spark):
    rules = ((5, "alpha|two words"), (4, "beta"), (3, "gamma"))
    rows = ["nothing", "GAMMA", "gamma beta", "beta alpha", "xxbetaxx", "Two Words", "betİ", "", None, "KK gamma"]
    df = spark.createDataFrame(list(enumerate(rows)), "id int, t string")
    assert collect(df, keyword_class(F.col("t"), rules)) == [None, 3, 4, 5, 4, 5, None, None, None, 3]
    kelvin = spark.createDataFrame([(0, "Kill")], "id int, t string")
    assert collect(kelvin, keyword_class(F.col("t"), ((4, "kill"),))) == [4]


def test_keyword_class_computes_its_text_once(spark):
    rules = ((5, "kiss|skis"), (4, "Ki ss|x.z"), (3, "sI"))
    rows = ["ſkiß KISS", "Kiſs", "SKıS", "İ kİss", "xyz", "ﬁ straße sı", "Ki ss", "é si", "", None, "Σίσυφος"]
    df = spark.createDataFrame(list(enumerate(rows)), "id int, t string")
    slow = [next((n for n, p in rules if contains(t, p)), None) for t in rows]
    assert collect(df, keyword_class(F.col("t"), rules)) == slow
    plan = df.select(keyword_class(clean_text(F.col("t")), rules).alias("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 2


def contains(text, pattern):
    fold = str.maketrans("İıſK", "iisk")
    return text is not None and re.search(pattern, text.translate(fold), re.I | re.A) is not None


def test_flag_class(spark):
    rows = [(i, threat, hate, text) for i, (threat, hate, text) in enumerate(
        [(1, 0, "key"), (1, 1, "key"), (0, 1, "has KEY"), (0, 1, "plain"), (0, 0, "key")]
    )]
    df = spark.createDataFrame(rows, "id int, threat int, hate int, t string")
    got = collect(df, flag_class(F.col("t"), F.col("threat"), F.col("hate"), "key"))
    assert got == [4, 4, 5, 3, None]


def test_row_functions_run_on_streams(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame([(1, "Hello,  GAMMA"), (2, "nothing")], "id int, t string")
    df.write.parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    out = stream.select("id", clean_text(F.col("t")).alias("t"), keyword_class(F.col("t"), ((3, "gamma"),)).alias("label"))
    q = out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(sink)
    assert q.awaitTermination(60)
    got = sorted(tuple(r) for r in spark.read.parquet(sink).collect())
    assert got == [(1, "hello gamma", 3), (2, "nothing", None)]
