"""Host-level quality rules: failures per host, shrunk to what hosts have in common, and joined back to documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.binding import let, with_costly
from evenkeel.llm.common import WORD, settle, words

MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
WINDOW = 3
SYMBOLS = r"[#*$%&|<>]"
#: Rules beside the base ones: what a document may have at most.
SYMBOLS_PER_WORD = 0.2
MARKS_PER_WORD = 0.2
DUPLICATE_LINES = 0.5
#: A host goes when the shrunk share of its documents that fail one of the rules is above this.
HOST_LIMIT = 0.5
RULES = ("short", "repetitive", "symbols", "marks", "lines")


def _windows(found: Column, n: Column) -> Column:
    """A hash for each run of three words; no boundary between words is lost, as each word is hashed by itself."""
    def pairs(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))

    def of(h: Column) -> Column:
        return F.slice(pairs(pairs(h, F.slice(h, F.lit(2), n)), F.slice(h, F.lit(3), n)), F.lit(1), n - (WINDOW - 1))

    return let(F.transform(found, lambda w: F.xxhash64(w)), of)


def _covered(hashes: Column, n: Column) -> Column:
    """How many words lie in windows that occur twice or more.

    Windows are sorted as one bigint each, the upper bits of the hash over the place in the text, which puts
    equal ones side by side; those are compared by the whole hash.
    """
    mask = F.expr("shiftleft(1L, cast(ceil(log2(n_words + 1)) as int)) - 1L")

    def repeated(m: Column, h: Column) -> Column:
        packed = F.transform(h, lambda x, i: x.bitwiseAND(F.bitwise_not(m)).bitwiseOR(i.cast("bigint")))

        def pick(s: Column) -> Column:
            def same(v: Column, at: Column) -> Column:
                other = F.get(s, at)
                return (v.bitwiseAND(F.bitwise_not(m)) == other.bitwiseAND(F.bitwise_not(m))) & (
                    F.get(h, v.bitwiseAND(m).cast("int")) == F.get(h, other.bitwiseAND(m).cast("int"))
                )

            twice = F.filter(s, lambda v, k: F.coalesce(same(v, k - 1), F.lit(False)) | F.coalesce(same(v, k + 1), F.lit(False)))
            return F.sort_array(F.transform(twice, lambda v: v.bitwiseAND(m)))

        return let(F.sort_array(packed), pick)

    def count(places: Column) -> Column:
        steps = F.transform(places, lambda x, k: F.least(F.coalesce(F.get(places, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    return let(mask, lambda m: let(repeated(m, hashes), count))


def measures(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Counts of every whole text, and which rules it fails; a null text has no words."""
    base = docs.select(
        F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"),
        F.coalesce(F.col(text_col), F.lit("")).alias("body"),
    )
    found = with_costly(base, found=words(F.col("body"))).withColumn("n_words", F.size("found").cast("bigint"))
    n = F.col("n_words").cast("int")
    lines = F.filter(F.split("body", "\n"), lambda line: line.rlike(WORD))
    hashed = with_costly(
        found,
        hashes=F.when(n >= WINDOW, _windows(F.col("found"), n)),
        lined=let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("again"))),
    )
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    counted = with_costly(
        hashed,
        word_chars=F.length(F.array_join("found", "")).cast("bigint"),
        n_symbols=F.regexp_count("body", F.lit(SYMBOLS)).cast("bigint"),
        n_marks=F.regexp_count("body", F.lit("!")),
        n_repeat_words=F.when(repeats, _covered(F.col("hashes"), n)).otherwise(F.lit(0)).cast("bigint"),
    ).select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", F.col("lined.again").cast("bigint").alias("n_dup_lines"),
        "n_repeat_words", F.col("lined.n").alias("n_lines"), "n_marks",
    )
    short = F.col("n_words") < MIN_WORDS
    repetitive = 100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    return counted.select(
        "*",
        (short | repetitive).alias("base_failed"),
        short.alias("short"),
        repetitive.alias("repetitive"),
        (F.col("n_symbols") > SYMBOLS_PER_WORD * F.col("n_words")).alias("symbols"),
        (F.col("n_marks") > MARKS_PER_WORD * F.col("n_words")).alias("marks"),
        (F.col("n_dup_lines") > DUPLICATE_LINES * F.col("n_lines")).alias("lines"),
    )


def host_rates(measured: DataFrame) -> DataFrame:
    """``host, rule, n, failed, rate``: the share of failures, shrunk by a beta prior fitted to all hosts.

    The prior of a rule has the mean and variance of the hosts' shares (method of moments); where the shares vary less
    than a beta allows for, or there is one host only, every host counts as one of many alike and gets the common share.
    """
    per_host = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(r).cast("bigint")).alias(r) for r in RULES]
    )
    long = per_host.select("host", "n", F.expr(f"stack({len(RULES)}, {', '.join(f'{r!r}, {r}' for r in RULES)}) as (rule, failed)"))
    share = F.col("failed") / F.col("n")
    prior = long.groupBy("rule").agg(
        (F.sum("failed") / F.sum("n")).alias("mean"), F.var_pop(share).alias("var"), F.count(F.lit(1)).alias("hosts")
    )
    mean, var = F.col("mean"), F.col("var")
    weight = F.when((var > 0) & (F.col("hosts") > 1), F.greatest(mean * (1 - mean) / var - 1, F.lit(0.0)))
    rate = F.coalesce((F.col("failed") + mean * weight) / (F.col("n") + weight), mean)
    return long.join(F.broadcast(prior), "rule").select("host", "rule", "n", "failed", rate.alias("rate"))


def host_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limit: float = HOST_LIMIT,
) -> DataFrame:
    """One row per document: its counts, ``base_failed``, ``host_rate`` (the worst rule's shrunk rate) and ``kept``.

    Kept is false for a document that fails a base rule, that fails a rule of its own (symbols, exclamation marks, repeated lines), or whose
    host fails: its shrunk rate for some rule is above ``limit``. Null and empty texts have no words and fail. Documents
    without a host form one host. Rows with the same id are judged one by one, a null id stays null. Other columns,
    whatever their names, are not read. An empty table gives no rows. Hosts are summed up before they are shuffled, so a
    host with a third of all documents is one row per task, and come back as one row per host.
    """
    measured = measures(docs, id_col, text_col, host_col)
    measured = settle(measured)
    worst = host_rates(measured).groupBy("host").agg(F.max("rate").alias("host_rate"))
    joined = measured.join(worst.withColumnRenamed("host", "of_host"), F.col("host").eqNullSafe(F.col("of_host")))
    own = F.col("symbols") | F.col("marks") | F.col("lines")
    return joined.withColumn("kept", ~F.col("base_failed") & ~own & (F.col("host_rate") <= limit)).drop("of_host", "n_lines", "n_marks")
