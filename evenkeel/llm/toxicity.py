"""Toxicity by a learned lexicon, a fuzzy automaton for misspelled terms, and the words around a hit.

The lexicon is mined from labelled documents: words, and beginnings of words, that occur in toxic documents and
next to never in others, beyond chance. A trie of the words is walked together with a Levenshtein automaton, made
deterministic step by step as texts ask for it, so a word costs one table lookup per letter. A hit inside quotation
marks or beside a verb of speaking counts as quoted. How much hits of each sort say is fitted on the labelled rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import settle, small_batches, without, worker_cache

#: Labelled rows that the model is learned from at most, those whose ids hash lowest.
LABELLED_ROWS = 200_000
SHORTEST, LONGEST = 4, 8
SUPPORT, PURITY, CHANCE = 3, 0.95, 0.1
THRESHOLD = 0.7
FUZZY_FROM, FUZZY_TWICE_FROM = 4, 9
WINDOW = 6
QUOTES = "\"'«»„“”‘’‹›"
SAYING = frozenset("said says say called calls wrote writes quoted quote word words term dit écrit mot sagte schrieb wort dijo escribió palabra".split())
PUNCTUATION = "\"'«»„“”‘’‹›.,;:!?()[]{}<>*#$%&|-–—_=+/\\~`^"
SORTS = ("exact", "fuzzy", "exact_quoted", "fuzzy_quoted")
#: What a hit says before any label is seen, and how firmly: mean and weight of the fit's prior.
PRIOR, FIRMNESS = {"bias": -2.0, "exact": 2.0, "fuzzy": 1.0, "exact_quoted": 0.2, "fuzzy_quoted": 0.1}, 0.1
_KNOWN_WORDS, _KNOWN_STEPS = 400_000, 200_000
#: Words and characters that a task counts before it hands them on.
_COUNTED_WORDS, _COUNTED_CHARS = 400_000, 1 << 25


def plain_word(raw: str) -> str:
    return raw.strip(PUNCTUATION)


class FuzzyTrie:
    """Accepts the words within one edit of a term (two for long ones): insertion, deletion, change, swap of neighbours.

    A state is the set of places in the trie that can be reached with so many edits; states and steps are made when they
    are first needed.
    """

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.allowed, self.ends = [0], [-1]
        for term in terms:
            edits, node = (2 if len(term) >= FUZZY_TWICE_FROM else 1), 0
            self.allowed[0] = max(self.allowed[0], edits)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.allowed.append(0)
                    self.ends.append(-1)
                node = self.children[node][c]
                self.allowed[node] = max(self.allowed[node], edits)
            self.ends[node] = edits
        self._clear()

    def _clear(self) -> None:
        self.number: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.steps: dict[tuple[int, str], int] = {}
        self.start = self._state({(0, 0, "")})

    def _state(self, places: set) -> int:
        todo, seen = list(places), set(places)
        while todo:  # letters of the term that the word leaves out
            node, edits, waits = todo.pop()
            if waits:
                continue
            for child in self.children[node].values():
                place = (child, edits + 1, "")
                if edits < self.allowed[child] and place not in seen:
                    seen.add(place)
                    todo.append(place)
        key = frozenset(seen)
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
        return self.number[key]

    def _step(self, state: int, c: str) -> int:
        out = set()
        for node, edits, waits in self.states[state]:
            if waits:
                if waits == c:
                    out.add((node, edits, ""))
                continue
            if edits < self.allowed[node]:
                out.add((node, edits + 1, ""))
            for letter, child in self.children[node].items():
                if letter == c:
                    out.add((child, edits, ""))
                elif edits < self.allowed[child]:
                    out.add((child, edits + 1, ""))
                    after = self.children[child].get(c)
                    if after is not None and edits < self.allowed[after]:
                        out.add((after, edits + 1, letter))
        return self._state(out) if out else -1

    def accepts(self, word: str) -> bool:
        if len(self.steps) > _KNOWN_STEPS:
            self._clear()
        at = self.start
        for c in word:
            to = self.steps.get((at, c))
            if to is None:
                to = self.steps[at, c] = self._step(at, c)
            if to < 0:
                return False
            at = to
        return any(not waits and self.ends[node] >= edits for node, edits, waits in self.states[at])


@dataclass
class Model:
    """What is learned; its words are some of those in the labelled rows, and so bounded by their number."""

    stems: list[str] = field(default_factory=list)
    words: list[str] = field(default_factory=list)
    exceptions: list[str] = field(default_factory=list)
    weights: dict[str, float] = field(default_factory=lambda: dict(PRIOR))


class Matcher:
    """Sorts words into none, exact (1) and fuzzy (2) hits, and remembers what it saw."""

    def __init__(self, model: Model):
        self.stems, self.words = frozenset(model.stems), frozenset(model.words)
        self.lengths = sorted({len(s) for s in self.stems})
        self.exceptions = frozenset(model.exceptions)
        self.trie = FuzzyTrie(model.words)
        self.known: dict[str, int] = {}

    def sort(self, raw: str) -> int:
        word = plain_word(raw)
        if word in self.words or any(word[:n] in self.stems for n in self.lengths if len(word) >= n):
            return 1
        if len(word) >= FUZZY_FROM - 1 and word not in self.exceptions and self.trie.accepts(word):
            return 2
        return 0

    def sorts(self, words: list[str]) -> list[int]:
        if len(self.known) > _KNOWN_WORDS:
            self.known.clear()
        get = self.known.get
        out = [get(w) for w in words]
        if None in out:
            for i, s in enumerate(out):
                if s is None:
                    out[i] = s = self.sort(words[i])
                    if len(words[i]) < 40:
                        self.known[words[i]] = s
        return out

    def counts(self, text: str) -> tuple[int, int, int, int]:
        """Hits in a text by sort, on a scale of doublings: 0, 1, 2 for two or three, 3 for four to seven and so on."""
        words = text.lower().split()
        out = [0, 0, 0, 0]
        found = self.sorts(words)
        if any(found):
            for i, s in enumerate(found):
                if s:
                    out[s - 1 + 2 * quoted(words, i)] += 1
        return tuple(n.bit_length() for n in out)


def quoted(words: list[str], at: int) -> bool:
    """Whether the word stands in quotation marks or next to a verb or noun of speaking."""
    before, after = words[max(0, at - WINDOW) : at + 1], words[at : at + WINDOW + 1]
    if any(plain_word(w) in SAYING for w in (*before[:-1][-2:], *after[1:3])):
        return True
    opens = any(w[:1] in QUOTES for w in before if w)
    closes = any(w.rstrip(".,;:!?")[-1:] in QUOTES for w in after if w.rstrip(".,;:!?"))
    return opens and closes


def _held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 3 == 1


def training_labels(labels: DataFrame, id_col: str, label_col: str, rows: int = LABELLED_ROWS) -> DataFrame:
    """``(label_id, toxic)``: one row per labelled id that is not held out, at most ``rows`` of them."""
    one = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~F.coalesce(_held_out(F.col(id_col)), F.lit(True)))
        .groupBy(F.col(id_col).alias("label_id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    )
    drawn = one.orderBy(F.xxhash64("label_id"), "label_id").limit(rows)
    return settle(drawn)


def _word_counts(train: DataFrame) -> DataFrame:
    """``(word, pos, neg)``: toxic and other documents that hold the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, chars = (Counter(), Counter()), 0
        for batch in batches:
            for toxic, body in zip(batch.column("toxic").to_pylist(), batch.column("body")):
                text = (body.as_py() or "").lower()
                seen[toxic > 0].update({p for w in text.split() if len(p := plain_word(w)) >= SHORTEST})
                chars += len(text)
                if len(seen[0]) + len(seen[1]) > _COUNTED_WORDS or chars > _COUNTED_CHARS:
                    yield _counted(seen)
                    seen, chars = (Counter(), Counter()), 0
        yield _counted(seen)

    def _counted(seen) -> pa.RecordBatch:
        words = list(seen[1] | seen[0])
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), *(pa.array([seen[k][w] for w in words], pa.int64()) for k in (1, 0))], ["word", "pos", "neg"]
        )

    made = train.select("toxic", "body").mapInArrow(run, "word string, pos bigint, neg bigint")
    return made.groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _one_of_copies(train: DataFrame) -> DataFrame:
    """``train`` with one id for each text and label, so that a group of copies speaks for its words once.

    The ids are found by the hashes of texts, the texts themselves are not moved. There are at most as many as labelled rows.
    """
    texts = [F.xxhash64("body").alias("h"), F.xxhash64(F.lit(1), "body").alias("g")]
    first = train.select("label_id", "toxic", *texts).groupBy("h", "g", "toxic").agg(F.min("label_id").alias("first"))
    first = settle(first.select("first").distinct())
    return train.join(F.broadcast(first), F.col("label_id") == F.col("first"), "left_semi")


def _surprise(pos: Column, neg: Column, rate: float) -> Column:
    """Lower bound of minus the log of the chance that so many of the documents are toxic by luck."""
    n = pos + neg
    share = pos / n
    other = F.when(neg > 0, neg * F.log((neg / n) / (1 - rate))).otherwise(F.lit(0.0))
    return F.when((pos > 0) & (share > rate), pos * F.log(share / rate) + other).otherwise(F.lit(0.0))


def _lexicon(train: DataFrame) -> tuple[list[str], list[str], DataFrame]:
    """Stems and words that mark toxic documents, and the word counts they come from."""
    sizes = {r["toxic"] > 0: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = settle(_word_counts(train))
    if not sizes.get(True) or not sizes.get(False):
        return [], [], counts
    rate = sizes[True] / (sizes[True] + sizes[False])
    pure = (F.col("pos") >= SUPPORT) & (F.col("pos") >= PURITY * (F.col("pos") + F.col("neg")))
    tests = max(1, counts.count())
    enough = _surprise(F.col("pos"), F.col("neg"), rate) > math.log(tests / CHANCE)
    words = counts.where(pure & enough & (F.length("word") >= FUZZY_FROM))
    words = sorted(r["word"] for r in words.select("word").collect())

    cut = F.explode(F.transform(F.sequence(F.lit(SHORTEST), F.least(F.length("word"), F.lit(LONGEST))), lambda n: F.left(F.col("word"), n)))
    begun = counts.select(cut.alias("stem"), "pos", "neg").groupBy("stem").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    begun = settle(begun.where(pure).select("stem", "neg"))
    # several words of one document may share a beginning: documents are counted anew, over the toxic ones alone

    def stems_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body in batch.column("body"):
                plain = {p for w in (body.as_py() or "").lower().split() if len(p := plain_word(w)) >= SHORTEST}
                out += {p[:n] for p in plain for n in range(SHORTEST, min(len(p), LONGEST) + 1)}
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["stem"])

    in_toxic = train.where("toxic > 0").select("body").mapInArrow(stems_of, "stem string").groupBy("stem").agg(F.count(F.lit(1)).alias("pos"))
    found = in_toxic.join(begun, "stem").where(pure & enough)
    rows = sorted((r["stem"] for r in found.collect()), key=len)
    kept: set[str] = set()
    for stem in rows:  # a longer beginning adds nothing to a shorter one
        if not any(stem[:n] in kept for n in range(SHORTEST, len(stem))):
            kept.add(stem)
    return sorted(kept), words, counts


def _exceptions(counts: DataFrame, stems: list[str], words: list[str]) -> list[str]:
    """Words that are close to a term of the lexicon but occur in clean documents."""
    model = Model(stems, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in batches:
            keep = pa.array([matcher.sort(w) == 2 for w in batch.column("word").to_pylist()], pa.bool_())
            yield batch.filter(keep)

    clean = counts.where((F.col("neg") > 0) & (F.length("word") >= FUZZY_FROM - 1)).select("word", "neg")
    close = clean.mapInArrow(run, "word string, neg bigint")
    return sorted(r["word"] for r in close.select("word").collect())


def _fit(table: list[dict]) -> dict[str, float]:
    """Logistic weights of the counts, by Newton's steps over the table of count patterns.

    Counts are on a scale of doublings, so the patterns are few: a text of a million hits has one of 21 values of a sort.
    """
    import numpy as np

    names = ["bias", *SORTS]
    prior = np.array([PRIOR[n] for n in names])
    w = prior.copy()
    if not table:
        return dict(zip(names, w.tolist()))
    x = np.array([[1.0, *(float(r[s]) for s in SORTS)] for r in table])
    y, n = np.array([float(r["toxic"]) for r in table]), np.array([float(r["n"]) for r in table])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + FIRMNESS * (w - prior)
        bend = (x.T * (n * p * (1 - p))) @ x + FIRMNESS * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w - step / max(1.0, float(np.abs(step).max()))
    return dict(zip(names, w.tolist()))


def _hits(docs: DataFrame, id_col: str, text_col: str, model: Model) -> DataFrame:
    """``doc_id`` and the four counts, per row."""
    wanted = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"))
    kind = dict(wanted.dtypes)["doc_id"]
    key = ("toxicity", hash((tuple(model.stems), tuple(model.words), tuple(model.exceptions))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = worker_cache("toxicity")
        if key not in kept:  # one model at a time
            for old in [k for k in kept if k[0] == "toxicity"]:
                del kept[old]
            kept[key] = Matcher(model)
        matcher = kept[key]
        for batch in batches:
            rows = [matcher.counts(body.as_py() or "") for body in batch.column("body")]
            columns = [pa.array([r[i] for r in rows], pa.int32()) for i in range(len(SORTS))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *SORTS])

    return wanted.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{s} int" for s in SORTS))


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
    label_col: str = "toxic", rows: int = LABELLED_ROWS, threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``; the score is that of its text alone.

    Labels of ids whose crc32 leaves 1 modulo 3 are never looked at. Copies of a text count once in the lexicon. Of repeated labels of an id the largest counts; null
    labels and ids are passed over. Null and empty texts have no hits and the lowest score. Rows with the same id are scored
    one by one; a null id has a null ``held_out``. Other columns, whatever their names, are not read. An empty table
    gives no rows; without labels, or with one sort of them only, the lexicon is empty and all scores are the prior's.
    """
    known = F.broadcast(training_labels(labels, label_id, label_col, rows))  # bounded by ``rows``
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"))
    train = _one_of_copies(texts.join(known, F.col("doc_id") == F.col("label_id"))).select("body", "toxic")
    with small_batches(docs.sparkSession):
        stems, words, counts = _lexicon(train)
        model = Model(stems, words, _exceptions(counts, stems, words) if words else [])
    hits = settle(_hits(docs, id_col, text_col, model))
    table = (
        hits.join(known, F.col("doc_id") == F.col("label_id"))
        .groupBy(*SORTS, (F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count(F.lit(1)).alias("n"))
    )
    weights = _fit([r.asDict() for r in table.collect()])
    odds = F.lit(weights["bias"])
    for s in SORTS:
        odds = odds + F.col(s) * weights[s]
    score = 1 / (1 + F.exp(-odds))
    return hits.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with their own columns, without the ids that have a row predicted toxic; rows without an id stay."""
    bad = toxicity(docs, labels, id_col, text_col, **settings).where("predicted = 1")
    return without(docs, id_col, bad.select("doc_id"))
