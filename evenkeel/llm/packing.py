"""Concatenate and cut: tokens of all documents end to end, cut into sequences of one length.

The first pass turns texts into token ids and writes them with their place in the partition. The totals of the
partitions, one small row each, are summed up to offsets. The second pass adds the two and cuts at every multiple
of the sequence length, so a sequence may begin in one partition and end in the next and no row is moved for it.
"""

from __future__ import annotations

import base64
import json
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import worker_cache, written

LENGTH = 1024
END = 0
#: Token ids of a document that one row of the first pass holds at most.
RUN = 1 << 20
#: Entries of a worker's table of known chunks; a full table is emptied, which changes no result.
KNOWN = 100_000
#: Chunks of more characters are not kept in it.
LONG = 64
BYTES_AT_ONCE = 1 << 24
ODD_SPACE = re.compile(r" (?!\S)")


def _tokenizer(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def added_tokens(path: str | None = None) -> dict[str, int]:
    """What a tokenizer file, by default the public one, adds to its vocabulary: each literal with its id.

    The file's tokenizer cuts a text at these literals, the longest first, before it encodes what is between them.
    """
    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        listed = json.load(file)["added_tokens"]
    for token in listed:
        if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
            raise ValueError(f"added token {token['content']!r} is not a plain literal")
    return {token["content"]: token["id"] for token in listed}


class Encoder:
    """Byte-level BPE of whole texts, with a table of the chunks seen before.

    Literals in ``added`` have one id, and a text is cut at them first.
    The tokenizer first cuts a text into pieces and no token crosses a cut. A single space before a visible character
    always starts a piece, so the ids of a text are those of its chunks between such spaces, end to end. A text with
    any other run of white space around a space is encoded as one chunk.
    """

    def __init__(self, path: str, added: dict[str, int] | None = None):
        self.added = {literal: array("I", [i]).tobytes() for literal, i in (added or {}).items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        kept = worker_cache("packing")
        self.made = kept.setdefault(("tokenizer", path), None) or _tokenizer(path)
        kept[("tokenizer", path)] = self.made
        self.known: dict[str, bytes] = kept.setdefault(("chunks", path), {})

    def encode(self, text: str) -> bytes:
        """The ids as unsigned 32-bit numbers in the byte order of the machine (little-endian on all that run here)."""
        if self.cut is not None and any(literal in text for literal in self.added):
            parts = self.cut.split(text)
            return b"".join(self.added[p] if i % 2 else self._plain(p) for i, p in enumerate(parts) if p)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if ODD_SPACE.search(text):
            return array("I", self.made.encode_ordinary(text)).tobytes()
        first, *rest = text.split(" ")
        get = self.known.get
        out = [get(c) for c in rest]
        if None in out:
            if len(self.known) > KNOWN:
                self.known.clear()
            for i, ids in enumerate(out):
                if ids is None:
                    chunk = rest[i]
                    out[i] = ids = array("I", self.made.encode_ordinary(" " + chunk)).tobytes()
                    if len(chunk) <= LONG:
                        self.known[chunk] = ids
        return array("I", self.made.encode_ordinary(first)).tobytes() + b"".join(out)


def _encoded(
    docs: DataFrame, id_col: str, text_col: str, path: str, end: int, added: dict[str, int] | None
) -> DataFrame:
    """``(part, at, doc_id, start, doc_tokens, ids)``: a document's ids, in runs, with their place in the partition."""
    wanted = docs.select(
        F.spark_partition_id().cast("bigint").alias("part"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("body")
    )
    kind = dict(wanted.dtypes)["doc_id"]
    schema = f"part bigint, at bigint, doc_id {kind}, start bigint, doc_tokens bigint, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, at, tail = Encoder(path, added), 0, array("I", [end]).tobytes()
        for batch in batches:
            rows, held = [], 0
            for part, doc, body in zip(*(batch.column(i) for i in range(3))):
                ids = encoder.encode(body.as_py() or "") + tail
                total = len(ids) // 4
                for s in range(0, total, RUN):
                    rows.append((part.as_py(), at + s, doc.as_py(), s, total, ids[4 * s : 4 * (s + RUN)]))
                at, held = at + total, held + len(ids)
                if held > BYTES_AT_ONCE:
                    yield _batch(rows, batch.column("doc_id").type)
                    rows, held = [], 0
            yield _batch(rows, batch.column("doc_id").type)

    return wanted.mapInArrow(run, schema)


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), id_type, pa.int64(), pa.int64(), pa.binary())
    columns = list(zip(*rows)) or [()] * len(types)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], ["part", "at", "doc_id", "start", "doc_tokens", "ids"]
    )


def _cut(runs: DataFrame, length: int) -> DataFrame:
    """Runs with their global offset ``at`` become pieces that end at multiples of ``length``."""
    n = F.octet_length("ids") / 4
    first = F.floor(F.col("at") / length)
    last = F.floor((F.col("at") + n - 1) / length)
    low = F.greatest(F.col("sequence_id") * length, F.col("at"))
    high = F.least((F.col("sequence_id") + 1) * length, (F.col("at") + n).cast("bigint"))
    skip = F.col("low") - F.col("at")
    return (
        runs.select("*", F.explode(F.sequence(first, last)).alias("sequence_id"))
        .select("*", low.alias("low"), high.alias("high"))
        .select(
            "doc_id",
            (F.col("start") + skip).alias("start"),
            (F.col("high") - F.col("low")).alias("length"),
            F.substring(F.col("ids"), (skip * 4 + 1).cast("int"), ((F.col("high") - F.col("low")) * 4).cast("int"))
            .alias("ids"),
            "doc_tokens",
            "sequence_id",
            (F.col("low") - F.col("sequence_id") * length).alias("offset"),
        )
    )


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, tokenizer: str | None = None,
    end: int = END, added: dict[str, int] | None = None,
) -> DataFrame:
    """One boundary record per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    The ids of each text and then ``end`` follow each other without a gap; every sequence but the last is full. ``ids``
    are little-endian unsigned 32-bit numbers, ``start`` counts the document's ids before the piece, ``offset`` the
    sequence's. A piece never crosses a sequence; a document of over a million ids may have a cut inside a sequence. A
    null or empty text is its ``end`` id alone. A null id stays null; rows with the same id are packed one by one.
    Other columns, whatever their names, are not read. An empty table gives no pieces. ``tokenizer`` is the path of a file
    of byte-level ranks, by default the public one of 50,257 ids. With ``added_tokens`` of the tokenizer file of the same
    vocabulary as ``added`` the ids are those of that file, which the tests check; without, its literals are plain text.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.tiktoken")
    runs = written(_encoded(docs, id_col, text_col, path, end, added), "packed")
    totals = runs.groupBy("part").agg(F.sum(F.octet_length("ids") / 4).cast("bigint").alias("n"))
    # one row of two numbers per partition of the first pass: bounded by the number of its tasks
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = runs.join(F.broadcast(offsets), "part").withColumn("at", F.col("at") + F.col("base"))
    return _cut(placed, length)
