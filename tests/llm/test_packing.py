import array

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from evenkeel.llm import packing

ODD = [
    "", " ", "  ", "a  b", "a   b c", "a \n b", "a\n b", "a\n\n b", " a", "a ", "a\tb c", "a  b", "x　y z", "it's we'll  don't",
    "<|endoftext|> a<|endoftext|>", "ünï 漢字 😀 b\x00c", "1 22 333 4.5", "\r\n a b", "a\x85 b", "a\x1c b c",
]


@pytest.fixture(scope="module")
def plain():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return lambda text: made.encode(text or "", add_special_tokens=False).ids + [0]


def test_chunks_give_the_ids_of_the_whole_text(plain, monkeypatch):
    monkeypatch.setattr(packing, "KNOWN", 3)
    encoder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for text in ODD * 2:
        assert list(array.array("I", encoder.encode(text))) == plain(text)[:-1], repr(text)


@pytest.mark.parametrize(("length", "run"), [(1024, 1 << 20), (16, 50)])
def test_round_trip(spark, sf_dir, plain, monkeypatch, length, run):
    monkeypatch.setattr(packing, "RUN", run)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).select("doc_id", "text")
    more = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate([*ODD, None])], "doc_id bigint, text string")
    docs = docs.unionByName(more).repartition(4).cache()
    want = {r.doc_id: plain(r.text) for r in docs.collect()}
    rows = packing.pack(docs, length=length).collect()
    docs_seen, sequences = {}, {}
    for r in rows:
        ids = list(array.array("I", bytes(r.ids)))
        assert len(ids) == r.length > 0 and r.doc_tokens == len(want[r.doc_id])
        docs_seen.setdefault(r.doc_id, {})[r.start] = ids
        sequences.setdefault(r.sequence_id, {})[r.offset] = r.length
    for doc, pieces in docs_seen.items():
        assert [x for s in sorted(pieces) for x in pieces[s]] == want[doc]
    assert docs_seen.keys() == want.keys() and sorted(sequences) == list(range(len(sequences)))
    for number, pieces in sequences.items():
        end = 0
        for offset in sorted(pieces):
            assert offset == end
            end += pieces[offset]
        assert end == length or number == len(sequences) - 1


def test_literals_of_the_tokenizer_file(spark, tmp_path):
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [*ODD, end, f"a {end} b", f"{end}{end}x", f"a  {end}  b", f"{end} ", "<|endoftext| >", f"x<|{end}|> it's"]
    want = {i: made.encode(text, add_special_tokens=False).ids + [0] for i, text in enumerate(texts)}
    encoder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), packing.added_tokens())
    for i, text in enumerate(texts):
        assert list(array.array("I", encoder.encode(text))) == want[i][:-1], repr(text)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {}
    for r in corpus_pipeline.pack_sequences(spark, docs, str(tmp_path)).collect():
        got.setdefault(r.doc_id, {})[r.start] = list(array.array("I", bytes(r.ids)))
    assert {i: [x for s in sorted(pieces) for x in pieces[s]] for i, pieces in got.items()} == want
