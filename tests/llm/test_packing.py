import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from batchgate.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
_TOKENIZER = Tokenizer.from_file(PATH)
ODD = [None, "", "  \n", "one", "One, two. THREE!! <|endoftext|> <|ENDOFTEXT|>", "don't stop 'til 3.5",
       "été́ ﬁne x y", "same", "same", "word " * 5000, "x" * 9000]


def expected(text, tokenizer):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def check(packed, texts, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    rows = packed.collect()
    for key, text in texts:
        ids = expected(text, tokenizer)
        own = sorted((r for r in rows if r.doc_id == key), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // capacity)))
        for r in own:
            part = ids[r.start:r.start + r.length]
            assert r.start == r.piece * capacity and len(part) == r.length
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for contents in bins.values():
        at = 0
        for offset, length in sorted(contents):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


@pytest.mark.parametrize("capacity", [7, 2048])
def test_pieces_and_sequences(spark, capacity):
    texts = list(enumerate(ODD))
    frame = spark.createDataFrame([(k, t, "x") for k, t in texts],
                                  "doc_id long, text string, piece string").repartition(3)
    check(packing.op1_best_fit_packing(frame, capacity=capacity), texts, capacity)


def test_whole_table_is_packed_tightly(spark, tables):
    docs = tables("documents")
    frame = spark.createDataFrame(docs[["doc_id", "text"]])
    bins = check(packing.op1_best_fit_packing(frame), list(zip(docs.doc_id, docs.text)), 2048)
    total = sum(n for b in bins.values() for _, n in b)
    assert len(bins) <= 1.02 * -(-total // 2048) + 1


def test_repeated_rows_and_null_ids_are_packed_each(spark):
    frame = spark.createDataFrame([(None, "a b"), (None, "a b"), (4, "c"), (4, "c")],
                                  "doc_id long, text string")
    rows = packing.op1_best_fit_packing(frame, capacity=8).collect()
    assert len(rows) == 4 and sum(r.length for r in rows) == 10
    assert len({(r.sequence_id, r.offset) for r in rows}) == 4


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert packing.op1_best_fit_packing(frame).count() == 0


def test_sequences_hold_the_ids(spark):
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(ODD)], "doc_id long, text string")
    cut = packing.staged(packing.pieces(frame, PATH, 16, with_ids=True))
    rows = packing.sequences(packing.pack(cut, 16)).collect()
    tokenizer = Tokenizer.from_file(PATH)
    assert sorted(i for r in rows for i in r.input_ids) == sorted(
        i for t in ODD for i in expected(t, tokenizer))
    assert max(len(r.input_ids) for r in rows) <= 16


@given(st.dictionaries(st.integers(1, 60), st.integers(1, 400), max_size=40))
@settings(max_examples=40, deadline=None)
def test_solution_holds_exactly_the_histogram(histogram):
    got = {}
    sequences = 0
    for contents, times in packing.solve(histogram, 60):
        assert times > 0 and sum(n * c for n, c in contents) <= 60
        sequences += times
        for n, c in contents:
            got[n] = got.get(n, 0) + c * times
    assert got == histogram
    plain = sum(t for _, t in packing._best_fit([], histogram, 60))
    assert sequences <= 1.05 * plain + 2


def test_solution_is_no_worse_than_best_fit():
    histogram = {17: 154, 11: 1, 22: 60, 5: 145}
    packed, plain = packing.solve(histogram, 60), packing._best_fit([], histogram, 60)
    assert sum(t for _, t in packed) <= sum(t for _, t in plain)


WORDS = st.text(st.sampled_from(
    "abstrevlmdABST019²½'’.,%&-_<|>~\"éÉßñÿÀÞ×÷ªºµ́\xa0\xad界ЖѪǅİẞﬁ"), min_size=1, max_size=9)


@given(st.lists(st.one_of(WORDS, st.sampled_from(
    ["don't", "we'll", "x''s", "<|endoftext|>", "a<|startoftext|>b", "<|ENDOFTEXT|>"])),
    max_size=12))
@settings(max_examples=300, deadline=None)
def test_words_have_the_tokenizers_ids(words):
    encoder, tokenizer = packing.WordEncoder.__new__(packing.WordEncoder), _TOKENIZER
    encoder.tokenizer, encoder.merged = tokenizer, tokenizer.model.tokenize
    encoder.stop = tokenizer.token_to_id("<|startoftext|>")
    encoder.clear()
    texts = [" ".join(words), " \n".join(reversed(words)), *words[:3]]
    for _ in range(2):  # unknown words, then known ones
        ids, ends = encoder.encode(pa.array(texts, pa.string()))
        got = [part.tolist() for part in np.split(ids, ends)[:len(texts)]]
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_plain_words_are_merged_by_the_model_alone(monkeypatch):
    """Not by the whole tokenizer, which takes several times as long a word and a copy of it."""
    encoder = packing.WordEncoder(PATH)

    class Whole:
        def encode(self, *_, **__):
            raise AssertionError("the whole tokenizer")

    monkeypatch.setattr(encoder, "tokenizer", Whole())
    text = "One two, don't: l'été 3.5% ÀÉ x-y straße ~_~ 'tis"
    ids, _ = encoder.encode(pa.array([text]))
    assert ids.tolist() == _TOKENIZER.encode(text, add_special_tokens=False).ids


def test_parts_leave_no_memory_behind(monkeypatch, spark):
    """A worker's memory is given back after each part, not at the end of its task only."""
    monkeypatch.setattr(packing, "PART_BYTES", 100)
    calls, taken = [], []
    monkeypatch.setattr(packing, "give_back", lambda: calls.append(1))

    class Source:
        schema = {"doc_id": type("Field", (), {"dataType": type(
            "Type", (), {"simpleString": staticmethod(lambda: "bigint")})})}

        def mapInArrow(self, run, schema):
            texts = [f"word{k} " * 30 for k in range(6)]
            batch = pa.RecordBatch.from_pydict({
                "doc_id": pa.array(range(6), pa.int64()), "text": pa.array(texts),
                "task": pa.array([0] * 6, pa.int32())})
            taken.extend(run(iter([batch])))

    class Docs:
        def select(self, *columns):
            return Source()

    packing.pieces(Docs(), PATH)
    assert len(taken) > 1 and len(calls) == len(taken)
