import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from brute import best_fit_decreasing
from callpulse.llm import packing
from callpulse.llm.queries import packed_pieces

OTHER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ENCODE = packing.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def ids_of(text):
    return OTHER.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def pieces_of(text):
    ids = ids_of(text)
    cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
    return [(k, a, ids[a:b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_ids_are_those_of_tokenizers(text):
    assert ENCODE(text).tolist() == OTHER.encode(text, add_special_tokens=False).ids


def test_ids_of_the_corpus_and_of_odd_texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    odd = ["<|endoftext|> a", " " * 5000, "a" * 5000, "\n \n\t x", "don't I'LL", "　 x", "é" * 999]
    for text in [r[0] for r in rows] + odd:
        assert ENCODE(text).tolist() == OTHER.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("blank", [" ", "\t", "\n", "\r\n", " \n"])
def test_very_long_runs_of_blanks(spark, blank):
    text = "a" + blank * (1_000_000 // len(blank)) + "b <|endoftext|>"
    found = packing.tokenized(spark.createDataFrame([(1, text), (2, "c")], "doc_id long, text string")).collect()
    pieces = sorted((r.piece, r.start, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in found if r.doc_id == 1)
    assert pieces == pieces_of(text) and len([r for r in found if r.doc_id == 2]) == 1


def test_added_tokens_are_those_of_the_vocabulary(spark):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    r = random.Random(9)
    parts = ["<|endoftext|>", "<|endof", "text|>", "<|", " ", "  ", "\n", "a", "é", "don't", "12", "日"]
    texts = ["a <|endoftext|> b"] + ["".join(r.choices(parts, k=r.randint(1, 12))) for _ in range(500)]
    found = packing.tokenized(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    ids = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in found.collect()}
    assert ids[0] == [64, 220, 50256, 275, packing.END_ID]
    for k, text in enumerate(texts):
        assert ids[k] == [*plain.encode(text, add_special_tokens=False).ids, packing.END_ID]


@pytest.mark.parametrize("capacity", [8, 20, 64, 1024])
def test_the_plan_is_best_fit_decreasing(capacity):
    r = random.Random(capacity)
    for _ in range(60):
        lengths = [
            r.randint(1, capacity) if r.random() < 0.7 else r.choice([1, capacity // 2, capacity])
            for _ in range(r.randint(0, 200))
        ]
        counts = {n: lengths.count(n) for n in set(lengths)}
        bins = {}
        for length, _, first, number, each, offset in packing.plan(counts, capacity).tolist():
            for k in range(number * each):
                bins.setdefault(first + k // each, []).append((offset + k % each * length, length))
        for own in bins.values():
            ends = [0]
            for offset, length in sorted(own):
                assert offset == ends[-1]
                ends.append(offset + length)
        left = sorted(capacity - sum(n for _, n in own) for own in bins.values())
        assert left == best_fit_decreasing(lengths, capacity)
        assert sum(map(len, bins.values())) == len(lengths)


def test_the_plan_does_not_grow_with_the_documents():
    few = {n: 1 + n % 7 for n in range(1, 1025)}
    many = {n: 10**9 + n % 7 for n in range(1, 1025)}
    assert len(packing.plan(many)) < 10_000 > len(packing.plan(few))


TEXTS = [None, "", "a", "hello world " * 700, "x y " * 2000, "short text", "short text", "é" * 300]


def test_pieces_and_places(spark):
    rows = [(k if k != 2 else None, t, k) for k, t in enumerate(TEXTS)]
    rows += [(100 + k, "word " * (k * 13 % 900), 0) for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, offset long")
    found = packed_pieces(df).collect()
    expected = sorted(
        (str(i), p, a, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for i, t, _ in rows
        for p, a, ids in pieces_of(t)
    )
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 1024
    lengths = [e[3] for e in expected]
    assert len(sequences) == len(best_fit_decreasing(lengths, 1024))


def test_sequences_hold_the_pieces_ids(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS) if k != 3]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    packed = packing.pack(packing.tokenized(df))
    found = packing.sequences(packed).collect()
    again = {}
    for s in found:
        ids = np.frombuffer(bytes(s.ids), "<u4").tolist()
        for doc, a, b in zip(s.doc_ids, s.offsets, [*s.offsets[1:], len(ids)]):
            again.setdefault(doc, []).append(ids[a:b])
    for k, t in rows:
        assert sorted(again[k]) == sorted(ids for _, _, ids in pieces_of(t))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packed_pieces(df).count() == 0


def test_columns_of_any_name_are_kept(spark):
    df = spark.createDataFrame([(5, 1, 2, 3, 4, "r")], "length long, salt int, nth int, rank int, base int, row string")
    assert packing.pack(df).first().asDict() == {
        "length": 5, "salt": 1, "nth": 2, "rank": 3, "base": 4, "row": "r", "sequence_id": 0, "offset": 0,
    }
