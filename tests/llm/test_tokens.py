"""Tokenizers, packing and training order: exact against the library, round trips, brute-force checks of places."""

from __future__ import annotations

import collections
import json
import random
import zlib
from bisect import bisect_left, insort

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cdclake.llm.bpe import WordBPE, encode_decode
from cdclake.llm.common import slices
from cdclake.llm.packing import pack_best_fit, plan
from cdclake.llm.tokens import ByteBPE, token_pieces
from cdclake.llm.training_order import permute, read_slots, write_shards
from cdclake.sources.shared import new_path

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
word_whole, byte_whole = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
word, byte = WordBPE(WORD, long=20, leaf=3, cache=200), ByteBPE(BYTE)
odd_text = st.text(alphabet=st.one_of(st.sampled_from("abcdeinorst  \n\t.,!'’|<>\x0b\x85\xa0　ẞßİΣςéèñ́²½日本"), st.characters(codec="utf-8")), max_size=120)
DOCS = [(1, "Hello, world! It's."), (2, None), (3, ""), (None, "a" * 5000), (4, "<|endoftext|> x"), (4, "<|endoftext|> x"), (5, "word " * 3000), (6, " \n ")]


def docs_of(spark, rows=DOCS):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, ids int, piece string")


@settings(max_examples=200, deadline=None)
@given(odd_text)
def test_encoders_equal_the_library(text):
    for t in (text, text.replace(" ", ""), text * 5):
        expected = word_whole.encode(t, add_special_tokens=False).ids
        ids, decoded = word.encode_texts(pa.array([None, t, "", t]))
        assert ids.to_pylist() == [[], expected, [], expected]
        assert decoded.to_pylist()[1:] == [word_whole.decode(expected, skip_special_tokens=False), "", decoded.to_pylist()[1]]
        assert np.frombuffer(byte.encode(t), "<u4").tolist() == byte_whole.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("leaf", [1, 2, 7])
def test_tree_concatenation(leaf):
    tree = WordBPE(WORD, long=1, leaf=leaf)
    draw = random.Random(leaf)
    for _ in range(60):
        text = "".join(draw.choices(["the", "ing", "a", "er", "zq", "tion"], k=draw.randrange(1, 60)))
        assert [tree.names[i] for i in tree.encode_long(text)] == word_whole.encode(text, add_special_tokens=False).tokens


def test_long_chunks_go_through_the_tree():
    bpe = WordBPE(WORD)
    texts = ["ab" * 255 + "a", "ab" * 256, "plain words, no tree", "x" * 5000 + " and " + "y" * 600 + "!!"]
    ids, _ = bpe.encode_texts(pa.array(texts))
    assert bpe.trees == 3
    assert ids.to_pylist() == [word_whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_files_of_other_kinds_are_left_to_the_library(tmp_path):
    spec = json.load(open(WORD, encoding="utf-8"))
    spec["normalizer"]["normalizers"].pop()  # case counts here
    (tmp_path / "other.json").write_text(json.dumps(spec))
    other, library = WordBPE(str(tmp_path / "other.json")), Tokenizer.from_file(str(tmp_path / "other.json"))
    ids, decoded = other.encode_texts(pa.array(["Aa bB.", None]))
    expected = library.encode("Aa bB.", add_special_tokens=False).ids
    assert not other.apart and word.apart and ids.to_pylist() == [expected, []]
    assert decoded.to_pylist() == [library.decode(expected, skip_special_tokens=False), ""]


def test_slices_bound_the_bytes():
    texts = ["a" * n for n in (5, 5, 50, 1, 1, 1)] + [None, "é" * 4]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    assert [b.column(0).to_pylist() for b in slices(batch, 0, 10)] == [texts[:2], texts[2:3], texts[3:7], texts[7:]]


def test_encode_decode(spark):
    out = encode_decode(docs_of(spark), WORD).collect()
    assert len(out) == len(DOCS)
    expected = collections.Counter((i, tuple(e := word_whole.encode(t or "", add_special_tokens=False).ids), word_whole.decode(e, skip_special_tokens=False)) for i, t in DOCS)
    assert collections.Counter((r.doc_id, tuple(r.ids), r.decoded) for r in out) == expected
    assert encode_decode(docs_of(spark, []), WORD).count() == 0


def test_pieces(spark):
    out = token_pieces(docs_of(spark), BYTE, 100, 2).collect()
    by = collections.defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
        assert r.length == len(r.ids) // 4 and (r.length == 100 or r.piece == 0)
    ids = lambda i: [x for r in sorted(by[i], key=lambda r: r.piece) for x in np.frombuffer(r.ids, "<u4").tolist()]
    for i, t in {1: DOCS[0][1], 2: "", None: DOCS[3][1], 5: DOCS[6][1]}.items():
        assert ids(i) == byte_whole.encode(t, add_special_tokens=False).ids + [2]
    assert len(by[4]) == 2


def check_packed(rows, capacity):
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing(spark):
    draw = random.Random(1)
    lengths = [draw.choice([1024, 1024, 7, draw.randrange(1, 1025)]) for _ in range(3000)] + [300] * 2000
    items = spark.createDataFrame([(k % 50, n, 5) for k, n in enumerate(lengths)], "doc_id long, length long, sequence_id int")
    packed = pack_best_fit(items, 1024).collect()
    assert collections.Counter(r.length for r in packed) == collections.Counter(lengths)
    rooms: list[int] = []  # plain best-fit decreasing, item by item
    for n in sorted(lengths, reverse=True):
        at = bisect_left(rooms, n)
        insort(rooms, (rooms.pop(at) if at < len(rooms) else 1024) - n)
    assert check_packed(packed, 1024) == len(rooms)
    assert pack_best_fit(items.limit(0), 1024).count() == 0
    with pytest.raises(ValueError):
        pack_best_fit(items.withColumn("length", F.lit(1025)), 1024)


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), max_size=30))
def test_plan(counts):
    seen = collections.Counter()
    fill = collections.defaultdict(list)
    for length, low, high, each, first, offset in plan(counts, 40):
        seen[length] += high - low
        for rank in range(high - low):
            fill[first + rank // each].append((offset + rank % each * length, length))
    assert seen == collections.Counter(counts)
    for own in fill.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 40


@pytest.mark.parametrize("n", [1, 2, 3, 1000, 4097])
def test_permutation(n):
    slots = permute(np.arange(n), n, 9)
    assert sorted(slots) == list(range(n))
    assert (permute(slots, n, 9, inverse=True) == np.arange(n)).all()


def test_shards(spark, tmp_path):
    out = f"file://{tmp_path}/shards"
    index = write_shards(docs_of(spark), BYTE, out, sequence_ids=64, shard_rows=10, waves=3).collect()
    index.sort(key=lambda r: r.slot)
    assert [r.slot for r in index] == list(range(len(index)))
    read = list(read_slots(spark, out, 0, 10**6, sequence_ids=64, shard_rows=10))
    assert [(len(x), zlib.crc32(x.tobytes())) for x in read] == [(r.length, r.ids_crc32) for r in index]
    some = list(read_slots(spark, out, 15, 12, sequence_ids=64, shard_rows=10))
    assert [x.tobytes() for x in some] == [x.tobytes() for x in read[15:27]]
    assert write_shards(docs_of(spark, []), BYTE, f"{out}-none").count() == 0


def test_shards_can_be_written_again(spark, tmp_path):
    out = f"file://{tmp_path}/shards"
    write_shards(docs_of(spark), BYTE, out, sequence_ids=64, shard_rows=10)
    first = [x.tobytes() for x in read_slots(spark, out, 0, 10**6, sequence_ids=64, shard_rows=10)]
    write_shards(docs_of(spark), BYTE, out, sequence_ids=64, shard_rows=10)
    assert [x.tobytes() for x in read_slots(spark, out, 0, 10**6, sequence_ids=64, shard_rows=10)] == first
    fewer = write_shards(docs_of(spark, DOCS[:3]), BYTE, out, sequence_ids=64, shard_rows=10).count()
    assert len(list(read_slots(spark, out, 0, 10**6, sequence_ids=64, shard_rows=10))) == fewer == 3
    with pytest.raises(ValueError):
        write_shards(docs_of(spark), BYTE, out, sequence_ids=1 << 16)


@pytest.mark.parametrize("char, number", [(" ", 1_000_000), ("\n", 1_000_000), ("\t", 1_000_000), (" ", 5_000_000)])
def test_long_runs_of_white_space(char, number):
    text = "a" + char * number + "b"
    assert byte.encode(text) == np.array(byte_whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_white_space_through_packing_and_order(spark):
    docs = spark.createDataFrame([(1, " " * 1_500_000), (2, "\n" * 2_500_000 + "x"), (3, "plain text")], "doc_id bigint, text string")
    pieces = token_pieces(docs, BYTE, 1024, 2)
    expected = {i: len(byte_whole.encode(t, add_special_tokens=False).ids) + 1 for i, t in docs.collect()}
    assert {r.doc_id: r.n for r in pieces.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()} == expected
    assert pack_best_fit(pieces.select("doc_id", "piece", "start", "length"), 1024).agg(F.sum("length")).first()[0] == sum(expected.values())
    out = write_shards(docs, BYTE, new_path(spark, "white"))
    assert out.count() > 0
