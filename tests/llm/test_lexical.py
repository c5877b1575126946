"""Lexical search against brute force, with odd rows."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pytest

import cdclake.llm.lexical as L


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, queries, best=10):
    docs = [(i, collections.Counter(terms(t))) for i, t in docs]
    number, length = sum(1 for _, c in docs if c), sum(c.total() for _, c in docs)
    df = collections.Counter(t for _, c in docs for t in c)
    out = []
    for item, text in queries:
        scores = []
        for i, c in docs:
            m = 25 + 75 * c.total() * number // length if c else 0
            x = sum(math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if x > 0:
                scores.append((-x, i is None, i or 0))
        out += [(item, k + 1, None if none else i, -x) for k, (x, none, i) in enumerate(sorted(scores)[:best])]
    return sorted(out, key=repr)


def cases():
    rng = random.Random(1)
    words = [a + b for a in "abcdefgXYZé1" for b in "xyzQ中0"] + ["The", "of"] * 10
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "-", "\x00"]) for _ in range(n))
    docs = [(k, text(rng.randrange(1, 80))) for k in range(300)]
    docs += [(k, docs[7][1]) for k in range(300, 400)]  # copies tie
    docs += [(400, None), (401, ""), (402, "..."), (None, docs[3][1]), (None, "ax"), (403, "the " * 3000), (5, docs[5][1]), (5, docs[5][1])]
    rng.shuffle(docs)
    queries = [(k, text(rng.randrange(1, 12))) for k in range(25)] + [(25, docs[7][1]), (25, "The THE of"), (26, None), (27, "?"), (None, "ax zz"), (28, "nowhere"), (29, "ax " * 50)]
    return docs, queries


@pytest.mark.parametrize("matrix", [L.MATRIX, 60])
def test_search(spark, monkeypatch, matrix):
    monkeypatch.setattr(L, "MATRIX", matrix)  # 60: a few queries at a time
    monkeypatch.setattr(L, "FIRST", 1)
    docs, queries = cases()
    docs_frame = spark.createDataFrame([(i, t, 3, "x") for i, t in docs], "doc_id bigint, text string, n int, term string").repartition(3)
    queries_frame = spark.createDataFrame([(i, t, 1) for i, t in queries], "item_id bigint, text string, rank int")
    if matrix == 60:
        queries, queries_frame = queries[20:], queries_frame.where("item_id >= 20 or item_id is null")
    got = L.search(L.build(docs_frame), queries_frame).collect()
    assert sorted(map(tuple, got), key=repr) == brute(docs, queries)


def test_small_shards_stop_early_and_exactly(spark, monkeypatch):
    """Shards that are arranged in this process, as small as the visits that the test wants to see."""
    rng = np.random.default_rng(2)
    lists = [np.unique(rng.integers(0, 40, 12) + 40 * (k % 5)) for k in range(400)]  # five topics, mixed
    monkeypatch.setattr(L, "SHARD", 100)
    shards = L.arranged(np.concatenate(lists), np.cumsum([0, *map(len, lists)])[:-1])
    assert sorted(np.concatenate(shards)) == list(range(400)) and max(map(len, shards)) <= 100
    topics = [collections.Counter(k % 5 for k in s).most_common(2) for s in shards]
    assert sum(n for own in topics for _, n in own) > 380  # alike documents lie together


def test_empty_tables(spark):
    docs, queries = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), spark.createDataFrame([("q", "b c")], "item_id string, text string")
    assert L.search(L.build(docs.limit(0)), queries).count() == 0
    assert L.search(L.build(docs), queries.limit(0)).count() == 0
    assert [tuple(r)[:3] for r in L.search(L.build(docs.union(docs.select("doc_id", "text"))), queries).collect()] == [("q", 1, 1), ("q", 2, 1)]


def test_sample_bisection():
    rng = random.Random(4)
    sample = [[b"%d-%d" % (k % 2, rng.randrange(30)) for _ in range(10)] for k in range(200)]
    tree = L.fit(sample)
    leaves = [tree.leaf(collections.Counter(words)) for words in sample]
    first = [leaf >> (L.LEVELS - 1) for leaf in leaves]
    assert abs(sum(first) - 100) <= 20 and len({(k % 2, side) for k, side in enumerate(first)}) <= 4
    assert sum(first[::2]) in range(0, 10) or sum(first[::2]) in range(90, 101)
    assert L.fit([]).leaf(collections.Counter([b"x"])) == 0
