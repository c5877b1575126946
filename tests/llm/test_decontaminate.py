"""Decontamination against brute force, with odd rows."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

import cdclake.llm.decontaminate as D

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def small(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = re.findall(WORD, small(text))
        k = min(len(w), 10)
        for i in range(len(w) - k + 1) if k else ():
            windows.setdefault(tuple(w[i : i + k]), set()).add(item)
    out = []
    for doc, text in docs:
        w = re.findall(WORD, small(text))
        hit, own = set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit |= set(range(i, i + k))
                    own |= {str(x) for x in windows[tuple(w[i : i + k])] if x is not None}
        out.append((doc, len(w), sorted(hit), sorted(own)))
    return sorted(out, key=repr)


def cases():
    rng = random.Random(5)
    words = ["Die", "STRASSE", "\u00c9t\u00e9", "a1", "of", "the", "x", "\u4e2d\u6587", "end", "I"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "--", "\x00", "_"]) for _ in range(n))
    items = [(k, text(rng.choice([3, 10, 11, 30]))) for k in range(20)] + [(20, "zz"), (21, "Zz yy"), (22, None), (23, "..."), (None, "nobody knows"), (24, "same words"), (24, "same words"), (25, "same words")]
    docs = [(k, text(rng.randrange(60)) + str(rng.choice(items)[1]) + text(rng.randrange(5))) for k in range(60)]
    docs += [(1, None), (2, ""), (None, "zz YY"), (None, "nobody knows"), (3, "zz" * 9), (4, "Same words. same WORDS"), (4, "Same words. same WORDS"), (5, " zz " * 5000), (6, ".zz")]
    return docs, items


@pytest.mark.parametrize("rows_at_once", [D.SET_ROWS, 40])
def test_contaminated_words(spark, monkeypatch, rows_at_once):
    monkeypatch.setattr(D, "SET_ROWS", rows_at_once)  # 40: several blocks
    docs, items = cases()
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], "doc_id bigint, text string, words string, k string").repartition(3)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, h int")
    got = D.contaminated_words(frame, bench).collect()
    found = [(r.doc_id, r.n_words, [i for a in r.ranges for i in range(a.start, a.stop)], r["items"]) for r in got]
    assert sorted(found, key=repr) == brute(docs, items)
    assert all(r.n_hit == sum(a.stop - a.start for a in r.ranges) for r in got)
    assert all(a.stop < b.start for r in got for a, b in zip(r.ranges, r.ranges[1:]))


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert D.contaminated_words(docs.limit(0), bench).count() == 0
    (row,) = D.contaminated_words(docs, bench.limit(0)).collect()
    assert (row.n_words, row.n_hit, row.ranges, row["items"]) == (2, 0, [], [])


def test_clean(spark):
    docs = [(1, "Well, zz! and so on"), (2, "and ZZ"), (3, "zz"), (4, None), (5, "fine, fine"), (5, "fine, fine")]
    frame = spark.createDataFrame([(t, i) for i, t in docs], "text string, start bigint")
    bench = spark.createDataFrame([(1, "zz")], "item_id bigint, text string")
    assert sorted(map(tuple, D.clean(frame, bench).collect()), key=repr) == sorted([(None, 4), ("fine, fine", 5), ("fine, fine", 5)], key=repr)
    cut = {r.start: r.text for r in D.clean(frame, bench, spans=True).collect()}
    assert cut == {1: "Well, and so on", 2: "and ", 3: "", 4: None, 5: "fine, fine"}
    assert D.clean(frame.limit(0), bench, spans=True).columns == ["text", "start"]


def test_no_python(spark):
    docs, items = cases()
    frame = spark.createDataFrame([(i, t) for i, t in docs], "doc_id bigint, text string")
    out = D.contaminated_words(frame, spark.createDataFrame(items, "item_id bigint, text string"))
    plan = out.select(F.count("*"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
