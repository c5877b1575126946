"""The source audit against brute force, with odd rows."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

import cdclake.llm.divergence as D
from cdclake.llm.common import term_pieces


def brute(rows, least=3, ranks=200):
    docs = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), lang or "", source or "") for t, lang, source in rows]
    out = []
    for lang in {d[1] for d in docs}:
        own = [d for d in docs if d[1] == lang]
        df = collections.Counter(t for w, *_ in own for t in set(w))
        kept = [t for t in df if df[t] >= least]
        counts = {s: collections.Counter(t for w, _, source in own if source == s for t in w) for s in {d[2] for d in own}}
        every = sum(counts.values(), collections.Counter())

        def p(count):
            total = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // total for t in kept}

        of, q = {s: p(c) for s, c in counts.items()}, p(every)
        for s in counts:
            pairs = [(-sum((of[s][t] - of[x][t]) ** 2 // of[x][t] for t in kept), x.encode()) for x in counts if x != s]
            terms = [(-((of[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if counts[s][t] > 0 and of[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:ranks])):
                out += [(lang, s, part, i.decode(), -v, k + 1) for k, (v, i) in enumerate(found)]
    return sorted(out)


def cases():
    rng = random.Random(3)
    words = [a + b for a in "abcXYé" for b in ["x", "Yz", "中", "q"]] + ["The"] * 20
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", "-", "9", "\n", "\x00"]) for _ in range(rng.randrange(40)))
    rows = [(text(), rng.choice(["en", "de", "en", None, ""]), rng.choice(["s1", "s2", "s3", "s4", "", None, "é"])) for _ in range(150)]
    rows += [(None, "fr", "s1"), ("", "fr", "s2"), ("a b", "fr", "s3"), (None, None, None), ("only one source here", "it", "s"), ("one two one", "it", "s"), ("one", "it", "s"), ("one " * 3000, "en", "s1")]
    return rows + rows[:3]


@pytest.mark.parametrize("few", [D.FEW_GROUPS, 0])
def test_divergence(spark, monkeypatch, few):
    monkeypatch.setattr(D, "FEW_GROUPS", few)
    rows = cases()
    docs = spark.createDataFrame([(t, x, s, 1, 2.0) for t, x, s in rows], "text string, lang string, source string, term int, value double").repartition(3)
    for least, ranks in ((3, 200), (1, 5)):
        assert sorted(map(tuple, D.divergence(docs, least, ranks).collect())) == brute(rows, least, ranks)
    assert D.divergence(docs.limit(0)).count() == 0


def test_sketch_never_underestimates(spark):
    docs = spark.createDataFrame([(f"w{chr(97 + k % 26) * (1 + k % 7)} common", "en", "s") for k in range(300)], "text string, lang string, source string").repartition(4)
    bits = D.possible(docs, 3)
    df = collections.Counter(t for (text,) in docs.select("text").collect() for t in set(text.split()))
    terms = [t for t in df if df[t] >= 3]
    for r, at in enumerate(D.places("en", [t.encode() for t in terms])):
        assert (bits[r, at >> 3] >> (at & 7).astype(np.uint8) & 1).all()
    assert len(np.flatnonzero(bits)) < 3 * D.ROWS * len(df)


def test_pieces_of_long_texts():
    text = "Abc é, " * 400_000
    found = collections.Counter(w for own in term_pieces(text, D.TERMS) for w in own)
    assert found == {b"abc": 400_000, "é".encode(): 400_000}


@pytest.mark.parametrize(("counted", "held"), [(1 << 20, 1 << 20), (200, 1 << 20), (1, 3000), (1, 1)])
def test_tallies(monkeypatch, counted, held):
    monkeypatch.setattr(D, "COUNTED", counted)
    monkeypatch.setattr(D, "HELD", held)
    monkeypatch.setattr("cdclake.llm.common.PIECE", 50)
    rows = [(t or "", lang or "", source or "") for t, lang, source in cases()]
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*rows[k : k + 40], strict=True)], ["text", "lang", "source"]) for k in range(0, len(rows), 40)]
    n, df, blocks = collections.Counter(), collections.Counter(), 0
    for groups, t in D.tallies(iter(batches), [1, 2]):
        keys = [(*groups[g], t.terms[int(c)].as_py().decode()) for g, c in zip(t.group, t.code, strict=True)]
        assert len(set(keys)) == len(keys)
        n.update(dict(zip(keys, t.n.tolist(), strict=True)))
        df.update(dict(zip(keys, t.df.tolist(), strict=True)))
        blocks += 1
    words = [(lang, source, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))) for t, lang, source in rows]
    assert n == collections.Counter((lang, source, w) for lang, source, own in words for w in own)
    assert df == collections.Counter((lang, source, w) for lang, source, own in words for w in set(own))
    assert blocks == 1 if held == 1 << 20 else blocks > 3
    assert list(D.tallies(iter([]), [1])) == []


def test_rows_of_a_task_are_counted_once(spark):
    """What a task sends is counted already: no aggregate runs over it before the shuffle."""
    docs = spark.createDataFrame([("a b a", "en", f"s{k % 5}") for k in range(30)], "text string, lang string, source string").repartition(2)
    out = D.counted(docs, 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(lang") == 1
    assert "Aggregate" not in plan[plan.index("Exchange hashpartitioning(lang") :]
    assert sorted(map(tuple, out.collect())) == [("en", f"s{k}", t, n, 6) for k in range(5) for t, n in (("a", 12), ("b", 6))]


def test_pair_sums_held_or_sorted(monkeypatch):
    rng = random.Random(5)
    rows = [("en" if k % 3 else "de", [{"source": s, "p": rng.randrange(1, 10**6), "z": 1 + len(s)} for s in rng.sample(["a", "bb", "ccc", "dddd"], rng.randrange(2, 5))]) for k in range(300)]
    shape = pa.list_(pa.struct([("source", pa.string()), ("p", pa.int64()), ("z", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], shape)], ["lang", "own"])
    f = lambda p, q: (p - q) ** 2 // q
    want = collections.Counter()
    for lang, own in rows:
        for a in own:
            for b in own:
                if a["source"] != b["source"]:
                    want[lang, a["source"], b["source"]] += f(a["p"], b["p"]) - f(a["p"], b["z"]) - f(a["z"], b["p"]) + f(a["z"], b["z"])
    for cells in (1 << 20, 0):
        monkeypatch.setattr(D, "CELLS", cells)
        got = collections.Counter()
        for b in D.pair_sums(iter([batch, batch.slice(0, 0)])):
            for r in b.to_pylist():
                got[r["lang"], r["source"], r["item"]] += r["value"]
        assert got == want


def test_probability_of_large_counts(spark):
    rows = [(c, c * 3 + 7, 5) for c in (0, 8_999_999_999, 9_000_000_000, 9_223_372_036, 10**15)] + [(0, 0, 0)]
    got = spark.createDataFrame(rows, "n long, total long, v long").select(D.probability("n", "total", "v")).collect()
    assert [r[0] for r in got] == [1 + 10**9 * (n + 1) // (total + v) if v else None for n, total, v in rows]


def test_names_that_end_in_nul(spark):
    rows = [(f"w{chr(97 + k % 9)} x", lang, source) for k in range(40) for lang, source in (("en", "s"), ("en\0", "s"), ("en\0", "s\0"))]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(2)
    assert sorted(map(tuple, D.divergence(docs).collect())) == brute(rows)
