"""Classifiers, fingerprints, resampling and the language model: held-out quality, brute force, odd rows."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import cdclake.llm.fingerprint as fp
import cdclake.llm.recurrent_lm as R
from cdclake.llm import importance, language_id, toxicity
from cdclake.llm.common import id_crc, slices
from cdclake.llm.fingerprint import edited_comparison, fingerprints
from tests.conftest import SMALL
from tests.llm.test_exact_and_near import shingles

ODD = [(1, None), (2, ""), (3, "12 34"), (4, "und so weiter"), (4, "und so weiter"), (None, "the cat and the dog"), (5, "the cat and the dog " * 5000)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()


def odd(spark, rows=ODD):
    return spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id bigint, text string, score string, lang_pred int")


def test_language(spark, docs):
    held_out = id_crc(F.col("doc_id")) % 5 == 0
    model = language_id.fit(docs.where(~held_out), "text", "lang", F.col("doc_id"))
    found = language_id.predict(docs.where(held_out), model).collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.9
    out = language_id.predict(odd(spark), model).collect()
    assert [r.lang_pred for r in out][:3] == ["und"] * 3
    assert all(0 <= r.score <= 1 and r.text is not None for r in out[3:]) and out[3].score == out[4].score
    none = language_id.fit(docs.limit(0), "text", "lang", F.col("doc_id"))
    assert {r.lang_pred for r in language_id.predict(odd(spark), none).collect()} == {"und"}
    assert language_id.predict(odd(spark, []), model).count() == 0


def test_toxicity(spark, docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = toxicity.fit(docs, labels)
    out = toxicity.score(docs.join(labels, "doc_id"), model).collect()
    assert np.mean([(r.score >= 0.5) == (r.toxic == 1) for r in out]) > 0.9
    got = toxicity.score(odd(spark), model).collect()
    assert all(0 <= r.score <= 1 for r in got) and got[0].score == got[1].score and got[3].score == got[4].score
    assert toxicity.score(odd(spark, []), model).count() == 0
    blank = toxicity.fit(docs, labels.limit(0))
    assert {r.score < 0.5 for r in toxicity.score(odd(spark), blank).collect()} == {True}


def test_fingerprints(spark, docs):
    rows = {r.doc_id: r.text for r in docs.collect()}
    order = sorted(rows, reverse=True)
    errors = []
    for r in edited_comparison(docs).collect():
        text, after = rows[r.doc_id], rows[order[(order.index(r.doc_id) + 1) % len(order)]]
        cut = len(text) // 3
        assert r.edited == text[: len(text) - cut] + after[:cut] and r.n_chars == len(text)
        a, b, c = shingles(text), shingles(r.edited), shingles(after)
        errors += [r.near_edited - len(a & b) / len(a | b), r.near_next - len(a & c) / len(a | c)]
    assert np.sqrt(np.mean(np.square(errors))) < 0.05 and abs(np.mean(errors)) < 0.01


def test_fingerprints_odd(spark):
    got = fingerprints(odd(spark)).collect()
    assert got[0].fingerprint == got[1].fingerprint == "" and got[3].fingerprint == got[4].fingerprint != ""
    out = {(r.doc_id, r.n_chars): r for r in edited_comparison(odd(spark)).collect()}
    assert len(out) == 6 and out[2, 0].near_edited == 1.0 and out[2, 0].near_next == 1.0
    assert edited_comparison(odd(spark, [])).count() == 0
    one = edited_comparison(odd(spark, [(1, "abcdef")])).first()
    assert one.edited == "abcdab" and one.near_next == 1.0


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_next_document(spark, monkeypatch, kind):
    """Blocks of a few rows; ids that many rows share, or that are null, are more than one block."""
    monkeypatch.setattr(fp, "BLOCK_ROWS", 10)
    draw = np.random.default_rng(5)
    ids = [None] * 60 + [7] * 60 + [int(i) for i in draw.permutation(200) * 3]
    rows = [(i if i is None or kind == "bigint" else f"é'{i:04}", f"text {k}") for k, i in enumerate(ids)]
    frame = spark.createDataFrame(rows, f"doc_id {kind}, text string")
    got = {r.text: r.next_text for r in fp.with_next(frame, "doc_id", "text", ["text"]).collect()}
    at, order = "text 0", []
    for _ in rows:
        order.append(at)
        at = got[at]
    assert at == "text 0" and len(set(order)) == len(rows)  # one round through all
    of = dict((t, i) for i, t in rows)
    first = next(k for k, t in enumerate(order) if of[t] is not None and of[order[k - 1]] is None)
    found = [of[t] for t in order[first:] + order[:first]]
    assert found == sorted(found, key=lambda i: (i is not None, i or (0 if kind == "bigint" else "")), reverse=True)


def test_resampling(spark, docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = labels.where("quality = 1").select("doc_id")
    out = importance.resample(docs, good, 0.8).collect()
    assert sum(r.selected for r in out) == round(0.8 * len(out))
    assert min(r.gumbel_key for r in out if r.selected) >= max(r.gumbel_key for r in out if not r.selected)
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    kept = {r.doc_id: r.selected for r in out}
    assert np.mean([kept[i] for i in bad]) < np.mean(list(kept.values()))
    assert len(importance.resample(odd(spark), good.limit(0), 0.5).collect()) == len(ODD)
    assert importance.resample(odd(spark, []), good, 0.5).count() == 0


def test_kth_greatest(spark, monkeypatch):
    monkeypatch.setattr(importance, "PARTS", 4)
    monkeypatch.setattr(importance, "FEW", 3)
    values = [1.0] * 10 + list(np.linspace(-5, 5, 37))
    frame = spark.createDataFrame([(float(v),) for v in values], "x double")
    for k in (1, 5, 15, 20, len(values)):
        assert importance.kth_greatest(frame, k) == sorted(values, reverse=True)[k - 1]


def test_gradient(monkeypatch):
    for name, value in {"HEAD": 8, "CLASS": 4, "HIDDEN": 5, "CLASSES": 18}.items():
        monkeypatch.setattr(R, name, value)
    net = R.Network(R.Network().flat.astype(np.float64) * 5)
    draw = np.random.default_rng(0)
    x, reset, valid, h = draw.integers(0, 24, (6, 3)), draw.random((6, 3)) < 0.3, draw.random((6, 3)) < 0.9, np.zeros((3, 5))
    g, _, touched = net.gradient(x, reset, valid, h)
    assert not R.Network(g).E[np.setdiff1d(np.arange(24), touched)].any()
    again, _, _ = net.gradient(x, reset, valid, h, into=R.Network(np.zeros_like(net.flat)))
    assert np.allclose(g, again) and not np.allclose(g, net.gradient(x, reset, None, h)[0])

    def loss(flat):
        other = R.Network(flat)
        _, before, _ = other.run(x, reset, h)
        ok = valid.ravel()
        return -other.output(before.reshape(-1, 5)[ok], x.ravel()[ok], False)[0].sum() / ok.sum()

    for k in draw.integers(0, len(net.flat), 40):
        step = np.zeros(len(net.flat))
        step[k] = 1e-3
        assert abs((loss(net.flat + step) - loss(net.flat - step)) / 2e-3 - g[k]) < 1e-4


def test_probabilities_sum_to_one():
    texts = ["the cat the dog the cat", "a cat, a dog. once"]
    counts = collections.Counter(w for t in texts for w in [*R.tokens(t), R.END])
    words = [w for w, n in counts.most_common() if n > 1]
    tail = [w for w in counts if w not in words]
    total, distinct = np.zeros(8), np.zeros(8)
    for w in tail:
        total[R.sign(w)] += counts[w]
        distinct[R.sign(w)] += 1
    number = np.zeros(R.HEAD, np.int64)
    number[: len(words)] = [counts[w] for w in words]
    voc = R.Vocabulary(sum(counts.values()), len(counts), {w: k for k, w in enumerate(words)}, number, np.zeros(8), total, distinct, len(words))
    net = R.Network.start(voc)
    rows = np.concatenate((np.arange(R.HEAD), np.arange(R.HEAD, R.HEAD + 2 * R.SIGNS)))
    out, _ = net.output(np.zeros((len(rows), R.HIDDEN), np.float32), rows, False)
    assert abs(np.exp(out).sum() - 1) < 1e-3


def test_language_model(spark, docs, monkeypatch):
    monkeypatch.setattr(R, "MID", 500)
    monkeypatch.setattr(R, "ROUNDS", (0.5, 0.5))
    held_out = id_crc(F.col("doc_id")) % 7 == 2
    out = {r.doc_id: r for r in R.score_texts(docs, ~held_out).collect()}
    texts = {r.doc_id: (r.text, r.h) for r in docs.select("doc_id", "text", held_out.alias("h")).collect()}
    words = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]
    counts = collections.Counter(w for t, h in texts.values() if not h for w in words(t))
    n, v = sum(counts.values()), len(counts)
    for i, (t, _) in texts.items():
        own, r = words(t), out[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(w in counts for w in own), n)
        assert math.isclose(r.base_score, sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)
    held = [out[i] for i, (_, h) in texts.items() if h]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    strange = R.score_texts(odd(spark), F.lit(True)).collect()
    assert len(strange) == len(ODD) and all(math.isfinite(r.score) for r in strange)
    empty = [r for r in strange if r.doc_id in (1, 2)]
    assert [r.n_tokens for r in empty] == [1, 1] and math.isclose(empty[0].score, empty[1].score, rel_tol=1e-6)
    assert R.score_texts(odd(spark, []), F.lit(True)).count() == 0
    assert all(math.isfinite(r.score) for r in R.score_texts(odd(spark), F.lit(False)).collect())


def test_language_model_learns_from_every_text(spark):
    """With the shipped rounds: each text has a word of its own, whose input row only that text's gradient moves."""
    rows = [(f"w{k} w{k}", k / 64) for k in range(64)] + [("last last", 1 - 2**-20)]
    texts = spark.createDataFrame(rows, "text string, draw double")
    voc = R.vocabulary(R.count(texts.select("text")))
    before, after = R.Network.start(voc), R.fit(texts, voc)
    own = [voc.symbol[t.split()[0].encode()] for t, _ in rows]
    assert (before.E[own] != after.E[own]).any(1).all()
    assert sum(R.ROUNDS) == 1


def test_toxicity_sample(spark, monkeypatch):
    """The learner gets about 2500 labelled rows of each label, if there are so many."""
    seen = []
    monkeypatch.setattr(toxicity, "learn", lambda rows, y, weight: seen.extend(y))
    docs = spark.range(5400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    toxicity.fit(docs, docs.select("doc_id", (F.col("doc_id") % 2).alias("toxic")))
    assert all(abs(seen.count(label) - 2500) < 100 for label in (0, 1))


def test_more_than_256_languages(spark):
    """Every language is learned, the rarest too."""
    word = lambda k: hashlib.md5(str(k).encode()).hexdigest().translate(str.maketrans("0123456789", "ghijklmnop"))[:8]
    rows = [(k * 6 + j, f"{word(k)} " * (j + 3), f"l{k:03}") for k in range(300) for j in range(6 if k < 299 else 5)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(train, "text", "lang", F.col("doc_id"))
    assert model.languages == [f"l{k:03}" for k in range(300)]
    assert model.predict(f"{word(299)} " * 4)[0] == "l299"


def test_tokens_of_slices():
    """Arrow's slices hold offsets into what they were cut from."""
    texts = ["Foo  BAR ÄÖ.", None, "", " \t", "x\x0by Z", "\x85 a\xa0b"] * 40
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    for part in [batch.column(0), batch.column(0).slice(7, 100), *[b.column(0) for b in slices(batch, 0, 64)]]:
        code, edge, words = R.tokenised(part)
        found = [[words[int(c)].as_py() for c in code[a:z]] for a, z in zip(edge, edge[1:], strict=False)]
        assert found == [[*R.tokens(t), R.END] for t in part.to_pylist()]
        named = [w for w in words.to_pylist() if w]
        assert R.signs(pa.array(named, pa.large_binary())).tolist() == [R.sign(w) for w in named]


def test_scores_equal_those_of_each_text_alone(spark):
    """In streams beside a text of very many tokens, which is scored whole in memory that grows with its tokens alone."""
    draw = np.random.default_rng(3)
    texts = [draw.integers(0, R.HEAD + 16, n) for n in (1, 5, 300, 17, 2, 200_000)] + [draw.integers(0, R.HEAD, 9) for _ in range(600)]
    net = R.Network()
    tracemalloc.start()
    together = R.log10_of(net, texts)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 60e6  # streams x longest stream would be 200,000 x 512
    for k in (0, 1, 2, 3, 4, 5, 6, 605):
        h, begins = np.zeros((1, R.HIDDEN), np.float32), np.zeros((len(texts[k]), 1), bool)
        begins[0] = True
        alone = 0.0
        for at in range(0, len(texts[k]), 1000):
            x = texts[k][at : at + 1000, None]
            _, before, h = net.run(x, begins[at : at + 1000], h)
            alone += net.output(before[:, 0], x[:, 0], False)[0].sum()
        assert together[k] == pytest.approx(alone / np.log(10), rel=1e-4)


def test_training_carries_the_state_through_segments(monkeypatch):
    for name, value in {"SEGMENT": 16, "RATE": 0.0}.items():
        monkeypatch.setattr(R, name, value)
    net, text, met = R.Network(), np.arange(40), {}
    _, whole, _ = net.run(text[:, None], (text == 0)[:, None], np.zeros((1, R.HIDDEN), np.float32))
    output = R.Network.output

    def watched(self, before, row, learn, into=None):
        met.update(zip(row.tolist(), before, strict=True))
        return output(self, before, row, learn, into)

    monkeypatch.setattr(R.Network, "output", watched)
    assert R.train(net, iter([[text, np.array([50, 51])]])) == 42
    assert all(np.allclose(met[k], whole[k, 0], atol=1e-5) for k in range(40))
    no, yes = np.zeros((16, 1), bool), np.ones((16, 1), bool)
    cut = no.copy()
    cut[0] = True
    g, _, _ = net.gradient(text[:16, None], no, yes, np.zeros((1, R.HIDDEN), np.float32), cut, whole[:16])
    assert not R.Network(g).s.any()
