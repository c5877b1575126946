"""Classifiers and resampling against plain versions that go feature by feature."""

from __future__ import annotations

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdclake.llm import importance, language_id, ngrams, toxicity
from tests.conftest import SMALL

TEXTS = ["Über den Fluss", "the cat sat on the mat", "El niño está aquí", "a", "", "the THE the", "½ ½", "12 34"]
MASK = (1 << 64) - 1


def plain_buckets(text, sizes, bits):
    """One n-gram at a time."""
    padded, out = f" {text.lower()} ", []
    for n in sizes:
        for k in range(len(padded) - n + 1):
            h = 0
            for c in padded[k : k + n]:
                h = (h * int(ngrams.FACTOR) + ord(c)) & MASK
            out.append((((h ^ (h >> 29)) + n) * int(ngrams.SPREAD) & MASK) >> (64 - bits))
    return collections.Counter(out)


@pytest.mark.parametrize("block", [4, 1 << 18])
def test_ngrams(monkeypatch, block):
    monkeypatch.setattr(ngrams, "BLOCK", block)
    occur = ngrams.Presence((2, 3), 7)
    for text in [*TEXTS, "long " * 50]:
        at, n = ngrams.bucket_counts(text, (1, 2, 3), 7)
        assert dict(zip(at.tolist(), n.tolist(), strict=True)) == plain_buckets(text, (1, 2, 3), 7)
        assert set(occur(text).tolist()) == set(plain_buckets(text, (2, 3), 7))


def test_tfidf(monkeypatch):
    monkeypatch.setattr(language_id, "BITS", 7)
    idf = np.random.default_rng(1).random(128) + 1
    for text in TEXTS:
        at, x = language_id.tfidf(text, idf)
        raw = {b: (1 + math.log(n)) * idf[b] for b, n in plain_buckets(text, language_id.SIZES, 7).items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        assert dict(zip(at.tolist(), x, strict=True)) == pytest.approx({b: v / norm for b, v in raw.items()})


def plain_ftrl(rows, classes, dimension):
    """FTRL-proximal, one weight at a time; the last feature is the bias, without L1."""
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(f, c):
        l1 = 0 if f == dimension else language_id.L1
        if abs(z[f, c]) <= l1:
            return 0.0
        return -(z[f, c] - math.copysign(l1, z[f, c])) / ((language_id.BETA + math.sqrt(n[f, c])) / language_id.ALPHA + language_id.L2)

    order = np.random.default_rng(7)
    for _ in range(language_id.PASSES):
        for k in order.permutation(len(rows)):
            at, x, y = rows[k]
            features = [*zip(at.tolist(), x.tolist(), strict=True), (dimension, 1.0)]
            w = {(f, c): weight(f, c) for f, _ in features for c in range(classes)}
            logits = [sum(v * w[f, c] for f, v in features) for c in range(classes)]
            e = [math.exp(t - max(logits)) for t in logits]
            for c in range(classes):
                error = e[c] / sum(e) - (c == y)
                for f, v in features:
                    g = error * v
                    sigma = (math.sqrt(n[f, c] + g * g) - math.sqrt(n[f, c])) / language_id.ALPHA
                    z[f, c] += g - sigma * w[f, c]
                    n[f, c] += g * g
    return [[weight(f, c) for c in range(classes)] for f in range(dimension)], [weight(dimension, c) for c in range(classes)]


def test_ftrl(monkeypatch):
    monkeypatch.setattr(language_id, "BITS", 5)
    monkeypatch.setattr(language_id, "L1", 0.3)
    draw = np.random.default_rng(2)
    rows = []
    for k in range(40):
        at = np.sort(draw.choice(32, draw.integers(1, 9), replace=False))
        rows.append((at, draw.random(len(at)), k % 3))
    weights, bias = language_id.learn(rows, 3)
    expected, expected_bias = plain_ftrl(rows, 3, 32)
    assert np.allclose(weights, expected) and np.allclose(bias, expected_bias)
    assert (weights == 0).any()  # L1 leaves some out


def test_temperature():
    draw = np.random.default_rng(3)
    y = draw.integers(0, 4, 400)
    logits = draw.normal(size=(400, 4))
    logits[np.arange(400), y] += 1
    for scale in (0.3, 1.0, 4.0):
        def loss(t):
            p = language_id.softmax(logits * scale / t)
            return -np.log(p[np.arange(400), y]).mean()

        best = min(np.exp(np.linspace(np.log(0.05), np.log(5), 2000)), key=loss)
        assert language_id.fit_temperature(logits * scale, y) == pytest.approx(best, rel=0.01)


def test_letters_are_of_category_l():
    model = language_id.LanguageModel(["en"], np.ones(1 << language_id.BITS), np.zeros((1 << language_id.BITS, 1)), np.zeros(1), 1.0)
    for text in ("½ ½", "² 3", "12 34", "", None, "_ ́ ٣ Ⅷ"):
        assert model.predict(text) == ("und", 0.0)
    for text in ("é", "1 a", "日", "ʰ"):
        assert model.predict(text) == ("en", 1.0)


def test_the_sample_is_bounded_in_bytes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language_id, "SAMPLE_BYTES", 20_000)
    learn = language_id.learn
    monkeypatch.setattr(language_id, "learn", lambda rows, classes: seen.extend(rows) or learn(rows, classes))
    rows = [(k, f"{'abc' if k % 2 else 'xyz'} {k} " * 9, "ab"[k % 2]) for k in range(1500)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "text", "lang", F.col("doc_id"))
    assert sum(6 * len(at) for at, _, _ in seen) < 25_000 and {y for *_, y in seen} == {0, 1}
    assert model.predict("xyz xyz")[0] == "a"


def plain_nb(rows, y, weight):
    """Naive Bayes ratios and adaptive logistic regression, one feature at a time."""
    found = [collections.Counter(b for r, k in zip(rows, y, strict=True) if k == c for b in r.tolist()) for c in (0, 1)]
    size = [sum(1 for k in y if k == c) for c in (0, 1)]
    ratio = lambda b: math.log((found[1][b] + toxicity.SMOOTH) / (size[1] + 2 * toxicity.SMOOTH)) - math.log((found[0][b] + toxicity.SMOOTH) / (size[0] + 2 * toxicity.SMOOTH))
    mean = sum(weight) / len(weight)
    w, n = collections.defaultdict(float), collections.defaultdict(lambda: 1.0)
    bias = math.log(sum(s for s, k in zip(weight, y, strict=True) if k) / sum(s for s, k in zip(weight, y, strict=True) if not k))
    seen, draw = 1.0, np.random.default_rng(7)
    for _ in range(toxicity.PASSES):
        for k in draw.permutation(len(rows)):
            z = sum(ratio(b) * w[b] for b in rows[k].tolist()) + bias
            e = (1 / (1 + math.exp(-z)) - y[k]) * weight[k] / mean
            for b in rows[k].tolist():
                g = e * ratio(b) + toxicity.PENALTY * w[b]
                n[b] += g * g
                w[b] -= toxicity.RATE * g / math.sqrt(n[b])
            seen += e * e
            bias -= toxicity.RATE * e / math.sqrt(seen)
    return {b: ratio(b) * v for b, v in w.items()}, bias


def test_toxicity_learner(monkeypatch):
    monkeypatch.setattr(toxicity, "BITS", 6)
    draw = np.random.default_rng(4)
    rows = [np.sort(draw.choice(64, draw.integers(1, 12), replace=False)) for _ in range(50)]
    y, weight = draw.integers(0, 2, 50), draw.random(50) + 0.5
    model = toxicity.learn(rows, y, weight)
    weights, bias = plain_nb(rows, y, weight)
    assert model.bias == pytest.approx(bias)
    assert {b: model.weights[b] for b in weights} == pytest.approx(weights)
    for r in rows[:5]:
        assert model.score(r) == pytest.approx(1 / (1 + math.exp(-sum(weights[b] for b in r.tolist()) - bias)))


def test_importance_weights(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    good = spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1").select("doc_id")
    texts = {r.doc_id: r.text for r in docs.collect()}
    wanted = {r.doc_id for r in good.collect()}
    one: dict = {}

    def plain(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        grams = [(w,) for w in words] + list(zip(words, words[1:], strict=False))
        for g in grams:
            if g not in one:  # of a text of these words alone: the words' buckets, then the pair's
                one[g] = int(importance.buckets(" ".join(g))[-1])
        return collections.Counter(one[g] for g in grams)

    counts = {i: plain(t) for i, t in texts.items()}

    def shares(ids):
        total = sum((counts[i] for i in ids), collections.Counter())
        extra = importance.SMOOTH * max(sum(total.values()), 1) / (1 << importance.BITS)
        whole = sum(total.values()) + extra * (1 << importance.BITS)
        return lambda b: (total[b] + extra) / whole

    raw, target = shares(texts), shares([i for i in texts if i in wanted])
    got = {r.doc_id: r.log_weight for r in importance.log_weights(docs.withColumn("log_weight", docs.doc_id), good).collect()}
    for i, c in counts.items():
        assert got[i] == pytest.approx(sum(n * (math.log(target(b)) - math.log(raw(b))) for b, n in c.items()), rel=1e-6, abs=1e-6)
