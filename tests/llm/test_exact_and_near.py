"""Exact dedup and the Jaccard join against brute force, with odd rows."""

from __future__ import annotations

import collections
import hashlib
import os
import random
import re
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import cdclake.llm.jaccard_join as J
from cdclake.llm.common import join_counted
from cdclake.llm.exact_dedup import exact_dedup
from cdclake.llm.queries import OP9_SQL
from tests.conftest import SMALL

ODD = [(1, "a b c"), (2, "ab\tc"), (3, None), (4, ""), (5, " \n"), (6, "abc"), (6, "abc"), (7, "x  y  z"), (8, "xyz"), (None, "xyz"), (9, "é" * 3)]
EXTRA = "doc_id bigint, text string, kept string, KEY string, h int"


def with_extras(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 0) for i, t in rows], EXTRA)


def brute_exact(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((i, t or ""))
    out = []
    for norm, own in groups.items():
        best = min(own, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        out += [(i, best[0], len(own), (i, len(t)) == (best[0], len(best[1])), hashlib.sha256(norm.encode()).hexdigest()) for i, t in own]
    return sorted(out, key=str)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(spark, weak):
    hashed = {"content_hash": lambda c: F.unhex(F.substring(F.md5(c.cast("binary")), 1, 1))} if weak else {}  # collides a lot
    got = exact_dedup(with_extras(spark, ODD), **hashed)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "n_chars"]
    assert sorted(map(tuple, got.drop("n_chars").collect()), key=str) == brute_exact(ODD)
    assert sorted(r.n_chars for r in got.collect()) == sorted(len(t or "") for _, t in ODD)
    assert exact_dedup(with_extras(spark, [])).count() == 0


def test_exact_dedup_hot_group(spark):
    rows = [(i, "same text" if i % 2 else f"text {i}") for i in range(4000)]
    assert sorted(map(tuple, exact_dedup(with_extras(spark, rows)).drop("n_chars").collect()), key=str) == brute_exact(rows)


def test_exact_dedup_sql(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    sql = OP9_SQL.replace("FROM documents", f"FROM '{SMALL}/documents.parquet'")
    got = exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(duckdb.sql(sql).fetchall())


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) or frozenset([tuple(w)] if w else [])


def brute_near(rows):
    sets = [shingles(t) for _, t in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            union = len(sets[a] | sets[b])
            if (len(sets[a] & sets[b]) >= 0.8 * union - 1e-9) if union else True:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, least[find(k)], links[k]) for k, (i, _) in enumerate(rows))


def near_rows(seed, family=60):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefg", k=4))
    passage = " ".join(word() for _ in range(30))
    base = [word() for _ in range(120)]
    rows = []
    for k in range(family):  # one large group of near copies
        own = list(base)
        for _ in range(draw.randrange(4)):
            own[draw.randrange(120)] = word()
        rows.append(" ".join(own))
    rows += [passage + " " + " ".join(word() for _ in range(100)) for _ in range(60)]  # a passage that many share
    rows += [rows[0]] * 20 + ["", None, " ", "one two", "one  two", "one two three four five six", "one two three four five six seven"]
    draw.shuffle(rows)
    return [(3 * k + 1, t) for k, t in enumerate(rows)]


@pytest.mark.parametrize("bucket", [512, 8])
def test_near_duplicates(spark, monkeypatch, bucket):
    monkeypatch.setattr(J, "BUCKET", bucket)
    rows = near_rows(bucket)
    got = J.near_duplicates(with_extras(spark, rows)).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == brute_near(rows)
    kept = collections.Counter(r.class_id for r in got if r.kept)
    assert set(kept) == {r.class_id for r in got} and set(kept.values()) == {1}


@pytest.mark.parametrize("breaks", [1, 6])
def test_recall_at_the_threshold(spark, breaks):
    """Pairs of likeness 0.8 exactly, of 45 and 270 shingles: the larger ones pass the sketches' estimate too."""
    draw = random.Random(breaks)
    rows = []
    for pair in range(600):
        words = [f"{draw.getrandbits(40):x}" for _ in range(45 * breaks + 4)]
        other = list(words)
        for k in range(breaks):
            other[len(words) * (2 * k + 1) // (2 * breaks)] = "changed"
        assert len(shingles(" ".join(words)) & shingles(" ".join(other))) == 40 * breaks
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(other))]
    got = J.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sum(r.n_links for r in got if r.doc_id % 2)
    assert found >= 0.999 * 600 and all(r.class_id >= r.doc_id - 1 for r in got)


def test_texts_of_any_length_and_ids_of_any_kind(spark):
    long = " ".join(f"w{k % 9000}" for k in range(200_000))
    rows = [("b", long), ("a", long + " end"), ("c", long.replace(" ", "\n")), (None, long), ("d", ""), ("", None)]
    frame = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(frame).collect()}
    assert got == {"b": ("b", 3, True), "a": ("a", 1, True), "c": ("b", 3, False), None: ("b", 3, False), "d": ("", 2, False), "": ("", 2, True)}
    near = {r.doc_id: r.class_id for r in J.near_duplicates(frame).collect()}
    assert near == {"b": "a", "a": "a", "c": "a", None: "a", "d": "", "": ""}


def test_exact_dedup_of_many_groups(spark):
    """Many groups, with a hot one among them, by the same plan as none."""
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i % 700}") for i in range(6000)]
    many = exact_dedup(with_extras(spark, rows)).drop("n_chars")
    assert sorted(map(tuple, many.collect()), key=str) == brute_exact(rows)
    none = exact_dedup(with_extras(spark, [(i, f"text {i}") for i in range(6000)])).drop("n_chars")
    shapes = [re.sub(r"#\d+L?|\d+", "", f._jdf.queryExecution().optimizedPlan().toString()) for f in (many, none)]
    assert shapes[0] == shapes[1]


def test_join_of_hot_keys(spark):
    rows = spark.range(5000).selectExpr("id", "if(id % 2 = 0, 'hot', cast(id % 50 as string)) AS k")
    few = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k <> '7'")
    assert join_counted(rows, few, "k", "n", 5000).count() == 5000 - 100
    left = join_counted(rows, few, "k", "n", 5000, "left")
    assert left.columns == ["k", "id", "n"] and left.count() == 5000 and left.where("n is null").count() == 100


def test_near_duplicates_empty(spark):
    assert J.near_duplicates(with_extras(spark, [])).count() == 0
    got = J.near_duplicates(with_extras(spark, [(None, "a b"), (None, "a b"), (2, None)])).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == [(2, 2, 0), (None, None, 1), (None, None, 1)]


def test_repeated_runs_reach_the_recall():
    assert J.runs() >= 3


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64])
def test_words_across_blocks(monkeypatch, block):
    rng = random.Random(block)
    texts = ["".join(rng.choice("ab \u00e9\t\n \u4e2d") for _ in range(rng.randrange(80))) for _ in range(300)]
    whole = [J.word_hashes(t).tolist() for t in texts]
    monkeypatch.setattr(J, "BLOCK", block)
    assert [J.word_hashes(t).tolist() for t in texts] == whole
    assert all(len(w) == len(t.split()) for w, t in zip(whole, texts, strict=True))


def test_memory_of_a_long_text():
    """50 MB, once as words and once as a single one, below 1 GB."""
    run = "import resource; import cdclake.llm.jaccard_join as J; from cdclake.llm.importance import buckets; "
    run += "a = J.shingle_set('lorem ipsum dolor ' * 2_900_000); b = J.shingle_set('x' * 50_000_000); c = buckets('lorem ipsum dolor ' * 2_900_000); "
    run += "print(len(a), len(b), len(c), max(map(len, J._powers)), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)"
    out = subprocess.run([sys.executable, "-c", run], capture_output=True, text=True, check=True, cwd=os.path.dirname(os.path.dirname(os.path.dirname(__file__)))).stdout
    shingles, one, words, powers, megabytes = map(int, out.split()[-5:])
    assert (shingles, one, words) == (3, 1, 2 * 8_700_000 - 1) and powers <= 4 * J.BLOCK and megabytes < 1000
