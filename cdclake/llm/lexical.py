"""Ranked lexical search over an index whose documents are ordered by recursive graph bisection.

Building: each text becomes its terms and their counts, written once. A bisection fitted to a bounded sample of rows sends
every document down LEVELS halvings; range partitions of that order go on bisecting their own documents, up to ROUNDS
rounds of swaps a level, until a shard of at most SHARD documents is left. A shard's rows are its documents in order and,
for each term, the documents that hold it and the greatest score that it can give there.

Searching: the queries' lists are taken from the index once. A shard's bound for a query is the sum of its terms' greatest
scores there. Queries visit shards by bound, some more in each round, and stop exactly: when no shard that is left could
hold a document as good as the worst of the best. Ties go by document id, which shards map their places back to.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdclake.llm.common import forget, materialise, term_pieces
from cdclake.llm.jaccard_join import groups

#: What bytes.translate() makes of a text: letters A to Z small, other ASCII characters but a to z and digits into spaces.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: The bisection's sample: rows, terms of a row (of the least hashes), terms of all rows; halvings that it decides.
SAMPLE, OF_ROW, VOCABULARY, LEVELS = 4096, 128, 8192, 6
ROUNDS = 8
#: Documents of a shard, and what a task arranges at a time: documents, bytes.
SHARD, ARRANGED, ARRANGED_BYTES = 2048, 4096, 16 << 20
#: Queries that are searched at a time have at most so many terms times queries.
MATRIX = 8_000_000
#: Shards that a query visits in the first round; each further round visits MORE times as many.
FIRST, MORE, BEST = 4, 4, 10


@dataclass
class Index:
    """table: (shard, term, at, tf, best) for each term of a shard, and (shard, ids, n) of its documents in order, without term."""

    table: DataFrame
    documents: int
    length: int


def term_counts(text: str | None) -> Counter:
    found: Counter = Counter()
    for words in term_pieces(text or "", TERMS):
        found.update(words)
    return found


def halves(ids: np.ndarray, first: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Which documents (terms ids, from first on) go to the second half, and each term's preference for it.

    Swaps pairs of documents as long as that shortens the gaps between a term's documents, as estimated by their numbers
    in each half.
    """
    n = len(first)
    terms = int(ids.max(initial=-1)) + 1
    sizes = np.diff(np.append(first, len(ids)))
    of = np.repeat(np.arange(n), sizes)
    right = np.arange(n) >= n // 2
    a, b = max(n // 2, 1), max(n - n // 2, 1)

    def cost(left: np.ndarray, other: np.ndarray) -> np.ndarray:
        return left * np.log2(a / (left + 1)) + other * np.log2(b / (other + 1))

    def degrees() -> tuple[np.ndarray, np.ndarray]:
        there = np.bincount(ids[right[of]], minlength=terms).astype(float)
        return np.bincount(ids, minlength=terms) - there, there

    for _ in range(rounds):
        left, there = degrees()
        now = cost(left, there)
        to_right, to_left = now - cost(np.maximum(left - 1, 0), there + 1), now - cost(left + 1, np.maximum(there - 1, 0))
        gain = np.bincount(of, np.where(right[of], to_left[ids], to_right[ids]), n)
        l, r = np.flatnonzero(~right), np.flatnonzero(right)
        l, r = l[np.argsort(-gain[l], kind="stable")], r[np.argsort(-gain[r], kind="stable")]
        k = min(len(l), len(r))
        swap = gain[l[:k]] + gain[r[:k]] > 1e-9
        if not swap.any():
            break
        right[l[:k][swap]], right[r[:k][swap]] = True, False
    left, there = degrees()
    return right, cost(left + 1, there) - cost(left, there + 1)


def part_of(ids: np.ndarray, first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terms of some of the documents."""
    ends = np.append(first, len(ids))
    sizes = ends[rows + 1] - ends[rows]
    starts = np.cumsum(sizes) - sizes
    return ids[np.repeat(ends[rows] - starts, sizes) + np.arange(sizes.sum())], starts


@dataclass
class Bisection:
    """A node's children are 2 * node + 1 and 2 * node + 2; a document goes to the second if its terms' preferences exceed the limit."""

    terms: dict[bytes, int]
    preferences: np.ndarray
    limits: np.ndarray

    def leaf(self, words: Counter) -> int:
        ids = [k for k in map(self.terms.get, words) if k is not None]
        node = 0
        for _ in range(LEVELS):
            node = 2 * node + 1 + int(self.preferences[node, ids].sum() > self.limits[node])
        return node - (2**LEVELS - 1)


def fit(sample: list[list[bytes]]) -> Bisection:
    df = Counter(t for words in sample for t in words)
    usual = sorted((t for t in df if 4 <= df[t] <= max(4, len(sample) // 2)), key=lambda t: (-df[t], t))[:VOCABULARY]
    terms = {t: k for k, t in enumerate(usual)}
    nodes = 2**LEVELS - 1
    out = Bisection(terms, np.zeros((nodes, max(1, len(terms))), np.float32), np.zeros(nodes))
    lists = [np.array([terms[t] for t in words if t in terms], np.int64) for words in sample]
    ids = np.concatenate([*lists, np.empty(0, np.int64)])
    first = np.cumsum([0, *map(len, lists)])[:-1]
    rows = {0: np.arange(len(lists))}
    for node in range(nodes):
        own = rows.pop(node)
        if len(own) > 1 and len(ids):
            own_ids, own_first = part_of(ids, first, own)
            _, preference = halves(own_ids, own_first, 2 * ROUNDS)
            out.preferences[node, : len(preference)] = preference
            score = np.array([out.preferences[node, lists[k]].sum() for k in own])
            out.limits[node] = np.median(score)
            right = score > out.limits[node]
        else:
            right = np.zeros(len(own), bool)
        rows[2 * node + 1], rows[2 * node + 2] = own[~right], own[right]
    return out


def arranged(ids: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Documents in shards of at most SHARD, alike ones together."""
    done, todo = [], [np.arange(len(first))]
    while todo:
        rows = todo.pop()
        if len(rows) <= SHARD:
            done.append(rows)
            continue
        right, _ = halves(*part_of(ids, first, rows), ROUNDS)
        todo += [rows[right], rows[~right]]
    return done


def lengths(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """25 + 75 * n * documents / length, rounded down, exactly."""
    if len(n) and 75 * int(n.max()) * documents >= 1 << 63:
        n = n.astype(object)
    return (25 + 75 * n * documents // length).astype(np.int64)


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index of every row of docs that has a term (A to Z, small, digits and characters beyond ASCII).

    Null and empty texts have none. Ids may be null or repeat, each row stands for itself; equal texts lie together.
    Texts of any length count whole. An empty table gives an empty index. Other columns are not read.
    """
    spark = docs.sparkSession
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    share = min(1.0, SAMPLE / max(docs.count(), 1))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text in b.column(0).to_pylist():
                words = sorted(term_counts(text), key=lambda t: (xxhash.xxh3_64_intdigest(t), t))[:OF_ROW]
                yield pa.RecordBatch.from_arrays([pa.array([b" ".join(words)], pa.binary())], ["words"])

    drawn = base.where(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(share * (1 << 30))).select("text").mapInArrow(chosen, "words binary")
    tree = spark.sparkContext.broadcast(fit(sorted(bytes(r[0]).split() for r in drawn.collect())))  # about SAMPLE rows of OF_ROW terms

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for k in range(0, big.num_rows, 500):
                b = big.slice(k, 500)
                keep, n, leaf, terms, tfs = [], [], [], [], []
                for i, text in enumerate(b.column(2).to_pylist()):
                    found = term_counts(text)
                    if found:
                        keep.append(i), n.append(found.total()), leaf.append(tree.value.leaf(found))
                        terms.append(b" ".join(found)), tfs.append(np.fromiter(found.values(), "<u4", len(found)).tobytes())
                at = pa.array(keep, pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(n, pa.int64()), pa.array(leaf, pa.int32()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())], ["row", "doc_id", "n", "leaf", "terms", "tfs"])

    rows = materialise(base.mapInArrow(forward, f"row long, doc_id {kind}, n long, leaf int, terms binary, tfs binary"), "search-rows", "zstd")
    number, length, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.octet_length("terms") + F.octet_length("tfs")), F.lit(0))).first()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, bytes_held = 0, [], 0
        place = TaskContext.get().partitionId() << 32

        def put() -> Iterator[pa.RecordBatch]:
            nonlocal made
            t = pa.Table.from_batches(held)
            n = t.column("n").to_numpy()
            m = lengths(n, number, length)
            tf = np.frombuffer(b"".join(t.column("tfs").to_pylist()), "<u4")
            first = np.cumsum([0, *(len(x) // 4 for x in t.column("tfs").to_pylist())])
            data = b" ".join(t.column("terms").to_pylist()) + b" "  # each term with a space behind it
            edges = np.concatenate(([0], np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1)).astype(np.int32)
            coded = pc.dictionary_encode(pa.BinaryArray.from_buffers(pa.binary(), len(tf), [None, pa.py_buffer(edges), pa.py_buffer(data)]))
            names = pc.utf8_rtrim(coded.dictionary.cast(pa.string()), " ")
            code = coded.indices.to_numpy()
            often = np.bincount(code) > 1  # a term of one document brings none together
            shared = often[code]
            number_before = np.concatenate(([0], np.cumsum(shared)))
            for rows in arranged(code[shared], number_before[first[:-1]]):
                own, starts = part_of(code, first[:-1], rows)
                own_tf = part_of(tf, first[:-1], rows)[0]
                at = np.repeat(np.arange(len(rows)), np.diff(np.append(starts, len(own))))
                order = np.argsort(own, kind="stable")
                own, own_tf, at = own[order], own_tf[order], at[order]
                cut = np.flatnonzero(np.diff(own, prepend=np.int32(-1)))
                edges = np.append(cut, len(own)).astype(np.int32)
                wide = own_tf.astype(np.int64)
                best = np.maximum.reduceat(1_000_000_000 * wide // (1000 * wide + 8 * m[rows][at]), cut)
                shard, none = pa.array(np.full(len(cut) + 1, place + made)), pa.nulls(1)
                listed = lambda x, width: pa.concat_arrays([pa.BinaryArray.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(edges * width), pa.py_buffer(x.tobytes())]), none.cast(pa.binary())])
                ids = t.column("doc_id").take(pa.array(rows)).combine_chunks()
                ids = pa.concat_arrays([pa.nulls(len(cut), pa.list_(ids.type)), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)])
                made += 1
                yield pa.RecordBatch.from_arrays(
                    [shard, pa.concat_arrays([names.take(pa.array(own[cut])), none.cast(pa.string())]), listed(at.astype("<u2"), 2), listed(own_tf.astype("<u4"), 4), pa.concat_arrays([pa.array(best), none.cast(pa.int64())]), ids, pa.array([None] * len(cut) + [n[rows].astype("<i8").tobytes()], pa.binary())],
                    ["shard", "term", "at", "tf", "best", "ids", "n"],
                )

        for big in batches:
            for k in range(0, big.num_rows, 500):
                b = big.slice(k, 500)
                held.append(b)
                bytes_held += b.nbytes
                if bytes_held > 2 * ARRANGED_BYTES or sum(x.num_rows for x in held) > 2 * ARRANGED:
                    yield from put()
                    held, bytes_held = [], 0
        if held:
            yield from put()

    parts = max(1, math.ceil(number / ARRANGED), math.ceil(size / ARRANGED_BYTES))
    ordered = rows.repartitionByRange(parts, "leaf", F.xxhash64("terms"), "row").sortWithinPartitions("leaf", F.xxhash64("terms"), "row")
    table = materialise(ordered.select("doc_id", "n", "terms", "tfs").mapInArrow(shards, f"shard long, term string, at binary, tf binary, best long, ids array<{kind}>, n binary"), "search-index", "zstd")
    forget(rows)
    return Index(table, number, length)


def search(index: Index, queries: DataFrame, best: int = BEST, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of queries its `best` documents with a score above 0.

    A term's weight w is floor(1000 * ln((2 N + 2) / (2 df + 1))), a document's score the sum over the query's terms,
    repeats included, of w * (10**9 tf div (1000 tf + 8 m)), m = 25 + 75 n N div L. Equal scores go by id, null ones
    last. Queries without a term, null ones too, have no row; queries that repeat are answered each. An empty index or
    table of queries gives an empty result.
    """
    spark = queries.sparkSession
    base = queries.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    doc_kind, item_kind = index.table.schema["ids"].dataType.elementType.simpleString(), base.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {doc_kind}, score long")
    block: list[tuple] = []
    terms: set[bytes] = set()
    for r in base.where("text is not null").toLocalIterator():  # a block is in memory at a time
        words = term_counts(r["text"])
        if block and len(terms | words.keys()) * (len(block) + 1) > MATRIX:
            out = out.unionByName(search_block(index, block, sorted(terms), best, item_kind))
            block, terms = [], set()
        if words:
            block.append((r["item_id"], words))
            terms |= words.keys()
    return out.unionByName(search_block(index, block, sorted(terms), best, item_kind)) if block else out


def search_block(index: Index, block: list[tuple], terms: list[bytes], best: int, item_kind: str) -> DataFrame:
    spark = index.table.sparkSession
    sc = spark.sparkContext
    code = {t: k for k, t in enumerate(terms)}
    asked = spark.createDataFrame([(t.decode(), k) for t, k in code.items()], "term string, t int")
    lists = materialise(index.table.where("term is not null").join(F.broadcast(asked), "term").select("shard", "t", "at", "tf", "best"), "search-lists", "zstd")
    df = {r["t"]: r["df"] for r in lists.groupBy("t").agg((F.sum(F.octet_length("at")) / 2).cast("long").alias("df")).collect()}  # a row for each term of the block
    weight = np.zeros(len(terms), np.int64)
    for t, n in df.items():
        weight[t] = math.floor(1000 * math.log((2 * index.documents + 2) / (2 * n + 1)))
    # term by term: the queries that ask for it, and its weight times its repeats there
    wanted: list[list[tuple[int, int]]] = [[] for _ in terms]
    for q, (_, words) in enumerate(block):
        for term, repeats in words.items():
            wanted[code[term]].append((q, repeats * int(weight[code[term]])))
    sent = sc.broadcast([(np.array([q for q, _ in own], np.int64), np.array([w for _, w in own], np.int64)) for own in wanted])
    queries, number, length, doc_kind = len(block), index.documents, index.length, index.table.schema["ids"].dataType.elementType.simpleString()

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard, t, most = (b.column(c).to_numpy() for c in range(3))
            for s in np.unique(shard):
                total = np.zeros(queries, np.int64)
                for k, x in zip(t[shard == s], most[shard == s], strict=True):
                    q, w = sent.value[k]
                    total[q] += w * x
                q = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), s)), pa.array(q.astype(np.int32)), pa.array(total[q])], ["shard", "q", "bound"])

    bound = lists.select("shard", "t", "best").mapInArrow(bounds, "shard long, q int, bound long").groupBy("q", "shard").agg(F.sum("bound").alias("bound"))
    order = Window.partitionBy("q").orderBy(F.col("bound").desc(), "shard")
    bound = materialise(bound.withColumn("turn", F.row_number().over(order)), "search-bounds")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches):
            t = table.column("t").to_pylist()
            own = t.index(None)  # the shard's documents
            n = np.frombuffer(table.column("n")[own].as_py(), "<i8")
            m = lengths(n, number, length)
            ids = table.column("ids")[own].values
            asking = np.array(table.column("qs")[own].as_py(), np.int64)
            column = np.full(queries, -1)
            column[asking] = np.arange(len(asking))
            total = np.zeros((len(n), len(asking)), np.int64)
            for k, at, tf in zip(t, table.column("at").to_pylist(), table.column("tf").to_pylist(), strict=True):
                if k is None:
                    continue
                q, w = sent.value[k]
                here = column[q] >= 0
                if here.any():
                    at, tf = np.frombuffer(at, "<u2").astype(np.int64), np.frombuffer(tf, "<u4").astype(np.int64)
                    total[at[:, None], column[q[here]][None, :]] += (1_000_000_000 * tf // (1000 * tf + 8 * m[at]))[:, None] * w[here][None, :]
            by_id = np.empty(len(n), np.int64)
            by_id[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(n))
            for k, q in enumerate(asking):
                x = total[:, k]
                least = max(1, int(np.partition(x, -best)[-best]) if len(x) > best else 1)
                at = np.flatnonzero(x >= least)
                at = at[np.lexsort((by_id[at], -x[at]))][:best]
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), q, np.int32)), ids.take(pa.array(at)), pa.array(x[at]), pa.array(np.full(len(at), table.column("shard")[0].as_py())), pa.array(at)], ["q", "doc_id", "score", "shard", "at"])

    shape = f"q int, doc_id {doc_kind}, score long, shard long, at long"
    found = spark.createDataFrame([], shape)
    before, least, after, more = None, {}, 0, FIRST
    places = index.table.where("term is null").select("shard", "ids", "n")
    empty: Column = F.lit(None)
    while True:
        stops = spark.createDataFrame([(q, least.get(q, 0)) for q in range(queries)], "q int, least long")
        # equal bounds count: a document of the same score may have a lesser id
        left = bound.where(F.col("turn") > after).join(F.broadcast(stops), "q").where("bound >= least")
        if left.isEmpty():
            break
        visits = left.where(F.col("turn") <= after + more).groupBy("shard").agg(F.collect_list("q").alias("qs"))
        rows = lists.select("shard", "t", "at", "tf", empty.cast(f"array<{doc_kind}>").alias("ids"), empty.cast("binary").alias("n"))
        rows = rows.unionByName(places.select("shard", empty.cast("int").alias("t"), empty.cast("binary").alias("at"), empty.cast("binary").alias("tf"), "ids", "n"))
        own = rows.join(visits, "shard").select("shard", "t", "at", "tf", "ids", "n", F.when(F.col("t").isNull(), F.col("qs")).alias("qs"))
        # by another expression than the join's: an equal partitioning would be left out, and lost where the join is broadcast
        fresh = own.repartition(F.xxhash64("shard")).sortWithinPartitions("shard").mapInArrow(score, shape)
        place = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "shard", "at")
        found = materialise(found.unionByName(fresh).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= best).drop("rank"), "search-found")
        forget(before)
        before = found
        least = {r["q"]: r["least"] for r in found.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") == best).collect()}  # a row for each query
        after, more = after + more, more * MORE
    forget(lists, bound)
    items = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(block)], f"q int, item_id {item_kind}")
    place = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "shard", "at")
    return found.withColumn("rank", F.row_number().over(place)).join(F.broadcast(items), "q").select("item_id", "rank", "doc_id", "score")
