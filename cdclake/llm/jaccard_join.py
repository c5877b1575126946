"""N-gram Jaccard join by chosen paths: all pairs of documents whose five-word shingle sets have a likeness of 0.8 or more.

Documents with equal sets are one class from the start; the join runs on one set of each class. A set's coordinates
are one-permutation minima of its hashed shingles, so choosing a coordinate samples a token that alike sets share.
In each run the root splits on PICKS coordinates, each large bucket splits again on PICKS coordinates of its own, and
small buckets are compared by brute force; runs repeat until a pair at the threshold is met with probability RECALL.
A bucket that splitting doesn't make smaller (its sets are all alike) is compared by brute force in blocks.

Pairs are never written out: a comparison emits a number of links and a local component for each set. A pair that
meets in several buckets counts in the first of them only, which both sets' bucket lists tell. First come sketches
(sets that meet nobody likely drop out), then exact sets, so every link is verified and every count exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm.common import forget, join_counted, materialise

WORDS, THRESHOLD = 5, 0.8
COORDINATES = 64
PICKS, RECALL = 2, 0.9999
#: Bytes of a text that are hashed at a time.
BLOCK = 1 << 20
#: Sets that one task compares with each other at a time; larger buckets split.
BUCKET = 512
DEPTH = 5
#: A bucket isn't split if a part of it would keep this share.
DENSE = 0.6
#: A pair of sets of ESTIMATED shingles or more goes to exact verification if so many of its coordinates agree. Of a
#: pair at the threshold 51.2 do, with a standard deviation of 3.3 (few bins are empty), so that less than one pair in
#: a million is lost here; it is part of what RECALL leaves out. Smaller sets all go to exact verification.
MAYBE, ESTIMATED, LOST = 0.5, 256, 1e-6

MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15 | 1
BYTE = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse modulo 2**64, to the powers 0 to n - 1."""
    if len(_powers[0]) < n:
        for k, b in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            step = np.full(2 * n, b, np.uint64)
            step[0] = 1
            _powers[k] = np.multiply.accumulate(step)
    return _powers[0][:n], _powers[1][:n]


def shingle_set(text: str | None) -> np.ndarray:
    """Hashes of the runs of five words, ascending and distinct; a text of fewer words is one run, an empty one has none."""
    w = word_hashes(text)
    if not len(w):
        return w
    n = max(1, len(w) - WORDS + 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(WORDS, len(w))):
        h = h * MIX1 + w[k : k + n]
    return np.unique(mixed(h))


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word between ASCII white space: block by block, a word that goes on in the next one too."""
    data = (text or "").encode()
    out, open_sum, open_length = [], np.uint64(0), 0  # of a word that the last block didn't end
    for at in range(0, len(data), BLOCK):
        b = np.frombuffer(data, np.uint8, min(BLOCK, len(data) - at), at)
        word = (b != 32) & ((b < 9) | (b > 13))
        edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False]))))
        start, stop = edge[::2], edge[1::2]
        up, down = powers(len(b) + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE[b] * up[: len(b)], dtype=np.uint64)))
        sums, sizes = (total[stop] - total[start]) * down[start], (stop - start).astype(np.uint64)
        if open_length and word[0]:
            sums[:1] = sums[:1] * np.uint64(pow(BASE, open_length, 1 << 64)) + open_sum
            sizes[0] += np.uint64(open_length)
        elif open_length:
            sums, sizes = np.append(open_sum, sums), np.append(np.uint64(open_length), sizes)
        open_sum, open_length = np.uint64(0), 0
        if word[-1]:
            open_sum, open_length = sums[-1], int(sizes[-1])
            sums, sizes = sums[:-1], sizes[:-1]
        out.append(mixed(sums + sizes))
    if open_length:
        out.append(mixed(np.array([open_sum], np.uint64) + np.uint64(open_length)))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """COORDINATES minima as 32-bit numbers; an empty bin borrows from the first filled one in its own random order."""
    bins = (hashes >> np.uint64(58)).astype(np.int64)  # 64 of them
    first = np.flatnonzero(np.diff(bins, prepend=-1))  # hashes ascend
    out, full = np.zeros(COORDINATES, np.uint32), np.zeros(COORDINATES, bool)
    out[bins[first]] = (hashes[first] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    full[bins[first]] = True
    if len(first) < COORDINATES:
        empty = np.flatnonzero(~full)
        out[empty] = out[ORDER[empty, full[ORDER[empty]].argmax(1)]]
    return out


ORDER = np.stack([np.random.default_rng(100 + k).permutation(COORDINATES) for k in range(COORDINATES)])


def runs() -> int:
    """How many runs meet a pair at the threshold with probability RECALL, at any depth."""
    q = 1.0
    for _ in range(50):  # a pair goes on if some coordinate agrees and the pair goes on below
        q = 1 - (1 - THRESHOLD * q) ** PICKS
    return math.ceil(math.log(1 - RECALL - LOST) / math.log(1 - q))


def children(nodes: np.ndarray, sketches: np.ndarray, picks: int) -> np.ndarray:
    """For each row, picks nodes below its node: the same coordinates for all rows of a node, then their values."""
    out = np.empty((len(nodes), picks), np.uint64)
    seed = mixed(nodes + np.uint64(0x51))
    at = (seed % np.uint64(COORDINATES)).astype(np.int64)
    step = (mixed(seed) % np.uint64(COORDINATES // 2)).astype(np.int64) * 2 + 1  # odd: another coordinate for each pick
    for k in range(picks):
        c = (at + k * step) % COORDINATES
        out[:, k] = mixed(mixed(nodes + c.astype(np.uint64)) ^ sketches[np.arange(len(nodes)), c].astype(np.uint64))
    return out


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one unit at a time from batches sorted by their first column."""
    rest: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        rest = t if rest is None else pa.concat_tables([rest, t])
        unit = rest.column(0).to_numpy()
        cut = np.flatnonzero(np.diff(unit)) + 1
        for a, z in zip([0, *cut[:-1]], cut, strict=False):
            yield rest.slice(a, z - a)
        if len(cut):
            rest = rest.slice(cut[-1])
    if rest is not None and rest.num_rows:
        yield rest


def met_first(node: int, lists: list[np.ndarray]) -> np.ndarray:
    """Which pairs of rows have this node as the first that is in both rows' lists."""
    out = np.ones((len(lists), len(lists)), bool)
    members: dict[int, list[int]] = {}
    for k, own in enumerate(lists):
        for other in own:
            if other < node:
                members.setdefault(int(other), []).append(k)
    for rows in members.values():
        if len(rows) > 1:
            out[np.ix_(rows, rows)] = False
    return out


def candidates(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Of a unit (columns unit, node, side, two_sided, sid, n, leaves, ...): pairs that it has to compare, as a matrix above the diagonal; sizes."""
    n = t.column("n").to_numpy()
    side = t.column("side").to_numpy()
    node = t.column("node")[0].as_py()
    pairs = np.triu(met_first(node, [np.array(x) for x in t.column("leaves").to_pylist()]), 1)
    if t.column("two_sided")[0].as_py():
        pairs &= side[:, None] != side[None, :]
    return pairs & (np.minimum(n[:, None], n[None, :]) >= THRESHOLD * np.maximum(n[:, None], n[None, :]) - 1e-9), n


def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, sid) of sets that may have a link whose first common bucket is the node."""
    for t in groups(batches):
        pairs, n = candidates(t)
        if not pairs.any():
            continue
        s = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint32).reshape(-1, COORDINATES)
        small = n < ESTIMATED
        equal = np.zeros(pairs.shape, np.uint8)
        for c in range(COORDINATES):
            equal += s[:, None, c] == s[None, :, c]
        pairs &= (equal >= MAYBE * COORDINATES) | small[:, None] | small[None, :]
        keep = pairs.any(0) | pairs.any(1)
        if keep.any():
            yield pa.RecordBatch.from_arrays([t.column("node").combine_chunks().filter(pa.array(keep)), t.column("sid").combine_chunks().filter(pa.array(keep))], ["node", "sid"])


def intersections(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs asked for."""
    out = np.zeros(pairs.shape, np.int64)
    a, b = np.nonzero(pairs)
    if len(a) < 4 * len(sets):
        for i, j in zip(a, b, strict=True):
            out[i, j] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return out
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, token, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often[token] > 1
    row, token = row[shared], token[shared]
    _, token = np.unique(token, return_inverse=True)
    order = np.argsort(token, kind="stable")
    row, token = row[order], token[order]
    for at in range(0, (token[-1] + 1) if len(token) else 0, 4096):
        lo, hi = np.searchsorted(token, (at, at + 4096))
        x = np.zeros((len(sets), 4096), np.float32)
        x[row[lo:hi], token[lo:hi] - at] = 1
        out += (x @ x.T).astype(np.int64)
    return out


def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sid, documents linked with it here, least sid that it is connected with here)."""
    for t in groups(batches):
        pairs, n = candidates(t)
        if not pairs.any():
            continue
        sets = [np.frombuffer(x, np.uint64) for x in t.column("hashes").to_pylist()]
        both = intersections(sets, pairs)
        linked = pairs & (both >= THRESHOLD * (n[:, None] + n[None, :] - both) - 1e-9)
        linked |= linked.T
        keep = np.flatnonzero(linked.any(0))
        if not len(keep):
            continue
        sid, members = t.column("sid").to_numpy(), t.column("members").to_numpy()
        number = linked @ members
        root = sid.copy()
        while True:
            low = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(1))
            if (low == root).all():
                break
            root = low
        yield pa.RecordBatch.from_arrays([pa.array(sid[keep]), pa.array(number[keep]), pa.array(root[keep])], ["sid", "links", "root"])


def units(rows: DataFrame) -> DataFrame:
    """(node, sid, ...) to units of comparison: a bucket of at most BUCKET sets is one, a larger one is cut into pairs of blocks."""
    sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > BUCKET)
    sized = join_counted(rows, sizes, "node", "rows", rows.count(), "left").withColumn("blocks", F.coalesce(F.ceil(F.col("rows") / BUCKET).cast("int"), F.lit(1)))
    sized = sized.withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    sized = sized.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return sized.select(F.xxhash64("node", low, high).alias("unit"), "node", F.col("block").alias("side"), (F.col("block") != F.col("other")).alias("two_sided"), *[c for c in rows.columns if c != "node"])


def components(edges: DataFrame) -> DataFrame:
    """(sid, label) for every sid in edges (sid, root): the least sid that it is connected with. A sid or label of many rows is dealt over many tasks."""
    both = edges.select("sid", F.col("root").alias("to")).union(edges.select(F.col("root").alias("sid"), F.col("sid").alias("to"))).where("sid <> to").distinct()
    both = materialise(both, "join-edges")
    total = both.count()
    # edges go both ways, so as many come from a sid as lead to it
    before = materialise(both.groupBy("sid").agg(F.least(F.col("sid"), F.min("to")).alias("label"), F.count(F.lit(1)).alias("edges")), "join-labels")
    label = before
    number = label.count()
    while True:
        near = join_counted(both, label.withColumnRenamed("sid", "to"), "to", "edges", total).groupBy("sid").agg(F.min("label").alias("near"))
        low = materialise(label.join(near, "sid").select("sid", "edges", "label", F.least("label", "near").alias("low")), "join-lows")
        jump = low.groupBy("low").agg(F.count(F.lit(1)).alias("rows")).join(label.select(F.col("sid").alias("low"), F.col("label").alias("far")), "low")
        after = join_counted(low, jump, "low", "rows", number)
        after = materialise(after.select("sid", "edges", F.least("low", "far").alias("label"), (F.least("low", "far") < F.col("label")).alias("moved")), "join-labels")
        label = after.drop("moved")
        forget(low, before)
        before = after
        if after.where("moved").isEmpty():
            forget(both)
            return label.drop("edges")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, class_id, n_links, set_id, kept, text_md5.

    n_links: other rows whose shingle set has a likeness of 0.8 or more, those with the same set included. class_id:
    the least doc_id of the rows connected through links (null if they have none but null). set_id: the least doc_id
    with the same set. kept: marks one row of each class, of its least doc_id (rows that repeat id and text are marked
    alike); text_md5, of the text, tells rows apart that share an id. Texts without words (null too) have the empty
    set, alike among themselves only. Repeated rows count each. Texts of any length count whole. An empty table gives
    an empty result. Other columns are not read.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.md5(F.coalesce(text_col, F.lit("")).cast("binary")).alias("text_md5"))
    kind = base.schema["doc_id"].dataType.simpleString()

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for b in batches:
            key, n, own = [], [], []
            for text in b.column(1).to_pylist():
                h = shingle_set(text)
                key.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest()), n.append(len(h))
                own.append(sketch(h).tobytes() if len(h) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(key, pa.binary()), pa.array(n, pa.int64()), pa.array(own, pa.binary())], ["doc_id", "text_md5", "key", "n", "sketch"])

    rows = materialise(base.mapInArrow(summarise, f"doc_id {kind}, text_md5 string, key binary, n long, sketch binary"), "join-rows")
    sets = rows.groupBy("key").agg(F.min("doc_id").alias("set_id"), F.count(F.lit(1)).alias("members"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    sets = materialise(sets.withColumn("sid", F.monotonically_increasing_id()), "join-sets")

    leaves = None
    roots = np.arange(1, runs() + 1, dtype=np.uint64) * np.uint64(BASE)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(-1, COORDINATES)
            out = np.concatenate([children(np.full(len(s), r), s, PICKS) for r in roots], 1).astype(np.int64)
            sid = np.repeat(b.column(0).to_numpy(), out.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(out.ravel()), pa.array(np.zeros(out.size, np.int64)), pa.array(sid)], ["node", "parent", "sid"])

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint32).reshape(-1, COORDINATES)
            node = b.column(0).to_numpy()
            out = children(node.view(np.uint64), s, PICKS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(out.ravel()), pa.array(np.repeat(node, PICKS)), pa.array(np.repeat(b.column(1).to_numpy(), PICKS))], ["node", "parent", "sid"])

    shape = "node long, parent long, sid long"
    level = sets.where("n > 0").select("sid", "sketch").mapInArrow(first, shape)
    above: DataFrame | None = None  # the rows of buckets that this level split
    spent = []
    for depth in range(DEPTH + 1):
        level = materialise(level, "join-level")
        spent.append(level)
        sizes = counted = materialise(level.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.first("parent").alias("parent")).where("rows > 1"), "join-sizes")
        if above is not None:
            # a bucket that keeps most of its rows in a part stays whole
            parents = above.groupBy("node").agg(F.count(F.lit(1)).alias("all"))
            dense = sizes.groupBy("parent").agg(F.max("rows").alias("most")).join(parents.withColumnRenamed("node", "parent"), "parent").where(F.col("most") > F.col("all") * DENSE).select("parent", "all")
            dense = materialise(dense, "join-dense")
            spent.append(dense)
            leaves = leaves.unionByName(join_counted(above, dense.withColumnRenamed("parent", "node"), "node", "all", above.count()).drop("all"))
            sizes = sizes.join(dense, "parent", "left_anti")
        spent.append(counted)
        last = depth == DEPTH
        full = join_counted(level.drop("parent"), sizes.select("node", "rows"), "node", "rows", level.count())
        done = full.where(F.lit(True) if last else F.col("rows") <= BUCKET).drop("rows")
        leaves = done if leaves is None else leaves.unionByName(done)
        if last:
            break
        above = materialise(full.where(F.col("rows") > BUCKET).select("node", "sid"), "join-large")
        spent.append(above)
        if above.isEmpty():
            break
        level = above.join(sets.select("sid", "sketch"), "sid").select("node", "sid", "sketch").mapInArrow(below, shape)
    leaves = materialise(leaves.select("node", "sid").distinct(), "join-leaves")
    forget(*spent)

    lists = leaves.groupBy("sid").agg(F.collect_list("node").alias("leaves"))  # a few for each set
    known = materialise(lists.join(sets.select("sid", "n", "members", "sketch"), "sid"), "join-known")
    fields = ["unit", "node", "side", "two_sided", "sid", "n", "leaves"]

    def compared(rows: DataFrame, extra: DataFrame, columns: list[str], run: Callable, out: str) -> DataFrame:
        asked = units(rows).join(extra, "sid").select(*fields, *columns)
        return asked.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, out)

    near = materialise(compared(leaves, known, ["sketch"], likely, "node long, sid long").distinct(), "join-likely")
    forget(leaves)

    wanted = near.select("sid").distinct().join(sets.select("sid", "key", "set_id"), "sid")
    texts = base.join(wanted.select(F.col("set_id").alias("_id")).distinct(), F.col("doc_id").eqNullSafe(F.col("_id"))).select("text")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for big in batches:
            for k in range(0, big.num_rows, 500):
                found = [shingle_set(t).tobytes() for t in big.column(0).slice(k, 500).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([hashlib.blake2b(h, digest_size=16).digest() for h in found], pa.binary()), pa.array(found, pa.binary())], ["key", "hashes"])

    hashes = texts.mapInArrow(exact, "key binary, hashes binary").join(wanted.select("key", "sid"), "key").dropDuplicates(["sid"]).select("sid", "hashes")
    hashes = materialise(known.drop("sketch").join(hashes, "sid"), "join-exact")
    forget(known)
    found = materialise(compared(near, hashes, ["members", "hashes"], links, "sid long, links long, root long"), "join-links")
    forget(near, hashes)

    label = components(found.select("sid", "root"))
    number = found.groupBy("sid").agg(F.sum("links").alias("links"))
    named = sets.select("sid", "key", "set_id", "members").join(number, "sid", "left").join(label, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    labelled = named = materialise(named, "join-labelled")
    forget(sets, found)
    first_of = named.groupBy("label").agg(F.min(F.struct(F.col("set_id").isNull().alias("none"), "set_id", "sid")).alias("first"), F.count(F.lit(1)).alias("sets"))
    named = join_counted(named, first_of, "label", "sets", named.count()).select("members", "key", "set_id", F.col("first.set_id").alias("class_id"), (F.col("first.sid") == F.col("sid")).alias("leads"), (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"))
    # of rows with the leading set and the least id, one text stays
    texts = rows.groupBy("key", "doc_id").agg(F.min("text_md5").alias("least_md5"))
    named = named.join(texts.withColumnRenamed("key", "_key"), (F.col("key") == F.col("_key")) & F.col("set_id").eqNullSafe(F.col("doc_id")) & F.col("leads"), "left")
    named = materialise(named.select("key", "members", "set_id", "class_id", "leads", "n_links", "least_md5"), "join-named")
    forget(labelled)
    kept = F.col("leads") & F.col("doc_id").eqNullSafe(F.col("set_id")) & (F.col("text_md5") == F.col("least_md5"))
    return join_counted(rows.select("doc_id", "text_md5", "key"), named, "key", "members", rows.count()).select("doc_id", "class_id", "n_links", "set_id", kept.alias("kept"), "text_md5")
