"""Source divergence audit: how the terms of each source differ from its language's and from those of other sources.

Four passes:

1. each task counts in how many of its documents a (language, term) occurs, in a count-min sketch whose counters stop at
   LEAST; tasks' sketches are added up block by block. No counter is less than the frequency of a term that it counts;
2. a second scan counts occurrences and documents of terms; those that the merged sketch rules out (a counter below
   LEAST) are thrown away before the shuffle, and survivors are counted exactly;
3. kept terms meet their group's totals and give each group its greatest terms;
4. groups of a language meet on the terms that both have. Their values are summed up where they meet, by list of a
   term's groups, and corrected for the terms that one of them lacks by a histogram of each group's values.

The sketch has the same size for any corpus (ROWS times WIDTH counters). Where it is full, it rules out less; results are
exact all the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdclake.llm.common import SALTS, join_counted, materialise, slices, term_pieces

#: Documents of a language that a term must be in, and ranks of terms that are reported.
LEAST, RANKS = 3, 200
#: The sketch: counters of a row, and of a block of the merge. Both rows come from one 64-bit hash.
ROWS, WIDTH, BLOCK = 2, 1 << 26, 1 << 16
#: Up to so many (language, source) groups are sent to all executors.
FEW_GROUPS = 100_000
#: Bytes of text whose terms a task counts at once, bytes of counts that it holds, and terms that are Python objects at once.
COUNTED, HELD, HASHED = 4 << 20, 32 << 20, 100_000
BILLION = 1_000_000_000
#: BILLION times a count below this is a 64-bit number.
WHOLE = 9_000_000_000
#: Pairs of groups whose sums are held as an array, not sorted.
CELLS = 1 << 20
#: What bytes.translate() makes of a text: letters A to Z small, other ASCII characters but a to z into spaces.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def places(lang: str, terms: list[bytes]) -> np.ndarray:
    """The counter of each term in each row of the sketch."""
    head = lang.encode() + b"\0"
    h = np.fromiter((xxhash.xxh3_64_intdigest(head + t) for t in terms), np.uint64, len(terms))
    return np.stack([h % np.uint64(WIDTH), (h >> np.uint64(32)) % np.uint64(WIDTH)]).astype(np.int64)


def blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The rows of all batches (text, lang, source), with about so many bytes of text at a time, or one row."""
    held, size = [], 0
    for b in batches:
        for part in slices(b, 0, most):
            own = pc.sum(pc.binary_length(part.column(0))).as_py() or 0
            if held and size + own > most:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(part)
            size += own
    if held:
        yield pa.Table.from_batches(held)


class Tally(NamedTuple):
    """How often terms[code] occurs in each group that has it, and in how many texts; by group and code."""

    terms: pa.Array
    group: np.ndarray
    code: np.ndarray
    n: np.ndarray
    df: np.ndarray

    @property
    def size(self) -> int:
        return self.terms.nbytes + 24 * len(self.n)


def tally(terms: pa.Array, group: np.ndarray, code: np.ndarray, n: np.ndarray, df: np.ndarray) -> Tally:
    """The same numbers, those of a group and code added up."""
    key = group.astype(np.int64) * max(1, len(terms)) + code
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.diff(key, prepend=-1))
    if not len(at):
        return Tally(terms, group, code, n, df)
    group, code = np.divmod(key[at], len(terms))
    return Tally(terms, group.astype(np.int32), code.astype(np.int32), np.add.reduceat(n[order], at), np.add.reduceat(df[order], at))


def together(parts: list[Tally]) -> Tally:
    """One tally of several."""
    every = pa.chunked_array([p.terms for p in parts], pa.binary()).combine_chunks().dictionary_encode()
    place = np.split(every.indices.to_numpy(), np.cumsum([len(p.terms) for p in parts])[:-1])
    code = np.concatenate([own[p.code] for own, p in zip(place, parts, strict=True)])
    return tally(every.dictionary, np.concatenate([p.group for p in parts]), code, np.concatenate([p.n for p in parts]), np.concatenate([p.df for p in parts]))


def terms_of(texts: list[bytes]) -> Tally:
    """The terms of texts, each of which is a group."""
    data = b" ".join([b"", *texts, b""]).translate(TERMS)
    inside = np.frombuffer(data, np.uint8) != 32
    cuts = np.flatnonzero(inside[1:] != inside[:-1]) + 1  # where a term begins or ends, in turn
    edges = np.zeros(len(cuts) // 2 + 1, np.int32)
    np.cumsum(cuts[1::2] - cuts[::2], out=edges[1:])
    first = np.cumsum([1] + [len(t) + 1 for t in texts])
    text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(cuts[::2], first)))
    words = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data.translate(None, b" "))]).dictionary_encode()
    size = max(1, len(words.dictionary))
    key = text * size + words.indices.to_numpy()
    key.sort()
    at = np.flatnonzero(np.diff(key, prepend=-1))
    return Tally(words.dictionary, key[at] // size, key[at] % size, np.diff(at, append=len(key)), np.ones(len(at), np.int64))


def terms_of_long(text: bytes) -> Tally:
    """The same of one text, PIECE bytes at a time."""
    one = together([terms_of([]), *(terms_of([b" ".join(words)]) for words in term_pieces(text, TERMS))])
    return one._replace(df=np.ones(len(one.n), np.int64))


def tallies(batches: Iterator[pa.RecordBatch], by: list[int]) -> Iterator[tuple[list[tuple], Tally]]:
    """(groups, tally) of batches (text, lang, source), whose groups are these columns' values."""
    number: dict[tuple, int] = {}
    held: list[Tally] = []
    for block in blocks(batches, COUNTED):
        texts = block.column(0).cast(pa.large_binary()).to_pylist()
        own = terms_of_long(texts[0]) if len(texts) == 1 else terms_of(texts)
        group = np.array([number.setdefault(g, len(number)) for g in zip(*[block.column(c).to_pylist() for c in by], strict=True)])
        held.append(tally(own.terms, group[own.group], own.code, own.n, own.df))
        if sum(t.size for t in held) > HELD:
            held = [together(held)]
            if held[0].size > HELD // 2:
                yield list(number), held[0]
                held, number = [], {}
    if held:
        yield list(number), together(held)


def by_first(first: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(value, where) of each run in an ascending array; long runs in parts."""
    at = np.flatnonzero(np.diff(first, prepend=-1))
    for start, stop in zip(at.tolist(), [*at[1:].tolist(), len(first)], strict=True):
        for k in range(start, stop, HASHED):
            yield int(first[k]), slice(k, min(stop, k + HASHED))


def sketches(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(block, places, counts) of the counters that a task's documents reach."""
        counters = np.zeros((ROWS, WIDTH), np.uint8)  # memory is taken where it is touched
        for langs, t in tallies(batches, [1]):
            df = np.minimum(t.df, least)
            for k, own in by_first(t.group):
                for r, at in enumerate(places(langs[k][0], t.terms.take(pa.array(t.code[own])).to_pylist())):
                    unique, inverse = np.unique(at, return_inverse=True)
                    counters[r, unique] = np.minimum(counters[r, unique] + np.bincount(inverse, df[own]).astype(np.int64), least)
            del t
        for r in range(ROWS):
            at = np.flatnonzero(counters[r])
            block = at // BLOCK
            for k, own in zip(block[np.flatnonzero(np.diff(block, prepend=-1))], np.split(at, np.flatnonzero(np.diff(block)) + 1) if len(at) else [], strict=False):
                yield pa.RecordBatch.from_arrays([pa.array([r * (WIDTH // BLOCK) + int(k)], pa.int32()), pa.array([(own % BLOCK).astype("<u2").tobytes()], pa.binary()), pa.array([counters[r, own].tobytes()], pa.binary())], ["block", "at", "counts"])

    return run


def merged(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(block, bits): which counters of a block reach least, over all tasks."""
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, at, counts in zip(*[b.column(c).to_pylist() for c in range(3)], strict=True):
                own = sums.setdefault(k, np.zeros(BLOCK, np.uint8))
                at = np.frombuffer(at, "<u2")  # distinct
                own[at] = np.minimum(own[at] + np.frombuffer(counts, np.uint8).astype(np.int64), least)
        for k, own in sums.items():
            if (own >= least).any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.packbits(own >= least, bitorder="little").tobytes()], pa.binary())], ["block", "bits"])

    return run


def possible(docs: DataFrame, least: int) -> np.ndarray:
    """Bit by bit, which counters of the merged sketch reach least: ROWS * WIDTH / 8 bytes at most."""
    parts = docs.mapInArrow(sketches(least), "block int, at binary, counts binary").repartition("block").mapInArrow(merged(least), "block int, bits binary")
    bits = np.zeros((ROWS * (WIDTH // BLOCK), BLOCK // 8), np.uint8)
    for r in parts.collect():  # as many rows as blocks, each of a fixed size
        bits[r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return bits.reshape(ROWS, WIDTH // 8)


def counted(docs: DataFrame, least: int) -> DataFrame:
    """(lang, source, term, n, df) of the terms that the sketch lets through: occurrences and documents, exactly."""
    sent = docs.sparkSession.sparkContext.broadcast(possible(docs, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for groups, t in tallies(batches, [1, 2]):
            langs: dict[str, int] = {}
            lang = np.array([langs.setdefault(g[0], len(langs)) for g in groups], np.int64)
            names = list(langs)
            key, place = np.unique(lang[t.group] * max(1, len(t.terms)) + t.code, return_inverse=True)  # a term of several sources is looked up once
            lang, code = np.divmod(key, max(1, len(t.terms)))
            through = np.ones(len(key), bool)
            for k, own in by_first(lang):
                for r, at in enumerate(places(names[k], t.terms.take(pa.array(code[own])).to_pylist())):
                    through[own] &= (bits[r, at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            stays = np.flatnonzero(through[place])
            columns = [pa.array(own, pa.string()) for own in zip(*groups, strict=True)]
            for k in range(0, len(stays), HASHED):
                at = stays[k : k + HASHED]
                own = [*(x.take(pa.array(t.group[at])) for x in columns), t.terms.take(pa.array(t.code[at])).cast(pa.string()), pa.array(t.n[at]), pa.array(t.df[at])]
                yield pa.RecordBatch.from_arrays(own, ["lang", "source", "term", "n", "df"])
            del t, key, code, place, stays

    parts = docs.mapInArrow(run, "lang string, source string, term string, n long, df long")
    parts = parts.repartition("lang", "source", "term")  # a task's rows are counted already: no aggregate before the shuffle
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def probability(count: str, total: str, terms: str) -> Column:
    """1 + floor(BILLION * (count + 1) / (total + terms)) of these columns; null where there is no term."""
    exact = f"(cast({BILLION} as decimal(10,0)) * cast({count} + 1 as decimal(19,0))) div cast({total} + {terms} as decimal(20,0))"
    return F.expr(f"case when {terms} > 0 then 1 + case when {count} < {WHOLE} then ({BILLION} * cast({count} + 1 as bigint)) div ({total} + {terms}) else {exact} end end")


def deviation(p: str, q: str) -> str:
    """(p - q)**2 / q, rounded down, as SQL over whole numbers."""
    return f"((({p}) - ({q})) * (({p}) - ({q}))) div ({q})"


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, and the sum of each one's values."""
    keys, inverse = np.unique(keys, return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, inverse, values)
    return keys, total


def pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, item, value) from terms (lang, own: a list of source, p and z): what each two groups that share terms add to their values."""

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // q

    for big in batches:
        for k in range(0, big.num_rows, 2000):
            b = big.slice(k, 2000)
            langs = pc.dictionary_encode(b.column(0))
            own = b.column(1)
            sizes = own.value_lengths().to_numpy()
            flat = own.flatten()
            sources = pc.dictionary_encode(flat.field(0))
            source, p, z = sources.indices.to_numpy(), flat.field(1).to_numpy(), flat.field(2).to_numpy()
            number = len(sources.dictionary)
            first = np.repeat(np.cumsum(sizes) - sizes, sizes)
            size, lang = np.repeat(sizes, sizes), np.repeat(langs.indices.to_numpy().astype(np.int64), sizes)
            place = np.arange(len(p)) - first
            cells = len(langs.dictionary) * number * number
            dense, hit = (np.zeros(cells, np.int64), np.zeros(cells, bool)) if cells <= CELLS else (None, None)
            keys, values = [], []
            for step in range(1, int(sizes.max(initial=0))):
                i = np.flatnonzero(size > step)
                j = first[i] + (place[i] + step) % size[i]  # each ordered pair of a term's groups once
                value = f(p[i], p[j]) - f(p[i], z[j]) - f(z[i], p[j]) + f(z[i], z[j])
                key = (lang[i] * number + source[i]) * number + source[j]
                if dense is None:
                    key, total = summed(key, value)
                    keys.append(key), values.append(total)
                else:
                    np.add.at(dense, key, value)
                    hit[key] = True
            if dense is not None:
                key = np.flatnonzero(hit)
                total = dense[key]
            elif keys:
                key, total = summed(np.concatenate(keys), np.concatenate(values))
            else:
                continue
            if len(key):
                take = lambda dictionary, at: dictionary.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([take(langs.dictionary, key // number // number), take(sources.dictionary, key // number % number), take(sources.dictionary, key % number), pa.array(total)], ["lang", "source", "item", "value"])


def with_others(rows: DataFrame, stats: DataFrame, few: bool, salt: Column) -> DataFrame:
    """rows, each with item and z_item of every group of its language but its own."""
    others = stats.select(F.col("lang").alias("_lang"), F.col("source").alias("item"), F.col("z").alias("z_item"))
    if few:
        out = rows.join(F.broadcast(others), F.col("lang") == F.col("_lang"))
    else:  # a language may hold most rows: they are dealt over SALTS tasks
        dealt = others.withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = rows.withColumn("_salt", F.pmod(salt, F.lit(SALTS)).cast("int")).join(dealt, (F.col("lang") == F.col("_lang")) & (F.col("_salt") == F.col("_other")))
    return out.where("source <> item")


def divergence(docs: DataFrame, least: int = LEAST, ranks: int = RANKS, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): how each (lang, source) group of docs differs from others.

    Terms are runs of letters A to Z, small, and of characters beyond ASCII; a language keeps those that at least
    `least` of its rows hold. p of a term is 1 + floor(10**9 * (count + 1) / (N + V)), N the group's occurrences of
    kept terms, V their number. Part `pair`: item is another source of the language, value the sum over kept terms of
    (p - q)**2 / q rounded down, q the item's p (0 if the language keeps no term). Part `term`: item is a term of the
    group with p > q, q the language's p, value the same for it alone; the first `ranks` of them. Ranks go by value,
    descending, then by item's UTF-8. Nulls in any of the columns count as empty text, which is a language or a source
    like others. Repeated rows count each, texts of any length whole. An empty table gives an empty result. Other
    columns are not read.
    """
    base = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    kept = counted(base, least).groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("own")).where(F.col("df") >= least)
    kept = materialise(kept.select("lang", "term", "total", "own"), "audit-kept")  # a term's sources are one row
    entries = kept.select("lang", "term", "total", F.explode("own").alias("o")).select("lang", "term", "total", "o.source", "o.n")
    sums = entries.groupBy("lang", "source").agg(F.sum("n").alias("n_group"), F.count(F.lit(1)).alias("terms"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("n_lang"))
    stats = base.groupBy("lang", "source").count().select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["n_group", "terms", "v", "n_lang"])
    zero = stats.withColumn("_none", F.lit(0))
    stats = materialise(zero.select("lang", "source", "n_group", "terms", "v", "n_lang", probability("_none", "n_group", "v").alias("z")), "audit-groups")
    few = stats.count() <= FEW_GROUPS

    group = lambda lang, source: F.concat(F.length(lang).cast("string"), F.lit(":"), lang, source)
    if few:
        known = entries.join(F.broadcast(stats), ["lang", "source"])
    else:
        keyed = stats.where("terms > 0").select(group("lang", "source").alias("_group"), "n_group", "terms", "v", "n_lang", "z")
        known = join_counted(entries.withColumn("_group", group("lang", "source")), keyed, "_group", "terms", entries.count()).drop("_group")
    known = known.select("lang", "source", "term", "z", probability("n", "n_group", "v").alias("p"), probability("total", "n_lang", "v").alias("q"))

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = known.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(deviation("p", "q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)  # cut before the shuffle, too

    shape = "lang string, source string, item string, value long"
    together = known.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "z")).alias("own")).where(F.size("own") > 1)
    shared = together.select("lang", "own").mapInArrow(pair_sums, shape)
    alone = with_others(known.groupBy("lang", "source", "p", "z").agg(F.count(F.lit(1)).alias("n")), stats, few, F.col("p"))
    here = F.struct("source", "item", F.expr(f"n * ({deviation('p', 'z_item')} - {deviation('z', 'z_item')})").alias("value"))
    there = F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.expr(f"n * ({deviation('z_item', 'p')} - {deviation('z_item', 'z')})").alias("value"))
    lacking = alone.select("lang", F.explode(F.array(here, there)).alias("o")).select("lang", "o.*")
    neither = with_others(stats.select("lang", "source", "v", "z"), stats, few, F.xxhash64("source")).select("lang", "source", "item", F.expr(f"coalesce(v * ({deviation('z', 'z_item')}), 0)").alias("value"))
    pairs = neither.unionByName(lacking).unionByName(shared).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(terms)
