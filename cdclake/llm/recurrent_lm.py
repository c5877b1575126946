"""LM scoring by a gated recurrent network in numpy.

Tokens are white-space words in lower case and one end for each text. Counts of all training tokens give the add-one
base and the vocabulary: HEAD most frequent words in classes of CLASS words, whose place in the class the network
predicts too; MID more words (seen twice at least), and all the rest (the tail, with one unknown word), in classes by spelling, inside
which counts decide. Every token so has a probability, and they sum to one: that of its class given the state, times
that of the word in its class.

Training runs truncated backpropagation through time once over all training texts, in ROUNDS; in each,
every partition starts from the same weights and the next round from their average. Texts lie one after the other in parallel
streams; the state is carried from window to window over the whole text. In training, a text that is longer than the
streams otherwise would be lies there in segments, so that it doesn't hold up its task; a forward run beforehand gives
each later segment its first state.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.llm.common import materialise, own_texts, slices

HEAD, CLASS, MID = 2048, 64, 131_072
SIGNS = 8
CLASSES = HEAD // CLASS + 2 * SIGNS
HIDDEN, STREAMS, WINDOW, SCORE_STREAMS, SCORE_WINDOW = 24, 256, 16, 512, 16
RATE = 0.15
#: Shares of the training texts that the rounds learn weights from; they sum to 1, so that each text gives gradients once.
ROUNDS = (1 / 32, 2 / 32, 4 / 32, 8 / 32, 17 / 32)
#: Bytes of text that a task lays in streams at a time (or one longer text); tokens of a segment in training, at least.
BYTES_EACH, SEGMENT = 16 << 20, 1024
#: Counts that are told apart when the vocabulary's least count is looked for.
COMMON = 4096
#: Taken off each tail count for words never seen.
DISCOUNT = 0.75
#: The end of a text among the words; words are never empty.
END = b""


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # ASCII rules for bytes: A-Z, and the six white-space characters


def tokenised(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Tokens of texts (null: empty) one after the other, each text's end included: their places in words; where each text begins, and the last ends; words."""
    split = pc.ascii_split_whitespace(own_texts(texts, small=True))
    found = split.values.dictionary_encode()
    words, code = found.dictionary.cast(pa.large_binary()), found.indices.to_numpy()
    end = pc.index_in(pa.scalar(END, pa.large_binary()), value_set=words).as_py()  # before leading and after closing white space too
    if end is None:
        end, words = len(words), pa.concat_arrays([words, pa.array([END], pa.large_binary())])
    there = code != end
    before = np.concatenate(([0], np.cumsum(there)))[split.offsets.to_numpy()]
    edge = before + np.arange(len(before))
    out = np.full(edge[-1], end, np.int32)
    out[np.arange(before[-1]) + np.repeat(np.arange(len(before) - 1), np.diff(before))] = code[there]
    return out, edge, words


def sign(word: bytes) -> int:
    """A word's class by spelling: letters beyond ASCII or not, and how it ends."""
    last = word[-1:]
    return (not word.isascii()) * 4 + (1 if last == b"," else 2 if last == b"." else 0 if last.isalnum() or last > b"\x7f" else 3)


SIGN_OF_LAST = np.array([sign(b"a" + bytes([b])) % 4 for b in range(256)])


def signs(words: pa.Array) -> np.ndarray:
    """sign() of each of an array of large binaries, none of which is empty."""
    _, edges, data = words.buffers()
    edges = np.frombuffer(edges, np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    beyond = np.concatenate(([0], np.cumsum(data[: edges[-1] if len(edges) else 0] > 127)))
    return SIGN_OF_LAST[data[edges[1:] - 1]] + 4 * (beyond[edges[1:]] > beyond[edges[:-1]])


@dataclass
class Vocabulary:
    total: int  # training tokens
    distinct: int
    symbol: dict[bytes, int]  # of head words 0 to HEAD - 1, of mid words HEAD + rank
    count: np.ndarray  # by symbol
    mid_total: np.ndarray  # training tokens by sign
    tail_total: np.ndarray
    tail_distinct: np.ndarray
    head: int

    @cached_property
    def words(self) -> pa.Array:
        """By symbol."""
        return pa.array(list(self.symbol), pa.large_binary())

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """By symbol: input row (head word, else HEAD + class by spelling) and log10 of the word in its class (head: 0)."""
        n = len(self.count)
        row, within = np.arange(n), np.zeros(n)
        for w, s in self.symbol.items():
            if s >= HEAD:
                k = sign(w)
                row[s], within[s] = HEAD + k, np.log10(self.count[s] / self.mid_total[k])
        return row, within


class Network:
    """Weights as one vector of 32-bit numbers, seen as matrices."""

    def __init__(self, flat: np.ndarray | None = None):
        h, rows = HIDDEN, HEAD + 2 * SIGNS
        shapes = {"E": (rows, 3 * h), "U": (h, 2 * h), "N": (h, h), "C": (h, CLASSES), "c": (CLASSES,), "W": (HEAD // CLASS, h, CLASS), "w": (HEAD // CLASS, CLASS), "s": (h,)}
        size = sum(int(np.prod(s)) for s in shapes.values())
        draw = np.random.default_rng(3)
        self.flat = (draw.standard_normal(size) * 0.1).astype(np.float32) if flat is None else flat
        at = 0
        for name, shape in shapes.items():
            n = int(np.prod(shape))
            setattr(self, name, self.flat[at : at + n].reshape(shape))
            at += n

    @classmethod
    def start(cls, voc: Vocabulary) -> Network:
        """Small random weights, with the classes' and words' shares as biases."""
        net = cls()
        head = np.zeros(HEAD)
        head[: voc.head] = voc.count[: voc.head]
        by_class = head.reshape(-1, CLASS)
        # tail classes get the mass of their words; the discounted part is already in it
        share = np.concatenate((by_class.sum(1), voc.mid_total, voc.tail_total)) + 0.5
        net.c[:] = np.log(share / share.sum())
        net.w[:] = np.where(by_class > 0, np.log(np.maximum(by_class, 1) / np.maximum(by_class.sum(1, keepdims=True), 1)), -30)
        return net

    def run(self, x: np.ndarray, reset: np.ndarray, h: np.ndarray, cut: np.ndarray | None = None, given: np.ndarray | None = None, learn: bool = True) -> tuple[np.ndarray | None, np.ndarray, np.ndarray]:
        """Gates of each step of x (steps x streams) if backward() needs them, states before each step, the state after all.

        reset: a text begins here; cut: a text goes on here, from the given state.
        """
        k, (steps, streams) = HIDDEN, x.shape
        scaled = self.E * np.repeat(np.array([-1, -2], self.E.dtype), (2 * k, k))
        before = np.empty((steps, streams, k), self.E.dtype)
        e = np.take(scaled, x, axis=0)
        gates = np.empty((3, steps if learn else 1, streams, k), self.E.dtype)
        u, n = -self.U, -2 * self.N
        starts, cuts = reset.any(1), cut.any(1) if cut is not None else np.zeros(steps, bool)
        h = h.astype(self.E.dtype)
        with np.errstate(over="ignore"):  # exp of a closed gate
            for t in range(steps):
                if starts[t]:
                    h[reset[t]] = self.s
                if cuts[t]:
                    h[cut[t]] = given[t][cut[t]]
                before[t] = h
                z, r, new = gates[:, t if learn else 0]
                a = h @ u
                a += e[t, :, : 2 * k]
                np.exp(a, out=a)
                a += 1
                np.reciprocal(a[:, :k], out=z)
                np.reciprocal(a[:, k:], out=r)
                a = (r * h) @ n
                a += e[t, :, 2 * k :]
                np.exp(a, out=a)
                a += 1
                np.divide(2, a, out=new)
                new -= 1
                h = h + z * (new - h)
        return gates if learn else None, before, h

    def output(self, before: np.ndarray, row: np.ndarray, learn: bool, into: Network | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """ln of each token's class and, for head words, place in it; before: states (tokens x HIDDEN).

        learn: also the gradient of the mean negative ln by the states, and by the weights, which into gets.
        """
        group = np.where(row < HEAD, row // CLASS, row - HEAD + HEAD // CLASS)
        at = np.arange(len(row))
        logits = before @ self.C
        logits += self.c
        picked = logits[at, group]
        e, total = exponentials(logits)
        out = picked - total[1]
        back = None
        one = np.ones(len(row), before.dtype)
        share = before.dtype.type(1 / max(1, len(row)))
        if learn:
            e *= (share / total[0])[:, None]
            e[at, group] -= share
            np.matmul(before.T, e, out=into.C)
            np.matmul(one, e, out=into.c)
            back = e @ self.C.T
        order = np.argsort(group.astype(np.uint8 if CLASSES <= 256 else np.int32), kind="stable")
        cuts = np.searchsorted(np.take(group, order), np.arange(HEAD // CLASS + 1)).tolist()
        order = order[: cuts[-1]]  # head words, class by class
        b, place, at = np.take(before, order, axis=0), np.take(row, order) % CLASS, at[: len(order)]
        logits = np.empty((len(order), CLASS), before.dtype)
        for g in range(HEAD // CLASS):
            if cuts[g] < cuts[g + 1]:
                own = logits[cuts[g] : cuts[g + 1]]
                np.matmul(b[cuts[g] : cuts[g + 1]], self.W[g], out=own)
                own += self.w[g]
        picked = logits[at, place]
        e, total = exponentials(logits)
        out[order] += picked - total[1]
        if learn:
            e *= (share / total[0])[:, None]
            e[at, place] -= share
            more = np.empty_like(b)
            for g in range(HEAD // CLASS):
                if cuts[g] < cuts[g + 1]:
                    own = e[cuts[g] : cuts[g + 1]]
                    np.matmul(own, self.W[g].T, out=more[cuts[g] : cuts[g + 1]])
                    np.matmul(b[cuts[g] : cuts[g + 1]].T, own, out=into.W[g])
                    np.matmul(one[: len(own)], own, out=into.w[g])
                else:
                    into.W[g], into.w[g] = 0, 0
            back[order] += more
        return out, back

    def gradient(self, x: np.ndarray, reset: np.ndarray, valid: np.ndarray | None, h: np.ndarray, cut: np.ndarray | None = None, given: np.ndarray | None = None, into: Network | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the mean negative ln over the valid tokens (None: all) of a window, as a vector like flat; the state after it; the rows of E that have one.

        into: a network that gets the gradient, whose E is zero.
        """
        k, (steps, streams) = HIDDEN, x.shape
        gates, before, after = self.run(x, reset, h, cut, given)
        g = Network(np.zeros_like(self.flat)) if into is None else into
        states, rows = before.reshape(-1, k), x.ravel()
        if valid is None:
            back = self.output(states, rows, True, g)[1].reshape(before.shape)
        else:
            ok = valid.ravel()
            back = np.zeros((steps * streams, k), before.dtype)
            back[ok] = self.output(states[ok], rows[ok], True, g)[1]
            back = back.reshape(before.shape)
        z, r, new = gates
        rh, stay = r * before, 1 - z
        of_new = z * (1 - new * new)
        of_z = (new - before) * z * stay
        of_r = rh * (1 - r)
        starts, cuts = reset.any(1), cut.any(1) if cut is not None else np.zeros(steps, bool)
        d = np.zeros((streams, k), before.dtype)
        de = np.empty((steps, streams, 3 * k), before.dtype)
        nt, ut = np.ascontiguousarray(self.N.T), np.ascontiguousarray(self.U.T)
        g.s[:] = 0
        for t in range(steps - 1, -1, -1):
            dn = d * of_new[t]
            de[t, :, 2 * k :] = dn
            drh = dn @ nt
            np.multiply(d, of_z[t], out=de[t, :, :k])
            np.multiply(drh, of_r[t], out=de[t, :, k : 2 * k])
            d *= stay[t]
            drh *= r[t]
            d += drh
            d += de[t, :, : 2 * k] @ ut
            d += back[t]
            if starts[t]:
                g.s += d[reset[t]].sum(0)
                d[reset[t]] = 0
            if cuts[t]:
                d[cut[t]] = 0
        de = de.reshape(-1, 3 * k)
        np.matmul(rh.reshape(-1, k).T, de[:, 2 * k :], out=g.N)
        np.matmul(states.T, de[:, : 2 * k], out=g.U)
        order = np.argsort(rows.astype(np.uint16 if HEAD + 2 * SIGNS < 1 << 16 else np.int32), kind="stable")
        rows, de = np.take(rows, order), np.take(de, order, axis=0)
        head = np.searchsorted(rows, HEAD)
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        heads = first[: np.searchsorted(first, head)]
        if len(heads):
            g.E[rows[heads]] = np.add.reduceat(de[:head], heads, axis=0)
        # the rest are a few long runs
        edges = [*first[len(heads) :].tolist(), len(rows)]
        for a, z in zip(edges, edges[1:], strict=False):
            g.E[rows[a]] = np.ones(z - a, de.dtype) @ de[a:z]
        return g.flat, after, rows[first]


def exponentials(logits: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """In place of logits (rows x choices), e to their power but for a factor of each row; by row the sum of these, and ln of the sum without the factor."""
    most = logits.max(initial=-np.inf)
    keep = logits if not len(logits) or most - logits.min() < 80 else None  # else rows may need factors of their own
    if keep is None:
        most = logits.max(1)
        logits -= most[:, None]
    elif len(logits):
        logits -= most
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], logits.dtype)
    return logits, (total, np.log(total) + most)


class Streams:
    """Texts (rows of tokens) laid one after the other in streams of about equal length, the longest first.

    Memory grows with the tokens alone, however unlike the texts' lengths are: windows are cut from one flat row.
    """

    def __init__(self, texts: list[np.ndarray], number: int):
        number = max(1, min(number, len(texts)))
        sizes = np.array([len(t) for t in texts], np.int64)
        own: list[list[int]] = [[] for _ in range(number)]
        heap = [(0, k) for k in range(number)]
        for t in np.argsort(-sizes, kind="stable").tolist():
            n, k = heap[0]
            own[k].append(t)
            heapq.heapreplace(heap, (n + int(sizes[t]), k))
        load = np.zeros(number, np.int64)
        for n, k in heap:
            load[k] = n
        by_load = np.argsort(-load, kind="stable")
        order = np.array([t for k in by_load for t in own[k]], np.int64)
        self.size = load[by_load]
        self.start = np.cumsum(self.size) - self.size
        self.x = np.concatenate([texts[t] for t in order]) if len(order) else np.empty(0, np.int64)
        self.which = np.repeat(order, sizes[order]).astype(np.int32)
        self.first = np.zeros(len(texts), np.int64)  # where each text begins
        self.first[order] = np.cumsum(sizes[order]) - sizes[order]
        self.begins = np.zeros(len(self.x), bool)
        self.begins[self.first] = True

    def windows(self, steps: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]]:
        """Of each window (steps x streams): tokens, begins, places in the flat row, and where something is (None: everywhere). Streams end from the last on."""
        longest = int(self.size[0]) if len(self.size) else 0
        least = int(self.size[-1]) if len(self.size) else 0
        for at in range(0, longest, steps):
            live = len(self.size) if at < least else int(np.count_nonzero(self.size > at))
            step = at + np.arange(min(steps, longest - at))[:, None]
            where, there = self.start[:live] + step, None
            if at + len(step) > self.size[live - 1]:
                there = step < self.size[:live]
                where = np.where(there, where, 0)
            begins = np.take(self.begins, where)
            yield np.take(self.x, where), begins if there is None else begins & there, where, there


def states_at_cuts(net: Network, texts: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """By segment of so many tokens of the texts in turn: whether its text begins there, and the state before it (0 where it begins)."""
    number = np.array([-(-len(t) // size) for t in texts])
    first = np.cumsum(number) - number
    begin = np.zeros(number.sum(), bool)
    begin[first] = True
    states = np.zeros((len(begin), HIDDEN), np.float32)
    long = np.flatnonzero(number > 1)
    if not len(long):
        return begin, states
    h, laid = None, Streams([texts[k][: (number[k] - 1) * size + 1] for k in long], SCORE_STREAMS)
    for x, begins, where, there in laid.windows(SCORE_WINDOW):
        h = np.zeros((x.shape[1], HIDDEN), np.float32) if h is None else h[: x.shape[1]]
        _, before, h = net.run(x, begins, h, learn=False)
        which = laid.which[where]
        place = where - laid.first[which]
        cut = (place > 0) & (place % size == 0)
        if there is not None:
            cut &= there
        states[first[long][which[cut]] + place[cut] // size] = before[cut]
    return begin, states


def train(net: Network, batches: Iterator[list[np.ndarray]]) -> int:
    """One pass over batches of texts; returns the number of tokens. Adaptive steps for each weight.

    A text that is longer than SEGMENT tokens and than the streams would be if all were of one length is cut.
    """
    seen, past, g = 0, Network(np.full_like(net.flat, 1e-6)), Network(np.zeros_like(net.flat))
    rest = slice(net.E.size, None)  # what lies behind E changes at every step
    for texts in batches:
        total = sum(map(len, texts))
        size = max(SEGMENT, -(-total // STREAMS))
        segments = [t[k : k + size] for t in texts for k in range(0, len(t), size)]
        first, states = states_at_cuts(net, texts, size)
        h, laid, whole = None, Streams(segments, STREAMS), first.all()
        for x, start, where, there in laid.windows(WINDOW):
            h = np.zeros((x.shape[1], HIDDEN), np.float32) if h is None else h[: x.shape[1]]
            cut = given = None
            if not whole:
                own = laid.which[where]
                cut, given = start & ~first[own], states[own]
                start = start & first[own]
            _, h, rows = net.gradient(x, start, there, h, cut, given, g)
            e = np.take(g.E, rows, axis=0)
            p = np.take(past.E, rows, axis=0) + e * e
            past.E[rows] = p
            net.E[rows] -= RATE * 0.2 * e / np.sqrt(p)
            g.E[rows] = 0
            e, p, w = g.flat[rest], past.flat[rest], net.flat[rest]
            p += e * e
            w -= RATE * 0.2 * e / np.sqrt(p)
        seen += total
    return seen


def log10_of(net: Network, texts: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each whole text's classes and head words."""
    total, h, laid = np.zeros(len(texts)), None, Streams(texts, SCORE_STREAMS)
    for x, begins, where, there in laid.windows(SCORE_WINDOW):
        h = np.zeros((x.shape[1], HIDDEN), np.float32) if h is None else h[: x.shape[1]]
        _, before, h = net.run(x, begins, h, learn=False)
        if there is None:
            before, x, which = before.reshape(-1, HIDDEN), x.ravel(), laid.which[where.ravel()]
        else:
            before, x, which = before[there], x[there], laid.which[where[there]]
        out, _ = net.output(before, x, False)
        total += np.bincount(which, weights=out, minlength=len(texts))
    return total / np.log(10)


def count(train_texts: DataFrame) -> DataFrame:
    """(word binary, n long) over all tokens of a one-column frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in slices(big, 0, 2 * BYTES_EACH):
                code, _, words = tokenised(b.column(0))
                n = np.bincount(code, minlength=len(words))
                met = pa.array(n > 0)  # not the end, where white space alone made it a word
                yield pa.RecordBatch.from_arrays([words.cast(pa.binary()).filter(met), pa.array(n).filter(met)], ["word", "n"])

    return materialise(train_texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From all counts: totals, and the HEAD + MID most frequent words, which are as many at any size of the corpus."""
    total, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    # a word seen once tells how likely new words are, so it stays in the tail
    often = counts.where(F.col("n") > 1)
    rows, least = 0, 2
    for r in often.groupBy(F.least("n", F.lit(COMMON)).alias("n")).count().orderBy(F.desc("n")).collect():  # COMMON rows at most
        rows, least = rows + r["count"], r["n"]
        if rows >= HEAD + MID:
            break
    # only what can be among the first is sorted
    top = often.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(HEAD + MID).toArrow()
    words, n = [bytes(w) for w in top.column("word").to_pylist()], top.column("n").to_numpy()
    symbol = {w: k for k, w in enumerate(words)}
    head = min(HEAD, len(words))
    size = max(HEAD, len(words))
    number = np.zeros(size, np.int64)
    number[: len(words)] = n
    mid = np.zeros(SIGNS)
    for k in range(HEAD, len(words)):
        mid[sign(words[k])] += n[k]

    def by_spelling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = signs(b.column(0).cast(pa.large_binary()))
            n = b.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(SIGNS)), pa.array(np.bincount(k, minlength=SIGNS)), pa.array(np.bincount(k, weights=n, minlength=SIGNS).astype(np.int64))], ["k", "words", "n"])

    by_sign = {r["k"]: (r["words"], r["n"]) for r in counts.where("length(word) > 0").mapInArrow(by_spelling, "k long, words long, n long").groupBy("k").agg(F.sum("words").alias("words"), F.sum("n").alias("n")).collect()}
    known = np.zeros((SIGNS, 2))
    for w, c in zip(words, n, strict=True):
        if w != END:
            known[sign(w)] += (1, c)
    every = np.array([by_sign.get(k, (0, 0)) for k in range(SIGNS)], float).reshape(SIGNS, 2)
    tail = every - known
    return Vocabulary(int(total or 0), int(distinct), symbol, number, mid, tail[:, 1], tail[:, 0], head)


def rows_of(code: np.ndarray, words: pa.Array, voc: Vocabulary, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Input rows and symbols (-1: tail) of tokens, by their places in words."""
    of_word = pc.fill_null(pc.index_in(words, value_set=voc.words), -1).to_numpy().astype(np.int64)
    tail = np.flatnonzero(of_word < 0)
    row_of = row[of_word].astype(np.int32)
    # the end may be unknown too, if nothing was learned; like a word that ends in another sign
    row_of[tail] = HEAD + SIGNS + signs(pc.if_else(pc.equal(words, END), pa.scalar(b"-", pa.large_binary()), words).take(pa.array(tail)))
    return np.take(row_of, code), np.take(of_word, code)


def fit(train_texts: DataFrame, voc: Vocabulary) -> Network:
    """The network after one pass over the training texts (columns text, draw from 0 to below 1)."""
    context = train_texts.sparkSession.sparkContext
    sent = context.broadcast((voc, *voc.tables()))  # HEAD + MID words at any size
    net = Network.start(voc)
    parts, low = 32, 0.0
    for share in ROUNDS:
        flat = context.broadcast(net.flat)

        def run(batches: Iterator[pa.RecordBatch], flat=flat) -> Iterator[pa.RecordBatch]:
            voc, row, _ = sent.value
            own = Network(flat.value.copy())

            def read(b: pa.RecordBatch) -> list[np.ndarray]:
                code, edge, words = tokenised(b.column(0))
                return np.split(rows_of(code, words, voc, row)[0], edge[1:-1])

            n = train(own, (read(b) for big in batches for b in slices(big, 0, BYTES_EACH)))
            if n:
                pieces = np.array_split(own.flat.astype(np.float64) * n, parts)
                yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array([n] * parts, pa.int64()), pa.array([p.tobytes() for p in pieces], pa.binary())], ["part", "n", "weights"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, tuple[int, np.ndarray]] = {}
            for b in batches:
                for part, n, w in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    m, x = total.get(part, (0, 0.0))
                    total[part] = (m + n, x + np.frombuffer(w))
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([n for n, _ in total.values()], pa.int64()), pa.array([x.tobytes() for _, x in total.values()], pa.binary())], ["part", "n", "weights"])

        shape = "part int, n long, weights binary"
        chosen = train_texts.where((F.col("draw") >= low) & (F.col("draw") < low + share)).select("text")
        summed = chosen.mapInArrow(run, shape).repartition(parts, "part").mapInArrow(add, shape).collect()  # one network
        if summed:
            by = {r["part"]: np.frombuffer(r["weights"]) / r["n"] for r in summed}
            net = Network(np.concatenate([by[k] for k in range(parts)]).astype(np.float32))
        low += share
    return net


def score_texts(docs: DataFrame, train_where: Column, id_col: str = "doc_id", text_col: str = "text", network: bool = True) -> DataFrame:
    """One row for each row of docs: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Rows of docs where train_where holds teach. score is the model's log10 probability of the whole text, its end
    included; base_score that of add-one counts. Null text counts as empty, which has one token; equal texts score
    alike to six digits, as sums are of 32-bit numbers in another order. With nothing to learn from, every token is
    unknown. Rows that repeat, or share an id, each count; rows with a null id teach too. A text of any length is scored
    whole, in memory that grows with its tokens. An empty table gives an empty result. Other columns than those named
    are not read. network False: all columns but score, which alone needs a network; none is trained or run.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(train_where, F.lit(False)).alias("teaches"))
    draw = F.pmod(F.xxhash64(F.lit(5), F.col("doc_id").cast("string")), F.lit(1 << 20)) / float(1 << 20)
    train_texts = base.where("teaches").select("text", draw.alias("draw"))
    counts = count(train_texts.select("text"))
    voc = vocabulary(counts)
    net = fit(train_texts, voc) if network else None
    context = docs.sparkSession.sparkContext
    sent = context.broadcast((voc, *voc.tables(), net.flat if network else None))
    kind = base.schema["doc_id"].dataType.simpleString()
    floor = np.log10(voc.total + voc.distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, row, within, flat = sent.value
        net, base_of = Network(flat) if network else None, np.log10(voc.count + 1) - floor
        for big in batches:
            for b in slices(big, 1, BYTES_EACH):
                code, edge, words = tokenised(b.column(1))
                rows, symbol = rows_of(code, words, voc, row)
                text = np.repeat(np.arange(b.num_rows), np.diff(edge))
                tail = symbol < 0
                own_row, own = text[~tail], symbol[~tail]
                known = np.bincount(own_row, minlength=b.num_rows)
                base = np.bincount(own_row, weights=base_of[own], minlength=b.num_rows)
                score = np.bincount(own_row, weights=within[own], minlength=b.num_rows)
                if network:
                    score = score + log10_of(net, np.split(rows, edge[1:-1]))
                ends = np.concatenate(([0], np.cumsum(np.bincount(text[tail], minlength=b.num_rows)))).astype(np.int32)
                unsure = pa.ListArray.from_arrays(pa.array(ends), words.take(pa.array(code[tail])).cast(pa.binary()))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(edge)), pa.array(known), pa.array(base, pa.float64()), pa.array(score, pa.float64()), unsure], ["doc_id", "n_tokens", "known", "base", "score", "tail"])

    shape = f"doc_id {kind}, n_tokens long, known long, base double, score double, tail array<binary>"
    scored = materialise(base.select("doc_id", "text").mapInArrow(run, shape).withColumn("row", F.monotonically_increasing_id()), "lm-scored", "zstd")

    # each distinct word is one row of counts, so its hash deals them evenly; a word of many rows is split by adaptive execution
    tail = scored.select("row", F.explode("tail").alias("word")).join(counts.hint("shuffle_hash"), "word", "left")
    last = F.substring("word", -1, 1)
    kind_of = F.when(last == F.lit(b","), 1).when(last == F.lit(b"."), 2).when((last > F.lit(b"\x7f")) | F.hex(last).rlike("^(3[0-9]|[46][1-9A-F]|[57][0-9A])$"), 0).otherwise(3)
    beyond = F.octet_length("word") != F.char_length(F.col("word").cast("string"))
    k = kind_of + F.when(beyond, 4).otherwise(0)
    total, unseen = F.array([F.lit(float(x)) for x in voc.tail_total]), F.array([F.lit(float(DISCOUNT * x)) for x in voc.tail_distinct])
    mass = F.when(F.col("n").isNull(), F.get(unseen, k)).otherwise(F.col("n") - DISCOUNT)
    # a class without tail words in training holds the unknown word alone
    share = F.when(F.get(total, k) > 0, mass / F.get(total, k)).otherwise(F.lit(1.0))
    sums = tail.groupBy("row").agg(
        F.count("n").alias("known2"),
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1) - float(floor)).alias("base2"),
        F.sum(F.log10(share)).alias("score2"),
    )
    out = scored.drop("tail").join(sums, "row", "left")
    out = out.select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("known2", F.lit(0))).alias("n_known"),
        F.lit(voc.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("score2", F.lit(0.0))).alias("score"),
    )
    return out if network else out.drop("score")
