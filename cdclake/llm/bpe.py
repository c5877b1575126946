"""BPE encoding and decoding of whole texts, exactly as the tokenizers library does it.

Text falls apart at ASCII white space into chunks, which this kind of tokenizer (white space dropped) encodes one
by one. Arrow splits a batch of texts and numbers its distinct chunks, so Python meets each distinct part of a batch
once, and a cache answers for those seen before; ids and decoded texts are put together from the numbers in Arrow.

A chunk of LONG characters or more is encoded by tree concatenation: its leaves are encoded as one batch (the library
spreads a batch over the cores it may use), then neighbours are joined pair by pair. At each join a window of tokens
around the seam is encoded again and grows until its first token is the left side's and its last token the right
side's. As every pair of neighbouring tokens then comes from an encoding of its own, the joined list is what encoding
the whole chunk gives. Shorter chunks are a leaf each: there is nothing to join.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Encoding, Tokenizer, models

from cdclake.llm.common import own_texts, slices

#: Chunks of at least so many characters are encoded by tree concatenation, from leaves of so many characters.
LONG, LEAF = 512, 128
#: Entries of a worker's cache, in two generations; bytes of text that are worked on at a time.
CACHE, BYTES_EACH = 400_000, 4 << 20
#: Up to here, letters compose and change case one by one.
LATIN = "\u024f"
#: Chunks of these characters only, without the one letter whose lower case is two; then a letter or digit and the signs behind it.
PLAIN = r"^[\x{00}-\x{12f}\x{131}-\x{24f}]*$"
ENDS = r"(?s)^(?P<body>.*[\p{L}\p{N}])(?P<signs>[^\p{L}\p{N}\s\x{0b}\x{85}\x{a0}]+)$"
#: Byte-level tokenizers write a byte that isn't a printable Latin-1 character as one from U+0100 on, in order.
_odd = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
BYTES = {b: chr(256 + k) for k, b in enumerate(_odd)}
#: The kind of file whose texts fall apart at white space (fixed values of the format).
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
OPEN = "<|"


def falls_apart(spec: dict) -> bool:
    """Whether a tokenizer file is of that kind: no text of it needs more than its chunks, nor decoding more than its tokens."""
    model, splitter = spec["model"], spec["pre_tokenizer"] or {}
    fine = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    fine &= spec["decoder"] is None and spec["post_processor"] is None
    fine &= spec["normalizer"] == {"type": "Sequence", "normalizers": NORMALIZERS}
    parts = splitter.get("pretokenizers", [])
    fine &= [p["type"] for p in parts] == ["Split", "ByteLevel"] and parts[0] == {"type": "Split", "pattern": {"Regex": WORDS}, "behavior": "Removed", "invert": True}
    fine = fine and not parts[1]["add_prefix_space"] and not parts[1]["use_regex"]
    for t in spec["added_tokens"]:
        fine &= OPEN in t["content"] and len(t["content"].split()) == 1 and t["content"].strip() == t["content"]
        fine &= not any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    return fine


class WordBPE:
    """A tokenizer of words with end-of-word suffix, whose normaliser and splitter drop white space.

    Files of other kinds (see falls_apart) are left to the library, text by text.
    """

    def __init__(self, path: str, long: int = LONG, leaf: int = LEAF, cache: int = CACHE):
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        spec = json.load(open(path, encoding="utf-8"))
        self.apart = falls_apart(spec)
        self.vocab = self.whole.get_vocab(with_added_tokens=True)
        self.names = {i: s for s, i in self.vocab.items()}
        self.long, self.leaf, self.most = long, leaf, cache // 2
        self.ids: dict[str, bytes] = {}  # of each part seen lately, as 32-bit numbers
        self.older: dict[str, bytes] = {}
        self.trees = 0  # parts that were encoded by tree concatenation
        if not self.apart:
            return
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(m) for m in model["merges"]]
        self.inside = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges))  # a part that doesn't end its word
        self.ending = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=self.suffix or None))
        self.special = re.compile("(" + "|".join(re.escape(t["content"]) for t in spec["added_tokens"]) + ")") if spec["added_tokens"] else None
        self.spaced = pa.array([" " + self.names.get(i, "") for i in range(max(self.names) + 1)], pa.large_string())

    def remember(self, new: Iterable[str]) -> None:
        """Encode parts, none of which is in the cache."""
        words, mixed = [], []
        for p in new:
            if len(p) >= self.long:
                self.ids[p] = array("i", self.encode_long(p)).tobytes()
            elif p.isalpha() and (p.isascii() or max(p) <= LATIN) and p.islower() and p == p.lower():
                words.append(p)
            else:
                mixed.append(p)
        # a word of plain letters is one unsplit word already: past the normaliser and the splitter
        self.put(words, self.ending.encode_batch_fast([p if p.isascii() else p.encode().decode("latin-1").translate(BYTES) for p in words], add_special_tokens=False))
        self.put(mixed, self.whole.encode_batch_fast(mixed, add_special_tokens=False))

    def put(self, parts: list[str], encoded: list[Encoding]) -> None:
        for p, e in zip(parts, encoded, strict=True):
            self.ids[p] = array("i", e.ids).tobytes()

    def encoded(self, parts: pa.Array) -> pa.Array:
        """The ids of distinct parts. Parts that the last two generations of the cache don't know are encoded."""
        wanted = parts.to_pylist()
        if len(self.ids) > self.most:
            self.ids, self.older = {}, self.ids
        older = self.older
        new = []
        for p in wanted:
            if p not in self.ids:
                if p in older:
                    self.ids[p] = older[p]
                else:
                    new.append(p)
        self.remember(new)
        return pa.array([self.ids[p] for p in wanted], pa.large_binary())

    def chunk_ids(self, chunks: pa.Array) -> pa.Array:
        """The ids of distinct chunks. Case and the signs at their ends come off where they don't matter: more chunks share their parts."""
        plain = pc.and_(pc.match_substring_regex(chunks, PLAIN), pc.invert(pc.match_substring(chunks, OPEN)))  # else a special token, whose case counts
        body = pc.if_else(plain, pc.utf8_lower(chunks), chunks)
        cut = pc.extract_regex(body, ENDS)
        ends = pc.and_(plain, pc.is_valid(cut))
        body = pc.if_else(ends, cut.field("body"), body).dictionary_encode()
        signs = pc.if_else(ends, cut.field("signs"), "").dictionary_encode()
        return pc.binary_join_element_wise(self.encoded(body.dictionary).take(body.indices), self.encoded(signs.dictionary).take(signs.indices), pa.scalar(b"", pa.large_binary()))

    def encode_long(self, text: str) -> list[int]:
        self.trees += 1
        out: list[int] = []
        for k, part in enumerate(self.special.split(text) if self.special else [text]):
            if k % 2:
                out.append(self.vocab[part])
            elif part:
                for word, _ in self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(part)):
                    out += map(self.vocab.__getitem__, self.tree(word))
        return out

    def tree(self, word: str) -> list[str]:
        """The tokens of one unsplit word."""
        leaves = [word[k : k + self.leaf] for k in range(0, len(word), self.leaf)]
        level = [e.tokens for e in self.inside.encode_batch(leaves[:-1], add_special_tokens=False)]
        level.append(self.ending.encode(leaves[-1], add_special_tokens=False).tokens)
        while len(level) > 1:
            last = len(level) - 1
            level = [self.join(level[k], level[k + 1], k + 1 == last) if k < last else level[k] for k in range(0, len(level), 2)]
        return level[0]

    def join(self, left: list[str], right: list[str], ends: bool) -> list[str]:
        """The tokens of the text of left and right; ends: right ends its word."""
        size = 2
        while True:
            a, b = min(size, len(left)), min(size, len(right))
            text = "".join(left[-a:]) + "".join(right[:b])
            at_end = ends and b == len(right)
            tokens = self.ending.encode(text.removesuffix(self.suffix)).tokens if at_end else self.inside.encode(text).tokens
            if (a == len(left) or tokens[0] == left[-a]) and (b == len(right) or tokens[-1] == right[b - 1]):
                return left[:-a] + tokens + right[b:]
            size *= 2

    def encode_texts(self, texts: pa.Array) -> tuple[pa.ListArray, pa.Array]:
        """Token ids and decoded text of each text; null counts as empty."""
        texts = own_texts(texts)
        if not self.apart:
            ids = [e.ids for e in self.whole.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            return pa.array(ids, pa.list_(pa.int32())), pa.array([self.whole.decode(i, skip_special_tokens=False) for i in ids], pa.string())
        split = pc.ascii_split_whitespace(texts)
        chunks = split.values.dictionary_encode()
        of_chunk = self.chunk_ids(chunks.dictionary)
        joined = pc.binary_join(pa.LargeListArray.from_arrays(split.offsets.cast(pa.int64()), of_chunk.take(chunks.indices)), pa.scalar(b"", pa.large_binary()))
        _, ends, data = joined.buffers()
        ends = np.frombuffer(ends, np.int64)[joined.offset : joined.offset + len(joined) + 1] // 4
        ids = np.frombuffer(data, np.int32)[: ends[-1]] if ends[-1] else np.empty(0, np.int32)
        # no decoder is set: tokens joined by spaces
        decoded = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends), self.spaced.take(pa.array(ids))), pa.scalar("", pa.large_string()))
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)), pc.utf8_slice_codeunits(decoded, 1).cast(pa.string())


_made: dict[str, WordBPE] = {}


def word_bpe(path: str) -> WordBPE:
    """This worker's tokenizer, whose cache the tasks share."""
    if path not in _made:
        _made[path] = WordBPE(path)
    return _made[path]


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, ids array<int>, decoded string.

    ids are those of encode(text, add_special_tokens=False) by the tokenizer file at path, which executors must
    find there too; decoded is decode(ids, skip_special_tokens=False). Null text counts as empty and gives no ids
    and an empty string; ids may be null or repeat, each row stands for itself. An empty table gives an empty result.
    A text of any length is encoded whole, in memory that grows with that text alone. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for big in batches:
            for b in slices(big, 1, BYTES_EACH):
                yield pa.RecordBatch.from_arrays([b.column(0), *bpe.encode_texts(b.column(1))], ["doc_id", "ids", "decoded"])

    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInArrow(run, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")
