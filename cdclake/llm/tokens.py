"""Token ids of whole texts by a byte-level BPE file."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: How byte-level tokenizers of this family split text (a fixed value of the format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters on whose classes all versions of Unicode agree. Other texts go to the library that the file is for.
SETTLED = re.compile("[\x00-\u024f\u0370-\u0377\u0391-\u03a1\u03a3-\u03ff\u0410-\u044f\u2010-\u2027\u2030-\u205e\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]*")
#: Byte-level files write a byte that isn't a printable Latin-1 character as one from U+0100 on, in order.
_odd = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
BYTE_OF = {chr(b): b for b in range(256) if b not in _odd} | {chr(256 + k): b for k, b in enumerate(_odd)}


class ByteBPE:
    """encode() gives ids as little-endian unsigned 32-bit bytes, those of the tokenizers library with the same file.

    Where the file's merges are in the order of their ids, its vocabulary is a table of ranks, which a faster encoder
    takes; else, and for texts with unsettled characters or with runs of white space that are too long for that
    encoder's pattern, the library itself encodes.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.fast = self.ranked(json.load(open(path, encoding="utf-8")))

    @staticmethod
    def ranked(spec: dict) -> tiktoken.Encoding | None:
        model, splitter, added = spec["model"], spec["pre_tokenizer"], spec["added_tokens"]
        vocab, merges = model["vocab"], model["merges"]
        order = [vocab["".join(m)] for m in merges]
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        plain &= spec["normalizer"] is None and splitter == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": splitter.get("trim_offsets"), "use_regex": True}
        plain &= not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if not plain or order != sorted(order) or len(vocab) != 256 + len(merges) or order[0] != 256:
            return None
        ranks = {bytes(map(BYTE_OF.__getitem__, t)): i for t, i in vocab.items()}
        return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={t["content"]: t["id"] for t in added})

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.fast is not None and SETTLED.fullmatch(text):
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()
            except ValueError:  # its pattern gives up on runs of some million spaces, which the library takes
                pass
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_made: dict[str, ByteBPE] = {}


def byte_bpe(path: str) -> ByteBPE:
    """This worker's tokenizer, which its tasks share."""
    if path not in _made:
        _made[path] = ByteBPE(path)
    return _made[path]


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """One row for each piece of each row of docs: doc_id, piece int, start long, length long, ids binary.

    A document is its text's ids (null text: none) and end_id. Documents longer than capacity are cut into pieces of
    capacity ids, of which the first may be shorter. ids are little-endian, unsigned, of width bytes (4 or 2; an id
    too large for 2 fails the job). Ids of documents may be null or repeat, each row stands for itself. Other columns
    are not read.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for big in batches:
            for at in range(0, big.num_rows, 500):
                b = big.slice(at, 500)
                row, piece, start, length, ids = [], [], [], [], []
                for k, own in enumerate(map(bpe.encode, b.column(1).to_pylist())):
                    own += end
                    n = len(own) // 4
                    if width == 2:
                        wide = np.frombuffer(own, "<u4")
                        if wide.max() > 0xFFFF:
                            raise ValueError(f"id {wide.max()} takes more than 2 bytes")
                        own = wide.astype("<u2").tobytes()
                    first = (n - 1) % capacity + 1
                    for j in range(1 + (n - first) // capacity):
                        a, z = (0, first) if j == 0 else (first + (j - 1) * capacity, first + j * capacity)
                        row.append(k), piece.append(j), start.append(a), length.append(z - a), ids.append(own[width * a : width * z])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInArrow(run, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids binary")
