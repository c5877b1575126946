"""Training-order materialisation: a keyed permutation gives every sequence a global slot, slots go to fixed-stride shards.

The permutation is a Feistel network over the least even number of bits that holds all indices; an image beyond the
last index walks its cycle until it falls inside. A shard holds a range of slots in slot order, each in a record of
the same size, so the record of slot s begins at (s mod shard_rows) * stride of shard s div shard_rows: readers go
through shards sequentially and resume anywhere. Each shard is written by one task, which gets its range of slots.

A record is the number of ids (unsigned 16 bits), the ids (unsigned 16 bits each, little-endian, filled up with the
end id) and one line feed. Shards are written by Spark's own text writer, so only committed files appear, in any
store that Spark reaches; the bytes pass through it as they are.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdclake.llm.common import delete_path, forget, list_path, materialise
from cdclake.llm.tokens import token_pieces
from cdclake.sources.shared import new_path

ROUNDS = 6


def mixed(x: np.ndarray, key: int) -> np.ndarray:
    """A hash of each 64-bit number, another for each key (splitmix64's finaliser)."""
    x = x + np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def round_keys(key: int) -> list[int]:
    return [int(k) for k in mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), key & (1 << 64) - 1)]


def permute(index: np.ndarray, total: int, key: int, inverse: bool = False) -> np.ndarray:
    """The slot of each index of 0 to total - 1; inverse: the index of each slot."""
    half = np.uint64(max(1, (max(total - 1, 1).bit_length() + 1) // 2))
    low = np.uint64((1 << int(half)) - 1)
    keys = round_keys(key)
    x = np.asarray(index).astype(np.uint64)
    todo = np.arange(len(x))
    with np.errstate(over="ignore"):
        while len(todo):
            a, b = x[todo] >> half, x[todo] & low
            if inverse:
                for k in reversed(keys):
                    a, b = b ^ (mixed(a, k) & low), a
            else:
                for k in keys:
                    a, b = b, a ^ (mixed(b, k) & low)
            x[todo] = a << half | b
            todo = todo[x[todo] >= total]
    return x.astype(np.int64)


def write_shards(docs: DataFrame, tokenizer_path: str, out: str, *, sequence_ids: int = 256, end_id: int = 50256, key: int = 1, shard_rows: int = 1 << 16, waves: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write every sequence of docs to its shard under out; return where each one is.

    A sequence is a piece of a document (see token_pieces) of at most sequence_ids ids. Returns one row for each:
    doc_id, piece, start, length, ids_crc32 (of the 16-bit ids), slot, shard, byte_offset; slots are 0 to the number
    of sequences less 1. Null and empty texts are one sequence of the end id each, a text of any length is as many
    sequences as it takes; an empty table writes no shard. Ids of documents may be null or repeat: equal sequences
    share their row, which of them gets which slot doesn't matter. Other columns are not read. More than 65535
    sequence_ids, or ids above 65535, raise ValueError.

    The slot of a sequence is worked out once, when it is stored with the others of its wave (a run of shards). Each
    wave then goes to its shards by one shuffle, a task for each shard, and leaves the store; so the shuffle and the
    store never hold more than the sequences once. A wave replaces its shards, so that it can be written again, as can
    the whole: shards beyond the last one that an earlier call left under out go.
    """
    if not 0 < sequence_ids <= 0xFFFF or not 0 <= end_id <= 0xFFFF:
        raise ValueError("lengths and ids have 16 bits")
    spark = docs.sparkSession
    pieces = token_pieces(docs, tokenizer_path, sequence_ids, end_id, id_col, text_col, width=2)
    # numbered by (writing task, place in its output), which the stored table fixes: no shuffle to give out indices
    pieces = pieces.select("*", F.crc32("ids").alias("ids_crc32"), F.monotonically_increasing_id().alias("_to_id"))
    by_wave = new_path(spark, "order-slots")
    stored = materialise(pieces, "order-sequences", "zstd")
    task = F.shiftrightunsigned("_to_id", 33).alias("_to_task")
    sizes = stored.groupBy(task).agg(F.count(F.lit(1)).alias("rows"))  # a row for each task
    before = (F.sum("rows").over(Window.orderBy("_to_task")) - F.col("rows")).alias("_to_before")
    sizes = materialise(sizes.select("_to_task", "rows", before), "order-tasks")
    total = sizes.agg(F.sum("rows")).first()[0] or 0
    shards = -(-total // shard_rows)
    each = -(-shards // waves) or 1

    @F.pandas_udf("long")
    def slot_of(index: pd.Series) -> pd.Series:
        return pd.Series(permute(index.to_numpy(), total, key))

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    own = stored.select(*names, "ids", task, F.col("_to_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_to_own"))
    slots = own.join(sizes.drop("rows"), "_to_task").select(*names, "ids", slot_of(F.col("_to_before") + F.col("_to_own")).alias("slot"))
    slots = slots.withColumn("shard", F.expr(f"slot div {shard_rows}"))
    slots.withColumn("wave", F.expr(f"cast(shard div {each} as int)")).write.partitionBy("wave").option("compression", "zstd").parquet(by_wave)
    forget(stored, sizes)
    index = materialise(spark.read.schema(slots.drop("ids").schema).parquet(by_wave).drop("wave"), "order-index")

    hexed = F.lpad(F.hex("length"), 4, "0")
    head = F.unhex(F.concat(F.substring(hexed, 3, 2), F.substring(hexed, 1, 2)))
    record = F.concat(head, F.rpad("ids", 2 * sequence_ids, F.lit(struct.pack("<H", end_id))))
    for wave, first in enumerate(range(0, shards, each)):
        rows = spark.read.schema(slots.schema).parquet(f"{by_wave}/wave={wave}").select("shard", "slot", record.cast("string").alias("record"))
        rows = rows.repartitionById(min(each, shards - first), (F.col("shard") - first).cast("int")).sortWithinPartitions("shard", "slot")
        rows.drop("slot").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").option("maxRecordsPerFile", 0).text(out)
        delete_path(spark, f"{by_wave}/wave={wave}")
    for name in list_path(spark, out):
        if name.startswith("shard=") and int(name.removeprefix("shard=")) >= shards:
            delete_path(spark, f"{out}/{name}")
    return index.withColumn("byte_offset", F.col("slot") % shard_rows * (2 * sequence_ids + 3))


def read_slots(spark: SparkSession, out: str, first: int, number: int, *, sequence_ids: int = 256, shard_rows: int = 1 << 16) -> Iterator[np.ndarray]:
    """The ids of the sequences in slots first to first + number - 1, in slot order; stops after the last slot there is."""
    stride = 2 * sequence_ids + 3
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    slot, stop = first, first + number
    while slot < stop:
        folder = jvm.org.apache.hadoop.fs.Path(f"{out}/shard={slot // shard_rows}")
        fs = folder.getFileSystem(conf)
        if not fs.exists(folder):
            return
        (file,) = [s for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
        rows = min(stop - slot, shard_rows - slot % shard_rows, file.getLen() // stride - slot % shard_rows)
        if rows <= 0:
            return
        stream = fs.open(file.getPath())
        try:
            stream.seek(slot % shard_rows * stride)
            data = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, rows * stride))
        finally:
            stream.close()
        for k in range(rows):
            (n,) = struct.unpack_from("<H", data, k * stride)
            yield np.frombuffer(data, "<u2", n, k * stride + 2)
        slot += rows
