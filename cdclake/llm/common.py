"""Helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.sources.shared import new_path

#: The white space of the text contracts: U+0020 and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"

def materialise(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: cuts the lineage, and a lost executor costs no rerun."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def forget(*tables: DataFrame | None) -> None:
    """Delete what materialise() wrote for these tables, which nothing may read any more."""
    for t in tables:
        if t is not None:
            delete_path(t.sparkSession, t.written_at)


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def list_path(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(hadoop)] if fs.exists(hadoop) else []


#: A key is hot from this share of the rows on (and so many rows), so there are at most as many hot keys as its inverse.
HOT_SHARE, HOT_ROWS, SALTS = 1 / 1000, 1000, 64


def join_counted(rows: DataFrame, few: DataFrame, on: str, number: str, total: int, how: str = "inner") -> DataFrame:
    """rows joined with few, whose column number says in how many of the total rows its value of on is.

    few has one row for each value. Rows of hot values are dealt over SALTS tasks, each of which gets few's row.
    Columns that begin with _hot_ are taken.
    """
    is_hot = F.col(number) > max(HOT_ROWS, int(total * HOT_SHARE))
    hot = few.where(is_hot).select(F.col(on).alias("_hot_key"))  # 1 / HOT_SHARE rows at most
    salt = F.when(F.col("_hot_key").isNotNull(), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).otherwise(F.lit(0))
    dealt = rows.join(F.broadcast(hot), F.col(on) == F.col("_hot_key"), "left").withColumn("_hot_salt", salt.cast("int")).drop("_hot_key")
    copies = F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    return dealt.join(few.withColumn("_hot_salt", copies), [on, "_hot_salt"], how).drop("_hot_salt")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id as text, which decides who is held out."""
    return F.crc32(doc_id.cast("string").cast("binary"))


#: bytes.translate() by this makes A to Z small and leaves other bytes, those of other characters too.
SMALL = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def own_texts(texts: pa.Array, small: bool = False) -> pa.Array:
    """An array of texts, perhaps a slice of another, in buffers of its own; null counts as empty. small: A to Z in lower case.

    Arrow's ascii_lower goes wrong on a slice that was cast, so it isn't used.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, edges, data = texts.buffers()
    edges = np.frombuffer(edges, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    own = data.slice(edges[0], edges[-1] - edges[0]).to_pybytes() if data is not None and len(texts) else b""
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(edges - edges[0]), pa.py_buffer(own.translate(SMALL) if small else own))


#: Bytes of a text that are split at once.
PIECE = 1 << 20


def term_pieces(text: str | bytes, table: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, some at a time; table: what bytes.translate() makes of it, spaces between terms."""
    data = (text.encode() if isinstance(text, str) else text).translate(table)
    at = 0
    while at < len(data):
        stop = data.find(b" ", at + PIECE)
        stop = len(data) if stop < 0 else stop
        yield data[at:stop].split()
        at = stop


def slices(b: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most so many bytes of text, or of one row."""
    size = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < b.num_rows:
        stop = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
        yield b.slice(at, stop - at)
        at = stop
