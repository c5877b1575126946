"""Files of a batch's writers: a file ends at so many rows, or so long after its first row, and both counts start anew.

Where a file ends depends on where the one before did, so no window function tells it. Each row can tell, though, where a
file would end that began with it: its next pointer. Files are what the pointers reach from a writer's first row. A
writer of any number of rows is dealt over many tasks by its order, and then in blocks of its places. A block is entered
at one of the rows of its first file, whatever lies before it; for these rows alone it tells where their files leave it.
Over these, which are few, the entries are found by pointer doubling: the jump over 2, 4, 8 ... blocks is the one before,
taken twice. Each block then follows its pointers from its entry. All rows are shuffled a fixed number of times.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.sources.shared import written

#: Rows that a task orders at a time, and rows of a block.
TASK_ROWS = 250_000


def _meet(left: DataFrame, right: DataFrame, writer: list[str], on: list[tuple[str, str]], keep: dict[str, str], how: str = "inner") -> DataFrame:
    """left with columns of right (keep: their new names) where the writers are the same (nulls alike) and the pairs of on equal."""
    names = [*writer, *[b for _, b in on]]
    own = right.select(*[F.col(c).alias(f"_of_{k}") for k, c in enumerate(names)], *[F.col(c).alias(f"_get_{c}") for c in keep])
    same = F.lit(True)
    for k, c in enumerate(writer):
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{k}"))
    for k, (a, _) in enumerate(on, len(writer)):
        same = same & (F.col(a) == F.col(f"_of_{k}"))
    return left.join(own, same, how).select(*left.columns, *[F.col(f"_get_{c}").alias(name) for c, name in keep.items()])


def _in_order(rows: DataFrame, writer: list[str], order: list[str], keep: list[Column | str], parts: int) -> DataFrame:
    """Columns keep of rows with _row: a number that grows along a task's rows, which are a run of a writer's order, and with the task."""
    dealt = rows.repartitionByRange(parts, *writer, *order) if parts > 1 else rows.repartition(1)
    numbered = dealt.sortWithinPartitions(*writer, *order).select(*keep, F.monotonically_increasing_id().alias("_row"))
    return written(numbered, "flush-order")  # its cuts are drawn anew in each run


def _runs(ordered: DataFrame, writer: list[str]) -> DataFrame:
    """Of each task's run of a writer: _task, its rows (_n), its first _row, and the writer's rows before it."""
    runs = ordered.groupBy(*writer, F.shiftright("_row", 33).alias("_task")).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*writer).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task of a writer
    return written(runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))), "flush-runs")


def _placed(ordered: DataFrame, runs: DataFrame, writer: list[str], name: str) -> DataFrame:
    """ordered with each row's place, from 1, in its writer's order."""
    tasks = ordered.withColumn("_task", F.shiftright("_row", 33))
    met = _meet(tasks, runs, writer, [("_task", "_task")], {"_first": "_first", "_before": "_before"})
    return met.withColumn(name, F.col("_row") - F.col("_first") + F.col("_before") + 1).drop("_row", "_task", "_first", "_before")


def _whole_blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
    """Whole blocks, some at a time, of batches in the order of their blocks and places; by row, the first row of its block, the row
    after its last, and the row that next leads to if the block has it."""
    kept: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        kept.append(b)
        rows += b.num_rows
        if rows >= size:
            table = pa.Table.from_batches(kept)
            cut = int(np.flatnonzero(_begins(table, size))[-1])
            if cut:
                yield _laid(table.slice(0, cut), size)
                kept, rows = table.slice(cut).combine_chunks().to_batches(), table.num_rows - cut
    if rows:
        yield _laid(pa.Table.from_batches(kept), size)


def _begins(table: pa.Table, size: int) -> np.ndarray:
    return (table.column("_i").to_numpy() - 1) % size == 0


def _laid(table: pa.Table, size: int) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    heads = np.flatnonzero(_begins(table, size))
    sizes = np.diff(heads, append=table.num_rows)
    to = np.arange(table.num_rows) + table.column("_next").to_numpy() - table.column("_i").to_numpy()
    return table, np.repeat(heads, sizes), np.repeat(heads + sizes, sizes), to


def _exits(nexts: DataFrame, writer: list[str], size: int, parts: int) -> DataFrame:
    """Of each row that a file may begin with which is the first to begin in its block (_i): where the first file after the
    block begins (_next), and the files that begin in between, its own with them (_files)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first, end, to in _whole_blocks(batches, size):
            inside = to < end
            last, hops = np.where(inside, to, np.arange(len(to))), inside.astype(np.int64)
            while not np.array_equal(more := last[last], last):
                hops += hops[last]
                last = more
            i, next_ = table.column("_i").to_numpy(), table.column("_next").to_numpy()
            entry = pa.array(i <= next_[first])  # next pointers never cross
            out = table.select(writer).append_column("_i", table.column("_i")).append_column("_next", pa.array(next_[last])).append_column("_files", pa.array(hops + 1))
            yield from out.filter(entry).combine_chunks().to_batches()

    shape = T.StructType([*[nexts.schema[c] for c in writer], *T.StructType.fromDDL("_i long, _next long, _files long").fields])
    blocks = nexts.select(*writer, "_i", "_next", "_block").repartition(parts, *writer, "_block").sortWithinPartitions(*writer, "_i")
    return written(blocks.drop("_block").mapInArrow(run, shape), "flush-next")


def _entries(exits: DataFrame, writer: list[str]) -> DataFrame:
    """Those rows of exits that files do begin with."""

    def follow(left: DataFrame, jump: DataFrame, on: str) -> DataFrame:
        """left with _then: where the pointer of its place `on` leads; rows beyond the writer's last drop out."""
        return _meet(left, jump, writer, [(on, "_i")], {"_next": "_then"})

    jump = exits.select(*writer, "_i", "_next")
    jumps = [jump]
    while not jump.isEmpty():  # as often as a writer's blocks can be halved
        jump = written(follow(jump, jump, "_next").select(*writer, "_i", F.col("_then").alias("_next")), "flush-next")
        jumps.append(jump)
    starts = exits.where("_i = 1").select(*writer, "_i")
    for jump in reversed(jumps[:-1]):
        there = follow(starts, jump, "_i").select(*writer, F.col("_then").alias("_i"))
        starts = written(starts.unionByName(there), "flush-starts")
    # places beyond a writer's last row are no row's
    return _meet(starts, exits, writer, [("_i", "_i")], {"_files": "_files"})


def _opens(nexts: DataFrame, writer: list[str], size: int, parts: int) -> DataFrame:
    """(writer, _i, _file) of the rows that files or blocks begin with; nexts with _entry and _opened of the row's block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first, end, to in _whole_blocks(batches, size):
            heads = np.flatnonzero(first == np.arange(len(first)))
            i, opened = table.column("_i").to_numpy(), table.column("_opened").to_numpy()
            entry = table.column("_entry").to_numpy()
            at = (heads + entry[heads] - i[heads]).tolist()
            opens, leads = np.zeros(len(to), np.int64), to.tolist()
            for p, stop in zip(at, end[heads].tolist(), strict=True):
                while p < stop:
                    opens[p] = 1
                    p = leads[p]
            so_far = np.cumsum(opens)
            file = opened + so_far - (so_far - opens)[first] - 1
            opens[heads] = 1
            out = table.select(writer).append_column("_i", table.column("_i")).append_column("_file", pa.array(file))
            yield from out.filter(pa.array(opens == 1)).combine_chunks().to_batches()

    shape = T.StructType([*[nexts.schema[c] for c in writer], *T.StructType.fromDDL("_i long, _file long").fields])
    blocks = nexts.select(*writer, "_i", "_next", "_entry", "_opened", "_block").repartition(parts, *writer, "_block").sortWithinPartitions(*writer, "_i")
    return blocks.drop("_block").mapInArrow(run, shape)


def flushed_batch(rows: DataFrame, writer: list[str], at: str, order: str, most_rows: int, minutes: float, task_rows: int = TASK_ROWS) -> DataFrame:
    """rows with file (long): the number, from 0, of the file of their writer (columns writer, nulls alike) that they go into.

    A writer takes its rows by `at` (a timestamp, not null) and `order`, which tells its rows apart. A file ends before
    the row that would be beyond most_rows, or that is `minutes` or more after the file's first. Columns may not begin
    with an underscore. The files are those of streaming.state.flushed.
    """
    millis = int(minutes * 60_000)
    block = F.expr(f"(_i - 1) div {task_rows}")
    parts = max(1, -(-rows.count() // task_rows))
    timed = rows.withColumn("_ms", F.unix_millis(F.col(at).cast("timestamp")))
    ordered = _in_order(timed, writer, ["_ms", order], timed.columns, parts)
    runs = _runs(ordered, writer)
    placed = _placed(ordered, runs, writer, "_i")

    # a writer's rows and, a file's age later, their ends, in one order: an end's place tells how many rows are before it
    points = placed.select(*writer, "_i", F.col("_ms").alias("_time"), F.lit(1).alias("_kind"))
    ends = placed.select(*writer, "_i", (F.col("_ms") + millis).alias("_time"), F.lit(0).alias("_kind"))
    both = _in_order(points.unionByName(ends), writer, ["_time", "_kind", "_i"], [*writer, F.when(F.col("_kind") == 0, F.col("_i")).alias("_i")], parts)
    merged = _placed(both, _runs(both, writer), writer, "_place").where("_i is not null")
    next_ = F.least(F.col("_i") + most_rows, F.greatest(F.col("_place") - F.col("_i") + 1, F.col("_i") + 1))
    nexts = merged.select(*writer, "_i", next_.alias("_next"), block.alias("_block"))

    # writers of one block begin with its first row; of the others each block has its entry, if it has one, and the files before it
    large = written(runs.groupBy(*writer).agg(F.sum("_n").alias("_n")).where(F.col("_n") > task_rows), "flush-large")
    if large.isEmpty():
        entered = nexts.withColumns({"_entry": F.lit(1).cast("long"), "_opened": F.lit(0).cast("long")})
    else:
        exits = _exits(_meet(nexts, large, writer, [], {}), writer, task_rows, parts)
        entries = _entries(exits, writer).withColumn("_block", block)
        every = large.select(*writer, F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {task_rows}"))).alias("_block"))
        earlier = Window.partitionBy(*writer).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block of a writer
        known = _meet(every, entries, writer, [("_block", "_block")], {"_i": "_entry", "_files": "_files"}, "left")
        known = written(known.withColumn("_opened", F.coalesce(F.sum("_files").over(earlier), F.lit(0))), "flush-blocks")
        # a block that no file begins in is entered behind its end
        met = _meet(nexts, known.withColumn("_entry", F.coalesce("_entry", (F.col("_block") + 1) * task_rows + 1)), writer, [("_block", "_block")], {"_entry": "_entry", "_opened": "_opened"}, "left")
        entered = met.withColumns({"_entry": F.coalesce("_entry", F.lit(1)), "_opened": F.coalesce("_opened", F.lit(0))})
    opens = _opens(entered, writer, task_rows, parts)

    marked = placed.drop("_ms").withColumn("_is_row", F.lit(True)).unionByName(opens.withColumn("_is_row", F.lit(False)), allowMissingColumns=True)
    so_far = Window.partitionBy(*writer, "_block").orderBy("_i").rangeBetween(Window.unboundedPreceding, 0)
    files = marked.withColumn("_block", block).withColumn("file", F.last("_file", ignorenulls=True).over(so_far))
    return files.where("_is_row").select(*rows.columns, "file")
