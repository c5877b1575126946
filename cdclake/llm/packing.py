"""Best-fit packing from the histogram of lengths.

The histogram has at most `capacity` entries whatever the input, so the driver plans on counts: lengths from long
to short go into the open sequences with the least room that is enough. A plan is a table of slots, a few for each
length; items take the slot of their rank among the items of their length. Ranks come from salted buckets, so that
a length that many items share is dealt over many tasks.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cdclake.llm.common import materialise

#: Items of one length fall into buckets of about so many rows, and so many buckets at least.
BUCKET_ROWS, LEAST_BUCKETS = 50_000, 64


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, first rank, rank after the last, items in a sequence, first sequence, offset) for counts of lengths.

    Best-fit decreasing over counts. Sequences of like filling are one range of sequence numbers, so the work and the
    plan grow with the number of distinct lengths only.
    """
    if bad := [n for n in counts if n is None or not 1 <= n <= capacity]:
        raise ValueError(f"lengths {sorted(bad, key=str)[:5]} aren't in 1 to {capacity}")
    open_rooms: list[int] = []  # rooms that some sequences have, ascending
    ranges: dict[int, list[tuple[int, int]]] = defaultdict(list)  # by room: (first sequence, sequences)
    slots, next_sequence = [], 0

    def keep(room: int, first: int, number: int) -> None:
        if room and number:
            if not ranges[room]:
                insort(open_rooms, room)
            ranges[room].append((first, number))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(open_rooms, length)
            if at < len(open_rooms):
                room = open_rooms[at]
                first, number = ranges[room].pop()
                if not ranges[room]:
                    open_rooms.pop(at)
            else:
                room, first, number = capacity, next_sequence, -(-left // (capacity // length))
                next_sequence += number
            each = room // length
            full = min(number, left // each)
            if full:
                slots.append((length, rank, rank + full * each, each, first, capacity - room))
                keep(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if left and full < number:  # one more, not full of this length
                slots.append((length, rank, rank + left, left, first + full, capacity - room))
                keep(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            keep(room, first + full, number - full)
    return slots


def pack_best_fit(items: DataFrame, capacity: int, length_col: str = "length") -> DataFrame:
    """items with sequence_id long and offset long: each item's place in sequences of at most capacity.

    Offsets in a sequence leave no gap from 0 on. Lengths must be in 1 to capacity (else ValueError). Items that are
    equal in all columns are told apart, which gets which slot doesn't matter. Other columns may hold nulls; a null
    length is not in 1 to capacity. An empty table gives an empty result.
    Columns named sequence_id or offset are replaced; names that begin with _pk_ are taken. items is written once.
    """
    spark = items.sparkSession
    items = items.drop("sequence_id", "offset")
    names = items.columns
    # the stored table fixes a number for each row, so that equal rows are dealt evenly too
    items = materialise(items.withColumns({"_pk_length": F.col(length_col).cast("long"), "_pk_row": F.monotonically_increasing_id()}), "pack-items")
    buckets = max(LEAST_BUCKETS, items.count() // BUCKET_ROWS)
    bucketed = items.withColumn("_pk_bucket", F.pmod(F.xxhash64("_pk_row"), F.lit(buckets)))

    by_bucket = bucketed.groupBy("_pk_length", "_pk_bucket").agg(F.count(F.lit(1)).alias("_pk_rows"))
    before = F.sum("_pk_rows").over(Window.partitionBy("_pk_length").orderBy("_pk_bucket")) - F.col("_pk_rows")
    by_bucket = materialise(by_bucket.withColumn("_pk_before", before), "pack-buckets")
    counts = {r["_pk_length"]: r["n"] for r in by_bucket.groupBy("_pk_length").agg(F.sum("_pk_rows").alias("n")).collect()}  # capacity rows at most

    slots = spark.createDataFrame(plan(counts, capacity), "_pk_of long, _pk_lo long, _pk_hi long, _pk_each long, _pk_first long, _pk_at long")
    own = F.row_number().over(Window.partitionBy("_pk_length", "_pk_bucket").orderBy("_pk_row")) - 1
    ranked = bucketed.withColumn("_pk_own", own).join(by_bucket.drop("_pk_rows"), ["_pk_length", "_pk_bucket"])
    ranked = ranked.withColumn("_pk_rank", F.col("_pk_own") + F.col("_pk_before"))
    placed = ranked.join(
        F.broadcast(slots),  # grows with the number of distinct lengths, so with capacity only
        (F.col("_pk_length") == F.col("_pk_of")) & (F.col("_pk_rank") >= F.col("_pk_lo")) & (F.col("_pk_rank") < F.col("_pk_hi")),
    )
    nth = F.col("_pk_rank") - F.col("_pk_lo")
    sequence = (F.col("_pk_first") + F.expr("(_pk_rank - _pk_lo) div _pk_each")).cast("long")
    offset = F.col("_pk_at") + (nth % F.col("_pk_each")) * F.col("_pk_length")
    return placed.select(*[F.col(f"`{c}`") for c in names], sequence.alias("sequence_id"), offset.cast("long").alias("offset"))
