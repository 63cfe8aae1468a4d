"""Exact ranks and running sums within groups of any size."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom.operators.lineage import cut

#: Rows that one range should hold; ranges are never fewer than this asks for, whatever the session's shuffle setting.
RANGE_ROWS = 1_000_000
_NEW = ("__vx_part", "__vx_at", "__vx_rank", "__vx_sum", "__vx_head")


def _differs(column: pa.Array, before: pa.Array | None) -> np.ndarray:
    """Whether each value differs from the one ahead of it; nulls are equal, and so are NaNs. ``before`` is one value or None."""
    first = before if before is not None else column.slice(0, 1)
    ahead = pa.concat_arrays([first.cast(column.type), column.slice(0, len(column) - 1)])
    other = pc.fill_null(pc.not_equal(column, ahead), False)
    if pa.types.is_floating(column.type):
        other = pc.and_(other, pc.invert(pc.and_(pc.fill_null(pc.is_nan(column), False), pc.fill_null(pc.is_nan(ahead), False))))
    other = pc.or_(other, pc.xor(column.is_null(), ahead.is_null()))
    return other.to_numpy(zero_copy_only=False)


def _local(keys: list[str], value: str | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Position, rank and running sum of every row of a sorted partition, and whether its key is the partition's first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen = rank = total = 0  # rows so far; rank and sum at the last row
        last: list[pa.Array | None] = [None] * len(keys)
        head = True
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            for i, k in enumerate(keys):
                new |= _differs(b.column(k), last[i])
                last[i] = b.column(k).slice(n - 1, 1)
            new[0] |= seen == 0
            begin = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            held = begin < 0  # rows that go on with the key of the batch before
            ranks = np.arange(n) - np.maximum(begin, 0) + 1 + np.where(held, rank, 0)
            amount = pc.fill_null(b.column(value).cast(pa.int64()), 0).to_numpy(zero_copy_only=False) if value else np.zeros(n, np.int64)
            upto = np.cumsum(amount)
            sums = upto - np.where(held, -total, (upto - amount)[np.maximum(begin, 0)])
            heads = np.logical_and(head, np.cumsum(new) == (1 if seen == 0 else 0))
            head = bool(heads[-1])
            made = (np.full(n, part), seen + np.arange(n), ranks, sums, heads)
            seen, rank, total = seen + n, int(ranks[-1]), int(sums[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, made)], [*b.schema.names, *_NEW])

    return run


def rank_and_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: str | None = None,
    rank: str = "rank",
    running: str = "running",
    partitions: int | None = None,
    written: bool = False,
) -> DataFrame:
    """``df`` with each row's position (from 1) among the rows of its ``keys`` in ``order``, and the sum of ``value`` up to it.

    The rows are range-partitioned on keys and order, in as many ranges as their number asks for, so a key that holds a third
    of all rows takes a third of the ranges. Ranks and sums are found in one walk over each sorted range. Only a key that
    begins a range can have rows in earlier ones, so one row per range, which comes to the driver, is enough to shift them:
    that is the only shuffle. ``df`` should hold no more columns than needed; ``written`` tells that it is cut off already. The order should be total; ties are settled
    arbitrarily but once and for all, since the ranks are written to the checkpoint folder. Null keys form a group of their own;
    ``value`` holds whole numbers, and its nulls count 0. Columns named like the new ones are replaced.
    """
    # Finding the ranges takes a pass of its own, so what leads to ``df`` is cut off first and runs once.
    rows = df.drop(rank, *([running] if value else []))
    rows = rows if written else cut(rows)
    if partitions is None:
        n = rows.count()
        usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        partitions = max(1, math.ceil(n / RANGE_ROWS), min(usual, math.ceil(n / 20_000)))
    by = [F.col(k) for k in keys]
    ranged = rows.repartitionByRange(partitions, *by, *order).sortWithinPartitions(*by, *order)
    new = T.StructType().add("__vx_part", "long").add("__vx_at", "long").add("__vx_rank", "long").add("__vx_sum", "long").add("__vx_head", "boolean")
    local = cut(ranged.mapInArrow(_local(list(keys), value), T.StructType([*rows.schema.fields, *new.fields])))
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    ends = local.groupBy("__vx_part").agg(
        F.min_by(key, "__vx_at").alias("first"),
        F.max_by(F.struct(key.alias("key"), "__vx_rank", "__vx_sum", "__vx_head"), "__vx_at").alias("last"),
    )
    shifts, held, n0, v0 = [], None, 0, 0
    for r in sorted(ends.collect(), key=lambda r: r["__vx_part"]):
        if held is None or r["first"] != held:
            n0, v0 = 0, 0
        shifts.append((r["__vx_part"], n0, v0))
        more = r["last"]["__vx_head"]  # the whole range is one key, which adds to what came before
        n0, v0 = r["last"]["__vx_rank"] + (n0 if more else 0), r["last"]["__vx_sum"] + (v0 if more else 0)
        held = r["last"]["key"]
    table = df.sparkSession.createDataFrame(shifts, "__vx_p long, __vx_n0 long, __vx_v0 long")
    out = local.join(F.broadcast(table), F.col("__vx_part") == F.col("__vx_p"))  # one row per range
    carried = lambda own, more: F.col(own) + F.when(F.col("__vx_head"), F.col(more)).otherwise(0)
    out = out.withColumn(rank, carried("__vx_rank", "__vx_n0"))
    if value:
        out = out.withColumn(running, carried("__vx_sum", "__vx_v0"))
    return out.select(*rows.columns, rank, *([running] if value else []))
