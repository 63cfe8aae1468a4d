"""Continuous periods and gaps of overlapping intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.operators.lineage import cut

#: Intervals are merged within blocks of this length, so that one busy key is shared out over many tasks.
BLOCK_MS = 900_000


def _sessions(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Sessions of the intervals ``start``..``end`` (milliseconds) per ``keys``, each as long as its own rows say."""
    length = F.expr(f"make_interval(0, 0, 0, 0, 0, 0, cast(({end} - {start}) as decimal(18, 0)) / 1000)")
    return (
        df.groupBy(*keys, F.session_window(F.timestamp_millis(F.col(start)), length).alias("__vx_session"))
        .agg(F.min(start).alias(start), F.max(end).alias(end))
        .select(*keys, start, end)
    )


def periods_and_gaps(df: DataFrame, keys: Sequence[str], start: str, end: str, block_ms: int = BLOCK_MS) -> DataFrame:
    """(keys, kind, start, end): the longest stretches without a gap that the intervals of each key cover, as kind ``period``,
    and the stretch between every two neighbouring ones, as kind ``gap``.

    ``start`` and ``end`` are whole milliseconds. Overlapping, nested, touching and repeated intervals become one period.
    Intervals with a null bound or with an end not after their start cover nothing; a null key is left out; other columns
    are ignored. An empty table gives an empty one.

    A session window per key and block of ``block_ms`` of the start, whose duration is each row's own length, merges
    overlapping rows; sessions that touch are joined afterwards. Blocks are then stitched: a session that starts no later
    than the ends of all earlier blocks continues what they hold, the others are fresh. For that, and for the next fresh
    start (``lead`` within the block, the next block's first one at its end), one row per key and block is enough, so no
    key's rows ever meet in one task.
    """
    rows = df.select(*keys, start, end).where(F.col(end) > F.col(start))
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    by = [*keys, "__vx_block"]
    # Sessions and the ends of blocks both need the rows; what leads to them is heavier than writing these few columns.
    rows = cut(rows.withColumn("__vx_block", F.floor(F.col(start) / block_ms)))
    inside = Window.partitionBy(*by).orderBy(start)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    along = Window.partitionBy(*keys).orderBy("__vx_block")
    earlier, later = along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(1, Window.unboundedFollowing)
    local = (
        _sessions(rows, by, start, end)
        .withColumn("__vx_new", (~F.col(start).eqNullSafe(F.lag(end).over(inside))).cast("int"))
        .withColumn("__vx_no", F.sum("__vx_new").over(upto))
        .groupBy(*by, "__vx_no")
        .agg(F.min(start).alias(start), F.max(end).alias(end))
        .drop("__vx_no")
    )
    tops = rows.groupBy(*by).agg(F.max(end).alias("__vx_top")).withColumn("__vx_before", F.max("__vx_top").over(earlier)).drop("__vx_top")
    marked = local.join(tops, by).withColumn("__vx_fresh", F.coalesce(F.col(start) > F.col("__vx_before"), F.lit(True)))
    heads = (
        marked.groupBy(*by)
        .agg(F.count_if("__vx_fresh").alias("__vx_n"), F.min(F.when(F.col("__vx_fresh"), F.col(start))).alias("__vx_head"))
        .withColumn("__vx_shift", F.coalesce(F.sum("__vx_n").over(earlier), F.lit(0)))
        .withColumn("__vx_then", F.first("__vx_head", ignorenulls=True).over(later))
        .drop("__vx_n", "__vx_head")
    )
    following = F.struct(F.col(start).alias("s"), F.col("__vx_fresh").alias("f"))
    islands = (
        marked.withColumn("__vx_next", F.lead(following).over(inside))
        .withColumn("__vx_count", F.sum(F.col("__vx_fresh").cast("int")).over(upto))
        .join(heads, by)
        .withColumn("__vx_gap_end", F.when(F.col("__vx_next").isNull(), F.col("__vx_then")).when(F.col("__vx_next.f"), F.col("__vx_next.s")))
        .groupBy(*keys, (F.col("__vx_shift") + F.col("__vx_count")).alias("__vx_no"))
        .agg(F.min(start).alias(start), F.max(end).alias(end), F.max("__vx_gap_end").alias("__vx_gap_end"))
    )
    parts = F.array(
        F.struct(F.lit("period").alias("kind"), F.col(start).alias("a"), F.col(end).alias("b")),
        F.struct(F.lit("gap").alias("kind"), F.col(end).alias("a"), F.col("__vx_gap_end").alias("b")),
    )
    return (
        islands.select(*keys, F.explode(parts).alias("__vx_p"))
        .where(F.col("__vx_p.b").isNotNull())
        .select(*keys, F.col("__vx_p.kind").alias("kind"), F.col("__vx_p.a").alias(start), F.col("__vx_p.b").alias(end))
    )
