"""Numbering runs of equal neighbours in an order, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.operators.lineage import cut


def merge_runs(
    df: DataFrame, group: str, block: Column, order: Sequence[str], value: str, total: str, no: str, text: str | None = None
) -> DataFrame:
    """Neighbouring rows of a ``group`` with the same ``value`` become one row with the sum of ``total``, numbered from 1.

    Neighbours are taken in ``order``; null values are equal to each other. ``block`` must rise (or stay) along the order:
    runs are found within blocks, and only one row per block is needed to number them over the whole group, so a group of
    any size is shared out over many tasks. The result has the columns group, ``no``, value and total.

    With ``text``, a run comes in parts, one for each block that it reaches into, so that no row grows without bound: group,
    ``no``, part_no (from 1), the least of the first order column, value, total and the texts of the part, joined by spaces.
    """
    also = [F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, text))), lambda x: x[text]), " ").alias(text)] if text else []
    extra = [text] if text else []
    inside = Window.partitionBy(group, "_block").orderBy(*order)
    runs = (
        df.select(group, block.alias("_block"), *order, value, total, *extra)
        .withColumn("_first", F.row_number().over(inside) == 1)
        .withColumn("_new", (F.col("_first") | ~F.col(value).eqNullSafe(F.lag(value).over(inside))).cast("int"))
        .withColumn("_run", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(group, "_block", "_run")
        .agg(F.first(value).alias(value), F.sum(total).alias(total), F.min(order[0]).alias(order[0]), *also)
    )
    # Both the blocks and the result need the runs; what leads to them is heavier than writing them.
    runs = cut(runs)
    along = Window.partitionBy(group).orderBy("_block")
    blocks = (
        runs.groupBy(group, "_block")
        .agg(F.max("_run").alias("_n"), F.min_by(F.struct(value), "_run").alias("_head"), F.max_by(F.struct(value), "_run").alias("_tail"))
        .withColumn("_joined", F.coalesce((F.col("_head") == F.lag("_tail").over(along)).cast("int"), F.lit(0)))
        .withColumn("_before", F.coalesce(F.sum(F.col("_n") - F.col("_joined")).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select(group, "_block", (F.col("_before") - F.col("_joined")).alias("_shift"))
    )
    if text:
        parts = runs.join(blocks, [group, "_block"]).withColumn(no, F.col("_shift") + F.col("_run"))
        part = F.row_number().over(Window.partitionBy(group, no).orderBy("_block"))
        return parts.select(group, no, part.alias("part_no"), order[0], value, total, text)
    return (
        runs.join(blocks, [group, "_block"])
        .groupBy(group, (F.col("_shift") + F.col("_run")).alias(no))
        .agg(F.first(value).alias(value), F.sum(total).alias(total))
    )
