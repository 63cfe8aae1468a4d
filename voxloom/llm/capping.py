"""Problem 6: capping records per dominant contributor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.operators.lineage import cut
from voxloom.operators.ranking import rank_and_running


def water_level(histogram: Sequence[tuple[int, int]], max_share: float = 1.0, max_count: int | None = None) -> int:
    """The largest cap c, at most ``max_count``, such that no contributor with min(count, c) records has more than ``max_share``
    of the output.

    Counts above ``max_count`` are filled up to it alone. ``histogram`` holds (records, contributors with so many). The output at cap c is a sum of min(count, c), which is linear
    in c between neighbouring counts, so the level is found while walking down the sorted counts: all contributors above the
    level hold c each, the others hold their whole counts. With fewer than 1 / max_share contributors no output is
    consistent; the level is then the smallest count, which makes the shares as even as they can be. 0 without records.
    """
    filled: dict[int, int] = {}
    for n, k in histogram:
        n = n if max_count is None else min(n, max_count)
        filled[n] = filled.get(n, 0) + k
    rows = sorted((n, k) for n, k in filled.items() if n > 0 and k > 0)
    if not rows:
        return 0
    total = sum(n * k for n, k in rows)
    if rows[-1][0] <= max_share * total:
        return rows[-1][0]
    above, below = 0, total
    for i in range(len(rows) - 1, -1, -1):
        n, k = rows[i]
        above, below = above + k, below - n * k
        # c <= share * (below + above * c) for c between the next smaller count and n
        room = 1 - max_share * above
        level = int(max_share * below / room + 1e-9) if room > 0 else n
        smaller = rows[i - 1][0] if i else 0
        if level >= smaller and level > 0:
            return min(level, n)
    return rows[0][0]


def cap_contributors(
    records: DataFrame,
    contributor: str,
    order: Sequence[Column],
    max_count: int | None = None,
    max_share: float | None = None,
    kept: str = "kept",
) -> DataFrame:
    """``records`` with a column that tells whether the record stays when each contributor is capped.

    A contributor keeps its first records in ``order`` (best quality first, then a key that settles ties): at most
    ``max_count`` of them, and at most as many as ``max_share`` of all kept records allows. Both limits are solved together by
    water-filling over the sorted contributor counts, of which only the histogram comes to the driver (at most the square
    root of twice the number of records). Records with a null contributor are always kept and count for no share. No column
    besides those named is read; an empty table stays empty; without a limit all is kept.
    """
    if max_count is None and max_share is None:
        return records.withColumn(kept, F.lit(True))
    records = cut(records.drop(kept))
    counts = records.where(F.col(contributor).isNotNull()).groupBy(contributor).agg(F.count(F.lit(1)).alias("n"))
    level = water_level([tuple(r) for r in counts.groupBy("n").count().collect()], 1.0 if max_share is None else max_share, max_count)
    ranked = rank_and_running(records, [contributor], order, rank="__vx_rank", written=True)
    return ranked.withColumn(kept, F.col(contributor).isNull() | (F.col("__vx_rank") <= level)).drop("__vx_rank")


def best_scores(scores: DataFrame) -> DataFrame:
    """(segment_id, score): the total of each segment's latest row by scored_at whose total is from 0 to 100.

    Rows with a null, NaN or impossible total count as no score; of rows at the same time the highest total counts.
    """
    valid = scores.where(F.col("total").between(0, 100) & ~F.isnan("total") & F.col("segment_id").isNotNull())
    return valid.groupBy("segment_id").agg(F.max(F.struct("scored_at", "total")).alias("_s")).select("segment_id", F.col("_s.total").alias("score"))
