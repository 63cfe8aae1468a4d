"""Problem 2: splits that keep related records together."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.operators.lineage import cut
from voxloom.operators.ranking import rank_and_running

#: Links that one task may take when local forests are merged.
TASK_LINKS = 1_000_000


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find over the links a[i] - b[i]: every node with the smallest node of its tree (also the roots themselves).

    All links are followed to their roots and united together, the larger root hung below the smallest one it meets; paths are
    then halved until flat. Rounds go on until no link joins two trees, a few even for long chains.
    """
    codes, names = pd.factorize(np.concatenate([a, b]), sort=True)
    parent = np.arange(len(names))
    x, y = codes[: len(a)], codes[len(a) :]
    while len(x):
        high, low = np.maximum(parent[x], parent[y]), np.minimum(parent[x], parent[y])
        open_ = high > low
        if not open_.any():
            break
        x, y = x[open_], y[open_]
        np.minimum.at(parent, high[open_], low[open_])
        while True:
            above = parent[parent]
            if (above == parent).all():
                break
            parent = above
    return names, names[parent]


def _forests(most: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Forests of a task's links; a task with more than ``most`` builds several, which a later level has to merge."""

    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: list[tuple[np.ndarray, np.ndarray]] = []

        def grown() -> pa.RecordBatch:
            node, root = local_forest(np.concatenate([c[0] for c in chunks]), np.concatenate([c[1] for c in chunks]))
            return pa.RecordBatch.from_arrays([pa.array(node, pa.string()), pa.array(root, pa.string())], ["node", "root"])

        held = 0
        for b in batches:
            chunks.append((b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)))
            held += b.num_rows
            if held > most:
                yield grown()
                chunks.clear()
                held = 0
        if chunks:
            yield grown()

    return forests


def components(links: DataFrame, a: str, b: str, task_links: int = TASK_LINKS) -> DataFrame:
    """(node, root): every node that occurs in a link, with the smallest node (as a string) that it hangs together with.

    Each task builds a union-find forest of its links. Once all links fit one task of ``task_links``, a single forest ends
    it. Until then every level contracts: a node that is no root anywhere is set aside below the smallest of its roots, and
    what goes on are links between roots, so levels shrink. In the end the nodes set aside take the roots of their roots, level
    by level backwards. Every level is written to the checkpoint folder; only their sizes come to the driver. A node links
    to at most one root a task, so no task takes more than its share. Links with a null end are ignored; a node linked to
    itself is a tree.
    """
    made = "node string, root string"
    most = 2 * task_links
    tied = (
        links.select(F.col(a).cast("string").alias("_a"), F.col(b).cast("string").alias("_b"))
        .where(F.col("_a").isNotNull() & F.col("_b").isNotNull())
        .select(F.greatest("_a", "_b").alias("node"), F.least("_a", "_b").alias("root"))
        .distinct()
    )
    forest = cut(tied.mapInArrow(_forests(most), made).distinct())
    own, forest = forest.where("node = root"), forest.where("node != root")
    aside: list[DataFrame] = []
    while (size := forest.count()) > task_links:
        least = F.min("root").over(Window.partitionBy("node"))
        marked = cut(forest.withColumn("least", least))
        roots = forest.select(F.col("root").alias("node")).distinct()
        aside.append(marked.where("root = least").join(roots, "node", "left_anti").select("node", "root"))
        between = marked.where("root != least").select(F.col("root").alias("node"), F.col("least").alias("root"))
        above = forest.join(roots, "node", "left_semi")
        rest = between.unionByName(above).select(F.greatest("node", "root").alias("node"), F.least("node", "root").alias("root"))
        forest = cut(rest.distinct().repartition(math.ceil(size / task_links)).mapInArrow(_forests(most), made).where("node != root").distinct())
    known = forest.repartition(1).mapInArrow(_forests(math.inf), made)
    for level in reversed(aside):
        known = cut(known)
        up = known.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        known = known.unionByName(level.join(up, "root", "left").select("node", F.coalesce("_up", "root").alias("root")))
    return known.unionByName(own).groupBy("node").agg(F.min("root").alias("root"))


def group_records(records: DataFrame, record: str, strong: str, weak: str, group: str = "group_key") -> DataFrame:
    """(record, group): records that share a ``strong`` or a ``weak`` key, directly or over others, get one group.

    ``group`` is the smallest strong key in the group, or the smallest weak key where it has none, or the record itself where
    it has neither. A null key ties nothing. Several rows of one record tie all their keys. One row per non-null record.
    """
    rows = records.select(
        F.col(record).alias("_r"), F.concat(F.lit("0"), strong).alias("_s"), F.concat(F.lit("1"), weak).alias("_w")
    ).where(F.col("_r").isNotNull())
    own = F.concat(F.lit("2"), F.col("_r").cast("string"))
    differs = F.lit(False)
    for k in ("_s", "_w"):
        differs = differs | ~F.count(k).isin(0, F.count(F.lit(1))) | F.coalesce(F.min(k) != F.max(k), F.lit(False))
    per = rows.groupBy("_r").agg(F.min(F.coalesce("_s", "_w")).alias("_anchor"), differs.alias("_differs"))
    anchors = per.select("_r", F.coalesce("_anchor", own).alias("_anchor"), "_differs")
    # Both keys of a row are linked; a record whose rows differ links its anchor with the keys of all of them.
    direct = rows.select(F.coalesce("_s", "_w").alias("a"), F.coalesce("_w", "_s").alias("b"))
    several = rows.join(anchors.where("_differs"), "_r").select(F.col("_anchor").alias("a"), F.explode(F.array("_s", "_w")).alias("b"))
    trees = components(direct.unionByName(several), "a", "b")
    return (
        anchors.join(trees, anchors["_anchor"] == trees["node"], "left")
        .select(F.col("_r").alias(record), F.substring(F.coalesce("root", "_anchor"), 2, 1 << 30).alias(group))
    )


def deal(sizes: Sequence[tuple[int, int]], shares: Sequence[float]) -> dict[int, list[int]]:
    """How many groups of each size every split gets, largest groups first, each to the split furthest below its target.

    ``sizes`` holds (records in a group, groups of that size); ``shares`` may have any sum. Ties go to the earlier split.
    Each group given to a split lowers what it lacks by the group's size, so one by one the greedy choice takes the largest of
    all the values lack - j * size. For k groups of one size these are the k largest: the level above which at most k of them
    lie is found by bisection, and the few groups left at that level are dealt out one by one.
    """
    total = sum(n * k for n, k in sizes)
    target = [s * total for s in shares]
    have = [0] * len(shares)
    out: dict[int, list[int]] = {}
    for n, k in sorted(sizes, reverse=True):
        lack = [t - h for t, h in zip(target, have, strict=True)]
        above = lambda level, lack=lack, n=n: [max(0, math.ceil((x - level) / n)) for x in lack]
        low, high = min(lack) - n * (k + 1), max(lack)
        for _ in range(100):
            middle = (low + high) / 2
            low, high = (low, middle) if sum(above(middle)) <= k else (middle, high)
        got = [max(0, x - 1) for x in above(high)]  # one less each: rounding at the level is settled below
        for _ in range(k - sum(got)):
            i = max(range(len(shares)), key=lambda j: target[j] - (have[j] + got[j] * n))
            got[i] += 1
        have = [h + g * n for h, g in zip(have, got, strict=True)]
        out[n] = got
    return out


def assign_splits(grouped: DataFrame, group: str, splits: dict[str, float], seed: int = 0, split: str = "split") -> DataFrame:
    """``grouped`` with a split for every record, such that a group never parts and the shares come near ``splits``.

    Greedy, largest group first, to the split furthest below its target. Groups of one size are alike for that, so only the
    histogram of group sizes comes to the driver (at most the square root of twice the number of records); which groups of
    a size go where follows from a hash of group and ``seed``. Null groups get no split.
    """
    names = list(splits)
    spark = grouped.sparkSession
    groups = grouped.select(group).where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    groups = cut(groups)
    quota = deal([tuple(r) for r in groups.groupBy("_size").count().collect()], list(splits.values()))
    rows = []
    for n, got in quota.items():
        upto = 0
        for name, k in zip(names, got, strict=True):
            if k:
                rows.append((n, upto, upto + k, name))
            upto += k
    table = spark.createDataFrame(rows, "_size bigint, _from bigint, _to bigint, _split string")
    ranked = rank_and_running(groups, ["_size"], [F.md5(F.concat(F.col(group).cast("string"), F.lit(f" {seed}"))), F.col(group)], rank="_rank")
    chosen = ranked.join(table, (ranked["_size"] == table["_size"]) & (F.col("_rank") > F.col("_from")) & (F.col("_rank") <= F.col("_to")))
    return grouped.drop(split).join(chosen.select(group, F.col("_split").alias(split)), group, "left")
