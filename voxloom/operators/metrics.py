"""Completeness figures of a language's data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.operators.lineage import cut
from voxloom.operators.ranking import rank_and_running


def coverage(wanted: DataFrame, seen: DataFrame, group: str, item: str) -> DataFrame:
    """(group, n_wanted, n_seen, coverage, missing): how many wanted items of a group are seen in it."""
    w = wanted.select(group, item).dropna().distinct()
    s = seen.select(group, item).dropna().distinct().withColumn("_seen", F.lit(1))
    return (
        w.join(s, [group, item], "left")
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("n_wanted"), F.count("_seen").alias("n_seen"), F.array_sort(F.collect_list(F.when(F.col("_seen").isNull(), F.col(item)))).alias("missing"))
        .withColumn("coverage", F.col("n_seen") / F.col("n_wanted"))
    )


def jensen_shannon(actual: DataFrame, target: DataFrame, group: str, item: str, weight: str) -> DataFrame:
    """(group, jsd): Jensen-Shannon divergence in bits of two distributions, each scaled to sum to 1 per group.

    Groups missing on either side, and weights that are null or not positive, are left out.
    """

    def shares(df: DataFrame, out: str) -> DataFrame:
        good = df.where(F.col(weight) > 0).dropna(subset=[group, item]).groupBy(group, item).agg(F.sum(weight).alias("_w"))
        total = good.groupBy(group).agg(F.sum("_w").alias("_all"))
        return good.join(total, group).select(group, item, (F.col("_w") / F.col("_all")).alias(out))

    p, q = shares(actual, "p"), shares(target, "q")
    both = p.select(group).distinct().join(q.select(group).distinct(), group, "left_semi")
    joined = p.join(q, [group, item], "full").na.fill(0.0, ["p", "q"]).join(both, group, "left_semi")
    m = (F.col("p") + F.col("q")) / 2
    part = lambda c: F.when(F.col(c) > 0, F.col(c) * F.log2(F.col(c) / m)).otherwise(0.0)
    return joined.groupBy(group).agg((F.sum(part("p") + part("q")) / 2).alias("jsd"))


def gini(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, gini) of values that aren't negative: 0 where all are equal; 0 for a group without a positive value.

    Equal values are counted first, so the ranks come from a histogram and no group's rows meet in one task.
    """
    counts = df.where(F.col(value) >= 0).groupBy(group, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # sum of ranks over rows with equal values: n * before + n (n + 1) / 2
    ranks = F.col("_n") * F.col("_b") + F.col("_n") * (F.col("_n") + 1) / 2
    sums = ranked.groupBy(group).agg(F.sum(ranks * F.col("_v")).alias("_r"), F.sum(F.col("_n") * F.col("_v")).alias("_s"), F.sum("_n").alias("_m"))
    return sums.select(group, F.when(F.col("_s") > 0, 2 * F.col("_r") / (F.col("_m") * F.col("_s")) - (F.col("_m") + 1) / F.col("_m")).otherwise(0.0).alias("gini"))


def gaps(actual: DataFrame, target: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, actual, target, gap): what is missing to the target, never below 0."""
    a = actual.groupBy(*keys).agg(F.sum(value).alias("actual"))
    t = target.groupBy(*keys).agg(F.sum(value).alias("target"))
    return t.join(a, keys, "left").select(*keys, F.coalesce("actual", F.lit(0.0)).alias("actual"), "target", F.greatest(F.lit(0.0), F.col("target") - F.coalesce("actual", F.lit(0.0))).alias("gap"))


def percentiles(df: DataFrame, group: str, value: str, shares: list[float]) -> DataFrame:
    """(group, pNN ...): exact percentiles by linear interpolation; null values and NaN are left out.

    Values are ranked within their groups over ranges, so no group's values meet in one task; only the two rows on either
    side of each percentile are gathered.
    """
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(group, F.col(value).cast("double").alias("_v"))
    ranked = cut(rank_and_running(rows, [group], [F.col("_v")], rank="_r"))
    counts = ranked.groupBy(group).agg(F.max("_r").alias("_n")).withColumnRenamed(group, "_g")
    joined = ranked.join(counts, F.col(group).eqNullSafe(F.col("_g")))
    out = []
    for share in shares:
        place = 1 + (F.col("_n") - 1) * share
        low = F.floor(place)
        weight = F.when(F.col("_r") == low, 1 - (place - low)).when(F.col("_r") == low + 1, place - low)
        out.append(F.sum(F.col("_v") * F.when(weight > 0, weight)).alias(f"p{round(share * 100)}"))
    return joined.groupBy(group).agg(*out)


def pair_coverage(pairs: DataFrame, seen: DataFrame, group: str, first: str, second: str, word: str) -> DataFrame:
    """(group, n_pairs, n_seen, coverage): how many of a group's pairs of words have both words among those seen in it.

    A pair given twice or the other way round counts once; pairs with a null and of a word with itself are left out.
    """
    p = pairs.select(group, F.least(first, second).alias("_a"), F.greatest(first, second).alias("_b")).where("_a < _b").dropna().distinct()
    s = seen.select(group, F.col(word).alias("_w")).dropna().distinct()
    one = p.join(s.select(group, F.col("_w").alias("_a"), F.lit(1).alias("_has_a")), [group, "_a"], "left")
    both = one.join(s.select(group, F.col("_w").alias("_b"), F.lit(1).alias("_has_b")), [group, "_b"], "left")
    sums = both.groupBy(group).agg(F.count(F.lit(1)).alias("n_pairs"), F.count_if(F.col("_has_a").isNotNull() & F.col("_has_b").isNotNull()).alias("n_seen"))
    return sums.withColumn("coverage", F.col("n_seen") / F.col("n_pairs"))


def outcomes(df: DataFrame, groups: list[str], ok: Column) -> DataFrame:
    """(groups, processed, succeeded, failed, success_rate) of rows that are ``ok`` or not; null counts as not."""
    good = F.coalesce(ok, F.lit(False))
    sums = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("processed"), F.count_if(good).alias("succeeded"), F.count_if(~good).alias("failed"))
    return sums.withColumn("success_rate", F.col("succeeded") / F.col("processed"))


def cost_per_hour(df: DataFrame, groups: list[str], cost: Column, seconds: Column, accepted: Column) -> DataFrame:
    """(groups, hours, cost, cost_per_hour): what an hour of accepted material cost; null where nothing was accepted."""
    sums = df.groupBy(*groups).agg(
        (F.coalesce(F.sum(F.when(accepted, seconds)), F.lit(0.0)) / 3600).alias("hours"), F.coalesce(F.sum(cost), F.lit(0.0)).alias("cost")
    )
    return sums.withColumn("cost_per_hour", F.when(F.col("hours") > 0, F.col("cost") / F.col("hours")))


def retained(df: DataFrame, at: str, days: int) -> DataFrame:
    """Rows whose ``at`` is at most ``days`` days before the latest one; rows with a null ``at`` are kept."""
    oldest = df.agg((F.max(at) - F.make_dt_interval(F.lit(days))).alias("oldest"))
    return df.where(F.col(at).isNull() | (F.col(at) >= oldest.scalar()))


def error_rate(df: DataFrame, heard: str, wanted: str, out: str = "error_rate") -> DataFrame:
    """``df`` with the edit distance of two texts over the length of the wanted one; null where that is null or empty."""
    return df.withColumn(out, F.when(F.length(wanted) > 0, F.levenshtein(F.coalesce(heard, F.lit("")), F.col(wanted)) / F.length(wanted)))
