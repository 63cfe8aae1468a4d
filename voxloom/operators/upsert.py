"""Mutations as pure functions of a current and an incoming table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.provenance import source_reliability, source_type, url_status


def latest(incoming: DataFrame, keys: list[str], at: Column) -> DataFrame:
    """One row per key: the last by ``at``, ties by the largest values."""
    rest = [c for c in incoming.columns if c not in keys]
    return incoming.groupBy(*keys).agg(F.max(F.struct(at.alias("_at"), *rest)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def merge(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both, by key; where both have a key, incoming values that aren't null win.

    Each side has a key once. Null keys are equal to each other.
    """
    cols = current.columns
    a = current.select(*[F.col(c).alias(f"_a_{c}") for c in cols])
    b = incoming.select(*[F.col(c).alias(f"_b_{c}") for c in cols])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}"))
    return a.join(b, same, "full").select(*[F.coalesce(f"_b_{c}", f"_a_{c}").alias(c) for c in cols])


def register_sources(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Sources (source_name, source_type, source_url, license, notes, reliability_score) after registering ``incoming``.

    Known names take new values that aren't null and keep their score; new ones get their kind, if null, and a score.
    """
    fresh = incoming.withColumn("reliability_score", F.lit(None).cast("double")).select(*current.columns)
    merged = merge(current, fresh, ["source_name"])
    kind = F.coalesce("source_type", source_type(F.col("source_name"), F.col("source_url")))
    typed = merged.withColumn("source_type", kind)
    return typed.withColumn("reliability_score", F.coalesce("reliability_score", source_reliability(F.col("source_name"), F.col("source_url"), F.col("source_type"))))


def link_entities(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Links (entity_type, entity_id, source_id, confidence_score, extraction_date) after adding ``incoming``.

    Of several incoming rows of a link the latest by extraction_date counts; its values that aren't null replace those known.
    """
    keys = ["entity_type", "entity_id", "source_id"]
    return merge(current, latest(incoming.select(*current.columns), keys, F.col("extraction_date")), keys)


def maintenance(sources: DataFrame, responses: DataFrame, sample: int = 5, seed: int = 0) -> DataFrame:
    """(sources_reassessed, sources_verified, success): one run over sources (source_name, source_type, source_url, reliability_score).

    Scores are worked out anew, and a sample of sources with an address is held against ``responses`` (source_url, status,
    location). The sample is the first ones by a hash of name and seed, so it is the same on every run.
    """
    moved = reassess(sources)[1].agg(F.count(F.lit(1)).alias("sources_reassessed"))
    taken = sources.where("source_url IS NOT NULL").orderBy(F.md5(F.concat("source_name", F.lit(f" {seed}"))), "source_name").limit(sample)
    asked = taken.join(responses.select("source_url", "status", "location"), "source_url", "left")
    ok = url_status(F.col("status"), F.col("location"), F.col("source_url"))[0]
    verified = asked.agg(F.count_if(ok).alias("sources_verified"))
    both = moved.select("sources_reassessed", verified.scalar().alias("sources_verified"))
    return both.withColumn("success", (F.col("sources_reassessed") > 0) | (F.col("sources_verified") > 0))


def changes(old: DataFrame, new: DataFrame, key: str, fields: list[str], reason: str) -> DataFrame:
    """(key, field_name, old_value, new_value, reason): fields of rows in both tables whose values differ, as text."""
    a = old.select(F.col(key).alias("_key"), *[F.col(f).cast("string").alias(f"_old_{f}") for f in fields])
    both = new.select(key, *fields).join(a, F.col(key) == F.col("_key"))
    parts = [F.struct(F.lit(f).alias("field_name"), F.col(f"_old_{f}").alias("old_value"), F.col(f).cast("string").alias("new_value")) for f in fields]
    return (
        both.select(key, F.explode(F.array(*parts)).alias("_c"))
        .select(key, "_c.*", F.lit(reason).alias("reason"))
        .where(~F.col("old_value").eqNullSafe(F.col("new_value")))
    )


def reassess(sources: DataFrame, least: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """(sources with new scores, change records of those that moved by more than ``least``)."""
    score = source_reliability(F.col("source_name"), F.col("source_url"), F.col("source_type"))
    marked = sources.withColumn("_new", score)
    moved = marked.where(F.abs(F.coalesce(F.col("reliability_score"), F.lit(-1.0)) - F.col("_new")) > least)
    log = moved.select("source_name", F.lit("reliability_score").alias("field_name"), F.col("reliability_score").cast("string").alias("old_value"), F.col("_new").cast("string").alias("new_value"))
    return marked.withColumn("reliability_score", F.col("_new")).drop("_new"), log


def assign_ids(current: DataFrame, names: DataFrame, name: str, out: str) -> DataFrame:
    """``current`` (out, name) with new names appended under the next ids, in the order of the names."""
    from voxloom.operators.ranking import rank_and_running

    fresh = names.select(name).where(F.col(name).isNotNull()).distinct().join(current.select(name), name, "left_anti")
    top = current.agg(F.coalesce(F.max(out), F.lit(0)).cast("bigint").alias("_top"))
    ranked = rank_and_running(fresh.withColumn("_all", F.lit(1)), ["_all"], [F.col(name)], rank="_rank")
    numbered = ranked.join(F.broadcast(top.withColumn("_all", F.lit(1))), "_all").select((F.col("_rank") + F.col("_top")).alias(out), name)
    return current.select(F.col(out).cast("bigint").alias(out), name).unionByName(numbered)
