"""Lanes: text and audio batches as composed transforms, and the manifests that describe them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.text import chunks, normalize_text, text_hash
from voxloom.operators.lineage import cut
from voxloom.operators.snapshot import dataset_card
from voxloom.operators.validate import lint_manifest


def text_lane(documents: DataFrame, key: str, text: str, size: int = 400, overlap: int = 50) -> tuple[DataFrame, DataFrame]:
    """(chunks, metrics): documents cut into overlapping chunks; one row with documents, chunks and characters."""
    parts = chunks(documents, key, text, size, overlap)
    metrics = parts.agg(F.count_distinct(key).alias("documents"), F.count(F.lit(1)).alias("segments"), F.sum(F.length("chunk")).alias("characters"))
    return parts, metrics


def audio_lane(segments: DataFrame, start: Column, end: Column, least_s: float = 2.0, most_s: float = 12.0) -> tuple[DataFrame, DataFrame]:
    """(clips, metrics): segments cut into clips of at most ``most_s`` seconds of equal length; shorter ones than ``least_s`` are left out."""
    length = end - start
    n = F.ceil(length / most_s).cast("int")
    rows = segments.withColumn("_n", n).withColumn("_a", start).withColumn("_l", length / n).where((length >= least_s) & (F.col("_n") > 0))
    clips = rows.withColumn("clip_no", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    clips = clips.withColumn("clip_start_s", F.col("_a") + F.col("clip_no") * F.col("_l")).withColumn("clip_end_s", F.col("_a") + (F.col("clip_no") + 1) * F.col("_l")).drop("_n", "_a", "_l")
    return clips, clips.agg(F.count(F.lit(1)).alias("clips"), (F.sum(F.col("clip_end_s") - F.col("clip_start_s")) / 3600).alias("hours"))


def curator_lane(manifest: DataFrame, key: str = "clip_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(curated, rejected, card): clips that pass the lints, one of each text per language; why the others don't; the card.

    Texts are equal as ``normalize_text`` makes them; the smallest key stays, and clips without a text stay. ``rejected`` holds
    (key, code) with DUPLICATE for the other copies. Different sample rates don't reject a clip. A row given twice counts once.
    """
    rows = manifest.distinct()
    failed = lint_manifest(rows, key).where(F.col(key).isNotNull()).select(key, "code").distinct()
    passed = cut(rows.join(failed.select(key).distinct(), key, "left_anti"))
    same = F.when(normalize_text(F.col(text)) != "", text_hash(normalize_text(F.col(text))))
    curated = cut(passed.groupBy("lang", same.alias("_h"), F.when(same.isNull(), F.col(key)).alias("_own")).agg(F.min_by(F.struct(*rows.columns), key).alias("r")).select("r.*"))
    copies = passed.select(key).distinct().join(curated.select(key), key, "left_anti").select(key, F.lit("DUPLICATE").alias("code"))
    return curated, failed.unionByName(copies), dataset_card(curated, ["lang"])


def fold_manifests(stages: DataFrame) -> DataFrame:
    """(batch_id, outputs, metrics): the maps of all stages of a batch, later stages over earlier ones; null maps are empty."""

    def folded(c: str, kind: str) -> Column:
        empty = F.create_map().cast(kind)
        ordered = F.array_sort(F.collect_list(F.struct("stage_no", F.map_entries(F.coalesce(F.col(c), empty)).alias("m"))))
        put = lambda acc, x: F.map_concat(F.map_filter(acc, lambda k, v: ~F.exists(x["m"], lambda e: e["key"] == k)), F.map_from_entries(x["m"]))
        return F.aggregate(ordered, empty, put).alias(c)

    return stages.groupBy("batch_id").agg(folded("outputs", "map<string,string>"), folded("metrics", "map<string,double>"))


def estimate(segments: DataFrame, seconds: Column, bytes_per_second: int = 16_000) -> DataFrame:
    """(hours, gib): what a batch will take, from the seconds of its segments."""
    return segments.agg((F.coalesce(F.sum(seconds), F.lit(0.0)) / 3600).alias("hours"), (F.coalesce(F.sum(seconds), F.lit(0.0)) * bytes_per_second / (1 << 30)).alias("gib"))
