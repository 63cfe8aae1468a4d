"""Dataset cards and lint-gated snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.operators.validate import lint_manifest
from voxloom.schemas import schema
from voxloom.sources.readers import jsonl_strict
from voxloom.sources.sinks import write_jsonl, write_metadata_csv


def dataset_card(manifest: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(clips, sample_rate, minutes), for the whole manifest or per group."""
    out = [
        F.count(F.lit(1)).alias("clips"),
        F.array_sort(F.collect_set("sample_rate")).alias("sample_rate"),
        (F.coalesce(F.sum("duration_s"), F.lit(0.0)) / 60).alias("minutes"),
    ]
    return manifest.groupBy(*(by or [])).agg(*out)


class LintError(ValueError):
    """A manifest has lint issues."""


def build_snapshot(manifest: DataFrame, folder: str, key: str = "wav", use_phonemes: bool = False) -> dict[str, str]:
    """Manifest, metadata and card under ``folder``; nothing is written and LintError raised where the manifest has issues."""
    found = lint_manifest(manifest, key)
    bad = found.groupBy("code").count().orderBy("code").collect()
    if bad:
        raise LintError(", ".join(f"{r['code']}: {r['count']}" for r in bad))
    paths = {n: f"{folder}/{n}" for n in ("manifest", "metadata", "dataset_card")}
    write_jsonl(manifest, paths["manifest"])
    write_metadata_csv(manifest, paths["metadata"], use_phonemes)
    dataset_card(manifest).coalesce(1).write.mode("overwrite").json(paths["dataset_card"])
    return paths


def build_from_file(spark: SparkSession, path: str, folder: str, use_phonemes: bool = False) -> dict[str, str]:
    """``build_snapshot`` of a manifest file of JSON lines; a malformed line ends it, blank lines are skipped."""
    return build_snapshot(jsonl_strict(spark, path, schema("ManifestRow")), folder, "wav", use_phonemes)
