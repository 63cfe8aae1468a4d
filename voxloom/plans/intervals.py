"""Queries of problem 1: speaking periods and gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions.readings import in_force, milliseconds, speaker_directory, speaker_key
from voxloom.operators.intervals import periods_and_gaps


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Speaking periods and gaps of each known speaker in each audio file."""
    rows = in_force(
        spark.read.parquet(f"{sf}/audio_segments.parquet"),
        ["segment_id", "audio_file", "start_s", "end_s", "speaker_id", "ingested_at"],
    ).select(
        "audio_file",
        speaker_key(F.col("speaker_id")).alias("speaker_key"),
        milliseconds(F.col("start_s")).alias("start_ms"),
        milliseconds(F.col("end_s")).alias("end_ms"),
    )
    found = periods_and_gaps(rows, ["audio_file", "speaker_key"], "start_ms", "end_ms")
    known = speaker_directory(spark.read.parquet(f"{sf}/speakers.parquet"))
    return found.join(known, "speaker_key").select(
        "audio_file", F.col("known_speaker").alias("speaker_id"), "kind", "start_ms", "end_ms"
    )


def p1_speech_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Milliseconds of speech and of pauses, and their number, per known speaker over all files."""
    return (
        p1_found(spark, sf)
        .groupBy("speaker_id", "kind")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("end_ms") - F.col("start_ms")).alias("total_ms"))
    )


QUERIES = {"p1_found": p1_found, "p1_speech_totals": p1_speech_totals}

_KEY = (
    r"nullif(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({0}), '^[^\p{{L}}\p{{N}}]+', ''), "
    r"'^(?:spk|spkr|speaker|sprecher|sprecherin|hablante|locutor|locutora|locuteur|locutrice|falante|orador|oradora|msemaji|kasafo|voice|talker)[^\p{{L}}\p{{N}}]+', ''), "
    r"'[^\p{{L}}\p{{N}}]+', '', 'g'), '(^|\P{{N}})0+(\p{{N}})', '\1\2', 'g'), '')"
)
_FOUND = rf"""
WITH known AS (
    SELECT {_KEY.format('speaker_id')} AS k, min(speaker_id) AS speaker_id FROM speakers GROUP BY 1),
force AS (
    SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY ingested_at DESC NULLS LAST, audio_file DESC, start_s DESC, end_s DESC, speaker_id DESC) AS rn
    FROM audio_segments),
rows_ AS (
    SELECT f.audio_file, n.speaker_id, CAST(round(start_s * 1000) AS BIGINT) AS a, CAST(round(end_s * 1000) AS BIGINT) AS b
    FROM force f JOIN known n ON {_KEY.format('f.speaker_id')} = n.k
    WHERE rn = 1 AND start_s IS NOT NULL AND end_s IS NOT NULL AND audio_file IS NOT NULL),
marked AS (
    SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY audio_file, speaker_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh
    FROM rows_ WHERE b > a),
numbered AS (
    SELECT *, sum(fresh) OVER (PARTITION BY audio_file, speaker_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM marked),
merged AS (
    SELECT audio_file, speaker_id, g, min(a) AS a, max(b) AS b FROM numbered GROUP BY 1, 2, 3),
following AS (
    SELECT *, lead(a) OVER (PARTITION BY audio_file, speaker_id ORDER BY a) AS nxt FROM merged),
found AS (
    SELECT audio_file, speaker_id, 'period' AS kind, a AS start_ms, b AS end_ms FROM following
    UNION ALL SELECT audio_file, speaker_id, 'gap', b, nxt FROM following WHERE nxt IS NOT NULL)
"""
ORACLE = {
    "p1_found": _FOUND + "SELECT * FROM found",
    "p1_speech_totals": _FOUND
    + "SELECT speaker_id, kind, count(*) AS n, CAST(sum(end_ms - start_ms) AS BIGINT) AS total_ms FROM found GROUP BY 1, 2",
}
