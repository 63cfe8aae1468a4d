"""Readings of dirty columns that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# General words for "speaker" that may stand before a speaker's number.
SPEAKER_WORDS = (
    "spk", "spkr", "speaker", "sprecher", "sprecherin", "hablante", "locutor", "locutora", "locuteur", "locutrice",
    "falante", "orador", "oradora", "msemaji", "kasafo", "voice", "talker",
)

_SPEAKER_PREFIX = "^(?:" + "|".join(sorted(SPEAKER_WORDS, key=len, reverse=True)) + r")[^\p{L}\p{N}]+"


def speaker_key(label: Column) -> Column:
    """The form in which all spellings of one speaker label agree.

    Letter case, separators, zeros before a number and a general word for "speaker" in front are dropped, so
    ``SPEAKER es-000088`` and ``es_00088`` both give ``es88``. Null and labels without letters or digits give null.
    """
    low = F.regexp_replace(F.lower(label), r"^[^\p{L}\p{N}]+", "")
    bare = F.regexp_replace(low, _SPEAKER_PREFIX, "")
    joined = F.regexp_replace(bare, r"[^\p{L}\p{N}]+", "")
    key = F.regexp_replace(joined, r"(?<!\p{N})0+(?=\p{N})", "")
    return F.when(key != "", key)


def speaker_directory(speakers: DataFrame, key: str = "speaker_key", out: str = "known_speaker") -> DataFrame:
    """One row per key with the right spelling of the speaker; the smallest where two registered ids share a key."""
    return (
        speakers.select(speaker_key(F.col("speaker_id")).alias(key), F.col("speaker_id").alias(out))
        .where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(out).alias(out))
    )


def recording(path: Column) -> Column:
    """The name ``rec_`` + digits in a file path, in lower case; null if there is none."""
    name = F.regexp_extract(F.lower(path), r"rec_[0-9]+", 0)
    return F.when(name != "", name)


def milliseconds(seconds: Column) -> Column:
    """Whole milliseconds, rounded; null for null, NaN and infinite seconds."""
    return F.when(~F.isnan(seconds) & (F.abs(seconds) < F.lit(9e12)), F.round(seconds * 1000).cast("long"))


def in_force(segments: DataFrame, columns: list[str], key: str = "segment_id", at: str = "ingested_at") -> DataFrame:
    """Of several rows of one ``key`` the one with the latest ``at``; equal rows count once.

    Rows that differ but have the same ``at`` (or only null ones) are settled by the largest values of ``columns`` in
    their order, so the result doesn't depend on the order of rows. Rows whose key is null name no segment and are left out.
    """
    kept = [c for c in columns if c not in (key, at)]
    return (
        segments.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(F.col(at), *[F.col(c) for c in kept])).alias("_row"))
        .select(key, *[F.col(f"_row.{c}").alias(c) for c in kept])
    )
