"""Windowed aggregates and late duplicates, for streams and for tables alike."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def with_time(events: DataFrame, at: str = "ts") -> DataFrame:
    """``events`` with ``at`` as a timestamp with time zone, which watermarks need."""
    return events.withColumn(at, F.col(at).cast("timestamp"))


def throughput(events: DataFrame, at: str, length: str, slide: str | None = None, lateness: str | None = None, keys: list[str] | None = None, value: str | None = None) -> DataFrame:
    """(window_start, window_end, keys, n, total): events per tumbling, or sliding, window.

    With ``lateness`` a stream drops state and events that are later than that behind the latest event.
    """
    rows = events.withWatermark(at, lateness) if lateness else events
    out = rows.groupBy(F.window(at, length, slide), *(keys or [])).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col(value) if value else F.lit(0.0)), 6).alias("total"))
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *(keys or []), "n", "total")


def sessions(events: DataFrame, at: str, gap: str, keys: list[str], lateness: str | None = None) -> DataFrame:
    """(session_start, session_end, keys, n): events of a key with no longer pause than ``gap``."""
    rows = events.withWatermark(at, lateness) if lateness else events
    out = rows.groupBy(F.session_window(at, gap), *keys).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), *keys, "n")


def without_late_duplicates(events: DataFrame, at: str, key: str, lateness: str) -> DataFrame:
    """Each key once, if its copies come within ``lateness`` of each other; in a table simply once."""
    if events.isStreaming:
        return events.withWatermark(at, lateness).dropDuplicatesWithinWatermark([key])
    return events.dropDuplicates([key])


def stream_table(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 16) -> DataFrame:
    """A stream of the parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def run_available(df: DataFrame, sink: str, checkpoint: str, mode: str = "complete") -> None:
    """Runs a stream over what is there and ends; the sink is a parquet folder, written anew by every batch in complete mode."""

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(sink)

    df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(put).start().awaitTermination()


def batch_status(events: DataFrame) -> DataFrame:
    """(batch_id, status, stages): a batch has succeeded once its stage ``validate`` is there, failed with an error, else is running."""
    return events.groupBy("batch_id").agg(
        F.when(F.max(F.col("error").isNotNull().cast("int")) == 1, "failed").when(F.max((F.col("stage") == "validate").cast("int")) == 1, "succeeded").otherwise("running").alias("status"),
        F.array_sort(F.collect_set("stage")).alias("stages"),
    )


def batch_progress(events: DataFrame) -> DataFrame:
    """(batch_id, status, n_events) of a stream of (batch_id, stage, error), by state kept per batch: a batch fails for good
    with its first error and has succeeded with its stage ``validate``. Every change comes out again (update mode)."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, failed, done = state.get if state.exists else (0, False, False)
        for f in frames:
            n, failed, done = n + len(f), failed or bool(f["error"].notna().any()), done or bool((f["stage"] == "validate").any())
        state.update((n, failed, done))
        yield pd.DataFrame({"batch_id": [key[0]], "status": ["failed" if failed else "succeeded" if done else "running"], "n_events": [n]})

    return events.select("batch_id", "stage", "error").groupBy("batch_id").applyInPandasWithState(
        step, "batch_id bigint, status string, n_events bigint", "n bigint, failed boolean, done boolean", "update", "NoTimeout"
    )
