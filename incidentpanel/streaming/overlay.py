"""Near-real-time overlay next to the batch panel.

Events are de-duplicated inside the watermark, counted in tumbling windows or
upserted batch by batch.  The batch history is never changed: the overlay lives
in its own folder and is merged on read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from incidentpanel.operators.keys import upsert
from incidentpanel.session import scratch_path
from incidentpanel.skew import latest_by


def read_events(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    time: str,
    late: str,
    files: str = "*",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """File stream with an event-time watermark.  Event time must be a TIMESTAMP.

    With ``files_per_trigger`` the files are taken in order of their arrival; an event
    that arrives more than ``late`` behind the newest one seen is left to the batch history.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    raw = reader.parquet(folder)
    return raw.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)


def stable_key(*columns: str) -> Column:
    """Deterministic key over source fields for feeds without an id.

    128 bits of SHA-256 make a collision between real events unlikely.
    """
    return F.substring(F.sha2(F.to_json(F.struct(*columns)), 256), 1, 32)


def deduplicated(events: DataFrame, key: Sequence[str]) -> DataFrame:
    return events.dropDuplicatesWithinWatermark(list(key))


def windowed_counts(events: DataFrame, time: str, entity: Sequence[str], weekly: bool = False) -> DataFrame:
    """Daily counts, or weekly ones from Monday (the epoch is a Thursday)."""
    bucket = F.window(time, "7 days", startTime="4 days") if weekly else F.window(time, "1 day")
    return (
        events.groupBy(bucket.alias("w"), *entity)
        .agg(F.count("*").alias("accident_count"))
        .select(*entity, F.to_date("w.start").alias("period_start"), "accident_count")
    )


def write_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process everything available now into a Parquet folder."""
    return (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def upsert_available(
    stream: DataFrame, overlay: str, checkpoint: str, keys: Sequence[str], order: Sequence[Column]
) -> StreamingQuery:
    """Reduce every micro-batch to its newest row per key and store it under its batch id.

    A replayed batch overwrites its own folder, so the overlay is idempotent.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        reduced = latest_by(batch, keys, order)
        reduced.write.mode("overwrite").parquet(f"{overlay}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_overlay(spark: SparkSession, overlay: str, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Newest row per key over all stored batches."""
    return latest_by(spark.read.parquet(overlay).drop("batch_id"), keys, order)


def compact_overlay(spark: SparkSession, overlay: str, target: str, keys: Sequence[str], order: Sequence[Column]) -> str:
    """Rewrite the stored batches below a new folder as one, newest row per key.

    It gets the batch id -1, so batches that a restarted stream stores there later stand
    beside it; the old folder is left to its owner.
    """
    read_overlay(spark, overlay, keys, order).write.mode("overwrite").parquet(f"{target}/batch_id=-1")
    return target


def merged_view(history: DataFrame, overlay: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Batch history with the overlay on top."""
    return upsert(history, overlay, keys, order)


def watermarks(history: DataFrame, overlay: DataFrame, day: str) -> DataFrame:
    """Latest batch date, latest overlay date and the time of the check, one row."""
    return history.agg(F.max(day).alias("latest_batch")).select(
        "latest_batch", overlay.agg(F.max(day)).scalar().alias("latest_overlay"), F.current_timestamp().alias("checked_at")
    )


def run_folders(spark: SparkSession, name: str) -> tuple[str, str]:
    """Output and checkpoint folders below the shared scratch root."""
    base = scratch_path(spark, name)
    return f"{base}/data", f"{base}/checkpoint"
