"""Events behind the watermark are kept: they go to a side table and are merged from there.

Spark's stateful operators drop rows behind the watermark without a trace.  Here the
watermark of a micro-batch is worked out before any state sees it, from the newest event
time of all earlier batches: each batch is written in one pass, split by a ``late`` flag,
and its newest event time (observed by the same pass) is stored beside it.  Everything is
stored under the batch id, so a replayed batch replaces its own files and gets the
same watermark again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from incidentpanel.skew import latest_by
from incidentpanel.sources.readers import read_table
from incidentpanel.streaming.overlay import windowed_counts

FACTS = "newest timestamp, n_late long, n_rows long, batch_id long"


def batch_facts(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, newest, n_late, n_rows) of all routed batches."""
    found = read_table(spark, f"{path}/facts")
    return spark.createDataFrame([], FACTS) if found is None else found.select("newest", "n_late", "n_rows", F.col("batch_id").cast("long"))


def watermark_before(spark: SparkSession, path: str, batch_id: int) -> datetime | None:
    """Newest event time of the batches before this one; none before the first."""
    earlier = batch_facts(spark, path).filter(F.col("batch_id") < batch_id)
    return earlier.agg(F.max("newest")).first()[0]


def route_available(stream: DataFrame, path: str, checkpoint: str, time: str, delay: str) -> StreamingQuery:
    """Store everything available, flagged ``late`` where it lies more than ``delay`` behind.

    ``stream`` must not be stateful.  Rows without an event time are not late.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = watermark_before(spark, path, batch_id)
        late = F.lit(False)
        if newest is not None:
            late = F.coalesce(F.col(time) < F.lit(newest) - F.expr(f"interval {delay}"), F.lit(False))
        seen = Observation()
        routed = batch.withColumn("late", late.cast("int"))
        facts = [F.max(time).alias("newest"), F.sum("late").alias("n_late"), F.count("*").alias("n_rows")]
        routed.observe(seen, *facts).write.mode("overwrite").partitionBy("late").parquet(f"{path}/events/batch_id={batch_id}")
        got = seen.get
        row = spark.createDataFrame([(got["newest"], got["n_late"] or 0, got["n_rows"])], "newest timestamp, n_late long, n_rows long")
        row.coalesce(1).write.mode("overwrite").parquet(f"{path}/facts/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _stored(spark: SparkSession, path: str) -> DataFrame:
    found = read_table(spark, f"{path}/events")
    if found is None:
        raise FileNotFoundError(f"nothing was routed to {path}")
    return found


def routed_events(spark: SparkSession, path: str, key: Sequence[str]) -> DataFrame:
    """All stored events, each key once as it first arrived, with ``late`` and ``batch_id``."""
    first = latest_by(_stored(spark, path), key, [F.col("batch_id")], smallest=True)
    return first.withColumn("late", F.col("late") == 1)


def late_events(spark: SparkSession, path: str) -> DataFrame:
    """The side table; only its partitions are read."""
    return _stored(spark, path).filter(F.col("late") == 1).drop("late")


def merged_counts(events: DataFrame, time: str, entity: Sequence[str], weekly: bool = False) -> DataFrame:
    """Counts of on-time and late events of each window, and how many of them were late."""
    both = windowed_counts(events, time, [*entity, "late"], weekly)
    return both.groupBy(*entity, "period_start").agg(
        F.sum("accident_count").alias("accident_count"),
        F.sum(F.when(F.col("late"), F.col("accident_count")).otherwise(0)).alias("late_count"),
    )
