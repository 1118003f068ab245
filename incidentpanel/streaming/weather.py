"""Incremental weather load: a stream over JSON folders that rewrites touched partitions only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from incidentpanel.operators.keys import upsert
from incidentpanel.session import scratch_path
from incidentpanel.skew import latest_by
from incidentpanel.sources.readers import WEATHER_SCHEMA, read_table, unnest_daily, weather_cells
from incidentpanel.sources.writers import refresh_partitions, write_table

KEYS = ("latitude", "longitude", "weather_date")
FETCHED = "source_fetched_at"


def by_month() -> dict[str, Column]:
    return {"year": F.year("weather_date"), "month": F.month("weather_date")}


def weather_stream(spark: SparkSession, folder: str, multiline: bool = True) -> DataFrame:
    """One row per cell and day of every payload that arrives, with the time its file was stored."""
    raw = spark.readStream.schema(WEATHER_SCHEMA).option("multiLine", multiline).json(folder)
    cells = weather_cells(raw.withColumn(FETCHED, F.col("_metadata.file_modification_time")), FETCHED)
    return unnest_daily(cells)


def resume_date(spark: SparkSession, path: str) -> date | None:
    """Newest stored day, where the next load starts; none before the first load."""
    stored = read_table(spark, path)
    return None if stored is None else stored.agg(F.max("weather_date")).first()[0]


def load_available(
    days: DataFrame,
    path: str,
    checkpoint: str,
    start: date | None = None,
    partitions: Mapping[str, Column] | None = None,
    keys: Sequence[str] = KEYS,
) -> StreamingQuery:
    """Merge all available days from ``start`` on into the table at ``path``.

    The payload stored last wins per key.  A batch names the partitions it touches (at
    most as many as the calendar has), reads those, and replaces them; the others keep
    their files.  A replayed batch gives the same rows again.
    """
    columns = dict(partitions or by_month())
    order = [F.col(FETCHED), F.col("source_json_path"), F.col("day_index")]

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        wanted = batch if start is None else batch.filter(F.col("weather_date") >= F.lit(start))
        fresh_path = scratch_path(spark, "weather-fresh")
        latest_by(wanted, keys, order).withColumns(columns).write.parquet(fresh_path)
        fresh = spark.read.parquet(fresh_path)
        touched = [tuple(r) for r in fresh.select(*columns).distinct().collect()]
        if not touched:
            return
        stored = read_table(spark, path)
        if stored is None:
            write_table(fresh, path, list(columns))
            return
        # Literal partition values, so that the scan is pruned to them.
        picked = F.lit(False)
        for values in touched:
            same = F.lit(True)
            for name, value in zip(columns, values, strict=True):
                same = same & (F.col(name) == F.lit(value))
            picked = picked | same
        merged = upsert(stored.filter(picked).select(*fresh.columns), fresh, keys, order)
        staged = write_table(merged, scratch_path(spark, "weather-merged"))
        refresh_partitions(spark.read.parquet(staged), path, list(columns))

    return (
        days.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
