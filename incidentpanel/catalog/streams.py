"""Queries that drive a streaming job over all available events to completion."""

from __future__ import annotations

from pyspark.sql import functions as F

from incidentpanel.catalog.registry import query
from incidentpanel.catalog.roles import table
from incidentpanel.session import scratch_path
from incidentpanel.streaming import late as L
from incidentpanel.streaming import overlay as O
from incidentpanel.streaming import weather as W


def event_stream(spark, sf, late):
    schema = table(spark, sf, "events").schema
    return O.read_events(spark, sf, schema, "ts", late, files="events.parquet")


def deliveries(events, arrival, parts):
    """The events by arrival, one delivery after the other."""
    return [events.filter(arrival == part) for part in range(parts)]


def counted(spark, sf, weekly):
    """Counts over a feed of two deliveries; the second run goes on from the first one's state.

    Windows the watermark has not closed are read from the update log.
    """
    events = table(spark, sf, "events")
    feed = scratch_path(spark, "feed")
    data, checkpoint = O.run_folders(spark, "counts")

    def store(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{data}/batch_id={batch_id}")

    for delivery in deliveries(events, (F.dayofmonth("ts") > 15).cast("int"), 2):
        delivery.write.mode("append").parquet(feed)
        stream = O.deduplicated(O.read_events(spark, feed, events.schema, "ts", "2 days"), ["event_id"])
        counts = O.windowed_counts(stream, "ts", ["event_type"], weekly)
        (
            counts.writeStream.foreachBatch(store)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    # The newest batch holds the final count of a window.
    return (
        spark.read.parquet(data)
        .groupBy("event_type", "period_start")
        .agg(F.max_by("accident_count", "batch_id").alias("accident_count"))
    )


@query(
    "stream_daily_counts",
    "SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS period_start, count(*) AS accident_count FROM events GROUP BY 1, 2",
)
def stream_daily_counts(spark, sf):
    return counted(spark, sf, weekly=False)


@query(
    "stream_weekly_counts",
    "SELECT event_type, CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS period_start, count(*) AS accident_count FROM events GROUP BY 1, 2",
)
def stream_weekly_counts(spark, sf):
    return counted(spark, sf, weekly=True)


@query(
    "stream_closed_windows",
    """SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS period_start, count(*) AS accident_count FROM events GROUP BY 1, 2
       HAVING CAST(any_value(CAST(ts AS DATE)) AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
)
def stream_closed_windows(spark, sf):
    """Append mode: only windows behind the watermark are written."""
    counts = O.windowed_counts(event_stream(spark, sf, "1 hour"), "ts", ["event_type"])
    data, checkpoint = O.run_folders(spark, "closed")
    O.write_available(counts, data, checkpoint).awaitTermination()
    return spark.read.parquet(data)


UPSERT_SQL = """WITH r AS (SELECT user_id % 25 AS code, CAST(ts AS DATE) AS day, event_id, value,
    row_number() OVER (PARTITION BY user_id % 25, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS r FROM events)
  SELECT code, CAST(day AS VARCHAR) AS day, event_id, round(value, 6) AS value FROM r WHERE r = 1"""


@query("stream_upsert", UPSERT_SQL)
def stream_upsert(spark, sf):
    """Batch history of the early events, overlay of the late ones, merged on read."""
    order = [F.col("ts"), F.col("event_id")]
    keys = ["code", "day"]

    def shaped(df):
        return df.select((F.col("user_id") % 25).alias("code"), F.to_date("ts").alias("day"), "event_id", "ts", "value")

    batch = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    history = shaped(batch.filter(F.dayofmonth("ts") <= 20))
    late = shaped(event_stream(spark, sf, "3 days").filter(F.dayofmonth("ts") >= 15))
    data, checkpoint = O.run_folders(spark, "overlay")
    O.upsert_available(late, data, checkpoint, keys, order).awaitTermination()
    fresh = O.read_overlay(spark, data, keys, order)
    return O.merged_view(history, fresh, keys, order).select("code", "day", "event_id", "value")


@query(
    "overlay_watermarks",
    """SELECT CAST(CAST(max(ts) FILTER (WHERE day(ts) <= 20) AS DATE) AS VARCHAR) AS latest_batch, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS latest_overlay,
         count(DISTINCT event_type || value || user_id || CAST(ts AS VARCHAR)) AS distinct_keys FROM events""",
)
def overlay_watermarks(spark, sf):
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    keys = events.select(O.stable_key("event_type", "value", "user_id", "ts").alias("k"))
    marks = O.watermarks(events.filter(F.dayofmonth("ts") <= 20), events, "day").drop("checked_at")
    return marks.withColumn("distinct_keys", keys.agg(F.count_distinct("k")).scalar())


ARRIVAL_SQL = """a AS (SELECT *, CASE WHEN event_id % 97 = 0 THEN 3 ELSE (day(ts) - 1) // 8 END AS part FROM events),
  m AS (SELECT part, max(max(ts)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 2 DAY AS bar FROM a GROUP BY part),
  r AS (SELECT a.*, coalesce(ts < bar, false) AS late FROM a JOIN m USING (part))"""


def routed(spark, sf):
    """Four deliveries, one run each; every 97th event only comes with the last one."""
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    part = F.when(F.col("event_id") % 97 == 0, 3).otherwise(F.floor((F.dayofmonth("ts") - 1) / 8))
    feed = scratch_path(spark, "feed")
    path, checkpoint = O.run_folders(spark, "routed")
    for delivery in deliveries(events, part, 4):
        delivery.write.mode("append").parquet(feed)
        stream = spark.readStream.schema(events.schema).parquet(feed)
        L.route_available(stream, path, checkpoint, "ts", "2 days").awaitTermination()
    return path


@query(
    "late_event_counts",
    f"""WITH {ARRIVAL_SQL} SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS period_start, count(*) AS accident_count,
        count(*) FILTER (WHERE late) AS late_count FROM r GROUP BY 1, 2""",
)
def late_event_counts(spark, sf):
    """Daily counts with the events that came behind the watermark, and how many those were."""
    events = L.routed_events(spark, routed(spark, sf), ["event_id"])
    return L.merged_counts(events, "ts", ["event_type"])


@query(
    "late_event_rows",
    f"WITH {ARRIVAL_SQL} SELECT event_id, event_type, part AS batch_id, round(value, 6) AS value FROM r WHERE late",
)
def late_event_rows(spark, sf):
    """The side table: each late event and the delivery it came with."""
    return L.late_events(spark, routed(spark, sf)).select("event_id", "event_type", "batch_id", F.round("value", 6).alias("value"))


@query(
    "stream_weather_load",
    """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS warm FROM events GROUP BY 1, 2),
         s AS (SELECT max(day) AS start FROM d WHERE day(day) <= 20)
       SELECT CAST(user_id AS DOUBLE) AS elevation, CAST(day AS VARCHAR) AS weather_date,
         round(CASE WHEN day >= start THEN warm + 100 ELSE warm END, 6) AS warm FROM d, s WHERE day(day) <= 20 OR day >= start""",
)
def stream_weather_load(spark, sf):
    """Two feeds of weather payloads: days 1 to 20, then corrected days from 15 on, taken from the newest stored day."""
    u = F.col("user_id")
    daily = table(spark, sf, "events").groupBy(u, F.to_date("ts").alias("day")).agg(F.max("value").alias("warm"))
    feed = scratch_path(spark, "weather-feed")
    path, checkpoint = O.run_folders(spark, "weather")
    weeks = {"year": F.year("weather_date"), "week": F.weekofyear("weather_date")}
    feeds = [daily.filter(F.dayofmonth("day") <= 20), daily.filter(F.dayofmonth("day") >= 15).withColumn("warm", F.col("warm") + 100)]
    for days in feeds:
        entry = F.struct(F.col("day").cast("string").alias("d"), F.col("warm").cast("string").alias("w"))
        cells = days.groupBy(u).agg(F.array_sort(F.collect_list(entry)).alias("a"))
        series = F.struct(F.col("a.d").alias("time"), F.col("a.w").alias("temperature_2m_max"))
        payload = cells.select(u.cast("double").alias("latitude"), F.lit(0.0).alias("longitude"), u.cast("double").alias("elevation"), series.alias("daily"))
        payload.write.mode("append").json(feed)
        start = W.resume_date(spark, path)
        W.load_available(W.weather_stream(spark, feed, multiline=False), path, checkpoint, start, weeks).awaitTermination()
    stored = spark.read.parquet(path)
    return stored.select("elevation", "weather_date", F.round(F.col("temperature_2m_max").cast("double"), 6).alias("warm"))
