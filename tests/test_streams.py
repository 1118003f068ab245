"""Feeds that arrive in several deliveries: late rows, restarts, incremental weather."""

from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

from pyspark.sql import functions as F

from incidentpanel.session import scratch_path
from incidentpanel.streaming import late as L
from incidentpanel.streaming import overlay as O
from incidentpanel.streaming import weather as W

SCHEMA = "id int, ts timestamp, kind string"


def at(day, hour=12):
    return datetime(2024, 1, day, hour)


def deliver(spark, feed, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(feed)


def drain(spark, feed, path, checkpoint):
    stream = spark.readStream.schema(spark.createDataFrame([], SCHEMA).schema).parquet(feed)
    L.route_available(stream, path, checkpoint, "ts", "1 day").awaitTermination()


def test_late_rows_are_kept_and_merged(spark):
    feed, (path, checkpoint) = scratch_path(spark, "feed"), O.run_folders(spark, "routed")
    deliver(spark, feed, [(1, at(1), "a"), (2, at(5), "a"), (3, at(2), "b")])
    drain(spark, feed, path, checkpoint)
    # In the first delivery nothing is late; a row at the watermark itself is not late either.
    deliver(spark, feed, [(4, at(1), "a"), (5, at(4), "a"), (6, at(4, 11), "a"), (7, at(7), "b"), (2, at(5), "a"), (8, None, "b")])
    drain(spark, feed, path, checkpoint)
    drain(spark, feed, path, checkpoint)
    assert {(r.id, r.batch_id) for r in L.late_events(spark, path).collect()} == {(4, 1), (6, 1)}
    events = L.routed_events(spark, path, ["id"])
    assert {(r.id, r.late) for r in events.collect()} == {(i, i in (4, 6)) for i in range(1, 9)}
    counts = {(r.kind, r.period_start): (r.accident_count, r.late_count) for r in L.merged_counts(events, "ts", ["kind"]).collect()}
    assert counts == {
        ("a", date(2024, 1, 1)): (2, 1), ("a", date(2024, 1, 5)): (1, 0), ("a", date(2024, 1, 4)): (2, 1),
        ("b", date(2024, 1, 2)): (1, 0), ("b", date(2024, 1, 7)): (1, 0),
    }
    facts = {r.batch_id: (r.newest, r.n_late, r.n_rows) for r in L.batch_facts(spark, path).collect()}
    assert facts == {0: (at(5), 0, 3), 1: (at(7), 2, 6)}


def test_a_replayed_batch_gets_its_watermark_again(spark):
    feed, (path, checkpoint) = scratch_path(spark, "feed"), O.run_folders(spark, "routed")
    for rows in ([(1, at(9), "a")], [(2, at(1), "a"), (3, at(20), "a")]):
        deliver(spark, feed, rows)
        drain(spark, feed, path, checkpoint)
    before = sorted(map(tuple, L.routed_events(spark, path, ["id"]).collect()))
    # The second batch again, as after a crash before its commit: the same bar, the same rows.
    assert L.watermark_before(spark, path, 1) == at(9) and L.watermark_before(spark, path, 0) is None
    other = scratch_path(spark, "again")
    drain(spark, feed, path, other)
    assert sorted(r[0] for r in before) == sorted(r.id for r in L.routed_events(spark, path, ["id"]).collect())


def payload(spark, feed, cells):
    rows = [(float(c), 0.0, 1.0, (days, warm)) for c, days, warm in cells]
    kind = "latitude double, longitude double, elevation double, daily struct<time: array<string>, temperature_2m_max: array<string>>"
    spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").json(feed)


def files(path):
    return {p.relative_to(path): p.stat().st_mtime_ns for p in Path(path.removeprefix("file:")).rglob("*.parquet")}


def stored(spark, path):
    return {(r.latitude, r.weather_date): r.temperature_2m_max for r in spark.read.parquet(path).collect()}


def test_only_touched_partitions_are_rewritten(spark):
    feed, (path, checkpoint) = scratch_path(spark, "weather"), O.run_folders(spark, "weather")

    def load(start=None):
        W.load_available(W.weather_stream(spark, feed, multiline=False), path, checkpoint, start).awaitTermination()

    assert W.resume_date(spark, path) is None
    payload(spark, feed, [(1, ["2023-12-30", "2024-01-31", "2024-02-01"], ["1", "2", "3"]), (2, ["2024-02-01", "no date"], ["4"])])
    load()
    assert W.resume_date(spark, path) == date(2024, 2, 1)
    before = files(path)
    payload(spark, feed, [(1, ["2024-01-31", "2024-02-01", "2024-02-02"], ["20", "30", "40"])])
    load(W.resume_date(spark, path))
    # The day before the newest stored one is left as it is; the newest one is revised.
    assert stored(spark, path) == {
        (1.0, date(2023, 12, 30)): "1", (1.0, date(2024, 1, 31)): "2", (1.0, date(2024, 2, 1)): "30",
        (1.0, date(2024, 2, 2)): "40", (2.0, date(2024, 2, 1)): "4",
    }
    after = files(path)
    same = {p for p in before if after.get(p) == before[p]}
    assert {str(p.parent) for p in same} == {"year=2023/month=12", "year=2024/month=1"}
    load(W.resume_date(spark, path))
    assert files(path) == after


def test_several_deliveries_keep_their_state(spark):
    feed, (data, checkpoint) = scratch_path(spark, "feed"), O.run_folders(spark, "state")
    for rows in ([(1, at(1), "a"), (2, at(1), "a")], [(2, at(1), "a"), (3, at(2), "a")]):
        deliver(spark, feed, rows)
        schema = spark.createDataFrame([], SCHEMA).schema
        stream = O.deduplicated(O.read_events(spark, feed, schema, "ts", "5 days"), ["id"])
        O.write_available(stream, data, checkpoint).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(data).select(F.col("id")).collect()) == [1, 2, 3]
