"""Whole jobs on small inputs, checked against direct computation."""

from __future__ import annotations

import json
import math
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from incidentpanel.functions import crs
from incidentpanel.operators import samples as S
from incidentpanel.operators import weather as WX
from incidentpanel.plans import daily_forecast as DF
from incidentpanel.plans import event_panel as EP
from incidentpanel.session import scratch_path
from incidentpanel.sources import readers as R
from incidentpanel.sources import writers as W
from incidentpanel.streaming import overlay as O

HEAD = "id;data_inversa;horario;uf;br;km;municipio;pessoas;mortos;latitude;longitude;fase_dia"


def square(x0: float, y0: float, side: float = 0.5) -> str:
    c = [(x0, y0), (x0 + side, y0), (x0 + side, y0 + side), (x0, y0 + side), (x0, y0)]
    return "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in c) + "))"


def raw_events(spark):
    """The road runs along latitude -27.25 from -49.0 to -48.0."""
    rows = [
        "1;2024-01-01;08:00:00;sc;101;10,5;A ;2;1;-27,25;-48,9;Pleno dia",
        "2;2024-01-01;09:30:00;SC;0101;11;A;3;0;-27,2505;-48,8;Plena Noite",
        "3;2024-01-10;23:59:59;SC;101;12;B;;;-27,25;-48,2;Pleno dia",
        "4;2024-01-05;10:00:00;SC;101;12;B;5;2;-27,30;-48,2;Pleno dia",
        "5;2024-01-05;10:00:00;SC;101;12;B;5;2;0;0;Pleno dia",
        "6;2024-01-06;10:00:00;SC;116;12;B;5;2;-27,25;-48,2;Pleno dia",
        "7;2024-01-21;10:00:00;SC;101;12;B;1;0;;;Pleno dia",
        "8;;10:00:00;SC;101;12;A;4;1;-27,25;-48,9;Pleno dia",
        "9;2024-01-03;10:00:00;PR;101;12;C;4;0;-27,2501;-48,85;Pleno dia",
        "10;2024-01-04;10:00:00;SC;101;12;-;1;0;-27,25;-47,9999;Amanhecer",
    ]
    folder = scratch_path(spark, "raw")
    spark.createDataFrame([("\n".join([HEAD, *rows]),)], "value string").coalesce(1).write.text(f"{folder}/datatran2024")
    return EP.standardise_events(R.read_delimited(spark, [f"{folder}/datatran2024"], encoding="UTF-8"))


def territories(spark, code, name):
    rows = [
        ("10", "Alfa", "sc", "42", "INT", square(-49.0, -27.5), "1.234,5"),
        ("11", " Beta ", "SC", "42", "INT", square(-48.5, -27.5), "250,75"),
        ("12", "Longe", "SC", "42", "INT", square(-45.0, -25.0), "x"),
        ("13", "Outro", "MG", "31", "INT", square(-49.0, -27.5), "9"),
    ]
    raw = spark.createDataFrame(rows, f"{code} string, {name} string, sg_uf string, cd_rgint string, nm_rgint string, geometry string, area_km2 string")
    return EP.standardise_territories(raw, code, name, "municipio")


def snapshots(spark):
    line = "LINESTRING (-49.0 -27.25, -48.7 -27.25, -48.0 -27.25)"
    part = "MULTILINESTRING ((-48.7 -27.25, -49.0 -27.25))"
    rows = [("101", 2017, "v1", line), ("101", 2021, "v2", part), ("116", 2021, "v2", square(-49, -27))]
    raw = spark.createDataFrame(rows, "br_canonical string, snapshot_year int, versao_snv string, geometry string")
    return EP.road_snapshots(raw)


SETTINGS = EP.CorridorSettings(buffer_m=500.0, cell_m=10_000.0)


@pytest.fixture(scope="module")
def events(spark):
    return raw_events(spark).cache()


def test_standardised_events(events):
    rows = {int(r["id"]): r for r in events.collect()}
    assert set(rows) == {1, 2, 3, 4, 5, 7, 8, 9, 10}
    assert rows[1]["uf"] == "SC" and rows[1]["municipio"] == "A" and rows[1]["km"] == 10.5 and rows[1]["source_year_file"] == 2024
    assert rows[2]["br_canonical"] == "101"
    assert rows[5]["has_valid_coords"] is False and rows[5]["latitude"] is None and rows[7]["has_valid_coords"] is None
    assert rows[8]["timestamp"] is None and rows[8]["has_valid_timestamp"] is False
    assert rows[1]["week_start"] == date(2024, 1, 1) and rows[3]["fatal_victims_occ"] == 0


def test_territories_and_roads(spark):
    rows = {r["codigo_municipio"]: r for r in territories(spark, "codigo_municipio", "nome_municipio").collect()}
    assert set(rows) == {"10", "11", "12"}
    assert rows["11"]["nome_municipio"] == "Beta" and rows["11"]["area_km2_ibge"] == 250.75 and rows["10"]["area_km2_ibge"] is None
    assert rows["10"]["geometry_type"] == "Polygon" and 2500 < rows["10"]["polygon_area_km2"] < 3000
    summary = {r["snapshot_year"]: r for r in EP.snapshot_summary(snapshots(spark)).collect()}
    assert summary[2017]["segments"] == 2 and summary[2021]["versao_snv"] == "v2"
    union = EP.road_union(snapshots(spark), SETTINGS)
    total = union.agg(F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))).first()[0]
    # The 2021 part lies on the 2017 line and counts once.
    assert total == pytest.approx(summary[2017]["road_length_m"], rel=1e-6)


def test_municipality_panel(spark, events):
    towns = territories(spark, "codigo_municipio", "nome_municipio")
    out = EP.municipality_panel(events, towns, snapshots(spark), "SC", SETTINGS)
    assert {r["codigo_municipio"] for r in out["municipios_in_scope"].collect()} == {"10", "11"}
    placed = {r["id"]: r["codigo_municipio"] for r in out["canonical_accidents"].collect()}
    # 4 is 5 km off, 5 far away, 7 has no coordinates, 10 lies beyond the last square.
    assert placed == {1: "10", 2: "10", 3: "11", 8: "10", 10: None}
    days = {(r["codigo_municipio"], r["accident_date"]): r for r in out["day_panel"].collect()}
    # The span comes from all cleaned events of the state, up to event 7.
    assert len(days) == 2 * 21 and min(d for _, d in days) == date(2024, 1, 1) and max(d for _, d in days) == date(2024, 1, 21)
    first = days[("10", date(2024, 1, 1))]
    assert (first["accident_count"], first["fatal_victims"], first["people_involved"], first["fatal_accident_count"]) == (2, 1.0, 5.0, 1)
    assert days[("11", date(2024, 1, 10))]["accident_count"] == 1
    assert sum(r["accident_count"] for r in days.values()) == 3
    weeks = {(r["codigo_municipio"], r["week_start"]): r for r in out["week_panel"].collect()}
    assert len(weeks) == 2 * 3 and weeks[("10", date(2024, 1, 1))]["fatal_victim_share"] == 0.2
    assert weeks[("11", date(2024, 1, 8))]["fatal_victim_share"] is None
    assert weeks[("11", date(2024, 1, 8))]["fatal_accident_share"] == 0.0
    assert set(out["day_panel"].columns) == {
        "codigo_municipio", "nome_municipio", "sg_uf", "cd_rgint", "nm_rgint", "accident_date", "year", "month", "day",
        "accident_count", "fatal_victims", "people_involved", "fatal_accident_count",
    }
    sections = {r["codigo_municipio"]: r for r in out["road_sections_by_municipio"].collect()}
    assert set(sections) == {"10", "11"} and sections["10"]["section_id"] == "municipio_10"
    ratio = sections["10"]["road_length_m"] / sections["11"]["road_length_m"]
    assert ratio == pytest.approx(1.0, rel=1e-2) and "LINESTRING" in sections["10"]["geometry"]


def test_region_panel(spark, events):
    regions = territories(spark, "codigo_rgi", "nome_rgi")
    out = EP.region_panel(events, regions, snapshots(spark), SETTINGS)
    rows = {r["id"]: r for r in out["canonical_accidents_by_rgi_section"].collect()}
    assert set(rows) == {1, 2, 3, 8, 9, 10}
    assert rows[9]["codigo_rgi"] == "10" and rows[9]["section_id"] == "rgi_10"
    assert rows[10]["rgi_match_status"] == rows[10]["section_match_status"] == "unmatched_exact_polygon"
    assert [r["id"] for r in out["unmatched_assignments"].collect()] == [10]
    weeks = {(r["section_id"], r["week_start"]): r for r in out["section_week_panel"].collect()}
    assert len(weeks) == 2 * 3 and weeks[("rgi_10", date(2024, 1, 1))]["accident_count"] == 3
    by_region = {(r["codigo_rgi"], r["week_start"]): r for r in out["rgi_week_panel"].collect()}
    assert by_region[("11", date(2024, 1, 8))]["section_count"] == 1 and by_region[("11", date(2024, 1, 8))]["level_observed"]
    assert {"canonical_policy", "road_length_m", "fatal_victim_share"} <= set(out["rgi_week_panel"].columns)


def test_weather_from_files(spark):
    folder = scratch_path(spark, "meteo")
    days = ["2024-01-01", "2024-01-02"]

    def cell(lat, lon, warm, **more):
        return {"latitude": lat, "longitude": lon, "elevation": 5.0, "daily": {"time": days, "temperature_2m_max": warm, "sunrise": ["2024-01-01T05:30"], **more}}

    payloads = [json.dumps({"responses": [cell(-27.2, -48.8, [30.5, None])]}), json.dumps(cell(-27.3, -48.7, [20.0, 21.0]))]
    payloads += [json.dumps([cell(-10.0, -48.7, [1.0, 2.0])])]
    for i, text in enumerate(payloads):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/{i}")
    cells = R.read_weather_json(spark, f"{folder}/*")
    assert cells.count() == 3
    towns = territories(spark, "codigo_municipio", "nome_municipio").filter("codigo_municipio = '10'")
    points = WX.scope_points(towns).join(towns.drop("geometry"), "codigo_municipio")
    r = points.first()
    assert (r["latitude"], r["longitude"]) == pytest.approx((-27.25, -48.75), abs=2e-3)
    table = WX.weather_table(points, R.unnest_daily(cells), "local_json", F.lit("2024-02-01").cast("timestamp"))
    got = {x["weather_date"]: x for x in table.collect()}
    d = {c: math.hypot(r["latitude"] - c[0], r["longitude"] - c[1]) for c in ((-27.2, -48.8), (-27.3, -48.7))}
    near = min(d, key=d.get)
    assert len(table.columns) == 27 and len(got) == 2
    assert got[date(2024, 1, 1)]["openmeteo_latitude"] == near[0]
    assert got[date(2024, 1, 2)]["sunrise"] is None and got[date(2024, 1, 1)]["sunrise"].hour == 5
    lo, hi = WX.requested_range(table, date(2024, 1, 1))
    span = spark.range(1).select(lo.alias("lo"), hi.alias("hi")).first()
    assert (span["lo"], span["hi"]) == (date(2024, 1, 2), date(2024, 1, 17))


def test_cells_at_one_place_are_told_apart_by_their_own_values(spark):
    points = spark.createDataFrame([("10", -27.0, -48.0, "m")], "codigo_municipio string, latitude double, longitude double, municipio_match_status string")

    def cell(elevation, warm):
        return json.dumps({"latitude": -27.0, "longitude": -48.1, "elevation": elevation, "daily": {"time": ["2024-01-01"], "temperature_2m_max": [warm]}})

    for names in ("ab", "ba"):
        folder = scratch_path(spark, "meteo-tied")
        for name, text in zip(names, (cell(3.0, "30.5"), cell(8.0, "11.0")), strict=True):
            spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/{name}")
        days = R.unnest_daily(R.read_weather_json(spark, f"{folder}/*"))
        made = WX.weather_table(points, days, "local_json", F.lit("2024-02-01").cast("timestamp"))
        assert [r["temperature_2m_max"] for r in made.collect()] == [30.5]


def test_weather_error_payload_stops(spark):
    folder = scratch_path(spark, "meteo-error")
    spark.createDataFrame([('{"error": true, "reason": "limit"}',)], "value string").coalesce(1).write.text(folder)
    with pytest.raises(Exception, match="limit"):
        R.read_weather_json(spark, folder).collect()


def test_centroid_round_trip(spark):
    x, y = crs.project(F.lit(-48.75), F.lit(-27.25))
    g = spark.range(1).select(crs.unproject(x, y).alias("g")).first()["g"]
    assert (g["lon"], g["lat"]) == pytest.approx((-48.75, -27.25), abs=1e-9)


def test_daily_plan(spark):
    start = date(2021, 1, 1)
    rows = [
        (code, f"Town {code}", "SC", "1", "I", start + timedelta(days=i), (start + timedelta(days=i)).year, 1, 1, int(i % 7 == k) * 3 + (i % 3 == 0))
        for k, code in enumerate(("4201", "4202"))
        for i in range(900)
    ]
    panel = spark.createDataFrame(
        rows, "codigo_municipio string, nome_municipio string, sg_uf string, cd_rgint string, nm_rgint string, accident_date date, year int, month int, day int, accident_count int"
    )
    settings = DF.DailySettings(
        years={"train": (2021, 2021), "validation": (2022, 2022), "test": (2023, 2023)}, lookback=28, n_kernels=168, alphas=(1.0, 100.0), horizon=5, weather=False
    )
    enriched = DF.enrich(panel, settings)
    facts = DF.registry(enriched, settings).first()
    assert facts["n_municipios"] == 2 and facts["n_train"] == 730 and facts["n_sequence_channels"] == 10
    trained = DF.train(enriched, settings)
    metrics = {r["split"]: r for r in trained["metrics"].collect()}
    assert metrics["train"]["n_predictions"] == 2 * (365 - 28) and metrics["test"]["n_predictions"] == 2 * 170
    assert metrics["test"]["r2"] > 0.3
    table, manifest = DF.forecast(enriched, trained, settings, "models:/town/1", generated_at="now")
    rows = table.collect()
    assert len(rows) == 10 and len(table.columns) == 15 and min(r["predicted_accident_count"] for r in rows) >= 0
    first = manifest.first()
    assert first["horizon_days"] == 5 and first["n_rows"] == 10 and first["forecast_min_date"] == str(start + timedelta(days=900))
    assert all(r["predicted_accident_count"] == max(0.0, r["prediction_raw"]) for r in rows)


def test_weather_is_required_when_enabled(spark):
    panel = spark.createDataFrame([("a", "SC", date(2024, 1, 1), 2024)], "codigo_municipio string, sg_uf string, accident_date date, year int")
    with pytest.raises(ValueError, match="weather"):
        DF.enrich(panel, DF.DailySettings())


def test_daily_plan_with_weather_channels(spark):
    start = date(2021, 1, 1)
    rows = [("4201", "T", "SC", start + timedelta(days=i), (start + timedelta(days=i)).year, 1, 1, i % 4) for i in range(500)]
    panel = spark.createDataFrame(rows, "codigo_municipio string, nome_municipio string, sg_uf string, accident_date date, year int, month int, day int, accident_count int")
    weather = panel.filter("day(accident_date) <= 20").select(
        "codigo_municipio", "accident_date", *[(F.col("accident_count") + i).cast("double").alias(c) for i, c in enumerate(S.WEATHER_CHANNELS)]
    )
    settings = DF.DailySettings(years={"train": (2021, 2021), "validation": (2022, 2022), "test": (2023, 2023)}, lookback=14, n_kernels=84, alphas=(10.0,), horizon=3)
    enriched = DF.enrich(panel, settings, weather)
    share = DF.registry(enriched, settings).first()["weather_complete_row_share"]
    assert share == pytest.approx(weather.count() / 500)
    trained = DF.train(enriched, settings)
    table, _ = DF.forecast(enriched, trained, settings, "m")
    assert table.count() == 3


def test_overlay_replay_and_merge(spark):
    folder, (data, checkpoint) = scratch_path(spark, "feed"), O.run_folders(spark, "overlay")
    schema = "k string, ts timestamp, v int"
    rows = [("a", "2024-01-01 10:00:00", 1), ("a", "2024-01-01 12:00:00", 2), ("b", "2024-01-02 09:00:00", 3)]

    def write(part):
        spark.createDataFrame(part, "k string, ts string, v int").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(folder)

    order = [F.col("ts"), F.col("v")]

    def drain():
        stream = O.read_events(spark, folder, spark.createDataFrame([], schema).schema, "ts", "1 day")
        O.upsert_available(stream, data, checkpoint, ["k"], order).awaitTermination()

    write(rows[:2])
    drain()
    write(rows[2:] + [("a", "2024-01-01 11:00:00", 9)])
    drain()
    drain()
    fresh = O.read_overlay(spark, data, ["k"], order)
    assert {(r["k"], r["v"]) for r in fresh.collect()} == {("a", 2), ("b", 3)}
    history = spark.createDataFrame([("a", "2024-01-03 00:00:00", 7), ("c", "2023-01-01 00:00:00", 8)], "k string, ts string, v int")
    history = history.withColumn("ts", F.col("ts").cast("timestamp"))
    merged = O.merged_view(history, fresh, ["k"], order)
    assert {(r["k"], r["v"]) for r in merged.collect()} == {("a", 7), ("b", 3), ("c", 8)}
    # The history itself is untouched.
    assert history.count() == 2


def test_late_duplicates_are_dropped_in_the_stream(spark):
    folder, (data, checkpoint) = scratch_path(spark, "dups"), O.run_folders(spark, "dups")
    rows = [(1, "2024-01-01 10:00:00"), (1, "2024-01-01 10:00:00"), (2, "2024-01-01 11:00:00")]
    spark.createDataFrame(rows, "id int, ts string").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(folder)
    stream = O.deduplicated(O.read_events(spark, folder, spark.read.parquet(folder).schema, "ts", "2 hours"), ["id"])
    O.write_available(stream, data, checkpoint).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(data).collect()) == [1, 2]


def test_table_round_trips(spark):
    path = scratch_path(spark, "table")
    df = spark.createDataFrame([(1, 2020, "a"), (2, 2021, "b")], "id int, year int, v string")
    W.write_table(df, path, ["year"], order=["id"])
    W.refresh_partitions(spark.createDataFrame([(3, 2021, "c")], df.schema), path, ["year"])
    assert {(r["id"], r["year"]) for r in R.read_table(spark, path).collect()} == {(1, 2020), (3, 2021)}
    W.publish(R.read_table(spark, path).filter("id = 3"), path, ["year"])
    assert [r["id"] for r in R.read_table(spark, path).collect()] == [3]
    plan = R.read_table(spark, path).filter("year = 2021")._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan
    with pytest.raises(ValueError, match="available: id, year, v"):
        R.ingest_territories(df, {"nope": "x"}, "municipio")


def test_event_ids_beyond_doubles_stay_whole(spark):
    from incidentpanel.functions import clean as C

    ids = spark.createDataFrame([("9007199254740993",), (" 12 ",), ("7,0",), ("x",)], "id string")
    made = ids.select(F.coalesce(F.trim("id").try_cast("bigint"), C.numeric_text("id").try_cast("bigint")).alias("id"))
    assert [r["id"] for r in made.collect()] == [9007199254740993, 12, 7, None]


def test_late_events_reach_the_panel_through_the_history(spark, tmp_path):
    schema = spark.createDataFrame([], "event_id long, ts timestamp, code string").schema
    arrivals = [
        [(1, "2024-01-01 08:00:00"), (2, "2024-01-02 09:00:00")],
        [(3, "2024-01-10 08:00:00"), (4, "2024-01-10 10:00:00")],
        # Late events are judged by the watermark of the batch before.
        [(7, "2024-01-10 11:00:00")],
        # Nine days behind what was seen, and a repeated event.
        [(5, "2024-01-01 12:00:00"), (4, "2024-01-10 10:00:00"), (6, "2024-01-11 07:00:00")],
    ]
    feed = str(tmp_path / "feed")
    for rows in arrivals:
        part = spark.createDataFrame([(i, t, "a") for i, t in rows], "event_id long, ts string, code string")
        part.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(feed)
    events = O.read_events(spark, feed, schema, "ts", "2 days", files="*.parquet", files_per_trigger=1)
    counts = O.windowed_counts(O.deduplicated(events, ["event_id"]), "ts", ["code"])
    data = str(tmp_path / "data")
    order = [F.col("accident_count")]

    def store(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{data}/batch_id={batch_id}")

    writer = counts.writeStream.foreachBatch(store).outputMode("update").option("checkpointLocation", str(tmp_path / "c"))
    writer.trigger(availableNow=True).start().awaitTermination()
    keys = ["code", "period_start"]

    def as_dict(df):
        return {str(r["period_start"]): r["accident_count"] for r in df.collect()}

    overlay = as_dict(O.read_overlay(spark, data, keys, order))
    assert overlay["2024-01-01"] == 1 and overlay["2024-01-10"] == 3
    history = spark.read.parquet(feed).distinct().groupBy("code", F.to_date("ts").alias("period_start")).agg(F.count("*").alias("accident_count"))
    whole = {"2024-01-01": 2, "2024-01-02": 1, "2024-01-10": 3, "2024-01-11": 1}
    assert as_dict(O.merged_view(history, O.read_overlay(spark, data, keys, order), keys, order)) == whole
    compacted = O.compact_overlay(spark, data, str(tmp_path / "compacted"), keys, order)
    assert as_dict(O.read_overlay(spark, compacted, keys, order)) == overlay
