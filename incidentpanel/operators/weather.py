"""Weather cells to entity x day features, with incremental upsert."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentpanel.functions import geometry as G
from incidentpanel.functions.clean import clean_text, finite_double, lenient_timestamp, round_coord
from incidentpanel.functions.crs import project, unproject
from incidentpanel.operators.calendar_tables import spine
from incidentpanel.operators.spatial import assign_polygon, polygon_edges, polygon_index
from incidentpanel.skew import latest_by, salted_join

FORECAST_DAYS = 15


def scope_points(polygons: DataFrame, code: str = "codigo_municipio", wkt: str = "geometry", size: float = 20_000.0) -> DataFrame:
    """Requested weather point of each polygon: its centroid and the polygon that owns it.

    A centroid outside every polygon keeps its own code; ``shares_point`` warns
    about polygons that round to the same coordinates.
    """
    rings = G.map_points(G.parse_wkt(wkt), project)
    centres = (
        polygons.withColumn("__c", G.polygon_centroid(rings))
        .filter(F.col("__c").isNotNull())
        .withColumns({"x": F.col("__c.x"), "y": F.col("__c.y"), "source_code": F.col(code)})
        .select("source_code", "x", "y")
    )
    edges = polygon_edges(polygons.select(code, wkt), wkt, projected=True)
    index = polygon_index(edges, code, size)
    owned = assign_polygon(centres, index, size, [code], "source_code", boundary=True)
    back = unproject(F.col("x"), F.col("y"))
    placed = owned.withColumn("__g", back).select(
        F.coalesce(code, "source_code").alias(code),
        "source_code",
        round_coord(F.col("__g.lat")).alias("latitude"),
        round_coord(F.col("__g.lon")).alias("longitude"),
        F.when(F.col(code).isNotNull(), "matched_centroid_superposition")
        .otherwise("fallback_source_polygon_centroid")
        .alias("municipio_match_status"),
    )
    doubled = placed.groupBy("latitude", "longitude").agg((F.count("*") > 1).alias("shares_point"))
    return placed.join(doubled, ["latitude", "longitude"])


def match_cells(
    points: DataFrame, cells: DataFrame, point_id: str, tolerance: float = 0.2, lat: str = "latitude", lon: str = "longitude"
) -> DataFrame:
    """Every cell within ``tolerance`` degrees of a point, with its distance.

    Cells are repeated for the nine grid squares around them, points fall into
    one, so the band join is an equi-join.
    """
    size = F.lit(float(tolerance))
    located = points.withColumns(
        {"__a": F.floor(F.col(lat) / size).cast("bigint"), "__o": F.floor(F.col(lon) / size).cast("bigint")}
    )
    around = F.sequence(F.lit(-1), F.lit(1))
    spread = (
        cells.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .withColumnsRenamed({"latitude": "cell_latitude", "longitude": "cell_longitude"})
        .withColumn("__da", F.explode(around))
        .withColumn("__do", F.explode(around))
        .withColumns(
            {
                "__a": F.floor(F.col("cell_latitude") / size).cast("bigint") + F.col("__da"),
                "__o": F.floor(F.col("cell_longitude") / size).cast("bigint") + F.col("__do"),
            }
        )
        .drop("__da", "__do")
    )
    distance = F.hypot(F.col(lat) - F.col("cell_latitude"), F.col(lon) - F.col("cell_longitude"))
    joined = salted_join(located, spread, ["__a", "__o"], [point_id]).drop("__a", "__o")
    return joined.withColumn("distance", distance).filter(F.col("distance") <= tolerance)


def nearest_per_day(matched: DataFrame, point_id: str, day: str, tie: Sequence[Column]) -> DataFrame:
    """For each point and day the values of the closest cell."""
    return latest_by(matched, [point_id, day], [F.col("distance"), *tie], smallest=True)


def weather_table(
    points: DataFrame, daily_cells: DataFrame, source_kind: str, fetched_at: Column, code: str = "codigo_municipio"
) -> DataFrame:
    """Entity x day weather rows from unnested cells."""
    # Points are matched with distinct cell coordinates; only then do days join in.
    cell = {"latitude": "cell_latitude", "longitude": "cell_longitude"}
    matched = match_cells(points, daily_cells.select(*cell).distinct(), code).join(
        daily_cells.withColumnsRenamed(cell), list(cell.values())
    )
    # Cells may share their coordinates: what they say themselves decides, before the names of files, which change from run to run.
    own = [F.col(c) for c in ("cell_latitude", "cell_longitude", "elevation", "temperature_2m_max", "source_json_path", "day_index")]
    nearest = nearest_per_day(matched, code, "weather_date", own)
    labels = [c for c in ("nome_municipio", "sg_uf", "cd_rgint", "nm_rgint") if c in points.columns]
    numbers = ["temperature_2m_max", "temperature_2m_min", "wind_speed_10m_max"]
    rain = ["precipitation_sum", "precipitation_hours"]
    return nearest.select(
        clean_text(code).alias(code),
        *[clean_text(c, upper=c == "sg_uf").alias(c) for c in labels],
        "weather_date",
        F.year("weather_date").alias("year"),
        F.month("weather_date").alias("month"),
        F.dayofmonth("weather_date").alias("day"),
        "latitude",
        "longitude",
        F.col("cell_latitude").alias("openmeteo_latitude"),
        F.col("cell_longitude").alias("openmeteo_longitude"),
        finite_double("elevation").alias("openmeteo_elevation_m"),
        *[finite_double(c).alias(c) for c in numbers],
        lenient_timestamp("sunrise").alias("sunrise"),
        lenient_timestamp("sunset").alias("sunset"),
        *[finite_double(c).alias(c) for c in rain],
        F.lit(source_kind).alias("source_kind"),
        F.lit(None).cast("string").alias("source_url"),
        "source_json_path",
        fetched_at.alias("source_fetched_at"),
        F.col("distance").alias("coordinate_match_distance_degrees"),
        "municipio_match_status",
    )


def requested_range(existing: DataFrame | None, today: date, start: date | None = None, end: date | None = None) -> tuple[Column, Column]:
    """First and last day to load: from the newest stored day (or ``start``) to ``end``."""
    first = F.lit(start) if start else (existing.agg(F.max("weather_date")).scalar() if existing is not None else F.lit(today))
    last = F.lit(end) if end else F.date_add(first, FORECAST_DAYS)
    return first, last


def missing_days(present: DataFrame, entities: DataFrame, entity: str, day: str, lo: Column, hi: Column, sample: int = 5) -> DataFrame:
    """How many requested days an entity lacks and the first few of them."""
    wanted = spine(entities.select(entity), lo, hi, day)
    absent = wanted.join(present.select(entity, day).distinct(), [entity, day], "left_anti")
    # A list per entity is bounded by the requested days.
    return absent.groupBy(entity).agg(
        F.count("*").alias("missing_days"),
        F.array_join(F.slice(F.array_sort(F.collect_list(F.col(day).cast("string"))), 1, sample), ", ").alias("first_missing"),
    )
