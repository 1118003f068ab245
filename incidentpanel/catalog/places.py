"""Queries for geometry: measures, corridor, point in polygon, clipping, weather cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from incidentpanel.catalog.registry import query
from incidentpanel.catalog.roles import (
    CORRIDOR,
    IN_SQUARE,
    POINTS,
    POLYGONS,
    ROADS,
    nation_polygons,
    point_segment_sql,
    road_segments,
    supplier_roads,
    table,
    usable_points,
)
from incidentpanel.functions import crs
from incidentpanel.functions import geometry as G
from incidentpanel.operators import spatial as S
from incidentpanel.operators.weather import match_cells, missing_days, nearest_per_day

CELL = 0.5


def polygon_parts(spark, sf):
    polygons = nation_polygons(spark, sf)
    edges = S.polygon_edges(polygons)
    return polygons, edges


@query(
    "parse_geometry",
    f"""WITH {POLYGONS} SELECT code AS codigo_municipio, 'Polygon' AS geometry_type, CASE WHEN holed THEN 2 ELSE 1 END AS rings,
        CASE WHEN holed THEN 8 ELSE 4 END AS edges, x0 AS min_x, y0 AS min_y, x0 + 2.25 AS max_x, y0 + 2.25 AS max_y, true AS round_trip FROM sq""",
)
def parse_geometry(spark, sf):
    """Type, rings, edges and bounds of WKT, and that writing it back parses to the same rings."""
    rings = G.parse_wkt("geometry")
    box = G.bounds(rings)
    return nation_polygons(spark, sf).select(
        "codigo_municipio",
        G.geometry_type("geometry").alias("geometry_type"),
        F.size(rings).alias("rings"),
        F.size(G.all_edges(rings)).alias("edges"),
        *[box[c].alias(c) for c in ("min_x", "min_y", "max_x", "max_y")],
        (G.parse_wkt(G.to_wkt_polygon(rings)) == rings).alias("round_trip"),
    )


@query(
    "polygon_area",
    f"""WITH {POLYGONS} SELECT code AS codigo_municipio, round(CAST(5.0625 - CASE WHEN holed THEN 0.25 ELSE 0.0 END AS DOUBLE), 6) AS area,
        round(x0 + (5.0625 * 1.125 - CASE WHEN holed THEN 0.25 ELSE 0 END) / (5.0625 - CASE WHEN holed THEN 0.25 ELSE 0 END), 6) AS centre_x,
        round(y0 + (5.0625 * 1.125 - CASE WHEN holed THEN 0.25 ELSE 0 END) / (5.0625 - CASE WHEN holed THEN 0.25 ELSE 0 END), 6) AS centre_y FROM sq""",
)
def polygon_area(spark, sf):
    made = S.polygon_measures(nation_polygons(spark, sf))
    return made.select(
        "codigo_municipio",
        (F.col("polygon_area_km2") * 1e6).alias("area"),
        F.col("centroid.x").alias("centre_x"),
        F.col("centroid.y").alias("centre_y"),
    )


def _project_sql(lon: str, lat: str) -> str:
    e2 = repr(crs.E2)
    return f"""phi AS (SELECT *, radians({lat}) AS p, radians({lon} + 54.0) AS dl FROM good),
    prj AS (SELECT id, lon, lat,
      5000000.0 + {crs.SEMI_MAJOR} / sqrt(1 - {e2} * sin(p) * sin(p)) / tan(p) * sin(dl * sin(p)) AS x,
      10000000.0 + {crs.SEMI_MAJOR} * ({crs.M0!r} * p - {crs.M2!r} * sin(2 * p) + {crs.M4!r} * sin(4 * p) - {crs.M6!r} * sin(6 * p))
        + {crs.SEMI_MAJOR} / sqrt(1 - {e2} * sin(p) * sin(p)) / tan(p) * (1 - cos(dl * sin(p))) AS y FROM phi)"""


@query(
    "project_points",
    f"WITH {POINTS}, {_project_sql('lon', 'lat')} SELECT id, round(x, 4) AS x, round(y, 4) AS y, round(lon, 6) AS lon, round(lat, 6) AS lat FROM prj",
)
def project_points(spark, sf):
    """Forward projection to metres, and degrees recovered by the inverse."""
    points = usable_points(spark, sf).withColumnsRenamed({"x": "lon", "y": "lat"})
    x, y = crs.project(F.col("lon"), F.col("lat"))
    placed = points.select("id", x.alias("x"), y.alias("y")).withColumn("g", crs.unproject(F.col("x"), F.col("y")))
    return placed.select("id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), "g.lon", "g.lat")


@query(
    "road_segments",
    f"WITH {ROADS} SELECT road_id, snapshot_year, round(x1, 6) AS x1, round(y1, 6) AS y1, round(x2, 6) AS x2, round(y2, 6) AS y2 FROM seg",
)
def segments(spark, sf):
    return road_segments(spark, sf)


@query(
    "dissolve_roads",
    f"""WITH {ROADS}, twice AS (SELECT snapshot_year, x1, y1, x2, y2, 'v' || road_id AS tag FROM seg UNION ALL SELECT snapshot_year, x2, y2, x1, y1, 'w' || road_id FROM seg)
        SELECT snapshot_year, count(*) AS segments, CAST(sum(copies) AS BIGINT) AS copies, round(sum(len), 6) AS length, min(tag) AS version FROM (
          SELECT snapshot_year, CASE WHEN (x1, y1) <= (x2, y2) THEN (x1, y1, x2, y2) ELSE (x2, y2, x1, y1) END AS k, count(*) AS copies,
            min(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))) AS len, min(tag) AS tag FROM twice GROUP BY 1, 2) GROUP BY 1""",
)
def dissolve_roads(spark, sf):
    """Each road stored twice, once reversed, dissolves to one copy per snapshot."""
    segs = road_segments(spark, sf).withColumn("tag", F.concat(F.lit("v"), F.col("road_id").cast("string")))
    back = segs.select(
        "road_id",
        "snapshot_year",
        F.col("x2").alias("x1"),
        F.col("y2").alias("y1"),
        F.col("x1").alias("x2"),
        F.col("y1").alias("y2"),
        F.concat(F.lit("w"), F.col("road_id").cast("string")).alias("tag"),
    )
    merged = S.dissolve_segments(segs.unionByName(back), ["snapshot_year"], "tag")
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    return merged.groupBy("snapshot_year").agg(
        F.count("*").alias("segments"),
        F.sum("copies").alias("copies"),
        F.sum(length).alias("length"),
        F.min("tag").alias("version"),
    )


@query(
    "multipart_sections",
    f"""WITH {ROADS}, p AS (SELECT snapshot_year, road_id, sum(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))) AS len FROM seg GROUP BY 1, 2)
        SELECT snapshot_year, 'MultiLineString' AS geometry_type, count(*) + 1 AS parts, count(*) AS sections, round(sum(len), 6) AS length FROM p GROUP BY 1""",
)
def multipart_sections(spark, sf):
    """Roads as MULTILINESTRINGs of at most 50 with an empty stretch; parts become sections, those without length go.

    The counts are those of one multipart per snapshot: its one empty stretch is added to the first block.
    """
    block = F.floor(F.col("road_id") / 50)
    body = F.regexp_replace("geometry", "^LINESTRING ", "")
    parts = supplier_roads(spark, sf).groupBy("snapshot_year", block.alias("block")).agg(F.array_sort(F.collect_list(body)).alias("p"))
    stub = F.when(F.col("block") == 0, F.array(F.lit("(-55 -29, -55 -29)"))).otherwise(F.array().cast("array<string>"))
    lines = parts.select("snapshot_year", F.concat(F.lit("MULTILINESTRING ("), F.array_join(F.concat("p", stub), ", "), F.lit(")")).alias("geometry"))
    rings = lines.select("snapshot_year", G.geometry_type("geometry").alias("geometry_type"), F.posexplode(G.parse_wkt("geometry")).alias("part", "ring"))
    edges = G.all_edges(F.array("ring"))
    length = F.aggregate(edges, F.lit(0.0), lambda s, e: s + F.hypot(e["x2"] - e["x1"], e["y2"] - e["y1"]))
    return rings.select("snapshot_year", "geometry_type", length.alias("l")).groupBy("snapshot_year", "geometry_type").agg(
        F.count("*").alias("parts"), F.count_if(F.col("l") > 0).alias("sections"), F.sum("l").alias("length")
    )


@query(
    "multipolygon_area",
    f"""WITH {POLYGONS} SELECT state AS uf, 'MultiPolygon' AS geometry_type, count(*) AS polygons, round(sum(5.0625 - CASE WHEN holed THEN 0.25 ELSE 0 END)::DOUBLE, 6) AS area FROM sq GROUP BY 1""",
)
def multipolygon_area(spark, sf):
    """The squares of a state, moved apart, as one MULTIPOLYGON: its area is the sum of theirs."""
    k = F.col("codigo_municipio").cast("int")
    moved = nation_polygons(spark, sf).withColumn("r", G.map_points(G.parse_wkt("geometry"), lambda x, y: (x + k * 10, y)))
    body = F.regexp_replace(G.to_wkt_polygon("r"), "^POLYGON ", "")
    joined = moved.groupBy("sg_uf").agg(F.array_sort(F.collect_list(body)).alias("p"))
    wkt = F.concat(F.lit("MULTIPOLYGON ("), F.array_join("p", ", "), F.lit(")"))
    made = S.polygon_measures(joined.select("sg_uf", F.size("p").alias("polygons"), wkt.alias("geometry"), G.geometry_type(wkt).alias("geometry_type")))
    return made.select(F.col("sg_uf").alias("uf"), "geometry_type", "polygons", (F.col("polygon_area_km2") * 1e6).alias("area"))


@query(
    "merge_overlapping_roads",
    """WITH s AS (SELECT s_nationkey AS lane, s_suppkey % 50 AS a, s_suppkey % 50 + 1 + s_suppkey % 7 AS b FROM supplier),
       u AS (SELECT DISTINCT lane, unnest(range(a, b)) AS unit FROM s)
       SELECT lane, CAST(count(*) AS DOUBLE) AS length FROM u GROUP BY 1""",
)
def merge_overlapping_roads(spark, sf):
    """Overlapping intervals on 25 parallel lines: the union counts shared parts once."""
    s = table(spark, sf, "supplier")
    a = (F.col("s_suppkey") % 50).cast("double")
    lane = F.col("s_nationkey").cast("double")
    segs = s.select(a.alias("x1"), lane.alias("y1"), (a + 1 + F.col("s_suppkey") % 7).alias("x2"), lane.alias("y2"))
    merged = S.merge_collinear(segs, block=8.0)
    return merged.groupBy(F.round("y1").cast("int").alias("lane")).agg(F.sum(F.col("x2") - F.col("x1")).alias("length"))


@query(
    "points_in_corridor",
    f"""WITH {POINTS},{ROADS} SELECT DISTINCT id FROM good, seg WHERE {point_segment_sql('lon', 'lat')} <= {CORRIDOR}""",
)
def points_in_corridor(spark, sf):
    return S.within_corridor(usable_points(spark, sf), road_segments(spark, sf), CORRIDOR).select("id")


@query(
    "corridor_area",
    f"""WITH {ROADS}, b AS (SELECT min(least(x1, x2)) AS lx, max(greatest(x1, x2)) AS hx, min(least(y1, y2)) AS ly, max(greatest(y1, y2)) AS hy FROM seg),
        cx AS (SELECT unnest(range(CAST(floor((lx - 0.3) / 0.05) AS BIGINT), CAST(floor((hx + 0.3) / 0.05) AS BIGINT) + 1)) AS i FROM b),
        cy AS (SELECT unnest(range(CAST(floor((ly - 0.3) / 0.05) AS BIGINT), CAST(floor((hy + 0.3) / 0.05) AS BIGINT) + 1)) AS j FROM b),
        c AS (SELECT i, j, (i + 0.5::DOUBLE) * 0.05::DOUBLE AS cxx, (j + 0.5::DOUBLE) * 0.05::DOUBLE AS cyy FROM cx, cy)
        SELECT count(*) AS cells, CAST(count(*) * 25 AS DOUBLE) AS corridor_area_km2
        FROM c WHERE EXISTS (SELECT 1 FROM seg WHERE {point_segment_sql('cxx', 'cyy')} <= {CORRIDOR})""",
)
def corridor_area(spark, sf):
    """The plane is scaled by 100 000, so that units act as metres and the area as square kilometres."""
    scale = 100_000.0
    segs = road_segments(spark, sf).select(*[(F.col(c) * scale).alias(c) for c in S.SEGMENT])
    return S.corridor_area(segs, CORRIDOR * scale, 0.05 * scale)


@query(
    "point_in_polygon",
    f"""WITH {POINTS},{POLYGONS}, m AS (SELECT id, min(code) AS code, count(*) AS n FROM (SELECT id, lon AS px, lat AS py FROM good), sq WHERE {IN_SQUARE} GROUP BY 1)
        SELECT good.id, m.code AS codigo_municipio, CASE WHEN m.code IS NULL THEN 'unmatched_exact_polygon' ELSE 'matched_exact_polygon' END AS match_status
        FROM good LEFT JOIN m ON m.id = good.id""",
)
def point_in_polygon(spark, sf):
    """First polygon by code that strictly contains the point; unmatched points stay."""
    _, edges = polygon_parts(spark, sf)
    index = S.polygon_index(edges.select("codigo_municipio", *S.SEGMENT), "codigo_municipio", CELL)
    placed = S.assign_polygon(usable_points(spark, sf), index, CELL, ["codigo_municipio"])
    status = F.when(F.col("codigo_municipio").isNotNull(), "matched_exact_polygon").otherwise("unmatched_exact_polygon")
    return placed.select("id", "codigo_municipio", status.alias("match_status"))


@query(
    "unmatched_report",
    f"""WITH {POINTS},{POLYGONS}, m AS (SELECT DISTINCT id FROM (SELECT id, lon AS px, lat AS py FROM good), sq WHERE {IN_SQUARE})
        SELECT id, round(lon, 6) AS x, round(lat, 6) AS y FROM good WHERE id NOT IN (SELECT id FROM m)""",
)
def unmatched_report(spark, sf):
    _, edges = polygon_parts(spark, sf)
    index = S.polygon_index(edges.select("codigo_municipio", *S.SEGMENT), "codigo_municipio", CELL)
    return S.points_in_polygons(usable_points(spark, sf), index, CELL, how="left_anti").select("id", "x", "y")


@query(
    "same_state_first",
    f"""WITH {POINTS},{POLYGONS}, p AS (SELECT id, lon AS px, lat AS py, 'R' || (c_nationkey % 5) AS own FROM good),
        m AS (SELECT id, code, row_number() OVER (PARTITION BY id ORDER BY CASE WHEN state = own THEN 0 ELSE 1 END, state, code) AS r FROM p, sq WHERE {IN_SQUARE})
        SELECT id, code AS codigo_municipio FROM m WHERE r = 1""",
)
def same_state_first(spark, sf):
    """Polygons of the point's own state win over others."""
    _, edges = polygon_parts(spark, sf)
    index = S.polygon_index(edges.select("codigo_municipio", "sg_uf", *S.SEGMENT), "codigo_municipio", CELL, ["sg_uf"])
    points = usable_points(spark, sf).withColumn("own", F.concat(F.lit("R"), (F.col("c_nationkey") % 5).cast("string")))
    placed = S.assign_polygon(points, index, CELL, ["sg_uf", "codigo_municipio"], prefer=("own", "sg_uf"))
    return placed.filter("codigo_municipio IS NOT NULL").select("id", "codigo_municipio")


@query(
    "two_level_match",
    f"""WITH {POINTS},{POLYGONS}, p AS (SELECT id, lon AS px, lat AS py FROM good),
        m AS (SELECT id, code, state FROM p, sq WHERE {IN_SQUARE})
        SELECT p.id, count(m.code) AS polygons, count(DISTINCT m.state) AS states, min(m.code) AS first_code, min(m.state) AS first_state
        FROM p LEFT JOIN m ON m.id = p.id GROUP BY 1""",
)
def two_level_match(spark, sf):
    """Left join point -> municipality -> state; all matches counted."""
    _, edges = polygon_parts(spark, sf)
    index = S.polygon_index(edges.select("codigo_municipio", "sg_uf", *S.SEGMENT), "codigo_municipio", CELL, ["sg_uf"])
    return (
        S.points_in_polygons(usable_points(spark, sf), index, CELL, how="left")
        .groupBy("id")
        .agg(
            F.count("codigo_municipio").alias("polygons"),
            F.count_distinct("sg_uf").alias("states"),
            F.min("codigo_municipio").alias("first_code"),
            F.min("sg_uf").alias("first_state"),
        )
    )


def _edge_sql() -> str:
    sides = []
    for lo, hi, where in (("0.0", "2.25", ""), ("0.75", "1.25", " WHERE holed")):
        corners = [(lo, lo), (hi, lo), (hi, hi), (lo, hi), (lo, lo)]
        sides += [
            f"SELECT code, x0 + {a[0]} AS ex1, y0 + {a[1]} AS ey1, x0 + {b[0]} AS ex2, y0 + {b[1]} AS ey2 FROM sq{where}"
            for a, b in zip(corners, corners[1:])
        ]
    return "edge AS (" + " UNION ALL ".join(sides) + ")"


def _near_sql() -> str:
    def d(px, py, s):
        x1, y1, x2, y2 = (f"{s}{c}" for c in ("x1", "y1", "x2", "y2"))
        return point_segment_sql(px, py, s if s else "")

    return f"least({d('ex1', 'ey1', '')}, {d('ex2', 'ey2', '')}, {d('x1', 'y1', 'e')}, {d('x2', 'y2', 'e')}) <= {CORRIDOR}"


CROSSES = """(((x2 - x1) * (ey1 - y1) - (y2 - y1) * (ex1 - x1)) * ((x2 - x1) * (ey2 - y1) - (y2 - y1) * (ex2 - x1)) < 0
  AND ((ex2 - ex1) * (y1 - ey1) - (ey2 - ey1) * (x1 - ex1)) * ((ex2 - ex1) * (y2 - ey1) - (ey2 - ey1) * (x2 - ex1)) < 0)"""


@query(
    "polygon_scope",
    f"""WITH {POLYGONS},{ROADS},{_edge_sql()}
        SELECT DISTINCT code AS codigo_municipio FROM edge, seg WHERE {CROSSES} OR {_near_sql()}
        UNION SELECT code FROM (SELECT x1 AS px, y1 AS py FROM seg), sq
          WHERE px BETWEEN x0 AND x0 + 2.25 AND py BETWEEN y0 AND y0 + 2.25
            AND NOT (holed AND px > x0 + 0.75 AND px < x0 + 1.25 AND py > y0 + 0.75 AND py < y0 + 1.25)""",
)
def polygon_scope(spark, sf):
    """Polygons touched by the corridor."""
    polygons, edges = polygon_parts(spark, sf)
    touched = S.polygons_near_corridor(polygons, edges, road_segments(spark, sf), "codigo_municipio", CORRIDOR, CELL)
    return touched.select("codigo_municipio")


# Share of a segment inside an axis-parallel box, by clipping its parameter range.
def _box_share(lo: str, hi: str) -> str:
    def slab(a: str, b: str, o: str) -> tuple[str, str]:
        near = f"CASE WHEN {b} = {a} THEN CASE WHEN {a} BETWEEN {o} + {lo} AND {o} + {hi} THEN 0.0 ELSE 2.0 END ELSE least(({o} + {lo} - {a}) / ({b} - {a}), ({o} + {hi} - {a}) / ({b} - {a})) END"
        far = f"CASE WHEN {b} = {a} THEN 1.0 ELSE greatest(({o} + {lo} - {a}) / ({b} - {a}), ({o} + {hi} - {a}) / ({b} - {a})) END"
        return near, far

    (nx, fx), (ny, fy) = slab("x1", "x2", "x0"), slab("y1", "y2", "y0")
    return f"greatest(0.0, least(1.0, {fx}, {fy}) - greatest(0.0, {nx}, {ny}))"


CLIPPED = f"""{POLYGONS},{ROADS},
clip AS (SELECT code, road_id, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) *
           ({_box_share('0.0', '2.25')} - CASE WHEN holed THEN {_box_share('0.75', '1.25')} ELSE 0.0 END) AS len FROM seg, sq)"""


def clipped(spark, sf):
    segs = road_segments(spark, sf).withColumn("segment_id", F.xxhash64("road_id", *S.SEGMENT))
    _, edges = polygon_parts(spark, sf)
    pieces = S.clip_segments(segs, edges, "segment_id", "codigo_municipio", CELL)
    return pieces.join(segs.select("segment_id", "road_id"), "segment_id")


@query(
    "clip_road",
    f"WITH {CLIPPED} SELECT code AS codigo_municipio, road_id, round(sum(len), 6) AS road_length FROM clip GROUP BY 1, 2 HAVING sum(len) > 1e-9",
)
def clip_road(spark, sf):
    """Road length inside each polygon, per road."""
    lengths = S.road_length_by(clipped(spark, sf), ["codigo_municipio", "road_id"])
    return lengths.filter("road_length_m > 1e-9").select("codigo_municipio", "road_id", F.col("road_length_m").alias("road_length"))


@query(
    "road_length_by_territory",
    f"WITH {CLIPPED} SELECT code AS codigo_municipio, round(sum(len), 6) AS road_length FROM clip GROUP BY 1 HAVING sum(len) > 1e-9",
)
def road_length_by_territory(spark, sf):
    lengths = S.road_length_by(clipped(spark, sf), ["codigo_municipio"])
    return lengths.filter("road_length_m > 1e-9").select("codigo_municipio", F.col("road_length_m").alias("road_length"))


NEAR = f"""{POINTS},{ROADS},
ter AS (SELECT *, 'T' || (seg_id // 10 % 4) AS territory, 'S' || (seg_id // 5) AS section_id FROM seg),
sl AS (SELECT section_id, sum(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))) AS len FROM ter GROUP BY 1),
own AS (SELECT id, lon, lat, CASE WHEN id % 6 < 5 THEN 'T' || (id % 6) END AS territory FROM good),
dist AS (SELECT own.id, ter.section_id, round(len, 6) AS len, min({point_segment_sql('lon', 'lat')}) AS d
         FROM own JOIN ter ON ter.territory = own.territory JOIN sl ON sl.section_id = ter.section_id GROUP BY 1, 2, 3)"""


@query(
    "nearest_section",
    f"""WITH {NEAR}, r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, len DESC, section_id) AS r FROM dist)
        SELECT own.id, own.territory, r.section_id, round(r.d, 6) AS distance, CASE WHEN own.territory IS NULL THEN 'unmatched_exact_polygon'
          WHEN r.id IS NOT NULL THEN 'matched_nearest_section' ELSE 'unmatched_no_section_in_rgi' END AS section_match_status
        FROM own LEFT JOIN r ON r.id = own.id AND r.r = 1""",
)
def nearest(spark, sf):
    """Closest section of the point's own territory; a fifth territory has no section."""
    s = F.col("s_suppkey")
    keyed = table(spark, sf, "supplier").select(
        s.alias("seg_id"),
        F.floor(s / 10).alias("road_id"),
        ((F.lit(-5500) + s % 10 * 10) / F.lit(100.0)).alias("x1"),
        ((F.lit(-2950) + s % 10 % 7 * 5 + F.floor(s / 20) % 20 * 45) / F.lit(100.0)).alias("y1"),
    )
    ends = keyed.select((F.col("seg_id") - 1).alias("seg_id"), "road_id", F.col("x1").alias("x2"), F.col("y1").alias("y2"))
    segs = keyed.join(ends, ["seg_id", "road_id"]).withColumns(
        {
            "territory": F.concat(F.lit("T"), (F.floor(F.col("seg_id") / 10) % 4).cast("string")),
            "section_id": F.concat(F.lit("S"), F.floor(F.col("seg_id") / 5).cast("string")),
        }
    )
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    sizes = segs.groupBy("section_id").agg(F.round(F.sum(length), 6).alias("road_length_m"))
    points = usable_points(spark, sf).select(
        "id", "x", "y", F.when(F.col("id") % 6 < 5, F.concat(F.lit("T"), (F.col("id") % 6).cast("string"))).alias("territory")
    )
    return S.nearest_section(points, segs.join(sizes, "section_id"), "territory", 0.5).select(
        "id", "territory", "section_id", "distance", "section_match_status"
    )


@query(
    "centroid_owner",
    f"""WITH {POLYGONS}, c AS (SELECT code AS source_code, x0 + (5.0625 * 1.125 - CASE WHEN holed THEN 0.25 ELSE 0 END) / (5.0625 - CASE WHEN holed THEN 0.25 ELSE 0 END) AS px,
          y0 + (5.0625 * 1.125 - CASE WHEN holed THEN 0.25 ELSE 0 END) / (5.0625 - CASE WHEN holed THEN 0.25 ELSE 0 END) AS py FROM sq),
        m AS (SELECT source_code, min(code) AS code FROM c, sq WHERE {IN_SQUARE} GROUP BY 1)
        SELECT c.source_code, coalesce(m.code, c.source_code) AS codigo_municipio,
          CASE WHEN m.code IS NULL THEN 'fallback_source_polygon_centroid' ELSE 'matched_centroid_superposition' END AS municipio_match_status
        FROM c LEFT JOIN m ON m.source_code = c.source_code""",
)
def centroid_owner(spark, sf):
    """Centroids inside a hole fall back to their own polygon (checked in the plane)."""
    polygons, edges = polygon_parts(spark, sf)
    centres = S.polygon_measures(polygons).select(
        F.col("codigo_municipio").alias("source_code"), F.col("centroid.x").alias("x"), F.col("centroid.y").alias("y")
    )
    index = S.polygon_index(edges.select("codigo_municipio", *S.SEGMENT), "codigo_municipio", CELL)
    owned = S.assign_polygon(centres, index, CELL, ["codigo_municipio"], "source_code", boundary=True)
    status = F.when(F.col("codigo_municipio").isNotNull(), "matched_centroid_superposition").otherwise(
        "fallback_source_polygon_centroid"
    )
    return owned.select(
        "source_code", F.coalesce("codigo_municipio", "source_code").alias("codigo_municipio"), status.alias("municipio_match_status")
    )


@query(
    "geojson_features",
    f"""WITH {POLYGONS}, n AS (SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS code, count(*) AS n FROM customer GROUP BY 1)
        SELECT code AS codigo_municipio, 'Feature' AS type, 'MultiPolygon' AS geometry_type, CASE WHEN holed THEN 2 ELSE 1 END AS rings,
          x0 AS first_x, y0 AS first_y, CAST(coalesce(n, 0) AS DOUBLE) AS metric FROM sq LEFT JOIN n USING (code)""",
)
def geojson_features(spark, sf):
    """GeoJSON text per polygon, read back with JSON paths."""
    metric = table(spark, sf, "customer").groupBy(F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("codigo_municipio")).agg(
        F.count("*").alias("metric")
    )
    rows = nation_polygons(spark, sf).join(metric, "codigo_municipio", "left")
    feature = rows.select("codigo_municipio", S.geojson_feature("geometry", ["codigo_municipio", "nome_municipio"], "metric").alias("j"))

    def at(path: str):
        return F.get_json_object("j", path)

    return feature.select(
        "codigo_municipio",
        at("$.type").alias("type"),
        at("$.geometry.type").alias("geometry_type"),
        F.size(F.from_json(at("$.geometry.coordinates"), "array<array<array<array<double>>>>")[0]).alias("rings"),
        at("$.geometry.coordinates[0][0][0][0]").cast("double").alias("first_x"),
        at("$.geometry.coordinates[0][0][0][1]").cast("double").alias("first_y"),
        at("$.properties.metric").cast("double").alias("metric"),
    )


@query(
    "map_frame",
    f"""WITH {POLYGONS} SELECT min(y0) AS min_lat, min(x0) AS min_lon, max(y0 + 2.25) AS max_lat, max(x0 + 2.25) AS max_lon,
        (min(y0) + max(y0 + 2.25)) / 2 AS center_lat, (min(x0) + max(x0 + 2.25)) / 2 AS center_lon FROM sq""",
)
def map_frame(spark, sf):
    return S.map_frame(nation_polygons(spark, sf))


WEATHER_CELLS = """
cell AS (SELECT user_id AS cell_id, -30.0::DOUBLE + (user_id * 13 % 101) / 10.0::DOUBLE AS cy, -55.0::DOUBLE + (user_id * 29 % 103) / 10.0::DOUBLE AS cx
         FROM (SELECT DISTINCT user_id FROM events)),
mid AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, -55.0::DOUBLE + n_nationkey % 5 * 2 + 1.03::DOUBLE AS px, -30.0::DOUBLE + (n_nationkey // 5) * 2 + 1.07::DOUBLE AS py FROM nation),
near AS (SELECT code, cell_id, cy, cx, sqrt((py - cy) * (py - cy) + (px - cx) * (px - cx)) AS dist FROM mid, cell)"""


def weather_cells(spark, sf):
    u = F.col("user_id")
    return table(spark, sf, "events").select(
        u.alias("cell_id"),
        (F.lit(-30.0) + (u * 13 % 101) / F.lit(10.0)).alias("latitude"),
        (F.lit(-55.0) + (u * 29 % 103) / F.lit(10.0)).alias("longitude"),
    ).distinct()


def request_points(spark, sf):
    k = F.col("n_nationkey")
    return table(spark, sf, "nation").select(
        F.lpad(k.cast("string"), 2, "0").alias("codigo_municipio"),
        (F.lit(-30.0) + F.floor(k / 5) * 2 + 1.07).alias("latitude"),
        (F.lit(-55.0) + k % 5 * 2 + 1.03).alias("longitude"),
    )


@query(
    "match_weather_cells",
    f"WITH {WEATHER_CELLS} SELECT code AS codigo_municipio, cell_id, round(dist, 6) AS distance FROM near WHERE dist <= 0.4",
)
def match_weather_cells(spark, sf):
    """Band join: every cell within 0.4 degrees of a request point."""
    matched = match_cells(request_points(spark, sf), weather_cells(spark, sf), "codigo_municipio", 0.4)
    return matched.select("codigo_municipio", "cell_id", "distance")


WEATHER_DAYS = f"""{WEATHER_CELLS},
obs AS (SELECT user_id AS cell_id, CAST(ts AS DATE) AS day, max(value) AS warm FROM events GROUP BY 1, 2),
pick AS (SELECT code, day, near.cell_id, dist, warm, row_number() OVER (PARTITION BY code, day ORDER BY dist, near.cell_id) AS r
         FROM near JOIN obs USING (cell_id) WHERE dist <= 0.4)"""


def cell_days(spark, sf):
    daily = table(spark, sf, "events").groupBy(F.col("user_id").alias("cell_id"), F.to_date("ts").alias("day")).agg(
        F.max("value").alias("warm")
    )
    return match_cells(request_points(spark, sf), weather_cells(spark, sf), "codigo_municipio", 0.4).join(daily, "cell_id")


@query(
    "nearest_cell_match",
    f"WITH {WEATHER_DAYS} SELECT code AS codigo_municipio, CAST(day AS VARCHAR) AS day, cell_id, round(dist, 6) AS distance, round(warm, 6) AS warm FROM pick WHERE r = 1",
)
def nearest_cell_match(spark, sf):
    nearest_rows = nearest_per_day(cell_days(spark, sf), "codigo_municipio", "day", [F.col("cell_id")])
    return nearest_rows.select("codigo_municipio", "day", "cell_id", "distance", "warm")


@query(
    "missing_days",
    f"""WITH {WEATHER_DAYS}, b AS (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM events),
        w AS (SELECT code, CAST(unnest(generate_series(lo - 2, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM mid, b),
        a AS (SELECT w.code, w.day, row_number() OVER (PARTITION BY w.code ORDER BY w.day) AS r FROM w LEFT JOIN pick p ON p.code = w.code AND p.day = w.day AND p.r = 1 WHERE p.code IS NULL)
        SELECT code AS codigo_municipio, count(*) AS missing_days, string_agg(CAST(day AS VARCHAR), ', ' ORDER BY day) FILTER (WHERE r <= 5) AS first_missing FROM a GROUP BY 1""",
)
def missing(spark, sf):
    """Requested days without any matched cell, per point."""
    events = table(spark, sf, "events")
    lo = events.agg(F.date_sub(F.to_date(F.min("ts")), 2)).scalar()
    hi = events.agg(F.to_date(F.max("ts"))).scalar()
    return missing_days(cell_days(spark, sf), request_points(spark, sf), "codigo_municipio", "day", lo, hi)


@query("supplier_roads_wkt", None)
def roads_wkt(spark, sf):
    """Roads with length, type and their WKT written back (text form differs between engines)."""
    rings = G.parse_wkt("geometry")
    return supplier_roads(spark, sf).select(
        "road_id",
        G.geometry_type("geometry").alias("geometry_type"),
        G.path_length(rings).alias("length"),
        G.to_wkt_line(rings).alias("geometry"),
    )
