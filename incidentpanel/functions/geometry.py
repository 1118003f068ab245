"""Planar geometry as column expressions: WKT, measures, distances, ray casting.

In flight a geometry is ``array<struct<outer:boolean, pts:array<struct<x,y>>>>``:
one entry per ring of a polygon or per part of a line.  At rest it is WKT text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from incidentpanel.functions.clean import col


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# WKT tag -> geometry type name.
TYPE_NAMES = {
    "POINT": "Point",
    "LINESTRING": "LineString",
    "POLYGON": "Polygon",
    "MULTIPOINT": "MultiPoint",
    "MULTILINESTRING": "MultiLineString",
    "MULTIPOLYGON": "MultiPolygon",
    "GEOMETRYCOLLECTION": "GeometryCollection",
}


def geometry_type(wkt: Column | str) -> Column:
    tag = F.regexp_extract(F.upper(F.trim(col(wkt))), "^[A-Z]+", 0)
    names = F.create_map(*[F.lit(v) for pair in TYPE_NAMES.items() for v in pair])
    return F.try_element_at(names, tag)


def parse_wkt(wkt: Column | str) -> Column:
    """WKT lines and polygons to rings; null, blank or EMPTY text gives an empty array.

    A ring directly behind an opening parenthesis starts a new part of the
    geometry; the following rings of the same part are holes.
    """
    text = F.coalesce(col(wkt), F.lit(""))
    openings = F.regexp_extract_all(text, F.lit(r"(\(*)\(([^()]+)\)"), 1)
    bodies = F.regexp_extract_all(text, F.lit(r"(\(*)\(([^()]+)\)"), 2)

    def point(pair: Column) -> Column:
        xy = F.split(F.trim(pair), r"\s+")
        return F.struct(F.get(xy, 0).cast("double").alias("x"), F.get(xy, 1).cast("double").alias("y"))

    return F.zip_with(
        openings,
        bodies,
        lambda o, b: F.struct((F.length(o) > 0).alias("outer"), F.transform(F.split(b, ","), point).alias("pts")),
    )


def map_points(rings: Column, fn: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """Apply a coordinate function to every vertex."""

    def moved(p: Column) -> Column:
        x, y = fn(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(rings, lambda r: F.struct(r["outer"].alias("outer"), F.transform(r["pts"], moved).alias("pts")))


def ring_edges(pts: Column) -> Column:
    """Consecutive vertex pairs of one ring or path."""
    last = F.greatest(F.size(pts) - 1, F.lit(0))
    return F.zip_with(
        F.slice(pts, F.lit(1), last),
        F.slice(pts, F.lit(2), last),
        lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")),
    )


def all_edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, lambda r: ring_edges(r["pts"])))


def _total(items: Column, term: Callable[[Column], Column]) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, e: acc + term(e))


def _ring_moments(ring: Column) -> Column:
    """Signed area and first moments of one ring, relative to its first vertex."""
    origin = F.get(ring["pts"], F.lit(0))

    def moments(edges: Column) -> Column:
        def cross(e: Column) -> Column:
            return (e["x1"] - origin["x"]) * (e["y2"] - origin["y"]) - (e["x2"] - origin["x"]) * (e["y1"] - origin["y"])

        area = _total(edges, cross) / 2
        mx = _total(edges, lambda e: (e["x1"] + e["x2"] - origin["x"] * 2) * cross(e)) / 6
        my = _total(edges, lambda e: (e["y1"] + e["y2"] - origin["y"] * 2) * cross(e)) / 6
        flip = F.when(area < 0, -1.0).otherwise(1.0) * F.when(ring["outer"], 1.0).otherwise(-1.0)
        return F.struct(
            (flip * area).alias("a"),
            (flip * (mx + origin["x"] * area)).alias("mx"),
            (flip * (my + origin["y"] * area)).alias("my"),
        )

    return let(ring_edges(ring["pts"]), moments)


def polygon_area(rings: Column) -> Column:
    """Outer rings minus holes, whatever their orientation."""
    return _total(F.transform(rings, _ring_moments), lambda m: m["a"])


def polygon_centroid(rings: Column) -> Column:
    """Area centroid as struct(x, y); null for a zero area."""

    def centre(parts: Column) -> Column:
        area = _total(parts, lambda m: m["a"])
        return F.when(
            area != 0,
            F.struct(
                (_total(parts, lambda m: m["mx"]) / area).alias("x"),
                (_total(parts, lambda m: m["my"]) / area).alias("y"),
            ),
        )

    return let(F.transform(rings, _ring_moments), centre)


def path_length(rings: Column) -> Column:
    return _total(all_edges(rings), lambda e: F.hypot(e["x2"] - e["x1"], e["y2"] - e["y1"]))


def bounds(rings: Column) -> Column:
    xs = F.flatten(F.transform(rings, lambda r: F.transform(r["pts"], lambda p: p["x"])))
    ys = F.flatten(F.transform(rings, lambda r: F.transform(r["pts"], lambda p: p["y"])))
    return F.struct(
        F.array_min(xs).alias("min_x"),
        F.array_min(ys).alias("min_y"),
        F.array_max(xs).alias("max_x"),
        F.array_max(ys).alias("max_y"),
    )


def points_text(pts: Column) -> Column:
    return F.array_join(F.transform(pts, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", ")


def to_wkt_polygon(rings: Column) -> Column:
    """POLYGON for one part, MULTIPOLYGON otherwise."""

    # A ring that opens a part closes the previous one.
    body = F.aggregate(
        rings,
        F.lit(""),
        lambda acc, r: F.concat(
            acc,
            F.when(F.length(acc) == 0, "(").when(r["outer"], "), (").otherwise(", "),
            F.lit("("),
            points_text(r["pts"]),
            F.lit(")"),
        ),
    )
    parts = F.size(F.filter(rings, lambda r: r["outer"]))
    return (
        F.when(F.size(rings) == 0, "POLYGON EMPTY")
        .when(parts > 1, F.concat(F.lit("MULTIPOLYGON ("), body, F.lit("))")))
        .otherwise(F.concat(F.lit("POLYGON "), body, F.lit(")")))
    )


def to_wkt_line(rings: Column) -> Column:
    body = F.array_join(F.transform(rings, lambda r: F.concat(F.lit("("), points_text(r["pts"]), F.lit(")"))), ", ")
    return (
        F.when(F.size(rings) == 0, "LINESTRING EMPTY")
        .when(F.size(rings) > 1, F.concat(F.lit("MULTILINESTRING ("), body, F.lit(")")))
        .otherwise(F.concat(F.lit("LINESTRING "), body))
    )


def point_segment_distance(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx, dy = x2 - x1, y2 - y1
    square = dx * dx + dy * dy
    along = F.when(square > 0, ((px - x1) * dx + (py - y1) * dy) / square).otherwise(F.lit(0.0))
    t = F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0))
    fx, fy = px - (x1 + t * dx), py - (y1 + t * dy)
    # Not hypot: ties are decided by the last bit, which is that of the SQL twins this way.
    return F.sqrt(fx * fx + fy * fy)


def _side(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def segments_distance(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Zero for crossing segments, else the smallest end-to-segment distance."""
    ends_a = [(a["x1"], a["y1"]), (a["x2"], a["y2"])]
    ends_b = [(b["x1"], b["y1"]), (b["x2"], b["y2"])]
    line_a = (a["x1"], a["y1"], a["x2"], a["y2"])
    line_b = (b["x1"], b["y1"], b["x2"], b["y2"])
    apart = F.least(
        *[point_segment_distance(x, y, *line_b) for x, y in ends_a],
        *[point_segment_distance(x, y, *line_a) for x, y in ends_b],
    )
    crossing = (_side(*line_a, *ends_b[0]) * _side(*line_a, *ends_b[1]) < 0) & (
        _side(*line_b, *ends_a[0]) * _side(*line_b, *ends_a[1]) < 0
    )
    return F.when(crossing, F.lit(0.0)).otherwise(apart)


def on_boundary(px: Column, py: Column, edges: Column) -> Column:
    return F.exists(
        edges,
        lambda e: (_side(e["x1"], e["y1"], e["x2"], e["y2"], px, py) == 0)
        & px.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & py.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])),
    )


def ray_parity(px: Column, py: Column, edges: Column) -> Column:
    """True when a ray towards +x crosses the edges an odd number of times."""
    crossings = F.size(
        F.filter(
            edges,
            lambda e: ((e["y1"] > py) != (e["y2"] > py))
            & (px < (e["x2"] - e["x1"]) * (py - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]),
        )
    )
    return crossings % 2 == 1


def inside(px: Column, py: Column, edges: Column, boundary: bool = False) -> Column:
    """Point in polygon; the boundary counts only when asked for."""
    edge_hit = on_boundary(px, py, edges)
    return (edge_hit | ray_parity(px, py, edges)) if boundary else (~edge_hit & ray_parity(px, py, edges))
