"""Grid joins: corridor tests, point in polygon, clipping, nearest section.

Every join below is an equi-join on grid cells with an exact predicate behind
it.  Segments and polygons are the small side, but their size is not assumed:
Spark broadcasts them only when its own size check allows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidentpanel.functions import geometry as G
from incidentpanel.functions.crs import project
from incidentpanel.session import checkpointed
from incidentpanel.skew import latest_by, salted_join

SEGMENT = ("x1", "y1", "x2", "y2")

# Segments in one list of the far search, about.
HEAP = 256


def _cell(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(float(size))).cast("bigint")


def segments_from_wkt(lines: DataFrame, wkt: str = "geometry", projected: bool = False) -> DataFrame:
    """One row per segment of every line, keeping the other columns."""
    rings = G.parse_wkt(wkt)
    if projected:
        rings = G.map_points(rings, project)
    kept = [c for c in lines.columns if c != wkt]
    return (
        lines.select(*kept, F.explode(G.all_edges(rings)).alias("__e"))
        .select(*kept, *[F.col(f"__e.{c}").alias(c) for c in SEGMENT])
        .filter((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))
    )


def polygon_edges(polygons: DataFrame, wkt: str = "geometry", projected: bool = False) -> DataFrame:
    return segments_from_wkt(polygons, wkt, projected)


def dissolve_segments(segments: DataFrame, by: Sequence[str], version: str | None = None) -> DataFrame:
    """Distinct segments per group whatever their direction, with the first version tag."""
    a = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))
    b = F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    directed = segments.withColumns({"__a": F.least(a, b), "__b": F.greatest(a, b)})
    tag = [F.min(version).alias(version)] if version else []
    merged = directed.groupBy(*by, "__a", "__b").agg(F.count("*").alias("copies"), *tag)
    return merged.select(
        *by,
        F.col("__a.x").alias("x1"),
        F.col("__a.y").alias("y1"),
        F.col("__b.x").alias("x2"),
        F.col("__b.y").alias("y2"),
        "copies",
        *([version] if version else []),
    )


def merge_collinear(segments: DataFrame, block: float, digits: int = 6) -> DataFrame:
    """Union of segments that overlap on a common supporting line.

    Segments are described by their line (direction and offset) and an interval
    along it.  Intervals are cut at multiples of ``block`` first, so even one
    very long straight road is merged in many independent groups.
    """
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    forward = (F.col("x2") > F.col("x1")) | ((F.col("x2") == F.col("x1")) & (F.col("y2") > F.col("y1")))
    sign = F.when(forward, 1.0).otherwise(-1.0)
    lined = (
        segments.select(*SEGMENT)
        .filter(length > 0)
        .withColumns({"ux": sign * (F.col("x2") - F.col("x1")) / length, "uy": sign * (F.col("y2") - F.col("y1")) / length})
        .withColumn("off", F.col("ux") * F.col("y1") - F.col("uy") * F.col("x1"))
        .withColumns(
            {
                "p": F.col("ux") * F.col("x1") + F.col("uy") * F.col("y1"),
                "q": F.col("ux") * F.col("x2") + F.col("uy") * F.col("y2"),
            }
        )
        .withColumns({"lo": F.least("p", "q"), "hi": F.greatest("p", "q")})
        .withColumns({"kx": F.round("ux", digits + 3), "ky": F.round("uy", digits + 3), "ko": F.round("off", digits)})
    )
    cut = (
        lined.withColumn("__b", F.explode(F.sequence(_cell(F.col("lo"), block), _cell(F.col("hi"), block))))
        .withColumns(
            {
                "lo": F.greatest(F.col("lo"), F.col("__b") * F.lit(float(block))),
                "hi": F.least(F.col("hi"), (F.col("__b") + 1) * F.lit(float(block))),
            }
        )
        .filter(F.col("hi") > F.col("lo"))
        # Identical intervals collapse before the ordered pass.
        .groupBy("kx", "ky", "ko", "__b", "lo", "hi")
        .agg(F.min("ux").alias("ux"), F.min("uy").alias("uy"), F.min("off").alias("off"))
    )
    line = ["kx", "ky", "ko", "__b"]
    ordered = Window.partitionBy(*line).orderBy("lo", "hi")
    reach = F.max("hi").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce((F.col("lo") > F.col("__reach")).cast("int"), F.lit(1))
    merged = (
        cut.withColumn("__reach", reach)
        .withColumn("__island", F.sum(starts).over(ordered))
        .groupBy(*line, "__island")
        .agg(
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            F.min("ux").alias("ux"),
            F.min("uy").alias("uy"),
            F.min("off").alias("off"),
        )
    )

    def at(t: str) -> tuple[Column, Column]:
        return F.col(t) * F.col("ux") - F.col("off") * F.col("uy"), F.col(t) * F.col("uy") + F.col("off") * F.col("ux")

    (ax, ay), (bx, by) = at("lo"), at("hi")
    return merged.select(ax.alias("x1"), ay.alias("y1"), bx.alias("x2"), by.alias("y2"))


def split_long(segments: DataFrame, limit: float) -> DataFrame:
    """Cut segments into pieces no longer than ``limit``."""
    others = [c for c in segments.columns if c not in SEGMENT]
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    count = F.greatest(F.ceil(length / F.lit(float(limit))), F.lit(1)).cast("int")
    cut = segments.withColumn("__n", count).withColumn("__i", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))

    def at(a: str, b: str, i: Column) -> Column:
        return F.when(i == F.col("__n"), F.col(b)).otherwise(
            F.col(a) + (F.col(b) - F.col(a)) * (i / F.col("__n"))
        )

    i = F.col("__i")
    return cut.select(
        *others,
        at("x1", "x2", i).alias("x1"),
        at("y1", "y2", i).alias("y1"),
        at("x1", "x2", i + 1).alias("x2"),
        at("y1", "y2", i + 1).alias("y2"),
    )


def _cover(segments: DataFrame, pad: float, size: float) -> DataFrame:
    """Segment pieces repeated for each cell their padded box touches."""
    pieces = split_long(segments, size)
    lo_x, hi_x = F.least("x1", "x2") - pad, F.greatest("x1", "x2") + pad
    lo_y, hi_y = F.least("y1", "y2") - pad, F.greatest("y1", "y2") + pad
    return pieces.withColumn("__cx", F.explode(F.sequence(_cell(lo_x, size), _cell(hi_x, size)))).withColumn(
        "__cy", F.explode(F.sequence(_cell(lo_y, size), _cell(hi_y, size)))
    )


def _with_cells(points: DataFrame, x: str, y: str, size: float) -> DataFrame:
    return points.withColumns({"__cx": _cell(F.col(x), size), "__cy": _cell(F.col(y), size)})


def _point_to_segment(x: str, y: str, left: str = "l", right: str = "r") -> Column:
    return G.point_segment_distance(
        F.col(f"{left}.{x}"), F.col(f"{left}.{y}"), *[F.col(f"{right}.{c}") for c in SEGMENT]
    )


def within_corridor(
    points: DataFrame, segments: DataFrame, distance: float, point_id: str = "id", x: str = "x", y: str = "y"
) -> DataFrame:
    """Points no farther than ``distance`` from any segment (boundary included).

    A point lies in the buffer of a line exactly when its distance is at most
    the buffer radius, so no buffer polygon is built.  The semi join stops at
    the first hit and emits no pairs.
    """
    size = max(float(distance), 1e-9)
    # Each stretch counts once however many roads share it; the second exchange shows Spark what the cells made of it.
    cover = _cover(segments.select(*SEGMENT).distinct(), float(distance), size).distinct()
    located = _with_cells(points, x, y, size)
    hit = _point_to_segment(x, y) <= F.lit(float(distance))
    return salted_join(located, cover, ["__cx", "__cy"], [point_id], "left_semi", hit).drop("__cx", "__cy")


def corridor_flag(
    points: DataFrame,
    segments: DataFrame,
    distance: float,
    point_id: str = "id",
    x: str = "x",
    y: str = "y",
    name: str = "inside_corridor",
) -> DataFrame:
    """All points with a flag; points without coordinates are outside.

    The road pieces that reach into a cell stand in one array, so a point meets its cell
    once and keeps its row: one join, nothing joined back.
    """
    size = max(float(distance), 1e-9)
    pieces = _cover(segments.select(*SEGMENT).distinct(), float(distance), size)
    cells = pieces.groupBy("__cx", "__cy").agg(F.collect_list(F.struct(*SEGMENT)).alias("__pieces"))
    located = salted_join(_with_cells(points, x, y, size), cells, ["__cx", "__cy"], [point_id], "left")
    near = F.exists(
        "__pieces",
        lambda p: G.point_segment_distance(F.col(x), F.col(y), *[p[c] for c in SEGMENT]) <= F.lit(float(distance)),
    )
    return located.select(*points.columns, F.coalesce(near, F.lit(False)).alias(name))


def corridor_area(segments: DataFrame, distance: float, cell: float) -> DataFrame:
    """Corridor area by grid quadrature: cells whose centre is inside, times cell area."""
    pieces = split_long(segments.select(*SEGMENT).distinct(), float(distance))
    pad = float(distance)
    cx = F.explode(F.sequence(_cell(F.least("x1", "x2") - pad, cell), _cell(F.greatest("x1", "x2") + pad, cell)))
    cy = F.explode(F.sequence(_cell(F.least("y1", "y2") - pad, cell), _cell(F.greatest("y1", "y2") + pad, cell)))
    centre_x, centre_y = (F.col("cx") + 0.5) * cell, (F.col("cy") + 0.5) * cell
    near = G.point_segment_distance(centre_x, centre_y, *[F.col(c) for c in SEGMENT]) <= pad
    cells = pieces.withColumn("cx", cx).withColumn("cy", cy).filter(near).select("cx", "cy").distinct()
    return cells.agg(
        F.count("*").alias("cells"), (F.count("*") * F.lit(float(cell) ** 2 / 1e6)).alias("corridor_area_km2")
    )


def polygon_index(edges: DataFrame, polygon_id: str, size: float, extra: Sequence[str] = ()) -> DataFrame:
    """Cells of every polygon with the edges a ray from that cell can meet.

    For each grid row the polygon's edges in that row are gathered (bounded by
    the polygon's own vertices); each cell keeps only those not left of it.
    """
    keys = [polygon_id, *extra]
    edge = F.struct(*SEGMENT)
    strips = (
        edges.withColumn(
            "__cy", F.explode(F.sequence(_cell(F.least("y1", "y2"), size), _cell(F.greatest("y1", "y2"), size)))
        )
        .groupBy(*keys, "__cy")
        .agg(
            F.collect_list(edge).alias("edges"),
            F.min(F.least("x1", "x2")).alias("__lo"),
            F.max(F.greatest("x1", "x2")).alias("__hi"),
        )
    )
    return strips.withColumn(
        "__cx", F.explode(F.sequence(_cell(F.col("__lo"), size), _cell(F.col("__hi"), size)))
    ).select(
        *keys,
        "__cx",
        "__cy",
        F.expr(f"filter(edges, e -> greatest(e.x1, e.x2) >= __cx * {float(size)!r}D)").alias("edges"),
    )


def points_in_polygons(
    points: DataFrame,
    index: DataFrame,
    size: float,
    point_id: str = "id",
    x: str = "x",
    y: str = "y",
    boundary: bool = False,
    how: str = "inner",
) -> DataFrame:
    """Every (point, polygon) match; ``index`` comes from :func:`polygon_index`."""
    located = _with_cells(points, x, y, size)
    hit = G.inside(F.col(f"l.{x}"), F.col(f"l.{y}"), F.col("r.edges"), boundary)
    return salted_join(located, index, ["__cx", "__cy"], [point_id], how, hit).drop("__cx", "__cy", "edges")


def assign_polygon(
    points: DataFrame,
    index: DataFrame,
    size: float,
    order: Sequence[str],
    point_id: str = "id",
    x: str = "x",
    y: str = "y",
    boundary: bool = False,
    prefer: tuple[str, str] | None = None,
) -> DataFrame:
    """Left join to the first matching polygon by its columns ``order``; unmatched points stay.

    All polygons that can hold a point cover its cell, so they are put into one ordered
    array per cell (bounded by how many overlap there) and the point takes the first
    that holds it: no pairs, no aggregate.  With ``prefer`` (point column, polygon
    column) polygons that agree in it come first.
    """
    keys = [c for c in index.columns if c not in ("__cx", "__cy", "edges")]
    polygon = F.struct(*order, *[k for k in keys if k not in order], "edges")
    cells = index.groupBy("__cx", "__cy").agg(F.array_sort(F.collect_list(polygon)).alias("__polygons"))
    located = salted_join(_with_cells(points, x, y, size), cells, ["__cx", "__cy"], [point_id], "left")
    hits = F.filter("__polygons", lambda p: G.inside(F.col(x), F.col(y), p["edges"], boundary))
    kept = F.transform(hits, lambda p: F.struct(*[p[k].alias(k) for k in keys]))
    first = F.get("__hits", F.lit(0))
    if prefer:
        own = F.filter("__hits", lambda p: p[prefer[1]] == F.col(prefer[0]))
        first = F.coalesce(F.get(own, F.lit(0)), first)
    chosen = located.withColumn("__hits", kept).withColumn("__first", first)
    return chosen.select(*points.columns, *[F.col(f"__first.{k}").alias(k) for k in keys])


def polygons_near_corridor(
    polygons: DataFrame, edges: DataFrame, segments: DataFrame, polygon_id: str, distance: float, size: float
) -> DataFrame:
    """Polygons within ``distance`` of the road or containing a part of it."""
    pieces = _cover(segments.select(*SEGMENT).distinct(), float(distance), size).distinct()
    borders = _cover(edges.select(polygon_id, *SEGMENT), 0.0, size)
    a = {c: F.col(f"l.{c}") for c in SEGMENT}
    b = {c: F.col(f"r.{c}") for c in SEGMENT}
    touched = salted_join(
        borders,
        pieces,
        ["__cx", "__cy"],
        list(SEGMENT),
        "left_semi",
        G.segments_distance(a, b) <= F.lit(float(distance)),
    ).select(polygon_id)
    starts = segments.select(F.xxhash64(*SEGMENT).alias("__sid"), F.col("x1").alias("x"), F.col("y1").alias("y"))
    holders = points_in_polygons(
        starts, polygon_index(edges, polygon_id, size), size, "__sid", boundary=True
    ).select(polygon_id)
    return polygons.join(touched.unionByName(holders).distinct(), polygon_id, "left_semi")


def _may_cross() -> Column:
    """Join condition of a road piece (l) and a border (r): their boxes meet, and the border's ends are not on one side.

    Slightly generous, so that no pair goes that the exact test would accept.
    """
    x1, y1, x2, y2 = (F.col(f"l.{c}") for c in SEGMENT)
    ex1, ey1, ex2, ey2 = (F.col(f"r.e{c}") for c in SEGMENT)
    dx, dy = x2 - x1, y2 - y1
    reach = F.abs(ex2 - ex1) + F.abs(ey2 - ey1)
    slack = reach * 1e-6 + 1e-6
    boxes = F.lit(True)
    for a, b, c, d in ((x1, x2, ex1, ex2), (y1, y2, ey1, ey2)):
        boxes = boxes & (F.least(a, b) <= F.greatest(c, d) + slack) & (F.least(c, d) <= F.greatest(a, b) + slack)
    first, second = (dx * (py - y1) - dy * (px - x1) for px, py in ((ex1, ey1), (ex2, ey2)))
    side = slack * (F.abs(dx) + F.abs(dy))
    return boxes & (F.least(first, second) <= side) & (F.greatest(first, second) >= -side)


def clip_segments(
    segments: DataFrame, edges: DataFrame, segment_id: str, polygon_id: str, size: float
) -> DataFrame:
    """Pieces of every segment inside every polygon.

    Segments are cut where any polygon edge meets them; a piece then lies wholly
    inside or outside each polygon, so its midpoint decides.  Roads that run
    along a shared border belong to both sides.
    """
    base = segments.select(segment_id, *SEGMENT)
    roads = _cover(base.withColumns({f"s{c}": F.col(c) for c in SEGMENT}), 0.0, size)
    borders = _cover(edges.select(*SEGMENT).distinct(), 0.0, size).withColumnsRenamed({c: f"e{c}" for c in SEGMENT})
    roads = roads.select(segment_id, "__cx", "__cy", *[F.col(f"s{c}").alias(c) for c in SEGMENT]).distinct()
    met = salted_join(roads, borders, ["__cx", "__cy"], [segment_id], "inner", _may_cross())
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    ex, ey = F.col("ex2") - F.col("ex1"), F.col("ey2") - F.col("ey1")
    det = dx * ey - dy * ex
    wx, wy = F.col("ex1") - F.col("x1"), F.col("ey1") - F.col("y1")
    t, u = (wx * ey - wy * ex) / F.nullif(det, F.lit(0.0)), (wx * dy - wy * dx) / F.nullif(det, F.lit(0.0))
    square = dx * dx + dy * dy

    def foot(px: Column, py: Column) -> Column:
        return ((px - F.col("x1")) * dx + (py - F.col("y1")) * dy) / square

    slack = F.lit(1e-9)
    crossing = F.when(t.between(0, 1) & u.between(-slack, 1 + slack), F.array(t))
    aligned = F.when(
        (det == 0) & (wx * dy - wy * dx == 0),
        F.array(foot(F.col("ex1"), F.col("ey1")), foot(F.col("ex2"), F.col("ey2"))),
    )
    cuts = (
        met.select(segment_id, F.explode(F.coalesce(crossing, aligned, F.array().cast("array<double>"))).alias("t"))
        .withColumn("t", F.round("t", 12))
        .filter((F.col("t") > 0) & (F.col("t") < 1))
        .groupBy(segment_id)
        .agg(F.collect_set("t").alias("__ts"))
    )
    inner = F.coalesce(F.col("__ts"), F.array().cast("array<double>"))
    knots = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0)), inner, F.array(F.lit(1.0)))))
    pieces = (
        base.join(cuts, segment_id, "left")
        .withColumn("__k", knots)
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.size("__k") - 2)))
        .withColumns({"t0": F.get("__k", F.col("piece")), "t1": F.get("__k", F.col("piece") + 1)})
    )

    def at(a: str, b: str, s: Column) -> Column:
        return F.col(a) + (F.col(b) - F.col(a)) * s

    half = (F.col("t0") + F.col("t1")) / 2
    placed = pieces.select(
        segment_id,
        "piece",
        F.xxhash64(segment_id, "piece").alias("__pid"),
        at("x1", "x2", half).alias("__mx"),
        at("y1", "y2", half).alias("__my"),
        at("x1", "x2", F.col("t0")).alias("x1"),
        at("y1", "y2", F.col("t0")).alias("y1"),
        at("x1", "x2", F.col("t1")).alias("x2"),
        at("y1", "y2", F.col("t1")).alias("y2"),
    )
    index = polygon_index(edges, polygon_id, size)
    found = points_in_polygons(placed, index, size, "__pid", "__mx", "__my", boundary=True)
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    return found.withColumn("length", length).filter("length > 0").drop("__pid", "__mx", "__my")


def road_length_by(pieces: DataFrame, keys: Sequence[str]) -> DataFrame:
    return pieces.groupBy(*keys).agg(F.sum("length").alias("road_length_m"), F.count("*").alias("pieces"))


def nearest_section(
    points: DataFrame,
    sections: DataFrame,
    territory: str,
    reach: float,
    point_id: str = "id",
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """Closest section of the point's own territory.

    ``sections`` has one row per segment: territory, section_id, road_length_m
    and the segment.  Ties go to the longer section, then the smaller id; sections
    that share a segment tie everywhere on it, so only the winner keeps it.  A grid
    with cells of ``reach`` answers the points that have a segment that close,
    and such a hit cannot be beaten by anything unseen: the segments that reach into
    a cell stand in one array, so a point meets its cell once.  The others first pick,
    from at most a hundred boxes per territory, those boxes that can hold their
    nearest segment, and are compared with the segments of these boxes only.
    """
    spark = sections.sparkSession
    listed = sections.select(F.col(territory), "section_id", "road_length_m", *SEGMENT)
    # Read by the near and by the far search.
    segs = checkpointed(
        spark, latest_by(listed, [territory, *SEGMENT], [-F.col("road_length_m"), F.col("section_id")], smallest=True)
    )
    usable = points.filter(F.col(territory).isNotNull()).select(point_id, territory, x, y)
    size = float(reach)
    cells = _cover(segs, size, size).groupBy(territory, "__cx", "__cy").agg(_segment_list())
    located = salted_join(_with_cells(usable, x, y, size), cells, [territory, "__cx", "__cy"], [point_id], "left")
    # One row per point, read as found and as still to be found.
    met = checkpointed(spark, located.select(point_id, territory, x, y, _best(x, y, size).alias("__best")))
    close = met.filter(F.col("__best").isNotNull())
    rest = met.filter(F.col("__best").isNull()).drop("__best")
    far = _far_search(rest, split_long(segs, size), territory, point_id, x, y)
    chosen = close.select(point_id, "__best").unionByName(far).select(
        point_id, F.col("__best.section_id").alias("section_id"), F.col("__best.distance").alias("distance")
    )
    status = (
        F.when(F.col(territory).isNull(), "unmatched_exact_polygon")
        .when(F.col("section_id").isNotNull(), "matched_nearest_section")
        .otherwise("unmatched_no_section_in_rgi")
    )
    return points.join(chosen, point_id, "left").withColumn("section_match_status", status)


def _segment_list() -> Column:
    return F.collect_list(F.struct("section_id", "road_length_m", *SEGMENT)).alias("__segments")


def _best(x: str, y: str, reach: float | None = None) -> Column:
    """Of the row's ``__segments`` the closest: (distance, longest first, section_id); null if none is within ``reach``."""
    ranked = F.transform(
        "__segments",
        lambda s: F.struct(
            G.point_segment_distance(F.col(x), F.col(y), *[s[c] for c in SEGMENT]).alias("distance"),
            (-s["road_length_m"]).alias("shorter"),
            s["section_id"].alias("section_id"),
        ),
    )
    if reach is not None:
        ranked = F.filter(ranked, lambda b: b["distance"] <= F.lit(reach))
    return F.array_min(ranked)


def _far_search(
    points: DataFrame, pieces: DataFrame, territory: str, point_id: str, x: str, y: str, boxes_per_side: int = 8
) -> DataFrame:
    """``(point_id, __best)`` from the pieces in the boxes that can hold a point's nearest one.

    The pieces of a box are listed in heaps of some ``HEAP``, so neither a list nor what meets
    a point grows to the size of a box.
    """
    extent = pieces.groupBy(territory).agg(
        F.min(F.least("x1", "x2")).alias("__ox"),
        F.min(F.least("y1", "y2")).alias("__oy"),
        (
            F.greatest(
                F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2")),
                F.max(F.greatest("y1", "y2")) - F.min(F.least("y1", "y2")),
                F.lit(1e-9),
            )
            / boxes_per_side
        ).alias("__step"),
    )
    middle_x, middle_y = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    boxed = pieces.join(extent, territory).withColumns(
        {
            "__bx": F.floor((middle_x - F.col("__ox")) / F.col("__step")).cast("int"),
            "__by": F.floor((middle_y - F.col("__oy")) / F.col("__step")).cast("int"),
        }
    ).drop("__ox", "__oy", "__step")
    boxes = (
        boxed.groupBy(territory, "__bx", "__by")
        .agg(
            F.min(F.least("x1", "x2")).alias("lo_x"),
            F.max(F.greatest("x1", "x2")).alias("hi_x"),
            F.min(F.least("y1", "y2")).alias("lo_y"),
            F.max(F.greatest("y1", "y2")).alias("hi_y"),
        )
        .groupBy(territory)
        .agg(F.collect_list(F.struct("__bx", "__by", "lo_x", "hi_x", "lo_y", "hi_y")).alias("__boxes"))
    )

    def gap(v: str, lo: Column, hi: Column) -> Column:
        return F.greatest(lo - F.col(v), F.col(v) - hi, F.lit(0.0))

    def span(v: str, lo: Column, hi: Column) -> Column:
        return F.greatest(F.abs(lo - F.col(v)), F.abs(hi - F.col(v)))

    measured = salted_join(points, boxes, [territory], [point_id]).withColumn(
        "__m",
        F.transform(
            "__boxes",
            lambda b: F.struct(
                b["__bx"].alias("__bx"),
                b["__by"].alias("__by"),
                F.hypot(gap(x, b["lo_x"], b["hi_x"]), gap(y, b["lo_y"], b["hi_y"])).alias("least"),
                F.hypot(span(x, b["lo_x"], b["hi_x"]), span(y, b["lo_y"], b["hi_y"])).alias("most"),
            ),
        ),
    )
    bound = F.array_min(F.transform("__m", lambda m: m["most"]))
    chosen = measured.withColumn("__bound", bound).select(
        point_id,
        territory,
        x,
        y,
        F.explode(F.expr("filter(__m, m -> m.least <= __bound)")).alias("__c"),
    )
    located = chosen.select(point_id, territory, x, y, F.col("__c.__bx").alias("__bx"), F.col("__c.__by").alias("__by"))
    key = [territory, "__bx", "__by"]
    counted = boxed.groupBy(*key).agg(F.ceil(F.count("*") / HEAP).alias("__heaps"))
    heap = F.pmod(F.xxhash64("section_id", *SEGMENT), F.col("__heaps")).alias("__heap")
    heaps = boxed.join(counted, key).groupBy(*key, heap).agg(_segment_list())
    met = salted_join(located, heaps, key, [point_id]).select(point_id, _best(x, y).alias("__best"))
    return met.groupBy(point_id).agg(F.min("__best").alias("__best"))


def polygon_measures(polygons: DataFrame, wkt: str = "geometry", projected: bool = False) -> DataFrame:
    """Type, area and centroid of every polygon; empty geometries are dropped."""
    rings = G.map_points(G.parse_wkt(wkt), project) if projected else G.parse_wkt(wkt)
    return (
        polygons.withColumn("__rings", rings)
        .filter(F.size("__rings") > 0)
        .withColumns(
            {
                "geometry_type": G.geometry_type(wkt),
                "polygon_area_km2": G.polygon_area(F.col("__rings")) / 1e6,
                "centroid": G.polygon_centroid(F.col("__rings")),
            }
        )
        .drop("__rings")
    )


def geojson_feature(wkt: str, properties: Sequence[str], metric: str) -> Column:
    """One GeoJSON feature per polygon row as text."""
    rings = G.parse_wkt(wkt)
    # Group rings by part: a ring that opens a part starts a new list.
    parts = F.aggregate(
        rings,
        F.expr("cast(array() as array<array<array<array<double>>>>)"),
        lambda acc, r: F.when(r["outer"], F.concat(acc, F.array(F.array(_pairs(r))))).otherwise(
            F.concat(
                F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(F.concat(F.get(acc, F.size(acc) - 1), F.array(_pairs(r)))),
            )
        ),
    )
    props = F.struct(*[F.col(p) for p in properties], F.coalesce(F.col(metric).cast("double"), F.lit(0.0)).alias(metric))
    return F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            F.struct(F.lit("MultiPolygon").alias("type"), parts.alias("coordinates")).alias("geometry"),
            props.alias("properties"),
        )
    )


def _pairs(ring: Column) -> Column:
    return F.transform(ring["pts"], lambda p: F.array(p["x"], p["y"]))


def map_frame(polygons: DataFrame, wkt: str = "geometry") -> DataFrame:
    """Bounds and centre over all polygons, one row."""
    boxes = polygons.select(G.bounds(G.parse_wkt(wkt)).alias("b"))
    return boxes.agg(
        F.min("b.min_y").alias("min_lat"),
        F.min("b.min_x").alias("min_lon"),
        F.max("b.max_y").alias("max_lat"),
        F.max("b.max_x").alias("max_lon"),
    ).withColumns(
        {
            "center_lat": (F.col("min_lat") + F.col("max_lat")) / 2,
            "center_lon": (F.col("min_lon") + F.col("max_lon")) / 2,
        }
    )
