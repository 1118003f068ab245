"""Geometry against brute force in numpy."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from incidentpanel.functions import crs
from incidentpanel.functions import geometry as G
from incidentpanel.operators import spatial as S

STAR = "POLYGON ((0 0, 4 1, 8 0, 7 4, 8 8, 4 7, 0 8, 1 4, 0 0), (3 3, 5 3, 5 5, 3 5, 3 3))"
PAIR = "MULTIPOLYGON (((10 0, 14 0, 14 4, 10 4, 10 0), (11 1, 12 1, 12 2, 11 2, 11 1)), ((16 0, 18 0, 17 3, 16 0)))"
OVER = "POLYGON ((2 2, 12 2, 12 6, 2 6, 2 2))"


def rings_of(text: str) -> list[np.ndarray]:
    import re

    return [np.array([[float(v) for v in p.split()] for p in body.split(",")]) for body in re.findall(r"\(([^()]+)\)", text)]


def brute_inside(px: float, py: float, text: str, boundary: bool = False) -> bool:
    odd = False
    for ring in rings_of(text):
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (x2 - x1) * (py - y1) == (y2 - y1) * (px - x1) and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
                return boundary
            if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def polygons(spark):
    return spark.createDataFrame([("a", STAR), ("b", PAIR), ("c", OVER)], "code string, geometry string")


@pytest.mark.parametrize("size", [0.7, 3.0, 50.0])
@pytest.mark.parametrize("boundary", [False, True])
def test_points_in_polygons(spark, size, boundary):
    rng = np.random.default_rng(7)
    pts = [(float(x), float(y)) for x, y in rng.uniform(-1, 19, (400, 2))]
    # Grid points hit vertices, edges and hole borders.
    pts += [(float(x), float(y)) for x in range(-1, 19) for y in range(-1, 10)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "id long, x double, y double")
    index = S.polygon_index(S.polygon_edges(polygons(spark)), "code", size)
    got = {(r["id"], r["code"]) for r in S.points_in_polygons(df, index, size, boundary=boundary).collect()}
    want = {
        (i, code)
        for i, (x, y) in enumerate(pts)
        for code, text in (("a", STAR), ("b", PAIR), ("c", OVER))
        if brute_inside(x, y, text, boundary)
    }
    assert got == want


def test_first_match_keeps_unmatched(spark):
    df = spark.createDataFrame([(1, 2.5, 2.5), (2, 100.0, 100.0), (3, 9.0, 3.0)], "id long, x double, y double")
    index = S.polygon_index(S.polygon_edges(polygons(spark)), "code", 1.0)
    got = {r["id"]: r["code"] for r in S.assign_polygon(df, index, 1.0, ["code"]).collect()}
    assert got == {1: "a", 2: None, 3: "c"}


def test_measures(spark):
    made = {r["code"]: r for r in S.polygon_measures(polygons(spark)).collect()}
    assert made["c"]["polygon_area_km2"] * 1e6 == pytest.approx(40.0)
    assert made["b"]["polygon_area_km2"] * 1e6 == pytest.approx(16 - 1 + 3)
    assert (made["c"]["centroid"]["x"], made["c"]["centroid"]["y"]) == pytest.approx((7.0, 4.0))
    assert made["a"]["geometry_type"] == "Polygon" and made["b"]["geometry_type"] == "MultiPolygon"
    # Same area whatever the ring direction.
    turned = "POLYGON ((2 2, 2 6, 12 6, 12 2, 2 2))"
    area = spark.createDataFrame([(turned,)], "g string").select(G.polygon_area(G.parse_wkt("g"))).first()[0]
    assert area == pytest.approx(40.0)


def test_empty_geometries(spark):
    df = spark.createDataFrame([("x", "POLYGON EMPTY"), ("y", None), ("z", OVER)], "code string, geometry string")
    assert [r["code"] for r in S.polygon_measures(df).collect()] == ["z"]
    back = spark.createDataFrame([(PAIR,)], "g string").select(G.to_wkt_polygon(G.parse_wkt("g"))).first()[0]
    assert [r.tolist() for r in rings_of(back)] == [r.tolist() for r in rings_of(PAIR)]
    assert back.startswith("MULTIPOLYGON (((") and back.count("((") == 2


def test_projection(spark):
    rng = np.random.default_rng(1)
    pts = [(float(a), float(b)) for a, b in zip(rng.uniform(-75, -28, 200), rng.uniform(-35, 6, 200))] + [(-50.0, 0.0), (-54.0, -20.0)]
    x, y = crs.project(F.col("lon"), F.col("lat"))
    df = spark.createDataFrame(pts, "lon double, lat double").withColumns({"x": x, "y": y})
    for r in df.withColumn("g", crs.unproject(F.col("x"), F.col("y"))).collect():
        assert abs(r["g"]["lon"] - r["lon"]) < 1e-9 and abs(r["g"]["lat"] - r["lat"]) < 1e-9
    # One hundredth of a degree of longitude at 27.5 S on the ellipsoid.
    pair = spark.createDataFrame([(-54.0, -27.5), (-53.99, -27.5)], "lon double, lat double").withColumns({"x": x, "y": y}).collect()
    assert math.hypot(pair[1]["x"] - pair[0]["x"], pair[1]["y"] - pair[0]["y"]) == pytest.approx(988.12138, abs=1e-4)
    assert pair[0]["x"] == pytest.approx(5_000_000.0)


def distance(px, py, s):
    x1, y1, x2, y2 = s
    d = (x2 - x1) ** 2 + (y2 - y1) ** 2
    t = 0.0 if d == 0 else min(1.0, max(0.0, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / d))
    return math.hypot(px - x1 - t * (x2 - x1), py - y1 - t * (y2 - y1))


@pytest.mark.parametrize("radius", [0.3, 2.0])
def test_corridor(spark, radius):
    rng = np.random.default_rng(3)
    segs = [tuple(map(float, s)) for s in rng.uniform(0, 30, (25, 4))]
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-2, 32, (500, 2)))] + [(1000, segs[0][0], segs[0][1])]
    p = spark.createDataFrame(pts, "id long, x double, y double")
    s = spark.createDataFrame(segs, "x1 double, y1 double, x2 double, y2 double")
    want = {i for i, x, y in pts if min(distance(x, y, q) for q in segs) <= radius}
    assert {r["id"] for r in S.within_corridor(p, s, radius).collect()} == want
    flags = {r["id"]: r["inside_corridor"] for r in S.corridor_flag(p, s, radius).collect()}
    assert flags == {i: i in want for i, _, _ in pts}


def test_corridor_boundary_is_inside(spark):
    p = spark.createDataFrame([(1, 5.0, 500.0), (2, 5.0, 500.0000001), (3, None, 1.0)], "id long, x double, y double")
    s = spark.createDataFrame([(0.0, 0.0, 10.0, 0.0)], "x1 double, y1 double, x2 double, y2 double")
    assert {r["id"]: r["inside_corridor"] for r in S.corridor_flag(p, s, 500.0).collect()} == {1: True, 2: False, 3: False}


def test_corridor_area_of_a_capsule(spark):
    s = spark.createDataFrame([(0.0, 0.0, 10_000.0, 0.0)], "x1 double, y1 double, x2 double, y2 double")
    area = S.corridor_area(s, 500.0, 20.0).first()["corridor_area_km2"]
    assert area == pytest.approx(10.0 + math.pi * 0.25, rel=2e-3)


def test_clip_matches_sampling(spark):
    rng = np.random.default_rng(11)
    segs = [(i, *map(float, s)) for i, s in enumerate(rng.uniform(-1, 19, (20, 4)))]
    # Along a border, through a vertex, wholly inside, wholly outside.
    segs += [(100, 2.0, 2.0, 12.0, 2.0), (101, -1.0, -1.0, 9.0, 9.0), (102, 3.0, 2.5, 4.0, 2.8), (103, 30.0, 30.0, 31.0, 31.0)]
    df = spark.createDataFrame(segs, "sid long, x1 double, y1 double, x2 double, y2 double")
    pieces = S.clip_segments(df, S.polygon_edges(polygons(spark)), "sid", "code", 1.5)
    got = {(r["sid"], r["code"]): r["n"] for r in pieces.groupBy("sid", "code").agg(F.sum("length").alias("n")).collect()}
    steps = (np.arange(4000) + 0.5) / 4000
    for sid, x1, y1, x2, y2 in segs:
        for code, text in (("a", STAR), ("b", PAIR), ("c", OVER)):
            hits = sum(brute_inside(x1 + (x2 - x1) * t, y1 + (y2 - y1) * t, text, True) for t in steps)
            length = math.hypot(x2 - x1, y2 - y1)
            assert got.get((sid, code), 0.0) == pytest.approx(hits / 4000 * length, abs=length * 2e-3)
    assert got[(100, "c")] == pytest.approx(10.0)


def test_merge_collinear(spark):
    rows = [(0.0, 0.0, 4.0, 4.0), (3.0, 3.0, 6.0, 6.0), (6.0, 6.0, 2.0, 2.0), (8.0, 8.0, 9.0, 9.0), (0.0, 1.0, 5.0, 1.0), (5.0, 1.0, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "x1 double, y1 double, x2 double, y2 double")
    made = S.merge_collinear(df, block=2.5)
    total = made.agg(F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))).first()[0]
    assert total == pytest.approx(math.sqrt(2) * 7 + 5)


def test_nearest_section(spark):
    rng = np.random.default_rng(5)
    segs = []
    for i in range(60):
        x, y = rng.uniform(0, 100, 2)
        segs.append((f"T{i % 3}", f"S{i % 12:02d}", float(x), float(y), float(x + rng.uniform(-8, 8)), float(y + rng.uniform(-8, 8))))
    lengths: dict[str, float] = {}
    for _, sec, x1, y1, x2, y2 in segs:
        lengths[sec] = lengths.get(sec, 0.0) + math.hypot(x2 - x1, y2 - y1)
    pts = [(i, f"T{i % 4}" if i % 9 else None, float(a), float(b)) for i, (a, b) in enumerate(rng.uniform(-300, 400, (300, 2)))]
    p = spark.createDataFrame(pts, "id long, territory string, x double, y double")
    s = spark.createDataFrame(
        [(t, sec, lengths[sec], *c) for t, sec, *c in segs],
        "territory string, section_id string, road_length_m double, x1 double, y1 double, x2 double, y2 double",
    )
    got = {r["id"]: r for r in S.nearest_section(p, s, "territory", 5.0).collect()}
    for i, t, x, y in pts:
        own = [(distance(x, y, c), -lengths[sec], sec) for tt, sec, *c in segs if tt == t]
        if t is None:
            assert got[i]["section_match_status"] == "unmatched_exact_polygon"
        elif not own:
            assert got[i]["section_match_status"] == "unmatched_no_section_in_rgi"
        else:
            best = min(own)
            assert got[i]["section_id"] == best[2] and got[i]["distance"] == pytest.approx(best[0])


def test_scope_contains_touching_polygons(spark):
    polys = spark.createDataFrame(
        [
            ("holds", "POLYGON ((0 0, 100 0, 100 100, 0 100, 0 0))"),
            ("near", "POLYGON ((100.4 40, 120 40, 120 60, 100.4 60, 100.4 40))"),
            ("far", "POLYGON ((103 40, 120 40, 120 60, 103 60, 103 40))"),
        ],
        "code string, geometry string",
    )
    road = spark.createDataFrame([(50.0, 50.0, 100.0, 50.0)], "x1 double, y1 double, x2 double, y2 double")
    made = S.polygons_near_corridor(polys, S.polygon_edges(polys), road, "code", 0.5, 7.0)
    assert {r["code"] for r in made.collect()} == {"holds", "near"}


def test_first_match_needs_no_aggregate_over_points(spark):
    points = spark.range(50).select("id", (F.col("id") * 1.0).alias("x"), F.lit(0.5).alias("y"), F.lit("payload").alias("p"))
    index = S.polygon_index(S.polygon_edges(polygons(spark)), "code", 1.0)
    plan = S.assign_polygon(points, index, 1.0, ["code"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    flag = S.corridor_flag(points, spark.createDataFrame([(0.0, 0.0, 9.0, 0.0)], "x1 double, y1 double, x2 double, y2 double"), 1.0)
    assert {r["id"] for r in flag.filter("inside_corridor").collect()} == set(range(10))


def copies_of(segment, n):
    return [(f"S{i:04d}", float(i % 7), *segment) for i in range(n)]


def test_shared_stretches_cost_a_corridor_nothing(spark, monkeypatch):
    met = []
    join = S.salted_join

    def spy(facts, lookup, *rest, **more):
        met.append(lookup.count())
        return join(facts, lookup, *rest, **more)

    monkeypatch.setattr(S, "salted_join", spy)
    points = spark.createDataFrame([(1, 0.5, 0.1), (2, 0.5, 0.9)], "id long, x double, y double")
    for many in (1, 500):
        roads = spark.createDataFrame([(0.0, 0.0, 1.0, 0.0)] * many, "x1 double, y1 double, x2 double, y2 double")
        assert [r["id"] for r in S.within_corridor(points, roads, 0.2).collect()] == [1]
    assert met[0] == met[1]


def test_nearest_section_stages_no_pairs(spark, monkeypatch):
    """Sections that share a segment, and points near and far: nothing staged grows with sections times points."""
    staged = []
    keep = S.checkpointed

    def spy(session, df):
        made = keep(session, df)
        staged.append(made.count())
        return made

    monkeypatch.setattr(S, "checkpointed", spy)
    rows = [("T", *r) for r in copies_of((0.0, 0.0, 1.0, 0.0), 300)]
    segs = spark.createDataFrame(rows, "territory string, section_id string, road_length_m double, x1 double, y1 double, x2 double, y2 double")
    points = spark.range(60).select("id", F.lit("T").alias("territory"), F.lit(0.5).alias("x"), (F.col("id") * 0.1).alias("y"))
    got = S.nearest_section(points, segs, "territory", 1.0)
    # The longest are those with i % 7 = 6, the first of them is S0006.
    assert {(r["section_id"], round(r["distance"] - r["id"] * 0.1, 9)) for r in got.collect()} == {("S0006", 0.0)}
    assert max(staged) <= 60


def test_far_points_meet_heaps_of_a_crowded_box(spark):
    rng = np.random.default_rng(9)
    ends = rng.uniform(0, 1, (1500, 4))
    rows = [("T", f"S{i:04d}", 1.0, *map(float, e)) for i, e in enumerate(ends)] + [("T", "S9999", 1.0, 90.0, 90.0, 91.0, 91.0)]
    segs = spark.createDataFrame(rows, "territory string, section_id string, road_length_m double, x1 double, y1 double, x2 double, y2 double")
    pts = [(i, "T", float(a), float(b)) for i, (a, b) in enumerate(rng.uniform(2, 60, (40, 2)))]
    got = {r["id"]: r for r in S.nearest_section(spark.createDataFrame(pts, "id long, territory string, x double, y double"), segs, "territory", 0.5).collect()}
    for i, _, x, y in pts:
        best = min((distance(x, y, c), sec) for _, sec, _, *c in rows)
        assert got[i]["distance"] == pytest.approx(best[0]) and got[i]["section_id"] == best[1]


def test_distance_has_the_bits_of_its_formula(spark):
    """A tie is broken by the last bit; the SQL twins take the root of the sum of squares."""
    rng = np.random.default_rng(2)
    rows = [tuple(map(float, r)) for r in rng.uniform(-55, -20, (2000, 6))]
    df = spark.createDataFrame(rows, "px double, py double, x1 double, y1 double, x2 double, y2 double")
    names = ("px", "py", "x1", "y1", "x2", "y2")
    for px, py, x1, y1, x2, y2, d in df.select("*", G.point_segment_distance(*map(F.col, names)).alias("d")).collect():
        dx, dy = x2 - x1, y2 - y1
        t = min(max(((px - x1) * dx + (py - y1) * dy) / (dx * dx + dy * dy), 0.0), 1.0)
        fx, fy = px - (x1 + t * dx), py - (y1 + t * dy)
        assert d == math.sqrt(fx * fx + fy * fy)
