"""How the shared test tables stand in for the incident domain.

Orders with their lines are incidents, nations are municipalities, regions are
states, customers carry coordinates, suppliers are road vertices and the event
stream is the weather feed.  Each role has an SQL twin used by the checks.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from incidentpanel.functions.temporal import week_start
from incidentpanel.operators.calendar_tables import weekly_holiday_features
from incidentpanel.operators.panel import count_events, day_panel, dense_weekly_panel, week_panel, with_week_splits
from incidentpanel.session import checkpointed

# Inner split bounds (Mondays); training starts and testing ends with the data.
TRAIN_END, VALIDATION, TEST_START = date(1998, 12, 28), (date(1999, 1, 4), date(1999, 12, 27)), date(2000, 1, 3)
FIRST_WEEK = "(SELECT CAST(date_trunc('week', min(o_orderdate)) AS DATE) FROM orders)"
LAST_WEEK = "(SELECT CAST(date_trunc('week', max(o_orderdate)) AS DATE) FROM orders)"
WEEK_SPLIT_SQL = {
    "train": (FIRST_WEEK, f"DATE '{TRAIN_END}'"),
    "validation": tuple(f"DATE '{d}'" for d in VALIDATION),
    "test": (f"DATE '{TEST_START}'", LAST_WEEK),
}
YEAR_SPLITS = {"train": (1995, 1998), "validation": (1999, 1999), "test": (2000, 2001)}
CORRIDOR = 0.2


_SCHEMAS: dict[str, StructType] = {}


def forget_schemas() -> None:
    """Called when a query starts, so a table rewritten between queries is read as it is now."""
    _SCHEMAS.clear()


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One shared table.  Within a query its footer is read once; later reads reuse the schema."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def day_span(spark: SparkSession, sf: str, name: str = "orders", column: str = "o_orderdate"):
    """First and last day of a table as literals: one small job, then plain plans."""
    row = table(spark, sf, name).agg(F.to_date(F.min(column)).alias("lo"), F.to_date(F.max(column)).alias("hi")).first()
    return F.lit(row["lo"]), F.lit(row["hi"])


def week_span(spark: SparkSession, sf: str, name: str = "orders", column: str = "o_orderdate"):
    lo, hi = day_span(spark, sf, name, column)
    return week_start(lo), week_start(hi)


def week_splits(spark: SparkSession, sf: str) -> dict[str, tuple[date, date]]:
    """Split bounds that cover every week of the orders."""
    first, last = table(spark, sf, "orders").agg(*[week_start(f("o_orderdate")) for f in (F.min, F.max)]).first()
    return {"train": (first, TRAIN_END), "validation": VALIDATION, "test": (TEST_START, last)}


def municipalities(spark: SparkSession, sf: str) -> DataFrame:
    """25 nations as territories, with state and macro-region labels."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("codigo_municipio"),
        F.col("n_name").alias("nome_municipio"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("sg_uf"),
        F.col("n_regionkey").cast("string").alias("cd_rgint"),
        F.col("r_name").alias("nm_rgint"),
        F.col("n_nationkey").alias("n_nationkey"),
    )


def incidents(spark: SparkSession, sf: str, victims: bool = True) -> DataFrame:
    """One row per order.  Lines are summed per order before they meet the orders."""
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    places = municipalities(spark, sf)
    base = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(places, customer.c_nationkey == places.n_nationkey)
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderdate").cast("timestamp").alias("timestamp"),
            F.to_date("o_orderdate").alias("accident_date"),
            week_start("o_orderdate").alias("week_start"),
            F.year("o_orderdate").alias("year"),
            F.month("o_orderdate").alias("month"),
            "codigo_municipio",
            "nome_municipio",
            F.col("sg_uf").alias("uf"),
            F.col("o_orderpriority").alias("fase_dia"),
            F.col("o_orderstatus").alias("condicao"),
            F.col("c_mktsegment").alias("segmento"),
            "c_custkey",
        )
    )
    if not victims:
        return base
    lines = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(
            F.sum("l_quantity").alias("pessoas"),
            F.count_if((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).cast("double").alias("mortos"),
        )
    )
    return base.join(lines, "id", "left")


INC = """
places AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS codigo_municipio, n_name AS nome_municipio,
         'R' || n_regionkey AS sg_uf, CAST(n_regionkey AS VARCHAR) AS cd_rgint, r_name AS nm_rgint, n_nationkey
  FROM nation JOIN region ON n_regionkey = r_regionkey),
vict AS (
  SELECT l_orderkey, sum(l_quantity) AS pessoas,
         CAST(count(*) FILTER (WHERE l_returnflag = 'R' AND l_linestatus = 'F') AS DOUBLE) AS mortos
  FROM lineitem GROUP BY 1),
inc AS (
  SELECT o_orderkey AS id, o_orderdate AS ts, CAST(o_orderdate AS DATE) AS d,
         CAST(date_trunc('week', o_orderdate) AS DATE) AS w, year(o_orderdate) AS year, month(o_orderdate) AS month,
         codigo_municipio, nome_municipio, sg_uf AS uf, o_orderpriority AS fase_dia, o_orderstatus AS condicao,
         c_mktsegment AS segmento, c_custkey, v.pessoas, v.mortos
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN places ON c_nationkey = n_nationkey
  LEFT JOIN vict v ON v.l_orderkey = o_orderkey)"""

DAY_CTE = (
    INC
    + """,
b AS (SELECT min(d) AS lo, max(d) AS hi FROM inc),
dcount AS (
  SELECT codigo_municipio, d, count(*) AS accident_count, sum(coalesce(mortos, 0)) AS fatal_victims,
         sum(coalesce(pessoas, 0)) AS people_involved, count(*) FILTER (WHERE mortos > 0) AS fatal_accident_count
  FROM inc GROUP BY 1, 2),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b),
dp AS (
  SELECT p.codigo_municipio, p.nome_municipio, p.sg_uf, p.cd_rgint, p.nm_rgint, days.d AS accident_date,
         coalesce(c.accident_count, 0) AS accident_count, coalesce(c.fatal_victims, 0) AS fatal_victims,
         coalesce(c.people_involved, 0) AS people_involved, coalesce(c.fatal_accident_count, 0) AS fatal_accident_count
  FROM places p CROSS JOIN days LEFT JOIN dcount c ON c.codigo_municipio = p.codigo_municipio AND c.d = days.d)"""
)

WEEK_CTE = (
    INC
    + """,
wb AS (SELECT min(w) AS lo, max(w) AS hi FROM inc),
wcount AS (
  SELECT codigo_municipio, w, count(*) AS accident_count, sum(coalesce(mortos, 0)) AS fatal_victims,
         sum(coalesce(pessoas, 0)) AS people_involved, count(*) FILTER (WHERE mortos > 0) AS fatal_accident_count
  FROM inc GROUP BY 1, 2),
weeks AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS w FROM wb),
wp AS (
  SELECT p.codigo_municipio, p.nome_municipio, p.sg_uf, p.cd_rgint, p.nm_rgint, weeks.w AS week_start,
         coalesce(c.accident_count, 0) AS accident_count, coalesce(c.fatal_victims, 0) AS fatal_victims,
         coalesce(c.people_involved, 0) AS people_involved, coalesce(c.fatal_accident_count, 0) AS fatal_accident_count
  FROM places p CROSS JOIN weeks LEFT JOIN wcount c ON c.codigo_municipio = p.codigo_municipio AND c.w = weeks.w)"""
)


def place_columns(spark: SparkSession, sf: str) -> DataFrame:
    return municipalities(spark, sf).drop("n_nationkey")


def daily_panel(spark: SparkSession, sf: str, victims: bool = True) -> DataFrame:
    """Municipality x day, zero-filled over the range of all incidents."""
    events = incidents(spark, sf, victims)
    if not victims:
        events = events.withColumns({"mortos": F.lit(0.0), "pessoas": F.lit(0.0)})
    counts = count_events(events, ["codigo_municipio", "accident_date"])
    lo, hi = day_span(spark, sf)
    return day_panel(place_columns(spark, sf), counts, "codigo_municipio", "accident_date", lo, hi)


def weekly_panel(spark: SparkSession, sf: str) -> DataFrame:
    counts = count_events(incidents(spark, sf), ["codigo_municipio", "week_start"])
    lo, hi = week_span(spark, sf)
    return week_panel(place_columns(spark, sf), counts, "codigo_municipio", lo, hi)


def region_static(spark: SparkSession, sf: str) -> DataFrame:
    """Static features of the weekly model: road length stands for supplier count."""
    supplier = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("n"))
    places = municipalities(spark, sf)
    return places.join(supplier, places.n_nationkey == supplier.s_nationkey, "left").select(
        F.col("codigo_municipio").alias("rgi_id"),
        F.col("nome_municipio").alias("rgi_name"),
        F.col("sg_uf").alias("uf"),
        (F.coalesce("n", F.lit(0)) * 1.5).alias("br101_length_km_in_rgi"),
    )


def state_extras(spark: SparkSession, sf: str) -> DataFrame:
    """State holidays as a table: one date per region."""
    region = table(spark, sf, "region")
    return region.select(
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("uf"),
        (F.col("r_regionkey") + 3).cast("int").alias("month"),
        F.lit(10).alias("day"),
    )


def modelling_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Region x week modelling panel with holiday features and split labels."""
    splits = week_splits(spark, sf)
    lo, hi = F.lit(splits["train"][0]), F.lit(splits["test"][1])
    static = region_static(spark, sf)
    targets = (
        incidents(spark, sf, victims=False)
        .groupBy(F.col("codigo_municipio").alias("rgi_id"), "week_start")
        .agg(F.count("*").alias("accident_count"))
    )
    holidays = weekly_holiday_features(static.select("uf"), lo, hi, state_extras(spark, sf))
    return with_week_splits(dense_weekly_panel(static, targets, holidays, lo, hi, grouped=True), splits)


def pinned_panel(spark: SparkSession, sf: str) -> DataFrame:
    """The modelling panel checkpointed once, for jobs that read it several times."""
    return checkpointed(spark, modelling_panel(spark, sf))


SPLIT_CASE = " ".join(
    f"WHEN {{0}} BETWEEN {lo} AND {hi} THEN '{name}'" for name, (lo, hi) in WEEK_SPLIT_SQL.items()
)


def split_sql(column: str) -> str:
    return "CASE " + SPLIT_CASE.format(column) + " ELSE 'outside_scope' END"


# Region x week panel without holiday features.
MODEL_CTE = (
    INC
    + f""",
road AS (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1),
static AS (
  SELECT codigo_municipio AS rgi_id, nome_municipio AS rgi_name, sg_uf AS uf,
         coalesce(n, 0) * CAST(1.5 AS DOUBLE) AS br101_length_km_in_rgi
  FROM places LEFT JOIN road ON n_nationkey = s_nationkey),
mw AS (SELECT CAST(unnest(generate_series({FIRST_WEEK}, {LAST_WEEK}, INTERVAL 7 DAY)) AS DATE) AS week_start),
mc AS (SELECT codigo_municipio AS rgi_id, w AS week_start, count(*) AS n FROM inc GROUP BY 1, 2),
mp AS (
  SELECT s.*, mw.week_start, coalesce(mc.n, 0) AS accident_count, {split_sql('mw.week_start')} AS split
  FROM static s CROSS JOIN mw LEFT JOIN mc ON mc.rgi_id = s.rgi_id AND mc.week_start = mw.week_start)"""
)


def located_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with coordinates by integer arithmetic; some invalid, some missing."""
    k = F.col("c_custkey")
    lon = F.lit(-55.0) + (k * 3701 % 9973) / F.lit(1000.0)
    lat = F.lit(-30.0) + (k * 4549 % 9967) / F.lit(1000.0)
    return table(spark, sf, "customer").select(
        k.alias("id"),
        F.when(k % 97 != 1, lon).alias("lon"),
        F.when(k % 50 == 0, 95.0).otherwise(lat).alias("lat"),
        F.col("c_nationkey"),
        (k % 3 != 0).alias("declared"),
    )


POINTS = """
pts AS (
  SELECT c_custkey AS id,
         CASE WHEN c_custkey % 97 <> 1 THEN -55.0::DOUBLE + (c_custkey * 3701 % 9973) / 1000.0::DOUBLE END AS lon,
         CASE WHEN c_custkey % 50 = 0 THEN 95.0::DOUBLE
              ELSE -30.0::DOUBLE + (c_custkey * 4549 % 9967) / 1000.0::DOUBLE END AS lat,
         c_nationkey, c_custkey % 3 <> 0 AS declared
  FROM customer),
good AS (SELECT * FROM pts WHERE lon BETWEEN -75 AND -28 AND lat BETWEEN -35 AND 6)"""


def usable_points(spark: SparkSession, sf: str) -> DataFrame:
    from incidentpanel.functions.clean import coords_valid

    return located_customers(spark, sf).filter(coords_valid("lat", "lon")).withColumnsRenamed({"lon": "x", "lat": "y"})


def nation_polygons(spark: SparkSession, sf: str) -> DataFrame:
    """Overlapping squares on a 5 x 5 grid as WKT; every third one has a hole."""
    k = F.col("n_nationkey")
    x0, y0 = F.lit(-55.0) + k % 5 * 2, F.lit(-30.0) + F.floor(k / 5) * 2

    def box(lo: float, hi: float):
        corners = [(lo, lo), (hi, lo), (hi, hi), (lo, hi), (lo, lo)]
        points = [F.concat_ws(" ", (x0 + a).cast("string"), (y0 + b).cast("string")) for a, b in corners]
        return F.concat(F.lit("("), F.concat_ws(", ", *points), F.lit(")"))

    hole = F.when(k % 3 == 0, F.concat(F.lit(", "), box(0.75, 1.25))).otherwise("")
    return municipalities(spark, sf).select(
        "codigo_municipio",
        "nome_municipio",
        "sg_uf",
        "cd_rgint",
        "nm_rgint",
        F.concat(F.lit("POLYGON ("), box(0.0, 2.25), hole, F.lit(")")).alias("geometry"),
    )


POLYGONS = """
sq AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, 'R' || n_regionkey AS state, n_nationkey % 3 = 0 AS holed,
         -55.0::DOUBLE + n_nationkey % 5 * 2 AS x0, -30.0::DOUBLE + (n_nationkey // 5) * 2 AS y0
  FROM nation)"""

IN_SQUARE = """(px > x0 AND px < x0 + 2.25 AND py > y0 AND py < y0 + 2.25
  AND NOT (holed AND px BETWEEN x0 + 0.75 AND x0 + 1.25 AND py BETWEEN y0 + 0.75 AND y0 + 1.25))"""


def supplier_roads(spark: SparkSession, sf: str) -> DataFrame:
    """A line per ten suppliers, as WKT; two roads that follow each other share their line in different snapshots."""
    s = F.col("s_suppkey")
    road, i = F.floor(s / 10), s % 10
    lon = (F.lit(-5500) + i * 10) / F.lit(100.0)
    lat = (F.lit(-2950) + i % 7 * 5 + F.floor(road / 2) % 20 * 45) / F.lit(100.0)
    text = F.concat_ws(" ", lon.cast("string"), lat.cast("string"))
    vertices = F.transform(F.array_sort(F.collect_list(F.struct(s.alias("k"), text.alias("t")))), lambda v: v["t"])
    return (
        table(spark, sf, "supplier")
        .groupBy(road.alias("road_id"))
        .agg(vertices.alias("v"))
        .filter(F.size("v") > 1)
        .select(
            "road_id",
            (F.lit(2017) + F.col("road_id") % 3 * 4).cast("int").alias("snapshot_year"),
            F.concat(F.lit("LINESTRING ("), F.array_join("v", ", "), F.lit(")")).alias("geometry"),
        )
    )


ROADS = """
vtx AS (
  SELECT s_suppkey AS k, s_suppkey // 10 AS road_id, 2017 + (s_suppkey // 10) % 3 * 4 AS snapshot_year,
         (-5500 + (s_suppkey % 10) * 10) / 100.0::DOUBLE AS x,
         (-2950 + (s_suppkey % 10) % 7 * 5 + (s_suppkey // 20) % 20 * 45) / 100.0::DOUBLE AS y
  FROM supplier),
seg AS (
  SELECT a.k AS seg_id, a.road_id, a.snapshot_year, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
  FROM vtx a JOIN vtx b ON b.k = a.k + 1 AND b.road_id = a.road_id)"""


def point_segment_sql(px: str, py: str, s: str = "") -> str:
    """Distance from a point to segment columns x1..y2 (optionally prefixed)."""
    x1, y1, x2, y2 = (f"{s}{c}" for c in ("x1", "y1", "x2", "y2"))
    t = (
        f"least(greatest((({px} - {x1}) * ({x2} - {x1}) + ({py} - {y1}) * ({y2} - {y1}))"
        f" / (({x2} - {x1}) * ({x2} - {x1}) + ({y2} - {y1}) * ({y2} - {y1})), 0.0), 1.0)"
    )
    dx, dy = f"({px} - ({x1} + {t} * ({x2} - {x1})))", f"({py} - ({y1} + {t} * ({y2} - {y1})))"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


def road_segments(spark: SparkSession, sf: str) -> DataFrame:
    from incidentpanel.operators.spatial import segments_from_wkt

    return segments_from_wkt(supplier_roads(spark, sf))
