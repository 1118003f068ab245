"""Queries for counts, dense panels and the modelling event set."""

from __future__ import annotations

from pyspark.sql import functions as F

from incidentpanel.catalog.registry import query
from incidentpanel.catalog.roles import (
    DAY_CTE,
    INC,
    MODEL_CTE,
    FIRST_WEEK,
    LAST_WEEK,
    WEEK_CTE,
    daily_panel,
    incidents,
    modelling_panel,
    region_static,
    table,
    week_span,
    weekly_panel,
)
from incidentpanel.functions.temporal import week_start
from incidentpanel.operators.calendar_tables import date_range, time_bounds, weekly_calendar
from incidentpanel.operators.keys import apply_exclusions, require_unique
from incidentpanel.operators.observed import left_join_on_write, modelling_events_on_write
from incidentpanel.operators.panel import (
    count_events,
    modelling_events,
    split_manifest,
    territory_metadata,
    week_panel,
    weekly_targets,
    with_victims,
)
from incidentpanel.session import scratch_path


@query(
    "time_bounds",
    f"""WITH {INC} SELECT CAST(min(d) AS VARCHAR) AS min_date, CAST(max(d) AS VARCHAR) AS max_date,
        CAST(min(w) AS VARCHAR) AS min_week, CAST(max(w) AS VARCHAR) AS max_week FROM inc""",
)
def bounds(spark, sf):
    return time_bounds(table(spark, sf, "orders"), "o_orderdate", both=True)


@query(
    "event_victims",
    f"""WITH {INC} SELECT id, coalesce(mortos, 0) AS mortos, coalesce(pessoas, 0) AS pessoas,
        coalesce(mortos, 0) > 0 AS has_fatality FROM inc""",
)
def event_victims(spark, sf):
    return with_victims(incidents(spark, sf)).select("id", "mortos", "pessoas", "has_fatality")


@query(
    "entity_day_counts",
    f"""WITH {DAY_CTE} SELECT codigo_municipio, CAST(d AS VARCHAR) AS accident_date, accident_count, fatal_victims,
        people_involved, fatal_accident_count FROM dcount""",
)
def entity_day_counts(spark, sf):
    return count_events(incidents(spark, sf), ["codigo_municipio", "accident_date"])


@query(
    "entity_week_counts",
    f"""WITH {WEEK_CTE} SELECT codigo_municipio, CAST(w AS VARCHAR) AS week_start, accident_count, fatal_victims,
        people_involved, fatal_accident_count FROM wcount""",
)
def entity_week_counts(spark, sf):
    return count_events(incidents(spark, sf), ["codigo_municipio", "week_start"])


@query(
    "entity_day_panel",
    f"""WITH {DAY_CTE} SELECT codigo_municipio, nome_municipio, sg_uf, cd_rgint, nm_rgint,
        CAST(accident_date AS VARCHAR) AS accident_date, year(accident_date) AS year, month(accident_date) AS month,
        day(accident_date) AS day, accident_count, fatal_victims, people_involved, fatal_accident_count FROM dp""",
)
def entity_day_panel(spark, sf):
    return daily_panel(spark, sf)


WEEK_SELECT = """CAST(week_start AS VARCHAR) AS week_start, CAST(week_start + 6 AS VARCHAR) AS week_end,
   year(week_start) AS year, month(week_start) AS month, quarter(week_start) AS quarter,
   accident_count, fatal_victims, people_involved, fatal_accident_count,
   CASE WHEN people_involved > 0 THEN round(fatal_victims / people_involved, 6) END AS fatal_victim_share,
   CASE WHEN accident_count > 0 THEN round(fatal_accident_count / CAST(accident_count AS DOUBLE), 6) END AS fatal_accident_share,
   accident_count > 0 AS level_observed"""


@query(
    "entity_week_panel",
    f"WITH {WEEK_CTE} SELECT codigo_municipio, nome_municipio, sg_uf, cd_rgint, nm_rgint, {WEEK_SELECT} FROM wp",
)
def entity_week_panel(spark, sf):
    return weekly_panel(spark, sf)


def supplier_sections(spark, sf):
    s = table(spark, sf, "supplier")
    return s.select(
        F.concat(F.lit("s"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("section_id"),
        "s_suppkey",
        F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("codigo_rgi"),
        F.col("s_acctbal").alias("road_length_m"),
    )


SECTION_CTE = """
sec AS (SELECT 's' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS section_id, s_suppkey,
          lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS codigo_rgi, s_acctbal AS road_length_m FROM supplier),
sw AS (SELECT CAST(date_trunc('week', min(l_shipdate)) AS DATE) AS lo, CAST(date_trunc('week', max(l_shipdate)) AS DATE) AS hi FROM lineitem),
sweeks AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS w FROM sw),
scount AS (
  SELECT l_suppkey, CAST(date_trunc('week', l_shipdate) AS DATE) AS w, count(*) AS n, sum(l_quantity) AS people,
         CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS dead, count(*) FILTER (WHERE l_returnflag = 'R') AS fatal
  FROM lineitem GROUP BY 1, 2),
sp AS (
  SELECT section_id, codigo_rgi, road_length_m, sweeks.w AS week_start, coalesce(n, 0) AS accident_count,
         coalesce(dead, 0) AS fatal_victims, coalesce(people, 0) AS people_involved, coalesce(fatal, 0) AS fatal_accident_count
  FROM sec CROSS JOIN sweeks LEFT JOIN scount c ON c.l_suppkey = s_suppkey AND c.w = sweeks.w)"""


@query(
    "section_week_panel",
    f"WITH {SECTION_CTE} SELECT section_id, codigo_rgi, round(road_length_m, 6) AS road_length_m, {WEEK_SELECT} FROM sp",
)
def section_week_panel(spark, sf):
    """Suppliers are sections; every order line is an event on its section."""
    lines = table(spark, sf, "lineitem").select(
        "l_suppkey",
        week_start("l_shipdate").alias("week_start"),
        F.col("l_quantity").alias("pessoas"),
        (F.col("l_returnflag") == "R").cast("double").alias("mortos"),
    )
    counts = count_events(lines, ["l_suppkey", "week_start"]).withColumnRenamed("l_suppkey", "s_suppkey")
    lo, hi = week_span(spark, sf, "lineitem", "l_shipdate")
    return week_panel(supplier_sections(spark, sf), counts, "s_suppkey", lo, hi).drop("s_suppkey")


@query(
    "territory_metadata",
    f"""WITH {SECTION_CTE} SELECT codigo_rgi, round(sum(road_length_m), 2) AS road_length_m, count(*) AS section_count,
        min(section_id) AS first_section FROM sec GROUP BY 1""",
)
def metadata(spark, sf):
    sections = supplier_sections(spark, sf).withColumn("first_section", F.col("section_id"))
    made = territory_metadata(sections, "codigo_rgi", ["first_section"])
    return made.withColumn("road_length_m", F.round("road_length_m", 2))


@query(
    "weekly_targets",
    f"""WITH {INC} SELECT codigo_municipio AS rgi_id, CAST(w AS VARCHAR) AS week_start, count(*) AS accident_count,
        CAST(w + 6 AS VARCHAR) AS week_end, isoyear(w) || '-W' || lpad(CAST(week(w) AS VARCHAR), 2, '0') AS year_week,
        isoyear(w) AS iso_year, week(w) AS iso_week
        FROM inc GROUP BY 1, w""",
)
def targets(spark, sf):
    calendar = weekly_calendar(spark, *week_span(spark, sf))
    events = incidents(spark, sf, victims=False)
    return weekly_targets(events.withColumnRenamed("codigo_municipio", "rgi_id"), calendar)


@query(
    "weekly_calendar",
    f"""WITH {INC}, b AS (SELECT min(w) AS lo, max(w) AS hi FROM inc),
        k AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS w FROM b)
        SELECT CAST(w AS VARCHAR) AS week_start, CAST(w + 6 AS VARCHAR) AS week_end, isoyear(w) AS iso_year, week(w) AS iso_week,
          isoyear(w) || '-W' || lpad(CAST(week(w) AS VARCHAR), 2, '0') AS year_week,
          row_number() OVER (ORDER BY w) - 1 AS week_index FROM k""",
)
def calendar(spark, sf):
    orders = table(spark, sf, "orders")
    lo, hi = (orders.agg(week_start(f("o_orderdate"))).scalar() for f in (F.min, F.max))
    return weekly_calendar(spark, lo, hi)


@query(
    "day_spine",
    f"""WITH {INC}, b AS (SELECT min(d) AS lo, max(d) AS hi FROM inc)
        SELECT CAST(CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS VARCHAR) AS date FROM b""",
)
def day_spine(spark, sf):
    orders = table(spark, sf, "orders")
    return date_range(spark, *(orders.agg(F.to_date(f("o_orderdate"))).scalar() for f in (F.min, F.max)))


def exclusion_list(spark, sf):
    """(state, year) pairs to leave out, with null keys on purpose."""
    k = F.col("r_regionkey")
    return table(spark, sf, "region").select(
        F.when(k != 4, F.concat(F.lit("R"), k.cast("string"))).alias("uf"),
        F.when(k != 3, F.lit(1995) + k).cast("int").alias("year"),
        (k != 1).alias("exclude_from_modeling"),
    )


EXCLUDED = """
ex AS (SELECT CASE WHEN r_regionkey <> 4 THEN 'R' || r_regionkey END AS uf,
         CASE WHEN r_regionkey <> 3 THEN 1995 + r_regionkey END AS year FROM region WHERE r_regionkey <> 1)"""


def gappy(spark, sf):
    """Incidents with missing states, years, regions and timestamps, and with regions nobody knows."""
    k = F.col("id")
    return incidents(spark, sf, victims=False).select(
        "id",
        F.when(k % 17 != 0, F.col("timestamp")).alias("timestamp"),
        F.when(k % 13 != 0, F.col("year")).alias("year"),
        F.when(k % 11 != 0, F.concat(F.lit(" "), F.lower("uf"))).alias("uf"),
        F.when(k % 19 == 0, "99").when(k % 7 != 0, F.col("codigo_municipio")).alias("codigo_rgi"),
        F.when(k % 5 != 0, F.col("nome_municipio")).alias("nome_rgi"),
    )


GAPPY = """
gap AS (SELECT id, CASE WHEN id % 17 <> 0 THEN ts END AS ts, CASE WHEN id % 17 <> 0 THEN w END AS w,
          CASE WHEN id % 13 <> 0 THEN year END AS year, CASE WHEN id % 11 <> 0 THEN uf END AS uf,
          CASE WHEN id % 19 = 0 THEN '99' WHEN id % 7 <> 0 THEN CAST(CAST(codigo_municipio AS INTEGER) AS VARCHAR) END AS rgi,
          CASE WHEN id % 5 <> 0 THEN nome_municipio END AS nome FROM inc)"""


@query(
    "exclusion_anti_join",
    f"""WITH {INC},{EXCLUDED},{GAPPY} SELECT id, uf, year FROM gap g
        WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.uf IS NOT DISTINCT FROM g.uf AND ex.year IS NOT DISTINCT FROM g.year)""",
)
def exclusion_anti_join(spark, sf):
    """Null keys match null keys; inactive list rows do not count."""
    events = gappy(spark, sf).withColumn("uf", F.upper(F.trim("uf")))
    return apply_exclusions(events, exclusion_list(spark, sf), "exclude_from_modeling").select("id", "uf", "year")


def numeric_static(spark, sf):
    return region_static(spark, sf).withColumn("rgi_id", F.col("rgi_id").cast("int").cast("string"))


KEPT = f"""NOT EXISTS (SELECT 1 FROM ex WHERE ex.uf IS NOT DISTINCT FROM g.uf AND ex.year IS NOT DISTINCT FROM g.year)"""
USED = f"""g.ts IS NOT NULL AND g.year IS NOT NULL AND {KEPT}
           AND g.rgi IS NOT NULL AND g.rgi <> '99'"""


@query(
    "modelling_events",
    f"""WITH {MODEL_CTE},{EXCLUDED},{GAPPY} SELECT g.id, strftime(g.ts, '%Y-%m-%d %H:%M:%S') AS timestamp, g.year, g.uf AS accident_uf,
          s.uf, g.rgi AS rgi_id, s.rgi_name, CAST(g.w AS VARCHAR) AS week_start, round(s.br101_length_km_in_rgi, 6) AS br101_length_km_in_rgi
        FROM gap g JOIN static s ON CAST(s.rgi_id AS INTEGER) = CAST(g.rgi AS INTEGER) WHERE {USED}""",
)
def events_for_model(spark, sf):
    return modelling_events(gappy(spark, sf), exclusion_list(spark, sf), numeric_static(spark, sf), *week_span(spark, sf))


@query(
    "prep_funnel",
    f"""WITH {INC},{EXCLUDED},{GAPPY}
        SELECT 'canonical_accidents_loaded' AS step, count(*) AS rows FROM gap
        UNION ALL SELECT 'rows_with_valid_timestamp', count(ts) FROM gap
        UNION ALL SELECT 'rows_after_manual_exclusions', count(*) FROM gap g WHERE ts IS NOT NULL AND {KEPT}
        UNION ALL SELECT 'rows_after_outer_window_filter', count(*) FROM gap g WHERE {USED}
        UNION ALL SELECT 'retained_rgis', count(DISTINCT rgi) FROM gap g WHERE {USED}""",
)
def funnel(spark, sf):
    """Counted by the job that stores the modelling event set."""
    path = scratch_path(spark, "modelling-events")
    inputs = gappy(spark, sf), exclusion_list(spark, sf), numeric_static(spark, sf)
    return modelling_events_on_write(*inputs, *week_span(spark, sf), path)[1]


@query(
    "dense_weekly_panel",
    f"""WITH {MODEL_CTE} SELECT rgi_id, rgi_name, uf, CAST(week_start AS VARCHAR) AS week_start,
        isoyear(week_start) || '-W' || lpad(CAST(week(week_start) AS VARCHAR), 2, '0') AS year_week,
        datediff('day', {FIRST_WEEK}, week_start) // 7 AS week_index, accident_count, split FROM mp""",
)
def dense_panel(spark, sf):
    return modelling_panel(spark, sf).select(
        "rgi_id", "rgi_name", "uf", "week_start", "year_week", "week_index", "accident_count", "split"
    )


@query(
    "split_manifest",
    f"""WITH {MODEL_CTE} SELECT rgi_id, rgi_name, uf, CAST(week_start AS VARCHAR) AS week_start, CAST(week_start + 6 AS VARCHAR) AS week_end,
        isoyear(week_start) || '-W' || lpad(CAST(week(week_start) AS VARCHAR), 2, '0') AS year_week, split,
        split = 'train' AS is_train, split = 'validation' AS is_validation, split = 'test' AS is_test FROM mp""",
)
def manifest_of_splits(spark, sf):
    return split_manifest(modelling_panel(spark, sf))


@query(
    "validated_enrichment",
    f"""WITH {INC} SELECT o_orderkey AS id, c_mktsegment AS segmento, round(c_acctbal, 6) AS saldo FROM orders
        JOIN customer ON c_custkey = o_custkey""",
)
def validated_enrichment(spark, sf):
    """Many-to-one left join; the job that stores it counts its rows before and after."""
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segmento"), F.col("c_acctbal").alias("saldo")
    )
    joined = left_join_on_write(table(spark, sf, "orders"), customer, ["o_custkey"], scratch_path(spark, "enriched"), "customers")
    return joined.select(F.col("o_orderkey").alias("id"), "segmento", "saldo")


@query(
    "unique_key_check",
    """SELECT count(*) AS rows, count(DISTINCT o_custkey) AS customers FROM orders""",
)
def unique_key_check(spark, sf):
    orders = require_unique(table(spark, sf, "orders"), ["o_orderkey"], "orders")
    return orders.agg(F.count("*").alias("rows"), F.count_distinct("o_custkey").alias("customers"))


@query(
    "in_scope_semi_join",
    f"""WITH {INC} SELECT id, CAST(w AS VARCHAR) AS week_start FROM inc WHERE w BETWEEN {FIRST_WEEK} + 7 AND {LAST_WEEK} - 7""",
)
def in_scope_semi_join(spark, sf):
    lo, hi = week_span(spark, sf)
    weeks = weekly_calendar(spark, F.date_add(lo, 7), F.date_sub(hi, 7)).select("week_start")
    return incidents(spark, sf, victims=False).join(weeks, "week_start", "left_semi").select("id", "week_start")


