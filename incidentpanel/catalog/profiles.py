"""Queries for coverage, category profiles, panel diagnostics and feature profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from incidentpanel.catalog.registry import query
from incidentpanel.catalog.roles import (
    CORRIDOR,
    DAY_CTE,
    INC,
    MODEL_CTE,
    POINTS,
    ROADS,
    WEEK_CTE,
    daily_panel,
    incidents,
    located_customers,
    modelling_panel,
    pinned_panel,
    point_segment_sql,
    road_segments,
    table,
    weekly_panel,
)
from incidentpanel.functions import clean as C
from incidentpanel.functions import labels as L
from incidentpanel.operators import profile as P
from incidentpanel.operators.keys import exact_quantiles, iqr_filter
from incidentpanel.operators.spatial import corridor_flag

EXCLUDED_STATES = ["R3", "R4"]


def classified(spark, sf):
    """Incidents with coordinates, declaration and corridor class of their customer."""
    points = located_customers(spark, sf).withColumn("has_valid_coords", C.coords_valid("lat", "lon"))
    ok = F.coalesce("has_valid_coords", F.lit(False))
    points = points.withColumns({"x": F.when(ok, F.col("lon")), "y": F.when(ok, F.col("lat"))})
    flagged = corridor_flag(points, road_segments(spark, sf), CORRIDOR, name="inside")
    places = flagged.select(
        F.col("id").alias("c_custkey"),
        "has_valid_coords",
        F.col("declared").alias("is_declared"),
        L.incident_class("has_valid_coords", "declared", "inside").alias("accident_class"),
    )
    events = incidents(spark, sf).withColumn("year", F.when(F.col("id") % 500 != 0, F.col("year")))
    return events.join(places, "c_custkey").withColumns(
        {
            "is_canonical": F.col("accident_class") == L.DECLARED_INSIDE,
            "fatal_victims_occ": C.count_or_zero("mortos"),
            "pessoas": F.coalesce("pessoas", F.lit(0.0)),
        }
    )


CLASSED = f"""{INC},{POINTS},{ROADS},
hit AS (SELECT DISTINCT id FROM good, seg WHERE {point_segment_sql('lon', 'lat')} <= {CORRIDOR}),
cls AS (SELECT p.id AS c_custkey, g.id IS NOT NULL AS valid, p.declared, h.id IS NOT NULL AS inside
        FROM pts p LEFT JOIN good g ON g.id = p.id LEFT JOIN hit h ON h.id = p.id),
ev AS (SELECT inc.id, inc.uf, CASE WHEN inc.id % 500 <> 0 THEN inc.year END AS year, valid, declared, inside,
         coalesce(mortos, 0) AS mortos, coalesce(pessoas, 0) AS pessoas
       FROM inc JOIN cls ON cls.c_custkey = inc.c_custkey)"""

COVERAGE_SQL = f"""WITH {CLASSED},
g AS (SELECT uf, year, count(*) AS total_cases, CAST(sum(mortos) AS BIGINT) AS fatal_victims_occ, sum(pessoas) AS total_people_involved,
        count(*) FILTER (WHERE NOT valid) AS missing_coords_cases, count(*) FILTER (WHERE declared) AS declared_cases,
        count(*) FILTER (WHERE valid AND declared AND NOT inside) AS declared_outside_corridor,
        count(*) FILTER (WHERE valid AND declared AND inside) AS canonical_cases
      FROM ev GROUP BY 1, 2)"""


@query(
    "coverage_review",
    COVERAGE_SQL
    + """ SELECT *, round(missing_coords_cases / CAST(total_cases AS DOUBLE), 6) AS missing_coords_share,
        CASE WHEN declared_cases > 0 THEN round(declared_outside_corridor / CAST(declared_cases AS DOUBLE), 6) END AS declared_outside_corridor_share,
        round(total_cases / CAST(nullif(lag(total_cases) OVER k, 0) AS DOUBLE) - 1, 6) AS cases_pct_change_vs_prev_year,
        round(fatal_victims_occ / CAST(nullif(lag(fatal_victims_occ) OVER k, 0) AS DOUBLE) - 1, 6) AS fatal_pct_change_vs_prev_year,
        coalesce(year = 2001, false) AS is_partial_year, 'manual_visual_review_only' AS review_rule,
        uf IN ('R3', 'R4') AS exclude_from_descriptive, uf IN ('R3', 'R4') AS exclude_from_modeling
      FROM g WINDOW k AS (PARTITION BY uf ORDER BY year NULLS FIRST)""",
)
def coverage_review(spark, sf):
    return P.coverage_review(classified(spark, sf), 2001, EXCLUDED_STATES)


@query(
    "manual_exclusions",
    f"""WITH {INC}, g AS (SELECT DISTINCT uf, year, uf IN ('R3', 'R4') AS x FROM inc)
        SELECT uf, year, CASE WHEN x THEN 'Excessive missing spatial coverage in point map (manual visual review).' ELSE '' END AS reason,
          CASE WHEN x THEN 'Coverage point plot indicates clear undercoverage/missingness.' ELSE '' END AS evidence,
          x AS exclude_from_descriptive, x AS exclude_from_modeling FROM g""",
)
def manual_exclusions(spark, sf):
    pairs = incidents(spark, sf, victims=False).select("uf", "year").distinct()
    return P.manual_exclusions(pairs, EXCLUDED_STATES)


CATEGORIES = ["fase_dia", "condicao", "month"]
HINTS = {
    "fase_dia": ["5-LOW", "3-MEDIUM", "1-URGENT", "0-NONE", "unknown"],
    "condicao": ["O", "F", "X"],
    "month": [f"{m:02d}" for m in range(1, 13)],
}


def categorised(spark, sf):
    k = F.col("id")
    return incidents(spark, sf).select(
        "id",
        "uf",
        "year",
        F.when(k % 19 != 0, F.col("fase_dia")).alias("fase_dia"),
        "condicao",
        F.when(k % 23 != 0, F.col("month")).alias("month"),
        "mortos",
        "pessoas",
    )


def category_levels(spark, sf, events=None):
    long = P.unpivot_levels(events if events is not None else categorised(spark, sf), CATEGORIES)
    return P.ordered_levels(long, P.expected_levels(spark, HINTS))


HINT_ROWS = ", ".join(f"('{v}', '{level}', {i})" for v, levels in HINTS.items() for i, level in enumerate(levels))
CATS = f"""{INC},
cat AS (SELECT id, uf, year, CASE WHEN id % 19 <> 0 THEN fase_dia END AS fase_dia, condicao,
          CASE WHEN id % 23 <> 0 THEN lpad(CAST(month AS VARCHAR), 2, '0') END AS month,
          coalesce(mortos, 0) AS mortos, coalesce(pessoas, 0) AS pessoas FROM inc),
lng AS (SELECT id, uf, year, mortos, pessoas, 'fase_dia' AS variable, fase_dia AS level_label FROM cat
        UNION ALL SELECT id, uf, year, mortos, pessoas, 'condicao', condicao FROM cat
        UNION ALL SELECT id, uf, year, mortos, pessoas, 'month', month FROM cat),
hints(variable, level_label, hint_order) AS (VALUES {HINT_ROWS}),
lev AS (SELECT coalesce(o.variable, h.variable) AS variable, coalesce(o.level_label, h.level_label) AS level_label,
          coalesce(hint_order, 1000000) AS hint_order, o.variable IS NOT NULL AS observed
        FROM (SELECT DISTINCT variable, level_label FROM lng WHERE level_label IS NOT NULL) o
        FULL JOIN hints h ON h.variable = o.variable AND h.level_label = o.level_label)"""

SHARES = """accident_count > 0 AS level_observed,
  CASE WHEN people_involved > 0 THEN round(fatal_victims / people_involved, 6) END AS fatal_victim_share,
  CASE WHEN accident_count > 0 THEN round(fatal_accident_count / CAST(accident_count AS DOUBLE), 6) END AS fatal_accident_share"""
SUMS = """coalesce(n, 0) AS accident_count, coalesce(dead, 0) AS fatal_victims, coalesce(people, 0) AS people_involved,
  coalesce(fatal, 0) AS fatal_accident_count"""


@query(
    "category_level_review",
    f"""WITH {CATS} SELECT variable, count(*) FILTER (WHERE observed) AS observed_levels, count(*) AS expected_levels_considered,
        string_agg(level_label, ' | ' ORDER BY hint_order, level_label) AS ordered_levels FROM lev GROUP BY 1""",
)
def category_level_review(spark, sf):
    return P.level_review(category_levels(spark, sf))


@query(
    "category_profile",
    f"""WITH {CATS}, c AS (SELECT variable, level_label, count(*) AS n, sum(mortos) AS dead, sum(pessoas) AS people,
          count(*) FILTER (WHERE mortos > 0) AS fatal FROM lng GROUP BY 1, 2),
        p AS (SELECT variable, level_label, {SUMS} FROM lev LEFT JOIN c USING (variable, level_label))
        SELECT *, {SHARES} FROM p""",
)
def category_profile(spark, sf):
    events = categorised(spark, sf)
    return P.category_profile(events, CATEGORIES, category_levels(spark, sf, events))


@query(
    "category_year_profile",
    f"""WITH {CATS}, c AS (SELECT year, variable, level_label, count(*) AS n, sum(mortos) AS dead, sum(pessoas) AS people,
          count(*) FILTER (WHERE mortos > 0) AS fatal FROM lng GROUP BY 1, 2, 3),
        y AS (SELECT DISTINCT year FROM inc),
        p AS (SELECT year, variable, level_label, {SUMS} FROM (SELECT * FROM lev CROSS JOIN y) LEFT JOIN c USING (year, variable, level_label))
        SELECT *, {SHARES} FROM p""",
)
def category_year_profile(spark, sf):
    events = categorised(spark, sf)
    return P.category_year_profile(events, CATEGORIES, category_levels(spark, sf, events))


MODEL_KEYS = ["uf", "year", "month", "fase_dia", "condicao"]


@query(
    "model_frame",
    f"""WITH {CATS}, p AS (SELECT uf, year, CAST(month AS INTEGER) AS month, fase_dia, condicao, count(*) AS accident_count, sum(mortos) AS fatal_victims,
          sum(pessoas) AS people_involved, count(*) FILTER (WHERE mortos > 0) AS fatal_accident_count FROM cat GROUP BY ALL)
        SELECT *, CASE WHEN people_involved > 0 THEN round(fatal_victims / people_involved, 6) END AS fatal_victim_share,
          round(fatal_accident_count / CAST(accident_count AS DOUBLE), 6) AS fatal_accident_share FROM p""",
)
def model_frame(spark, sf):
    return P.model_frame(categorised(spark, sf), MODEL_KEYS)


FRAME = f"""{CATS},
fr AS (SELECT uf, year, month, fase_dia, condicao, count(*) AS n, sum(pessoas) AS people FROM cat GROUP BY ALL),
fl AS (SELECT n, people, 'fase_dia' AS variable, fase_dia AS level_label FROM fr
       UNION ALL SELECT n, people, 'condicao', condicao FROM fr UNION ALL SELECT n, people, 'month', month FROM fr),
sup AS (SELECT l.variable, l.level_label, count(f.n) AS grouped_cells, coalesce(CAST(sum(f.n) AS BIGINT), 0) AS total_accidents,
          coalesce(sum(f.people), 0) AS total_people_involved, count(f.n) > 0 AS is_observed
        FROM lev l LEFT JOIN fl f ON f.variable = l.variable AND f.level_label = l.level_label GROUP BY 1, 2),
ref AS (SELECT variable, level_label AS reference_level_label FROM (
          SELECT variable, level_label, row_number() OVER (PARTITION BY variable ORDER BY count(*) DESC, level_label) AS r
          FROM fl WHERE level_label IS NOT NULL GROUP BY 1, 2) WHERE r = 1)"""


@query("level_support", f"WITH {FRAME} SELECT * FROM sup")
def level_support(spark, sf):
    events = categorised(spark, sf)
    return P.level_support(P.model_frame(events, MODEL_KEYS), CATEGORIES, category_levels(spark, sf, events))


@query("reference_levels", f"WITH {FRAME} SELECT * FROM ref")
def reference_levels(spark, sf):
    return P.reference_levels(P.model_frame(categorised(spark, sf), MODEL_KEYS), CATEGORIES)


def audit(spark, sf):
    events = categorised(spark, sf)
    frame = P.model_frame(events, MODEL_KEYS)
    return P.encoding_audit(frame, CATEGORIES, category_levels(spark, sf, events), P.reference_levels(frame, CATEGORIES))


@query(
    "encoding_audit",
    f"""WITH {FRAME} SELECT sup.*, reference_level_label, CASE WHEN NOT is_observed THEN 'expected_but_unobserved'
          WHEN level_label = reference_level_label THEN 'reference_dropped' ELSE 'encoded_dummy' END AS encoding_status
        FROM sup LEFT JOIN ref USING (variable)""",
)
def encoding_audit(spark, sf):
    return audit(spark, sf)


@query(
    "state_share",
    f"""WITH {INC} SELECT count(*) AS total_events, count(*) FILTER (WHERE uf = 'R2') AS state_events,
        round(count(*) FILTER (WHERE uf = 'R2') * 100.0::DOUBLE / count(*), 6) AS state_pct FROM inc""",
)
def state_share(spark, sf):
    return P.state_share(incidents(spark, sf, victims=False), "R2")


@query(
    "entity_stats",
    f"""WITH {DAY_CTE},
        wb AS (SELECT min(w) AS lo, max(w) AS hi FROM inc),
        wk AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS w FROM wb),
        wc AS (SELECT codigo_municipio, w, count(*) AS n FROM inc GROUP BY 1, 2),
        wd AS (SELECT p.codigo_municipio, wk.w, coalesce(n, 0) AS n FROM places p CROSS JOIN wk
               LEFT JOIN wc ON wc.codigo_municipio = p.codigo_municipio AND wc.w = wk.w),
        ds AS (SELECT codigo_municipio, CAST(sum(accident_count) AS BIGINT) AS total_accidents, min(accident_count) AS daily_min, max(accident_count) AS daily_max,
                 round(avg(accident_count), 6) AS daily_mean, median(accident_count) AS daily_median FROM dp GROUP BY 1),
        ws AS (SELECT codigo_municipio, min(n) AS weekly_min, max(n) AS weekly_max, round(avg(n), 6) AS weekly_mean,
                 median(n) AS weekly_median FROM wd GROUP BY 1)
        SELECT * FROM ds JOIN ws USING (codigo_municipio)""",
)
def entity_stats(spark, sf):
    return P.entity_event_stats(daily_panel(spark, sf, victims=False), weekly_panel(spark, sf), "codigo_municipio")


@query(
    "panel_stats",
    f"""WITH {WEEK_CTE} SELECT codigo_municipio, CAST(sum(accident_count) AS BIGINT) AS total_accidents, round(avg(accident_count), 6) AS mean_weekly_accidents,
        median(accident_count) AS median_weekly_accidents, round(avg(CAST(accident_count = 0 AS INTEGER)), 6) AS zero_share FROM wp GROUP BY 1""",
)
def panel_stats(spark, sf):
    return P.panel_stats(weekly_panel(spark, sf), ["codigo_municipio"])


def _five(alias: str, group: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT 'overall', '{group}', '{name}', round(CAST({expr} AS DOUBLE), 6), NULL, NULL, NULL, NULL FROM {source}"
        for name, expr in [
            ("min", f"min({alias})"),
            ("max", f"max({alias})"),
            ("std", f"stddev_pop({alias})"),
            ("mean", f"avg({alias})"),
            ("median", f"median({alias})"),
        ]
    )


def _dist(column: str) -> str:
    return " UNION ALL ".join(
        f"SELECT split, '{column}_distribution', '{name}', round({expr}, 6), NULL, NULL, NULL, NULL FROM ps GROUP BY split"
        for name, expr in [
            ("mean", f"avg({column})"),
            ("median", f"median({column})"),
            ("p10", f"quantile_cont({column}, 0.1)"),
            ("p90", f"quantile_cont({column}, 0.9)"),
        ]
    )


def _rank(name: str, direction: str) -> str:
    return f"""SELECT split, 'rgi_rank', '{name}_total_accidents', CAST(total_accidents AS DOUBLE), rgi_id, rgi_name, uf, r FROM (
      SELECT *, row_number() OVER (PARTITION BY split ORDER BY total_accidents {direction}, rgi_id) AS r FROM ps) WHERE r <= 10"""


@query(
    "panel_diagnostics",
    f"""WITH {MODEL_CTE},
    pe AS (SELECT rgi_id, sum(accident_count) AS n, avg(accident_count) AS m FROM mp GROUP BY 1),
    ps AS (SELECT split, rgi_id, rgi_name, uf, sum(accident_count) AS total_accidents, avg(accident_count) AS mean_weekly_accidents,
             avg(CAST(accident_count = 0 AS DOUBLE)) AS zero_share FROM mp GROUP BY 1, 2, 3, 4),
    u(split, diagnostic_group, diagnostic_name, value, rgi_id, rgi_name, uf, rank) AS (
      SELECT 'overall', 'panel', 'panel_rows', CAST(count(*) AS DOUBLE), NULL, NULL, NULL, NULL FROM mp
      UNION ALL SELECT 'overall', 'panel', 'retained_rgis', count(DISTINCT rgi_id), NULL, NULL, NULL, NULL FROM mp
      UNION ALL SELECT 'overall', 'panel', 'total_weeks', count(DISTINCT week_start), NULL, NULL, NULL, NULL FROM mp
      UNION ALL {_five('accident_count', 'overall_dense_target', 'mp')}
      UNION ALL {_five('n', 'overall_rgi_total_accidents', 'pe')}
      UNION ALL {_five('m', 'overall_rgi_mean_weekly_accidents', 'pe')}
      UNION ALL SELECT split, 'panel', 'rows', count(*), NULL, NULL, NULL, NULL FROM mp GROUP BY split
      UNION ALL SELECT split, 'panel', 'weeks', count(DISTINCT week_start), NULL, NULL, NULL, NULL FROM mp GROUP BY split
      UNION ALL SELECT split, 'target', 'mean_weekly_accidents', round(avg(accident_count), 6), NULL, NULL, NULL, NULL FROM mp GROUP BY split
      UNION ALL SELECT split, 'target', 'variance_weekly_accidents', round(var_pop(accident_count), 6), NULL, NULL, NULL, NULL FROM mp GROUP BY split
      UNION ALL SELECT split, 'target', 'zero_share', round(avg(CAST(accident_count = 0 AS DOUBLE)), 6), NULL, NULL, NULL, NULL FROM mp GROUP BY split
      UNION ALL {_dist('total_accidents')} UNION ALL {_dist('mean_weekly_accidents')} UNION ALL {_dist('zero_share')}
      UNION ALL {_rank('top', 'DESC')} UNION ALL {_rank('bottom', 'ASC')})
    SELECT * FROM u""",
)
def panel_diagnostics(spark, sf):
    return P.panel_diagnostics(pinned_panel(spark, sf))


@query(
    "top_bottom_entities",
    f"""WITH {MODEL_CTE}, t AS (SELECT split, rgi_id, CAST(sum(accident_count) AS BIGINT) AS total FROM mp GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY total DESC, rgi_id) AS hi,
                row_number() OVER (PARTITION BY split ORDER BY total, rgi_id) AS lo FROM t)
        SELECT split, rgi_id, total, hi AS rank, 'top' AS side FROM r WHERE hi <= 10
        UNION ALL SELECT split, rgi_id, total, lo, 'bottom' FROM r WHERE lo <= 10""",
)
def top_bottom(spark, sf):
    totals = modelling_panel(spark, sf).groupBy("split", "rgi_id").agg(F.sum("accident_count").alias("total"))
    return P.top_and_bottom(totals, ["split"], "total", "rgi_id", 10)


PROBABILITIES = [0.1, 0.25, 0.5, 0.75, 0.99]


@query(
    "exact_quantiles",
    " UNION ALL ".join(
        f"SELECT '{c}' AS variable, CAST({p} AS DOUBLE) AS p, round(quantile_cont({c}, {p}), 6) AS quantile FROM lineitem"
        for c in ("l_extendedprice", "l_quantity")
        for p in PROBABILITIES
    ),
)
def quantiles(spark, sf):
    return exact_quantiles(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"], PROBABILITIES)


@query(
    "iqr_outliers",
    """WITH f AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3,
           quantile_cont(user_id, 0.25) AS u1, quantile_cont(user_id, 0.75) AS u3 FROM events)
       SELECT event_id, round(value, 6) AS value FROM events, f WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
         AND user_id BETWEEN u1 - 1.5 * (u3 - u1) AND u3 + 1.5 * (u3 - u1)""",
)
def iqr_outliers(spark, sf):
    events = table(spark, sf, "events")
    return iqr_filter(events, ["value", "user_id"]).select("event_id", "value")


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "late"]


@query(
    "feature_profile",
    "WITH l AS (SELECT *, CASE WHEN l_linenumber > 5 THEN CAST(l_linenumber AS DOUBLE) END AS late FROM lineitem) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature_name, count({c}) AS non_null_count, count(*) - count({c}) AS null_count, round(avg({c}), 4) AS mean,
            round(stddev_pop({c}), 4) AS std, round(min({c}), 6) AS min, round(max({c}), 6) AS max, count(DISTINCT {c}) AS n_unique FROM l"""
        for c in NUMERIC
    ),
)
def feature_profile(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("late", F.when(F.col("l_linenumber") > 5, F.col("l_linenumber")))
    made = P.feature_profile(lines, NUMERIC)
    return made.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})
