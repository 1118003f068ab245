"""Queries for holidays, day weights, streaks, weekly features and origins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from incidentpanel.catalog.registry import query
from incidentpanel.catalog.roles import DAY_CTE, INC, daily_panel, day_span, incidents, state_extras, table, week_span
from incidentpanel.operators import calendar_tables as K

FIXED = ", ".join(f"({m}, {d}, {y})" for _, m, d, y in K.FIXED_HOLIDAYS)

HOLIDAYS = f"""
{INC},
hb AS (SELECT min(year) AS lo, max(year) AS hi, min(d) AS dlo, max(d) AS dhi, min(w) AS wlo, max(w) AS whi FROM inc),
yr AS (SELECT CAST(unnest(range(lo - 2, hi + 3)) AS INTEGER) AS y FROM hb),
e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM yr),
e2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM e1),
e3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM e2),
e4 AS (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS s FROM e3),
st AS (SELECT 'R' || r_regionkey AS uf, r_regionkey FROM region),
hol AS (
  SELECT uf, make_date(y, m, dd) AS date FROM st, yr, (VALUES {FIXED}) f(m, dd, since) WHERE y >= since
  UNION SELECT uf, make_date(y, s // 31, s % 31 + 1) - 2 FROM st, e4
  UNION SELECT uf, make_date(y, r_regionkey + 3, 10) FROM st, yr)"""


def _years(spark, sf):
    lo, hi = day_span(spark, sf)
    return F.year(lo) - 2, F.year(hi) + 2


def states(spark, sf):
    return table(spark, sf, "region").select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("uf"))


@query("holiday_calendar", f"WITH {HOLIDAYS} SELECT uf, CAST(date AS VARCHAR) AS date FROM hol")
def holiday_calendar(spark, sf):
    return K.holiday_table(states(spark, sf), *_years(spark, sf), state_extras(spark, sf))


@query(
    "holiday_status",
    f"""WITH {HOLIDAYS}, g AS (SELECT id, CASE WHEN id % 29 <> 0 THEN d END AS d, CASE WHEN id % 31 <> 0 THEN uf END AS uf FROM inc)
        SELECT g.id, CASE WHEN g.d IS NULL OR g.uf IS NULL THEN 'unknown' WHEN h0.uf IS NOT NULL THEN 'holiday' WHEN h1.uf IS NOT NULL THEN 'holiday_eve'
          WHEN h2.uf IS NOT NULL THEN 'day_after_holiday' ELSE 'regular_day' END AS holiday_status
        FROM g LEFT JOIN hol h0 ON h0.uf = g.uf AND h0.date = g.d LEFT JOIN hol h1 ON h1.uf = g.uf AND h1.date = g.d + 1
          LEFT JOIN hol h2 ON h2.uf = g.uf AND h2.date = g.d - 1""",
)
def holiday_status(spark, sf):
    events = incidents(spark, sf, victims=False).select(
        "id",
        F.when(F.col("id") % 29 != 0, F.col("accident_date")).alias("accident_date"),
        F.when(F.col("id") % 31 != 0, F.col("uf")).alias("uf"),
    )
    holidays = K.holiday_table(states(spark, sf), *_years(spark, sf), state_extras(spark, sf))
    return K.holiday_status(events, holidays, "accident_date").select("id", "holiday_status")


WEIGHTS = f"""{HOLIDAYS},
cal AS (SELECT uf, CAST(unnest(generate_series(dlo - 60, dhi + 60, INTERVAL 1 DAY)) AS DATE) AS date FROM st, hb),
raw AS (SELECT cal.uf, cal.date, isodow(cal.date) >= 6 OR hol.uf IS NOT NULL AS core
        FROM cal LEFT JOIN hol ON hol.uf = cal.uf AND hol.date = cal.date),
wt AS (SELECT uf, date, CASE WHEN core THEN 1.0::DOUBLE
          WHEN lag(core, 1, false) OVER k AND lead(core, 1, false) OVER k THEN 0.5 ELSE 0.0 END AS weight
       FROM raw WINDOW k AS (PARTITION BY uf ORDER BY date))"""


def date_table(spark, sf):
    lo, hi = day_span(spark, sf)
    return K.date_features(states(spark, sf), lo, hi, state_extras(spark, sf))


@query(
    "day_weights",
    f"WITH {WEIGHTS} SELECT uf, CAST(date AS VARCHAR) AS date, weight AS non_working_day_weight FROM wt, hb WHERE date BETWEEN dlo AND dhi",
)
def day_weights(spark, sf):
    return date_table(spark, sf).select("uf", "date", "non_working_day_weight")


@query(
    "days_off_streaks",
    f"""WITH {WEIGHTS},
        nz AS (SELECT uf, date, weight,
                 min(CASE WHEN weight = 0 THEN date END) OVER (PARTITION BY uf ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS stop_ahead,
                 max(CASE WHEN weight = 0 THEN date END) OVER (PARTITION BY uf ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stop_before FROM wt)
        SELECT n.uf, CAST(n.date AS VARCHAR) AS date,
          (SELECT coalesce(sum(x.weight), 0) FROM wt x WHERE x.uf = n.uf AND x.date > n.date AND x.date < n.stop_ahead AND x.date <= n.date + 30) AS days_off_ahead,
          (SELECT coalesce(sum(x.weight), 0) FROM wt x WHERE x.uf = n.uf AND x.date < n.date AND x.date > n.stop_before AND x.date >= n.date - 30) AS days_off_before
        FROM nz n, hb WHERE n.date BETWEEN dlo AND dhi""",
)
def days_off_streaks(spark, sf):
    return date_table(spark, sf).select("uf", "date", "days_off_ahead", "days_off_before")


@query(
    "enriched_day_panel",
    f"""WITH {WEIGHTS}, {DAY_CTE[len(INC) + 1:]}
        SELECT dp.codigo_municipio, CAST(dp.accident_date AS VARCHAR) AS accident_date, dp.accident_count, wt.weight AS non_working_day_weight,
          CASE WHEN year(accident_date) BETWEEN 1995 AND 1998 THEN 'train' WHEN year(accident_date) = 1999 THEN 'validation'
               WHEN year(accident_date) BETWEEN 2000 AND 2001 THEN 'test' ELSE 'out_of_range' END AS split
        FROM dp JOIN wt ON wt.uf = dp.sg_uf AND wt.date = dp.accident_date""",
)
def enriched_day_panel(spark, sf):
    return day_features_panel(spark, sf).select(
        "codigo_municipio", "accident_date", "accident_count", "non_working_day_weight", "split"
    )


def day_features_panel(spark, sf):
    """Day panel with date features of the state and year-based splits."""
    from incidentpanel.catalog.roles import YEAR_SPLITS
    from incidentpanel.functions.labels import split_by_year

    panel = daily_panel(spark, sf, victims=False).withColumnRenamed("sg_uf", "uf")
    features = date_table(spark, sf).withColumnRenamed("date", "accident_date")
    return panel.join(features, ["uf", "accident_date"], "left").withColumn("split", split_by_year("year", YEAR_SPLITS))


@query(
    "weekly_holiday_features",
    f"""WITH {WEIGHTS},
        wk AS (SELECT uf, CAST(date_trunc('week', date) AS DATE) AS w, date, weight FROM wt, hb WHERE date BETWEEN wlo AND whi + 6),
        rn AS (SELECT *, sum(CASE WHEN weight <= 0 THEN 1 ELSE 0 END) OVER (PARTITION BY uf, w ORDER BY date) AS run FROM wk),
        tot AS (SELECT uf, w, run, sum(weight) AS t FROM rn GROUP BY 1, 2, 3),
        ss AS (SELECT uf, w, max(t) AS streak FROM tot GROUP BY 1, 2),
        sh AS (SELECT uf, w, avg(weight) AS share FROM wk GROUP BY 1, 2)
        SELECT uf, CAST(w AS VARCHAR) AS week_start, CAST(w + 6 AS VARCHAR) AS week_end,
          isoyear(w) || '-W' || lpad(CAST(week(w) AS VARCHAR), 2, '0') AS year_week,
          round(lag(share, 1, 0) OVER k, 6) AS prev_week_non_work_day_share, lag(streak, 1, 0) OVER k AS prev_week_longest_non_work_streak,
          round(share, 6) AS curr_week_non_work_day_share, streak AS curr_week_longest_non_work_streak,
          round(lead(share, 1, 0) OVER k, 6) AS next_week_non_work_day_share, lead(streak, 1, 0) OVER k AS next_week_longest_non_work_streak
        FROM ss JOIN sh USING (uf, w) WINDOW k AS (PARTITION BY uf ORDER BY w)""",
)
def weekly_features(spark, sf):
    lo, hi = week_span(spark, sf)
    return K.weekly_holiday_features(states(spark, sf), lo, hi, state_extras(spark, sf))


@query(
    "longest_busy_streak",
    f"""WITH {DAY_CTE}, rn AS (SELECT codigo_municipio, accident_date, accident_count,
          sum(CASE WHEN accident_count <= 0 THEN 1 ELSE 0 END) OVER (PARTITION BY codigo_municipio ORDER BY accident_date) AS run FROM dp),
        t AS (SELECT codigo_municipio, run, sum(accident_count) AS s FROM rn GROUP BY 1, 2)
        SELECT codigo_municipio, CAST(max(s) AS DOUBLE) AS longest_streak FROM t GROUP BY 1""",
)
def longest_busy_streak(spark, sf):
    """The streak aggregate on event counts instead of off-day scores."""
    return K.longest_streak(
        daily_panel(spark, sf, victims=False), ["codigo_municipio"], "accident_date", "accident_count", "longest_streak"
    )


@query(
    "forecast_batches",
    f"""WITH {INC}, b AS (SELECT max(w) AS hi, max(w) - 364 AS lo FROM inc),
        k AS (SELECT CAST(unnest(generate_series(lo, hi - 21, INTERVAL 28 DAY)) AS DATE) AS s FROM b)
        SELECT CAST(s AS VARCHAR) AS forecast_batch_start, CAST(s - 28 AS VARCHAR) AS cutoff_week_start FROM k""",
)
def forecast_batches(spark, sf):
    """Four-week batches over the last 53 weeks of the data."""
    _, hi = week_span(spark, sf)
    return K.forecast_batches(spark, F.date_sub(hi, 364), hi, 4, 4)


@query(
    "future_rows",
    f"""WITH {WEIGHTS}, {DAY_CTE[len(INC) + 1:]},
        m AS (SELECT max(accident_date) AS cut FROM dp),
        f AS (SELECT CAST(cut + CAST(i AS INTEGER) AS DATE) AS d FROM m, range(1, 15) r(i))
        SELECT p.codigo_municipio, p.nome_municipio, CAST(f.d AS VARCHAR) AS accident_date, year(f.d) AS year, month(f.d) AS month,
          day(f.d) AS day, 0 AS accident_count, 'forecast' AS split, wt.weight AS non_working_day_weight
        FROM places p CROSS JOIN f JOIN wt ON wt.uf = p.sg_uf AND wt.date = f.d""",
)
def future(spark, sf):
    panel = day_features_panel(spark, sf)
    _, cut = day_span(spark, sf)
    features = K.date_features(states(spark, sf), F.date_add(cut, 1), F.date_add(cut, 14), state_extras(spark, sf))
    rows = K.future_rows(panel, ["nome_municipio", "uf"], "codigo_municipio", "accident_date", 14, "accident_count", features)
    return rows.filter(F.col("split") == "forecast").select(
        "codigo_municipio",
        "nome_municipio",
        "accident_date",
        "year",
        "month",
        "day",
        "accident_count",
        "split",
        "non_working_day_weight",
    )


@query(
    "state_year_change",
    f"""WITH {INC}, g AS (SELECT uf, year, count(*) AS n FROM inc GROUP BY 1, 2)
        SELECT uf, year, n, round(n / CAST(lag(n) OVER (PARTITION BY uf ORDER BY year) AS DOUBLE) - 1, 6) AS pct_change FROM g""",
)
def state_year_change(spark, sf):
    """Change against the previous row of the state (a handful of rows per state)."""
    grouped = incidents(spark, sf, victims=False).groupBy("uf", "year").agg(F.count("*").alias("n"))
    before = F.lag("n").over(Window.partitionBy("uf").orderBy("year"))
    return grouped.withColumn("pct_change", F.try_divide(F.col("n"), before) - 1)
