"""Queries behind the dashboard and the forecast lookup."""

from __future__ import annotations

from pyspark.sql import functions as F

from incidentpanel.catalog.registry import query
from incidentpanel.catalog.roles import DAY_CTE, daily_panel, day_span, table
from incidentpanel.operators import dashboard as D
from incidentpanel.skew import latest_by

DAY = "accident_date"
TOWN = "nome_municipio"
PICK = "NATION_7"


def raw_forecast(spark, sf):
    """The last four weeks moved forward, with text dates, as a model would deliver it."""
    panel = daily_panel(spark, sf, victims=False)
    last = last_day(spark, sf)
    return panel.filter(F.col(DAY) > F.date_sub(last, 28)).select(
        "codigo_municipio",
        F.when(F.col("codigo_municipio") != "03", F.col(TOWN)).alias(TOWN),
        F.date_add(DAY, 25).cast("string").alias("data"),
        (F.col("accident_count") * 1.5 + 0.25).cast("string").alias("yhat"),
    )


def last_day(spark, sf):
    return day_span(spark, sf)[1]


def merged(spark, sf, victims=False):
    panel = daily_panel(spark, sf, victims=victims).withColumn("accident_count", F.col("accident_count").cast("double"))
    return D.merge_forecast(panel, D.normalise_forecast(raw_forecast(spark, sf)), DAY)


FORECAST = f"""{DAY_CTE},
mx AS (SELECT max(accident_date) AS last FROM dp),
rf AS (SELECT codigo_municipio, CASE WHEN codigo_municipio <> '03' THEN nome_municipio END AS nome_municipio, accident_date + 25 AS d,
         accident_count * 1.5::DOUBLE + 0.25 AS v FROM dp, mx WHERE accident_date > last - 28),
mg AS (
  SELECT codigo_municipio, nome_municipio, sg_uf, cd_rgint, nm_rgint, accident_date, CAST(accident_count AS DOUBLE) AS accident_count,
    fatal_victims, people_involved, fatal_accident_count, 'histórico' AS fonte FROM dp
  UNION ALL SELECT p.codigo_municipio, p.nome_municipio, p.sg_uf, p.cd_rgint, p.nm_rgint, d, v, NULL, NULL, NULL, 'previsão'
  FROM rf JOIN places p USING (codigo_municipio), mx WHERE d > last)"""


@query(
    "forecast_normalised_day",
    f"WITH {FORECAST} SELECT codigo_municipio, nome_municipio, CAST(d AS VARCHAR) AS accident_date, v AS accident_count, 'previsão' AS fonte FROM rf",
)
def normalised_day(spark, sf):
    return D.normalise_forecast(raw_forecast(spark, sf))


@query(
    "forecast_weekly_rollup",
    f"""WITH {FORECAST} SELECT codigo_municipio, nome_municipio, CAST(CAST(date_trunc('week', d) AS DATE) AS VARCHAR) AS week_start,
        CAST(CAST(date_trunc('week', d) AS DATE) + 6 AS VARCHAR) AS week_end, 'previsão' AS fonte, sum(v) AS accident_count FROM rf GROUP BY 1, 2, 3, 4""",
)
def weekly_rollup(spark, sf):
    return D.normalise_forecast(raw_forecast(spark, sf), weekly=True)


@query(
    "forecast_merge",
    f"""WITH {FORECAST} SELECT codigo_municipio, nome_municipio, sg_uf, cd_rgint, nm_rgint, CAST(accident_date AS VARCHAR) AS accident_date, accident_count, fonte FROM mg""",
)
def forecast_merge(spark, sf):
    return merged(spark, sf).select(
        "codigo_municipio", TOWN, "sg_uf", "cd_rgint", "nm_rgint", DAY, "accident_count", "fonte"
    )


SOURCES = f"""{FORECAST},
mix AS (SELECT accident_date, CASE WHEN day(accident_date) % 10 = 0 AND codigo_municipio > '20' THEN 'previsão' WHEN day(accident_date) = 13 THEN NULL ELSE fonte END AS fonte FROM mg),
src AS (SELECT accident_date, CASE WHEN count(fonte) = 0 THEN '-' WHEN count(*) FILTER (WHERE fonte = 'histórico') = count(fonte) THEN 'Histórico'
          WHEN count(*) FILTER (WHERE fonte = 'previsão') = count(fonte) THEN 'Previsão' ELSE 'Misto' END AS source_label FROM mix GROUP BY 1)"""


def mixed(spark, sf):
    day = F.dayofmonth(DAY)
    source = (
        F.when((day % 10 == 0) & (F.col("codigo_municipio") > "20"), D.FORECAST)
        .when(day == 13, F.lit(None))
        .otherwise(F.col("fonte"))
    )
    return merged(spark, sf).withColumn("fonte", source)


@query("period_source", f"WITH {SOURCES} SELECT CAST(accident_date AS VARCHAR) AS accident_date, source_label FROM src")
def period_source(spark, sf):
    return D.period_sources(mixed(spark, sf), DAY)


@query(
    "periods_by_source",
    f"WITH {SOURCES} SELECT CAST(accident_date AS VARCHAR) AS accident_date, source_label FROM src WHERE source_label = 'Misto'",
)
def periods_by_source(spark, sf):
    return D.filter_periods(D.period_sources(mixed(spark, sf), DAY), "Misto")


@query("period_list", f"WITH {FORECAST} SELECT DISTINCT CAST(accident_date AS VARCHAR) AS accident_date FROM mg")
def period_list(spark, sf):
    return D.periods(merged(spark, sf), DAY)


@query("entity_list", f"WITH {FORECAST} SELECT DISTINCT coalesce(CASE WHEN nm_rgint <> 'ASIA' THEN nm_rgint END, 'Sem região') AS nm_rgint FROM mg")
def entity_list(spark, sf):
    panel = merged(spark, sf).withColumn("nm_rgint", F.when(F.col("nm_rgint") != "ASIA", F.col("nm_rgint")))
    return D.entities(panel, "nm_rgint")


@query(
    "period_metric_sum",
    f"""WITH {DAY_CTE} SELECT CAST(accident_date AS VARCHAR) AS accident_date, nm_rgint, CAST(sum(people_involved) AS DOUBLE) AS people_involved FROM dp GROUP BY 1, 2""",
)
def period_metric_sum(spark, sf):
    return D.by_period(daily_panel(spark, sf), DAY, "nm_rgint", "people_involved")


@query(
    "period_kpis",
    f"""WITH {FORECAST}, r AS (SELECT * FROM mg, mx WHERE accident_date = last)
        SELECT sum(accident_count) AS metric_total, count(*) FILTER (WHERE accident_count > 0) AS active_entities,
          max_by(nome_municipio, (accident_count, nome_municipio)) AS top_entity, 'histórico' AS sources FROM r""",
)
def period_kpis(spark, sf):
    return D.period_kpis(merged(spark, sf), DAY, last_day(spark, sf), TOWN, "accident_count")


@query(
    "default_entity",
    f"""WITH {DAY_CTE}, mx AS (SELECT max(accident_date) AS last FROM dp)
        SELECT nome_municipio, CAST(people_involved AS DOUBLE) AS people_involved FROM dp, mx WHERE accident_date = last ORDER BY people_involved DESC, nome_municipio LIMIT 1""",
)
def default_entity(spark, sf):
    return D.default_entity(daily_panel(spark, sf), DAY, last_day(spark, sf), TOWN, "people_involved")


@query(
    "ranking",
    f"""WITH {DAY_CTE}, mx AS (SELECT max(accident_date) AS last FROM dp)
        SELECT nome_municipio, CAST(people_involved AS DOUBLE) AS people_involved, CASE WHEN nome_municipio = '{PICK}' THEN 'Selecionado' ELSE 'Demais' END AS destaque
        FROM dp, mx WHERE accident_date = last""",
)
def ranking(spark, sf):
    return D.ranking(daily_panel(spark, sf), DAY, last_day(spark, sf), TOWN, "people_involved", PICK)


@query(
    "period_delta",
    f"""WITH {DAY_CTE}, mx AS (SELECT max(accident_date) AS last FROM dp),
        g AS (SELECT nome_municipio, CAST(sum(people_involved) FILTER (WHERE accident_date = last) AS DOUBLE) AS atual, CAST(sum(people_involved) FILTER (WHERE accident_date = last - 1) AS DOUBLE) AS anterior FROM dp, mx GROUP BY 1),
        d AS (SELECT *, atual - anterior AS variacao, row_number() OVER (ORDER BY nome_municipio = '{PICK}', abs(atual - anterior) DESC, nome_municipio) AS r FROM g)
        SELECT nome_municipio, atual, anterior, variacao, CASE WHEN nome_municipio = '{PICK}' THEN 'Selecionado' WHEN variacao > 0 THEN 'Aumento' WHEN variacao < 0 THEN 'Redução' ELSE 'Estável' END AS status
        FROM d WHERE r <= 18 OR nome_municipio = '{PICK}'""",
)
def period_delta(spark, sf):
    panel = daily_panel(spark, sf)
    # The panel is dense by day, so the period before is the day before.
    now = last_day(spark, sf)
    return D.period_delta(panel, DAY, now, F.date_sub(now, 1), TOWN, "people_involved", PICK)


@query(
    "last_periods",
    f"""WITH {DAY_CTE}, mx AS (SELECT max(accident_date) - 10 AS sel FROM dp)
        SELECT codigo_municipio, CAST(accident_date AS VARCHAR) AS accident_date, accident_count FROM dp, mx WHERE accident_date BETWEEN sel - 89 AND sel""",
)
def last_periods(spark, sf):
    panel = daily_panel(spark, sf, victims=False)
    made = D.last_periods(panel, DAY, F.date_sub(last_day(spark, sf), 10), 90)
    return made.select("codigo_municipio", DAY, "accident_count")


@query(
    "series_by_source",
    f"""WITH {FORECAST} SELECT CAST(accident_date AS VARCHAR) AS accident_date, nm_rgint, fonte, sum(accident_count) AS accident_count FROM mg GROUP BY 1, 2, 3""",
)
def series_by_source(spark, sf):
    return D.series_by_source(merged(spark, sf), DAY, "nm_rgint", "accident_count")


@query(
    "selected_vs_mean",
    f"""WITH {DAY_CTE}, g AS (SELECT accident_date, sum(accident_count) FILTER (WHERE nome_municipio = '{PICK}') AS s, sum(accident_count) / 25.0::DOUBLE AS a FROM dp GROUP BY 1)
        SELECT CAST(accident_date AS VARCHAR) AS accident_date, CAST(s AS DOUBLE) AS selected, round(a, 6) AS average,
          round(avg(s) OVER k, 6) AS selected_rolling, round(avg(a) OVER k, 6) AS average_rolling FROM g
        WINDOW k AS (ORDER BY accident_date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""",
)
def selected_vs_mean(spark, sf):
    return D.selected_vs_mean(daily_panel(spark, sf, victims=False), DAY, TOWN, "accident_count", PICK)


@query(
    "share_over_time",
    f"""WITH {DAY_CTE}, t AS (SELECT nome_municipio, row_number() OVER (ORDER BY sum(accident_count) DESC, nome_municipio) AS r FROM dp GROUP BY 1),
        g AS (SELECT accident_date, CASE WHEN r <= 8 OR nome_municipio = '{PICK}' THEN nome_municipio ELSE 'Demais' END AS grupo, sum(accident_count) AS n
              FROM dp JOIN t USING (nome_municipio) GROUP BY 1, 2),
        s AS (SELECT *, sum(n) OVER (PARTITION BY accident_date) AS total FROM g)
        SELECT CAST(accident_date AS VARCHAR) AS accident_date, grupo, CAST(n AS DOUBLE) AS accident_count, round(n / CASE WHEN total <> 0 THEN CAST(total AS DOUBLE) ELSE 1 END, 6) AS participacao,
          CASE WHEN grupo = '{PICK}' THEN 0 WHEN grupo = 'Demais' THEN 99 ELSE 1 END AS ordem FROM s""",
)
def share_over_time(spark, sf):
    return D.share_over_time(daily_panel(spark, sf, victims=False), DAY, TOWN, "accident_count", PICK)


@query(
    "heatmap",
    f"""WITH {DAY_CTE}, g AS (SELECT accident_date, nm_rgint, CAST(sum(accident_count) AS DOUBLE) AS n FROM dp GROUP BY 1, 2)
        SELECT nm_rgint, CAST(accident_date AS VARCHAR) AS accident_date, n AS accident_count, sum(n) OVER (PARTITION BY nm_rgint) AS total FROM g""",
)
def heatmap(spark, sf):
    return D.heatmap(daily_panel(spark, sf, victims=False), DAY, "nm_rgint", "accident_count")


@query(
    "heatmap_wide",
    f"""WITH {DAY_CTE} SELECT nome_municipio, {", ".join(f'CAST(sum(accident_count) FILTER (WHERE year(accident_date) = {y}) AS DOUBLE) AS "{y}"' for y in range(1995, 2002))},
        CAST(sum(accident_count) AS DOUBLE) AS total FROM dp GROUP BY 1""",
)
def heatmap_wide(spark, sf):
    panel = daily_panel(spark, sf, victims=False)
    # One column per year of the data; a calendar has few.
    years = [r[0] for r in panel.select("year").distinct().orderBy("year").collect()]
    return D.heatmap(panel, "year", TOWN, "accident_count", values=years)


@query(
    "period_table",
    f"""WITH {FORECAST}, r AS (SELECT max(accident_date) AS sel FROM mg)
        SELECT nome_municipio, CAST(accident_date AS VARCHAR) AS accident_date, accident_count, fatal_accident_count, fatal_victims, people_involved, fonte FROM mg, mx WHERE accident_date = last""",
)
def period_table(spark, sf):
    return D.period_table(merged(spark, sf, victims=True), DAY, last_day(spark, sf))


@query(
    "forecast_lookup",
    f"""WITH {FORECAST} SELECT codigo_municipio, CAST(d AS VARCHAR) AS accident_date, v AS accident_count FROM rf, mx
        WHERE codigo_municipio = '07' AND d BETWEEN last + 2 AND last + 20 ORDER BY d LIMIT 10""",
)
def forecast_lookup(spark, sf):
    rows = D.normalise_forecast(raw_forecast(spark, sf)).withColumn("__last", last_day(spark, sf))
    near = rows.filter(F.col(DAY).between(F.date_add("__last", 2), F.date_add("__last", 20))).drop("__last")
    return D.forecast_lookup(near, entity="07", limit=10).select("codigo_municipio", DAY, "accident_count")


@query(
    "forecast_freshness",
    """WITH m AS (SELECT CAST(max(o_orderdate) AS DATE) AS last, CAST(date_trunc('week', max(o_orderdate)) AS DATE) AS monday FROM orders),
       c(kind, shift, horizon) AS (VALUES ('exact', 0, 30), ('day_before', 1, 30), ('short', 0, 14), ('missing', NULL, 30))
       SELECT kind, coalesce(shift = 0 AND horizon = 30, false) AS is_current, coalesce(CAST(last - shift AS DATE) BETWEEN monday AND monday + 6 AND horizon = 30, false) AS is_current_week FROM m, c""",
)
def forecast_freshness(spark, sf):
    """Daily and weekly freshness of four manifests derived from the last order date."""
    orders = table(spark, sf, "orders")
    cases = orders.agg(F.to_date(F.max("o_orderdate")).alias("last")).select(
        "last",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(k).alias("kind"), F.lit(s).cast("int").alias("shift"), F.lit(h).alias("horizon_days"))
                    for k, s, h in [("exact", 0, 30), ("day_before", 1, 30), ("short", 0, 14), ("missing", None, 30)]
                ]
            )
        ),
    )
    manifest = cases.select("kind", F.date_sub("last", F.col("shift")).cast("string").alias("source_panel_max_date"), "horizon_days")
    days = orders.select(F.to_date("o_orderdate").alias(DAY))
    weeks = days.select(F.to_date(F.date_trunc("week", DAY)).alias("week_start")).withColumn("week_end", F.date_add("week_start", 6))
    daily = D.forecast_freshness(days, manifest, 30, DAY).select("kind", "is_current")
    weekly = D.forecast_freshness(weeks, manifest, 30, "week_start", "week_end").select(
        "kind", F.col("is_current").alias("is_current_week")
    )
    return daily.join(weekly, "kind")


@query(
    "latest_upsert",
    """WITH r AS (SELECT user_id % 25 AS code, CAST(ts AS DATE) AS day, event_id, ts, value, row_number() OVER (PARTITION BY user_id % 25, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS r,
         count(*) OVER (PARTITION BY user_id % 25, CAST(ts AS DATE)) AS n FROM events)
       SELECT code, CAST(day AS VARCHAR) AS day, event_id, round(value, 6) AS value FROM r WHERE r = 1""",
)
def latest_upsert(spark, sf):
    """Old rows in another schema, new rows on top, newest per key kept."""
    from incidentpanel.operators.keys import upsert

    feed = table(spark, sf, "events").select(
        (F.col("user_id") % 25).alias("code"), F.to_date("ts").alias("day"), "event_id", F.col("ts").cast("timestamp").alias("fetched"), "value"
    )
    old = feed.filter(F.col("event_id") % 2 == 0).withColumn("value", F.col("value").cast("string"))
    new = feed.filter(F.col("event_id") % 2 == 1)
    return upsert(old, new, ["code", "day"], [F.col("fetched"), F.col("event_id")]).select("code", "day", "event_id", "value")


@query(
    "keep_first_last",
    """SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_type, arg_max(event_type, (ts, event_id)) AS last_type,
         min(event_id) AS smallest FROM events GROUP BY 1""",
)
def keep_first_last(spark, sf):
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    order = [F.col("ts"), F.col("event_id")]
    first = latest_by(events, ["user_id"], order, smallest=True).select("user_id", F.col("event_type").alias("first_type"))
    last = latest_by(events, ["user_id"], order).select("user_id", F.col("event_type").alias("last_type"))
    smallest = events.groupBy("user_id").agg(F.min("event_id").alias("smallest"))
    return first.join(last, "user_id").join(smallest, "user_id")


@query(
    "global_rank",
    "SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS position FROM customer",
)
def global_rank(spark, sf):
    """Row numbers over a whole table without a single-task window."""
    from incidentpanel.skew import global_row_number

    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    ranked = global_row_number(customers, [F.col("c_acctbal").desc(), F.col("c_custkey")], "position")
    return ranked.select("c_custkey", "position")
