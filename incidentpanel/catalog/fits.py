"""Queries that fit models.

The full models have no SQL twin; the closed forms next to them (one feature, one term,
given kernels) do, and the tests check the same code numerically.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from incidentpanel.catalog.calendars import day_features_panel, states
from incidentpanel.catalog.forecasts import BASE, GAP, HISTORY, HORIZON, LAGS, LOOKBACK, eval_splits, samples_by_week
from incidentpanel.catalog.profiles import CATEGORIES, MODEL_KEYS, categorised, category_levels
from incidentpanel.catalog.registry import query
from incidentpanel.catalog.roles import DAY_CTE, INC, daily_panel, day_span, incidents, modelling_panel, pinned_panel, state_extras, table, week_splits
from incidentpanel.functions.temporal import calendar_cycles
from incidentpanel.models import glm, minirocket, pooled, ridge, seasonal
from incidentpanel.operators import evaluate as E
from incidentpanel.operators import profile as P
from incidentpanel.operators.calendar_tables import date_features, future_rows
from incidentpanel.operators.samples import EXOGENOUS, daily_blocks
from incidentpanel.session import checkpointed

FEATURES, SEED, AHEAD = 10_000, 101, 30
TOWN, DAY = "codigo_municipio", "accident_date"


def rocket_samples(spark, sf, panel=None):
    """Fitted kernels and the blocks of all daily samples; windows and features are made where they are used."""
    panel = checkpointed(spark, day_features_panel(spark, sf)) if panel is None else panel
    samples = checkpointed(spark, daily_blocks(panel, TOWN, DAY, LOOKBACK))
    return minirocket.fit_on(samples, FEATURES, seed=SEED), samples


@query("minirocket_features")
def minirocket_features(spark, sf):
    """Feature count, range and mean per split."""
    rocket, samples = rocket_samples(spark, sf)
    total = F.aggregate("features", F.lit(0.0), lambda acc, v: acc + v)
    values = minirocket.featurize(samples, rocket).select(
        "split", F.array_min("features").alias("low"), F.array_max("features").alias("high"), total.alias("total"), F.size("features").alias("n")
    )
    return values.groupBy("split").agg(
        F.min("low").alias("smallest"),
        F.max("high").alias("largest"),
        (F.sum("total") / F.sum("n")).alias("mean"),
        F.max("n").alias("features"),
        F.count("*").alias("samples"),
    )


@query("ridge_per_entity")
def ridge_per_entity(spark, sf):
    """One ridge per territory with its chosen penalty."""
    rocket, samples = rocket_samples(spark, sf)
    models = ridge.train_per_entity(samples, TOWN, rocket=rocket)
    return models.select(TOWN, "alpha", "selection_score", "n_train", F.size("coefficients").alias("n_features"))


@query("model_scores")
def model_scores(spark, sf):
    """Pooled and mean errors per split of the per-territory ridges."""
    rocket, samples = rocket_samples(spark, sf)
    models = checkpointed(spark, ridge.train_per_entity(samples, TOWN, rocket=rocket))
    scored = ridge.score_samples(samples, models, TOWN, rocket).withColumn("actual", F.col("y_raw"))
    return E.evaluate_entities(scored, TOWN)[0]


@query("recursive_forecast")
def recursive_forecast(spark, sf):
    """Thirty days ahead, each day feeding the next."""
    panel = checkpointed(spark, day_features_panel(spark, sf))
    rocket, samples = rocket_samples(spark, sf, panel)
    models = ridge.train_per_entity(samples, TOWN, rocket=rocket)
    _, last = day_span(spark, sf)
    ahead = date_features(states(spark, sf), F.date_add(last, 1), F.date_add(last, AHEAD), state_extras(spark, sf))
    extended = future_rows(panel, ["uf"], TOWN, DAY, AHEAD, "accident_count", ahead)
    cycles = calendar_cycles(DAY)
    extended = extended.withColumns(cycles)
    return ridge.recursive_forecast(extended, models, rocket, TOWN, DAY, [*cycles, *EXOGENOUS], LOOKBACK)


@query("grid_selection")
def grid_selection(spark, sf):
    """Validation search over seasonal ARIMA candidates by exact likelihood; failures stay as rows."""
    series = seasonal.entity_series(modelling_panel(spark, sf))
    made = seasonal.candidate_forecasts(series, seasonal.candidate_grid(), "validation", week_splits(spark, sf)["validation"])
    return seasonal.select_candidates(checkpointed(spark, made)).select(
        "rgi_id", "spec", "status", "n_predictions", "validation_rmse", "is_selected"
    )


# The exact likelihood of an AR(1) is largest at the root of a cubic, which 60 halvings find.
AR_SQL = f"""WITH RECURSIVE {BASE},
o AS (SELECT DISTINCT rgi_id, rgi_name, uf, start, cutoff FROM bz WHERE split = 'validation'),
y AS (SELECT o.rgi_id, cutoff, h.week_start, CAST(h.accident_count AS DOUBLE) AS y,
        lag(CAST(h.accident_count AS DOUBLE)) OVER (PARTITION BY o.rgi_id, cutoff ORDER BY h.week_start) AS before
      FROM o JOIN mp h ON h.rgi_id = o.rgi_id AND h.week_start <= cutoff),
q AS (SELECT rgi_id, cutoff, CAST(count(*) AS DOUBLE) AS n, sum(y * y) AS a, sum(y * before) AS b, arg_max(y, week_start) AS last,
        sum(y * y) - arg_min(y * y, week_start) - arg_max(y * y, week_start) AS c FROM y GROUP BY 1, 2),
ar(rgi_id, cutoff, k, low, high) AS (
  SELECT rgi_id, cutoff, 0, 0.0::DOUBLE, 1.0::DOUBLE FROM q
  UNION ALL
  SELECT rgi_id, cutoff, k + 1, CASE WHEN up THEN low ELSE mid END, CASE WHEN up THEN mid ELSE high END
  FROM (SELECT ar.*, (low + high) / 2 AS mid, n * ((low + high) / 2 * c - b) * (1 - ((low + high) / 2) ** 2) + (low + high) / 2 * (a - (low + high) * b + ((low + high) / 2) ** 2 * c) > 0 AS up
        FROM ar JOIN q USING (rgi_id, cutoff) WHERE k < 60))
SELECT bz.rgi_id, CAST(bz.cutoff AS VARCHAR) AS cutoff_week_start, CAST(bz.week_start AS VARCHAR) AS week_start, step AS horizon_step,
  round(low ** (datediff('day', bz.cutoff, bz.week_start) // 7) * last, 3) AS prediction, CAST(bz.accident_count AS DOUBLE) AS actual
FROM bz JOIN ar USING (rgi_id, cutoff) JOIN q USING (rgi_id, cutoff) WHERE split = 'validation' AND k = 60"""


@query("ar_forecasts", AR_SQL)
def ar_forecasts(spark, sf):
    """The candidate (1, 0, 0) refitted by exact likelihood at every validation origin."""
    series = seasonal.entity_series(modelling_panel(spark, sf))
    made = seasonal.candidate_forecasts(series, [(1, 0, 0, 0, 0, 0)], "validation", week_splits(spark, sf)["validation"], tolerance=1e-7)
    return made.select(
        "rgi_id", "cutoff_week_start", "week_start", "horizon_step", F.round("prediction", 3).alias("prediction"), "actual"
    )


@query("seasonal_forecasts")
def seasonal_forecasts(spark, sf):
    """Refit of the selected candidates on the validation and test origins."""
    panel = pinned_panel(spark, sf)
    series = seasonal.entity_series(panel)
    search = seasonal.candidate_forecasts(series, seasonal.candidate_grid(), "validation", week_splits(spark, sf)["validation"])
    diagnostics = checkpointed(spark, seasonal.select_candidates(checkpointed(spark, search)))
    return seasonal.selected_forecasts(series, diagnostics, eval_splits(spark, sf))


@query("group_models")
def group_models(spark, sf):
    """Linear and boosted models per activity group on the same samples: metrics and run key."""
    rows, features = pooled.step_rows(samples_by_week(spark, sf), HISTORY, len(LAGS), HORIZON)
    rows = checkpointed(spark, rows)
    forecasts = pooled.pooled_forecasts(rows, features)
    sizes = rows.groupBy("group_name").agg(F.count_distinct("rgi_id").alias("n"))
    scored = E.evaluate_by(forecasts, ["group_name", "architecture", "split"])
    key = F.concat("group_name", F.lit(pooled.key_settings(HISTORY, HORIZON, GAP, LAGS)), F.col("n").cast("string"))
    return scored.join(sizes, "group_name").withColumn("comparison_key", key).drop("n")


@query(
    "ridge_closed_form",
    f"""WITH {DAY_CTE}, rm AS (SELECT codigo_municipio, CAST(count(*) AS DOUBLE) AS n, avg(day(accident_date)) AS mx, avg(accident_count) AS my,
          sum(day(accident_date) * accident_count) AS sxy, sum(day(accident_date) * day(accident_date)) AS sxx FROM dp GROUP BY 1),
        rb AS (SELECT *, (sxy - n * mx * my) / (sxx - n * mx * mx + 1000.0) AS beta FROM rm)
        SELECT codigo_municipio, CAST(n AS BIGINT) AS n_train, round(beta, 6) AS coefficient, round(my - mx * beta, 6) AS intercept FROM rb""",
)
def ridge_closed_form(spark, sf):
    """One feature (day of the month) and one penalty, where the ridge has a closed form."""
    one = F.lit(1.0)
    rows = daily_panel(spark, sf, victims=False).select(
        TOWN,
        F.lit("train").alias("split"),
        F.array(F.dayofmonth(DAY).cast("float")).alias("features"),
        F.col("accident_count").cast("double").alias("y_scaled"),
        F.lit(0.0).alias("y_mean"),
        one.alias("y_std"),
    )
    return ridge.train_per_entity(rows, TOWN, [1000.0]).select(
        TOWN, "n_train", F.get("coefficients", F.lit(0)).alias("coefficient"), "intercept"
    )


@query(
    "kernel_shares",
    f"""WITH {INC},
        mo AS (SELECT codigo_municipio, year, month(d) - 1 AS t, count(*) AS x FROM inc GROUP BY 1, 2, 3),
        wn AS (SELECT DISTINCT codigo_municipio, year FROM mo),
        tp AS (SELECT unnest(range(0, 9)) AS j), ts AS (SELECT unnest(range(0, 12)) AS t),
        dl(i, dil) AS (VALUES (0, 1), (1, 2)),
        tr AS (SELECT a.j AS a, b.j AS b, c.j AS c, row_number() OVER (ORDER BY a.j, b.j, c.j) - 1 AS k FROM tp a, tp b, tp c WHERE a.j < b.j AND b.j < c.j),
        tap AS (SELECT w.codigo_municipio, w.year, dl.i, dil, ts.t, tp.j, coalesce(mo.x, 0) AS x FROM wn w, dl, ts, tp
                LEFT JOIN mo ON mo.codigo_municipio = w.codigo_municipio AND mo.year = w.year AND mo.t = ts.t + (tp.j - 4) * dil),
        rs AS (SELECT codigo_municipio, year, i, dil, t, k, sum(CASE WHEN j IN (a, b, c) THEN 2 ELSE -1 END * x) AS r FROM tap, tr GROUP BY 1, 2, 3, 4, 5, 6)
        SELECT codigo_municipio, year, i * 84 + k AS feature, round(avg(CAST(r > 0.5 AS DOUBLE)), 5) AS share FROM rs
        WHERE (i + k) % 2 = 0 OR 12 <= 8 * dil OR t BETWEEN 4 * dil AND 11 - 4 * dil GROUP BY 1, 2, 3""",
)
def kernel_shares(spark, sf):
    """All 84 kernels at two dilations with a given bias, on the twelve monthly counts of a territory's year."""
    events = incidents(spark, sf, victims=False)
    monthly = events.groupBy(TOWN, "year", F.month(DAY).alias("m")).agg(F.count("*").alias("n"))
    by_month = monthly.groupBy(TOWN, "year").agg(F.map_from_entries(F.collect_list(F.struct("m", "n"))).alias("n"))
    series = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda m: F.coalesce(F.try_element_at("n", m), F.lit(0)).cast("float"))
    samples = by_month.select(TOWN, "year", F.array(series).alias("sequence"))
    only = [np.array([0])] * len(minirocket.TRIPLES)
    bias = [np.array([0.5], np.float32)] * len(minirocket.TRIPLES)
    rocket = minirocket.Rocket([1, 2], [only, only], [bias, bias])
    made = minirocket.featurize(samples, rocket)
    return made.select(TOWN, "year", F.posexplode("features").alias("feature", "share")).withColumn("share", F.round(F.col("share").cast("double"), 5))


ONE_TERM = f"""WITH {DAY_CTE}, g AS (SELECT lpad(CAST(month(accident_date) AS VARCHAR), 2, '0') AS level_label, avg(accident_count) AS m,
          sum(fatal_accident_count) / CAST(sum(accident_count) AS DOUBLE) AS p FROM dp GROUP BY 1),
        r AS (SELECT m AS m0, p AS p0 FROM g WHERE level_label = '01')"""


def one_term(spark, sf, family):
    """GLM of the daily counts (or of the share of fatal ones) on the month alone, against January."""
    frame = daily_panel(spark, sf).select("month", "accident_count", "fatal_accident_count")
    terms = [("month", f"{m:02d}") for m in range(2, 13)]
    if family == "poisson":
        model = glm.fit_glm(glm.design(frame.select("month", "accident_count"), terms), "poisson", "accident_count")
    else:
        used = frame.filter("accident_count > 0").withColumn("share", F.col("fatal_accident_count") / F.col("accident_count"))
        model = glm.fit_glm(glm.design(used, terms), "binomial", "share", "accident_count")
    made = glm.coefficient_table(model, terms, spark)
    return made.select("level_label", F.round("coefficient", 4).alias("coefficient"))


@query("poisson_one_term", f"{ONE_TERM} SELECT level_label, round(ln(m / m0), 4) AS coefficient FROM g, r WHERE level_label <> '01'")
def poisson_one_term(spark, sf):
    return one_term(spark, sf, "poisson")


@query("binomial_one_term", f"{ONE_TERM} SELECT level_label, round(ln(p / (1 - p)) - ln(p0 / (1 - p0)), 4) AS coefficient FROM g, r WHERE level_label <> '01'")
def binomial_one_term(spark, sf):
    return one_term(spark, sf, "binomial")


@query(
    "joint_ranking",
    """WITH v AS (SELECT DISTINCT o_orderpriority AS variable, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS k FROM orders),
       j AS (SELECT variable, CASE WHEN k <> 1 THEN k % 4 END AS c, CASE WHEN k <> 5 THEN k * 3 % 4 END AS s FROM v),
       t AS (SELECT *, coalesce(c, 0) + coalesce(s, 0) AS score FROM j)
       SELECT variable, score AS overall_candidate_score, CASE WHEN c IS NOT NULL THEN 'count' ELSE 'severity' END AS reference_level,
         CASE WHEN score >= 5 THEN 'high_priority' WHEN score >= 3 THEN 'promising' WHEN score >= 1 THEN 'watchlist' ELSE 'low_priority' END AS overall_candidate_tier FROM t""",
)
def joint_ranking(spark, sf):
    """The joint ranking alone, on given scores; each side lacks one variable."""
    k = F.substring("o_orderpriority", 1, 1).cast("int")
    v = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("variable"), k.alias("k")).distinct()
    count = v.filter("k <> 1").select("variable", (F.col("k") % 4).alias("count_candidate_score"), F.lit("count").alias("count_reference_level"))
    severity = v.filter("k <> 5").select(
        "variable", (F.col("k") * 3 % 4).alias("severity_candidate_score"), F.lit("severity").alias("severity_reference_level")
    )
    return P.overall_ranking(count, severity).select("variable", "overall_candidate_score", "reference_level", "overall_candidate_tier")


def screening(spark, sf, family):
    """Audit, coefficients and tiers of one GLM on the cell frame."""
    events = categorised(spark, sf)
    frame = checkpointed(spark, P.model_frame(events, MODEL_KEYS))
    levels = category_levels(spark, sf, events)
    audit = checkpointed(spark, P.encoding_audit(frame, CATEGORIES, levels, P.reference_levels(frame, CATEGORIES)))
    terms = glm.dummy_terms(audit)
    data = glm.design(frame, terms)
    if family == "poisson":
        model = glm.fit_glm(data, "poisson", "accident_count")
    else:
        share = F.least(F.col("fatal_victim_share"), F.lit(1.0))
        usable = data.filter(F.col("people_involved") > 0).withColumn("fatal_victim_share", share)
        model = glm.fit_glm(usable, "binomial", "fatal_victim_share", "people_involved")
    expanded = glm.expand_coefficients(audit, glm.coefficient_table(model, terms, spark))
    return audit, expanded


@query("poisson_glm")
def poisson_glm(spark, sf):
    _, expanded = screening(spark, sf, "poisson")
    return expanded.select("variable", "level_label", "encoding_status", "coefficient", "pvalue", "abs_pct_change_vs_reference")


@query("binomial_glm")
def binomial_glm(spark, sf):
    _, expanded = screening(spark, sf, "binomial")
    return expanded.select("variable", "level_label", "encoding_status", "coefficient", "pvalue", "abs_pct_change_vs_reference")


@query("feature_tiers")
def feature_tiers(spark, sf):
    """Evidence tiers from both screenings and the joint ranking."""
    audit, count = screening(spark, sf, "poisson")
    _, severity = screening(spark, sf, "binomial")
    return P.overall_ranking(P.feature_tiers(count, audit, "count"), P.feature_tiers(severity, audit, "severity"))


TIER_ROWS = """
lv AS (SELECT o_orderpriority AS variable, o_orderstatus AS level_label, count(*) AS n, avg(o_totalprice) AS p FROM orders GROUP BY 1, 2),
co AS (SELECT *, CASE WHEN level_label = 'F' THEN 'reference_dropped' ELSE 'encoded_dummy' END AS encoding_status,
         CASE level_label WHEN 'O' THEN 0.004 WHEN 'P' THEN 0.03 END AS pvalue,
         CASE WHEN level_label <> 'F' THEN CAST(substr(variable, 1, 1) AS INTEGER) * 0.05::DOUBLE END AS effect FROM lv),
ti AS (SELECT variable, count(*) FILTER (WHERE pvalue < 0.01) AS p01, count(*) FILTER (WHERE pvalue < 0.05) AS p05, max(effect) AS e,
         avg(CAST(n < 250 AS DOUBLE)) AS sparse FROM co GROUP BY 1)"""


@query(
    "feature_tier_rules",
    f"""WITH {TIER_ROWS} SELECT variable, p01 AS count_significant_levels_p01, p05 AS count_significant_levels_p05, round(e, 6) AS count_max_abs_pct_change_vs_reference,
        round(sparse, 6) AS count_sparse_level_share, CASE WHEN p01 > 0 AND e >= 0.15 AND sparse <= 0.4 THEN 'strong' WHEN p05 > 0 AND e >= 0.05 THEN 'moderate'
          WHEN p05 > 0 OR e >= 0.05 THEN 'weak' ELSE 'low' END AS count_candidate_tier FROM ti""",
)
def feature_tier_rules(spark, sf):
    """The tier rules alone, on level counts of the orders with given p-values and effects."""
    lv = table(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("variable"), F.col("o_orderstatus").alias("level_label")
    ).agg(F.count("*").alias("total_accidents"))
    level = F.col("level_label")
    audit = lv.withColumns(
        {
            "reference_level_label": F.lit("F"),
            "is_observed": F.lit(True),
            "total_people_involved": F.lit(0.0),
            "encoding_status": F.when(level == "F", "reference_dropped").otherwise("encoded_dummy"),
        }
    )
    effect = F.substring("variable", 1, 1).cast("int") * 0.05
    coefficients = audit.withColumns(
        {
            "pvalue": F.when(level == "O", 0.004).when(level == "P", 0.03),
            "abs_pct_change_vs_reference": F.when(level != "F", effect),
        }
    )
    return P.feature_tiers(coefficients, audit, "count").select(
        "variable",
        "count_significant_levels_p01",
        "count_significant_levels_p05",
        "count_max_abs_pct_change_vs_reference",
        "count_sparse_level_share",
        "count_candidate_tier",
    )


LINEAR = f"""{INC},
s AS (SELECT codigo_municipio, count(*) AS n, avg(month) AS m FROM inc GROUP BY 1)"""


@query(
    "linear_scoring",
    f"""WITH {LINEAR} SELECT inc.id, round((0.5 * month + 0.25 * year + 1) * 2 + m, 6) AS prediction, round(greatest((0.5 * month + 0.25 * year + 1) * 2 + m, 0), 6) AS predicted_accident_count
        FROM inc JOIN s USING (codigo_municipio)""",
)
def linear_scoring(spark, sf):
    """Model table join, dot product, inverse scaling and clip."""
    from incidentpanel.catalog.roles import incidents

    events = incidents(spark, sf, victims=False)
    means = events.groupBy(TOWN).agg(F.avg("month").alias("y_mean"))
    features = events.join(means, TOWN).select(
        "id",
        TOWN,
        F.array(F.col("month").cast("float"), F.col("year").cast("float")).alias("features"),
        "y_mean",
        F.lit(2.0).alias("y_std"),
    )
    models = means.select(TOWN, F.array(F.lit(0.5), F.lit(0.25)).alias("coefficients"), F.lit(1.0).alias("intercept"))
    return ridge.score(features, models, TOWN).select("id", "prediction", "predicted_accident_count")


