"""Queries for activity groups, samples, baselines and forecast evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from incidentpanel.catalog.calendars import WEIGHTS, day_features_panel
from incidentpanel.catalog.registry import query
from incidentpanel.catalog.roles import (
    DAY_CTE,
    INC,
    MODEL_CTE,
    WEEK_SPLIT_SQL,
    modelling_panel,
    pinned_panel,
    table,
    week_splits,
)
from incidentpanel.models.baseline import baseline_forecasts
from incidentpanel.operators import activity as A
from incidentpanel.operators import evaluate as E
from incidentpanel.operators import samples as S
from incidentpanel.operators.profile import feature_profile, feature_registry
from incidentpanel.session import scratch_path
from incidentpanel.sources.writers import save_samples
from incidentpanel.operators.calendar_tables import HOLIDAY_FEATURES

HISTORY, GAP, HORIZON, LAGS = 12, 4, 4, (52, 104, 156)
LOOKBACK = 90
STRIDES = {"train": 1, "validation": 4, "test": 4}


@query(
    "activity_summary",
    f"""WITH {MODEL_CTE} SELECT rgi_id, rgi_name, uf, CAST(sum(accident_count) AS BIGINT) AS train_total_accidents, round(avg(accident_count), 6) AS train_mean_weekly_accidents,
        median(accident_count) AS train_median_weekly_accidents, round(avg(CAST(accident_count > 0 AS INTEGER)), 6) AS train_active_week_share,
        round(avg(CAST(accident_count = 0 AS INTEGER)), 6) AS train_zero_week_share,
        round(coalesce(avg(accident_count) FILTER (WHERE accident_count > 0), 0), 6) AS train_mean_positive_weekly_accidents,
        round(min(br101_length_km_in_rgi), 6) AS br101_length_km_in_rgi FROM mp WHERE split = 'train' GROUP BY 1, 2, 3""",
)
def activity_summary(spark, sf):
    return A.activity_summary(modelling_panel(spark, sf))


RANKED = f"""{MODEL_CTE},
act AS (SELECT rgi_id, rgi_name, uf, avg(accident_count) AS m, avg(CAST(accident_count > 0 AS INTEGER)) AS a,
          avg(CAST(accident_count = 0 AS INTEGER)) AS z, coalesce(avg(accident_count) FILTER (WHERE accident_count > 0), 0) AS p
        FROM mp WHERE split = 'train' GROUP BY 1, 2, 3),
rk AS (SELECT *, row_number() OVER (ORDER BY m, a, p, rgi_id) AS activity_rank, count(*) OVER () AS n FROM act),
gr AS (SELECT *, CASE WHEN activity_rank > n - greatest(1, CAST(floor(n * 0.2) AS INTEGER)) THEN 'high_activity'
          WHEN activity_rank <= greatest(1, CAST(floor(n * 0.2) AS INTEGER)) THEN 'low_activity' ELSE 'mid_activity' END AS group_name FROM rk)"""


def grouped(spark, sf):
    """Panel with activity groups and in-group indexes."""
    panel = pinned_panel(spark, sf)
    groups = A.activity_groups(A.activity_rank(A.activity_summary(panel)), 0.2, 0.2)
    return A.attach_groups(panel, groups), groups


@query(
    "activity_groups",
    f"""WITH {RANKED} SELECT rgi_id, activity_rank, group_name, CASE group_name WHEN 'low_activity' THEN 0 WHEN 'mid_activity' THEN 1 ELSE 2 END AS group_order FROM gr""",
)
def activity_groups(spark, sf):
    _, groups = grouped(spark, sf)
    return groups.select("rgi_id", "activity_rank", "group_name", "group_order")


@query(
    "coverage_by_group",
    f"""WITH {RANKED}, d AS (SELECT group_name, count(*) AS n, avg(m) AS m, avg(z) AS z FROM gr GROUP BY 1),
        t AS (SELECT group_name, count(*) AS n FROM mp JOIN gr USING (rgi_id) WHERE split = 'train' GROUP BY 1)
        SELECT group_name, 'membership' AS diagnostic_group, 'n_rgis' AS diagnostic_name, 'overall' AS split, CAST(n AS DOUBLE) AS value FROM d
        UNION ALL SELECT group_name, 'train_activity', 'mean_weekly_accidents_mean', 'train', round(m, 6) FROM d
        UNION ALL SELECT group_name, 'train_activity', 'zero_week_share_mean', 'train', round(z, 6) FROM d
        UNION ALL SELECT group_name, 'train_panel', 'rows', 'train', n FROM t""",
)
def coverage_by_group(spark, sf):
    return A.group_diagnostics(*grouped(spark, sf))


@query(
    "entity_index",
    f"""WITH {RANKED} SELECT group_name, rgi_id, rgi_name, uf, row_number() OVER (PARTITION BY group_name ORDER BY uf, rgi_id) - 1 AS rgi_index FROM gr""",
)
def entity_index(spark, sf):
    return A.entity_vocabulary(grouped(spark, sf)[0])


def _f32(column: str) -> str:
    """Samples hold 32-bit floats; round the same value."""
    return f"round(CAST(CAST({column} AS REAL) AS DOUBLE), 4)"


DAILY = f"""{WEIGHTS}, {DAY_CTE[len(INC) + 1:]},
tr AS (SELECT codigo_municipio, avg(accident_count) AS m, stddev_pop(accident_count) AS s FROM dp WHERE year(accident_date) <= 1998 GROUP BY 1),
z AS (SELECT dp.codigo_municipio, accident_date, accident_count, m, s, (accident_count - m) / s AS zc, weight,
        CASE WHEN year(accident_date) <= 1998 THEN 'train' WHEN year(accident_date) = 1999 THEN 'validation' ELSE 'test' END AS split
      FROM dp JOIN tr USING (codigo_municipio) JOIN wt ON wt.uf = dp.sg_uf AND wt.date = dp.accident_date)"""


def samples_by_day(spark, sf, lookback=LOOKBACK):
    return S.daily_samples(day_features_panel(spark, sf), "codigo_municipio", "accident_date", lookback)


@query(
    "lookback_samples",
    f"""WITH {DAILY}, w AS (SELECT *, row_number() OVER k AS pos, lag(zc, {LOOKBACK}) OVER k AS oldest, lag(zc, 1) OVER k AS newest,
          avg(CAST(CAST(zc AS REAL) AS DOUBLE)) OVER (k ROWS BETWEEN {LOOKBACK} PRECEDING AND 1 PRECEDING) AS mean_z, lag(weight, 1) OVER k AS last_weight FROM z
        WINDOW k AS (PARTITION BY codigo_municipio ORDER BY accident_date))
        SELECT codigo_municipio, CAST(accident_date AS VARCHAR) AS accident_date, split, 10 AS channels, {LOOKBACK} AS length,
          {_f32('oldest')} AS oldest, {_f32('newest')} AS newest, round(mean_z, 4) AS mean_z, round(last_weight, 4) AS last_weight,
          CAST(accident_count AS DOUBLE) AS y_raw, round(zc, 4) AS y_scaled, round(m, 6) AS y_mean, round(s, 6) AS y_std FROM w WHERE pos > {LOOKBACK}""",
)
def lookback_samples(spark, sf):
    """Daily windows summarised: shape, first, last and mean scaled count, last off-day weight."""
    made = samples_by_day(spark, sf)
    counts = F.get("sequence", F.lit(0))
    total = F.aggregate(counts, F.lit(0.0), lambda a, v: a + v)
    return made.select(
        "codigo_municipio",
        "accident_date",
        "split",
        F.size("sequence").alias("channels"),
        F.size(counts).alias("length"),
        F.round(F.get(counts, F.lit(0)).cast("double"), 4).alias("oldest"),
        F.round(F.get(counts, F.lit(LOOKBACK - 1)).cast("double"), 4).alias("newest"),
        F.round(total / LOOKBACK, 4).alias("mean_z"),
        F.round(F.get(F.get("sequence", F.lit(7)), F.lit(LOOKBACK - 1)).cast("double"), 4).alias("last_weight"),
        "y_raw",
        F.round("y_scaled", 4).alias("y_scaled"),
        "y_mean",
        "y_std",
    )


WEATHER = f"""{DAILY}, wr AS (SELECT lpad(CAST(user_id % 25 AS VARCHAR), 2, '0') AS town, CAST(CAST(ts AS DATE) - INTERVAL 26 YEAR AS DATE) AS d, value, event_id,
          row_number() OVER (PARTITION BY user_id % 25, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS r FROM events),
wx AS (SELECT z.*, value AS warm, CASE WHEN event_id % 3 <> 0 THEN value END AS rain FROM z LEFT JOIN wr ON wr.town = codigo_municipio AND wr.d = accident_date AND r = 1),
wm AS (SELECT codigo_municipio, coalesce(avg(warm) FILTER (WHERE split = 'train'), 0) AS wm,
         CASE WHEN stddev_pop(warm) FILTER (WHERE split = 'train') >= 1e-8 THEN stddev_pop(warm) FILTER (WHERE split = 'train') ELSE 1 END AS ws FROM wx GROUP BY 1),
wz AS (SELECT wx.*, (coalesce(warm, wm) - wm) / ws AS wzc FROM wx JOIN wm USING (codigo_municipio))"""


def weather_panel(spark, sf):
    """Day panel with weather; the readings of 2024 stand for those of 1998, which is in the training years."""
    moved = weather_channels(spark, sf).withColumn("accident_date", F.add_months("accident_date", -12 * 26))
    return day_features_panel(spark, sf).join(moved, ["codigo_municipio", "accident_date"], "left")


@query(
    "enriched_day_panel_weather",
    f"""WITH {WEATHER} SELECT codigo_municipio, CAST(accident_date AS VARCHAR) AS accident_date, accident_count, weight AS non_working_day_weight,
        round(warm, 6) AS target_max_temp_c, round(warm / 2, 6) AS target_min_temp_c, round(rain, 6) AS target_precipitation_mm FROM wx""",
)
def enriched_day_panel_weather(spark, sf):
    return weather_panel(spark, sf).select(
        "codigo_municipio", "accident_date", "accident_count", "non_working_day_weight", "target_max_temp_c", "target_min_temp_c", "target_precipitation_mm"
    )


@query(
    "weather_samples",
    f"""WITH {WEATHER}, w AS (SELECT *, row_number() OVER k AS pos, lag(wzc, {LOOKBACK}) OVER k AS oldest, lag(wzc, 1) OVER k AS newest,
          avg(CAST(CAST(wzc AS REAL) AS DOUBLE)) OVER (k ROWS BETWEEN {LOOKBACK} PRECEDING AND 1 PRECEDING) AS mean_warm FROM wz
        WINDOW k AS (PARTITION BY codigo_municipio ORDER BY accident_date))
        SELECT codigo_municipio, CAST(accident_date AS VARCHAR) AS accident_date, split, 17 AS channels, {LOOKBACK} AS length,
          {_f32('oldest')} AS oldest, {_f32('newest')} AS newest, round(mean_warm, 4) AS mean_warm FROM w WHERE pos > {LOOKBACK}""",
)
def weather_samples(spark, sf):
    """Windows of 17 channels, summarised by the scaled maximum temperature."""
    made = S.daily_samples(weather_panel(spark, sf), "codigo_municipio", "accident_date", LOOKBACK, weather=True)
    warm = F.get("sequence", F.lit(10))
    return made.select(
        "codigo_municipio",
        "accident_date",
        "split",
        F.size("sequence").alias("channels"),
        F.size(warm).alias("length"),
        F.round(F.get(warm, F.lit(0)).cast("double"), 4).alias("oldest"),
        F.round(F.get(warm, F.lit(LOOKBACK - 1)).cast("double"), 4).alias("newest"),
        F.round(F.aggregate(warm, F.lit(0.0), lambda a, v: a + v) / LOOKBACK, 4).alias("mean_warm"),
    )


@query(
    "zscore_train_only",
    f"""WITH {DAILY} SELECT codigo_municipio, CAST(accident_date AS VARCHAR) AS accident_date, round(zc, 6) AS accident_count_z FROM z""",
)
def zscore_train_only(spark, sf):
    scored = S.train_zscores(day_features_panel(spark, sf), "codigo_municipio", ["accident_count"])
    return scored.select("codigo_municipio", "accident_date", "accident_count_z")


@query(
    "weather_features",
    """WITH r AS (SELECT user_id % 25 AS k, CAST(ts AS DATE) AS d, value, ts, event_id, row_number() OVER (PARTITION BY user_id % 25, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS r FROM events)
       SELECT lpad(CAST(k AS VARCHAR), 2, '0') AS codigo_municipio, CAST(d AS VARCHAR) AS accident_date, round(value, 6) AS target_max_temp_c,
         CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS DOUBLE) AS target_sunrise_seconds FROM r WHERE r = 1""",
)
def weather_features(spark, sf):
    """Last reading per territory and day as model channels."""
    return weather_channels(spark, sf).select(
        "codigo_municipio", "accident_date", "target_max_temp_c", "target_sunrise_seconds"
    )


def weather_channels(spark, sf):
    ts = F.col("ts").cast("timestamp")
    feed = table(spark, sf, "events").select(
        F.lpad((F.col("user_id") % 25).cast("string"), 2, "0").alias("codigo_municipio"),
        F.to_date("ts").alias("weather_date"),
        "event_id",
        ts.alias("ts"),
        F.col("value").alias("temperature_2m_max"),
        (F.col("value") / 2).alias("temperature_2m_min"),
        F.lit(30.0).alias("wind_speed_10m_max"),
        ts.alias("sunrise"),
        ts.alias("sunset"),
        F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("precipitation_sum"),
        F.lit(1.0).alias("precipitation_hours"),
    )
    return S.weather_features(feed, "codigo_municipio", [F.col("ts"), F.col("event_id")])


@query(
    "weather_coverage",
    """WITH r AS (SELECT user_id % 25 AS k, CAST(ts AS DATE) AS d, event_id, row_number() OVER (PARTITION BY user_id % 25, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS r FROM events)
       SELECT round(avg(CAST(event_id % 3 <> 0 AS DOUBLE)), 6) AS weather_complete_row_share FROM r WHERE r = 1""",
)
def weather_coverage(spark, sf):
    return S.weather_coverage(weather_channels(spark, sf))


def samples_by_week(spark, sf):
    panel, _ = grouped(spark, sf)
    indexed = panel.join(A.entity_vocabulary(panel).select("rgi_id", "rgi_index"), "rgi_id")
    return S.weekly_samples(indexed, week_splits(spark, sf), HISTORY, GAP, HORIZON, LAGS, STRIDES)


_START = "CASE split " + " ".join(f"WHEN '{n}' THEN {lo}" for n, (lo, _) in WEEK_SPLIT_SQL.items()) + " END"
_END = "CASE split " + " ".join(f"WHEN '{n}' THEN {hi}" for n, (_, hi) in WEEK_SPLIT_SQL.items()) + " END"
_STRIDE = "CASE split " + " ".join(f"WHEN '{n}' THEN {v}" for n, v in STRIDES.items()) + " END"

WEEKLY = f"""{RANKED},
sc AS (SELECT rgi_id, greatest(1, 1 + avg(accident_count) FILTER (WHERE split = 'train')) AS scale FROM mp GROUP BY 1),
sx AS (SELECT mp.*, scale, accident_count / scale AS s, row_number() OVER k AS pos, count(*) OVER (PARTITION BY mp.rgi_id) AS total
       FROM mp JOIN sc USING (rgi_id) WINDOW k AS (PARTITION BY mp.rgi_id ORDER BY week_start)),
sm AS (SELECT *, lag(week_start, 4) OVER k AS cutoff, lag(s, 4) OVER k AS newest, lag(s, 15) OVER k AS oldest,
         avg(CAST(CAST(s AS REAL) AS DOUBLE)) OVER (k ROWS BETWEEN 15 PRECEDING AND 4 PRECEDING) AS history_mean, coalesce(lag(s, 52) OVER k, 0) AS lag52, coalesce(lag(s, 104) OVER k, 0) AS lag104, coalesce(lag(s, 156) OVER k, 0) AS lag156,
         lead(accident_count, 3) OVER k AS last_target, sum(accident_count) OVER (k ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS target_sum
       FROM sx WINDOW k AS (PARTITION BY rgi_id ORDER BY week_start)),
smp AS (SELECT * FROM sm WHERE pos > 15 AND pos + 3 <= total AND split <> 'outside_scope' AND week_start + 21 <= {_END}
          AND datediff('day', {_START}, week_start) // 7 % {_STRIDE} = 0)"""


@query(
    "weekly_samples",
    f"""WITH {WEEKLY} SELECT group_name, rgi_id, split, CAST(week_start AS VARCHAR) AS forecast_batch_start, CAST(cutoff AS VARCHAR) AS cutoff_week_start,
        12 AS history, 4 AS steps, {_f32('oldest')} AS oldest, {_f32('newest')} AS newest, round(history_mean, 5) AS history_mean, {_f32('lag52')} AS lag52, {_f32('lag104')} AS lag104, {_f32('lag156')} AS lag156,
        CAST(last_target AS DOUBLE) AS last_target, CAST(target_sum AS DOUBLE) AS target_sum, round(scale, 4) AS target_scale, round(ln(1 + scale), 4) AS scale_feature
        FROM smp JOIN gr USING (rgi_id)""",
)
def weekly_samples(spark, sf):
    made = samples_by_week(spark, sf)

    def total(c):
        return F.aggregate(c, F.lit(0.0), lambda a, v: a + v)

    def item(c, i):
        return F.get(c, F.lit(i)).cast("double")

    return made.select(
        "group_name",
        "rgi_id",
        "split",
        "forecast_batch_start",
        "cutoff_week_start",
        F.size("recent_history").alias("history"),
        F.size("targets").alias("steps"),
        F.round(item("recent_history", 0), 4).alias("oldest"),
        F.round(item("recent_history", HISTORY - 1), 4).alias("newest"),
        F.round(total("recent_history") / HISTORY, 5).alias("history_mean"),
        F.round(item(F.get("seasonal_context", F.lit(0)), 0), 4).alias("lag52"),
        F.round(item(F.get("seasonal_context", F.lit(0)), 1), 4).alias("lag104"),
        F.round(item(F.get("seasonal_context", F.lit(0)), 2), 4).alias("lag156"),
        item("actual_targets", 3).alias("last_target"),
        total("actual_targets").alias("target_sum"),
        F.round(F.col("target_scale").cast("double"), 4).alias("target_scale"),
        F.round(F.col("scale_feature").cast("double"), 4).alias("scale_feature"),
    )


@query(
    "sample_manifest",
    f"""WITH {WEEKLY} SELECT group_name, split, count(*) AS n_samples, CAST(min(week_start) AS VARCHAR) AS min_week_start, CAST(max(week_start) AS VARCHAR) AS max_week_start
        FROM smp JOIN gr USING (rgi_id) GROUP BY 1, 2""",
)
def sample_manifest(spark, sf):
    return E.sample_manifest(samples_by_week(spark, sf), ["group_name", "split"])


@query(
    "sample_store",
    f"""WITH {WEEKLY} SELECT group_name, split, count(*) AS n_samples, round(avg(last_target), 6) AS last_target FROM smp JOIN gr USING (rgi_id) GROUP BY 1, 2""",
)
def sample_store(spark, sf):
    """Samples written with their arrays, one folder per group and split, and read back."""
    path = save_samples(samples_by_week(spark, sf), scratch_path(spark, "samples"))
    back = spark.read.parquet(path)
    return back.groupBy("group_name", "split").agg(
        F.count("*").alias("n_samples"), F.avg(F.get("actual_targets", F.lit(HORIZON - 1)).cast("double")).alias("last_target")
    )


def matrix(spark, sf):
    """Flat samples; the identity is as wide as the largest activity group."""
    samples = samples_by_week(spark, sf)
    width = samples.agg(F.max("rgi_index")).first()[0] + 1
    return S.feature_matrix(samples, HISTORY, HORIZON, len(LAGS), width=width)


@query(
    "feature_matrix",
    f"""WITH {WEEKLY}, v AS (SELECT rgi_id, row_number() OVER (PARTITION BY group_name ORDER BY uf, rgi_id) - 1 AS i FROM gr)
        SELECT smp.rgi_id, CAST(week_start AS VARCHAR) AS forecast_batch_start, i AS rgi_index, {_f32('newest')} AS recent_history_t_minus_1,
          {_f32('lag52')} AS seasonal_lag_1_step_1, CAST(i = 1 AS INTEGER)::DOUBLE AS rgi_one_hot_02, CAST(last_target AS DOUBLE) AS actual_target_step_4
        FROM smp JOIN v USING (rgi_id)""",
)
def feature_matrix(spark, sf):
    m = matrix(spark, sf)
    return m.select(
        "rgi_id",
        "forecast_batch_start",
        "rgi_index",
        F.round(F.col("recent_history_t_minus_1").cast("double"), 4).alias("recent_history_t_minus_1"),
        F.round(F.col("seasonal_lag_1_step_1").cast("double"), 4).alias("seasonal_lag_1_step_1"),
        "rgi_one_hot_02",
        F.col("actual_target_step_4").cast("double").alias("actual_target_step_4"),
    )


@query(
    "feature_registry",
    f"""WITH {WEEKLY}, r(role, n) AS (VALUES ('recent_history_feature', 12), ('seasonal_feature', 12), ('future_holiday_feature', 24), ('rgi_identity_feature', 1 + (SELECT max(c) FROM (SELECT count(*) AS c FROM gr GROUP BY group_name))),
          ('static_feature', 2), ('target', 8), ('metadata', 7))
        SELECT role, CAST(n AS BIGINT) AS columns, role LIKE '%\\_feature' ESCAPE '\\' AS included_in_model, (SELECT count(*) FROM smp) AS sample_rows FROM r""",
)
def registry(spark, sf):
    """Columns per role next to the number of samples."""
    m = matrix(spark, sf)
    roles = feature_registry(m, HOLIDAY_FEATURES).groupBy("role").agg(
        F.count("*").alias("columns"), F.first("included_in_model").alias("included_in_model")
    )
    return roles.withColumn("sample_rows", m.agg(F.count("*")).scalar())


@query(
    "matrix_profile",
    f"""WITH {WEEKLY} SELECT 'recent_history_t_minus_1' AS feature_name, count(*) AS non_null_count, 0 AS null_count, round(avg(newest), 4) AS mean,
        round(stddev_pop(newest), 4) AS std,
        round(min(newest), 4) AS min, round(max(newest), 4) AS max, count(DISTINCT CAST(newest AS REAL)) AS n_unique FROM smp""",
)
def matrix_profile(spark, sf):
    made = feature_profile(matrix(spark, sf), ["recent_history_t_minus_1"])
    rounded = {c: F.round(c, 4) for c in ("mean", "std", "min", "max")}
    return made.withColumns(rounded)


@query(
    "static_scaler",
    f"""WITH {MODEL_CTE} SELECT round(avg(br101_length_km_in_rgi), 6) AS mean, round(stddev_pop(br101_length_km_in_rgi), 6) AS std FROM mp WHERE split = 'train'""",
)
def static_scaler(spark, sf):
    return S.static_scaler(modelling_panel(spark, sf))


def short_r2(df):
    return df.withColumn("r2", F.round("r2", 5))


def eval_splits(spark, sf):
    return {k: v for k, v in week_splits(spark, sf).items() if k != "train"}


def baselines(spark, sf):
    return baseline_forecasts(modelling_panel(spark, sf), eval_splits(spark, sf))


BASE = f"""{MODEL_CTE},
bx AS (SELECT *, {_START} AS lo, {_END} AS hi, datediff('day', {_START}, week_start) // 7 AS off FROM mp WHERE split IN ('validation', 'test')),
by1 AS (SELECT *, CAST(lo + CAST(off // 4 * 28 AS INTEGER) AS DATE) AS start, off % 4 + 1 AS step FROM bx),
bz AS (SELECT *, CAST(start - 28 AS DATE) AS cutoff FROM by1 WHERE start + 21 <= hi),
ma AS (SELECT b.rgi_id, b.week_start, avg(h.accident_count) AS p, count(*) AS n FROM bz b JOIN mp h
       ON h.rgi_id = b.rgi_id AND h.week_start <= b.cutoff AND h.week_start > b.cutoff - 28 GROUP BY 1, 2),
fc AS (
  SELECT 'seasonal_naive' AS model, b.split, b.rgi_id, b.rgi_name, b.uf, b.week_start, b.start, b.cutoff, b.step,
    CAST(s.accident_count AS DOUBLE) AS prediction, CAST(b.accident_count AS DOUBLE) AS actual,
    'seasonal_source_week=' || isoyear(b.week_start - 364) || '-W' || lpad(CAST(week(b.week_start - 364) AS VARCHAR), 2, '0') AS metadata
  FROM bz b LEFT JOIN mp s ON s.rgi_id = b.rgi_id AND s.week_start = b.week_start - 364 AND s.week_start <= b.cutoff
  UNION ALL SELECT 'moving_average_4w', b.split, b.rgi_id, b.rgi_name, b.uf, b.week_start, b.start, b.cutoff, b.step, ma.p,
    b.accident_count, 'history_rows=' || coalesce(ma.n, 0) FROM bz b LEFT JOIN ma ON ma.rgi_id = b.rgi_id AND ma.week_start = b.week_start)"""


@query(
    "baseline_forecasts",
    f"""WITH {BASE} SELECT model, split, rgi_id, rgi_name, uf, CAST(week_start AS VARCHAR) AS week_start, CAST(week_start + 6 AS VARCHAR) AS week_end,
        isoyear(week_start) || '-W' || lpad(CAST(week(week_start) AS VARCHAR), 2, '0') AS year_week, CAST(start AS VARCHAR) AS forecast_batch_start,
        CAST(cutoff AS VARCHAR) AS cutoff_week_start, step AS horizon_step, round(prediction, 6) AS prediction, actual, prediction IS NOT NULL AS is_available, metadata FROM fc""",
)
def baseline(spark, sf):
    return baselines(spark, sf)


ERR = """round(sqrt(avg((actual - prediction) * (actual - prediction))), 6) AS rmse, count(*) AS n_predictions"""


@query(
    "forecast_metrics",
    f"""WITH {BASE}, o AS (SELECT model, split, {ERR} FROM fc GROUP BY 1, 2),
        r AS (SELECT model, split, rgi_id, sqrt(avg((actual - prediction) * (actual - prediction))) AS e FROM fc GROUP BY 1, 2, 3),
        m AS (SELECT model, split, round(avg(e), 6) AS macro_rgi_rmse, count(*) AS n_rgis_with_predictions FROM r GROUP BY 1, 2),
        t AS (SELECT split, count(*) AS n_target_rows FROM mp GROUP BY 1)
        SELECT o.*, macro_rgi_rmse, n_rgis_with_predictions, n_target_rows, round(n_predictions / CAST(n_target_rows AS DOUBLE), 6) AS forecast_row_coverage
        FROM o JOIN m USING (model, split) JOIN t USING (split)""",
)
def forecast_metrics(spark, sf):
    panel = pinned_panel(spark, sf)
    return E.evaluate_panel_forecasts(panel, baseline_forecasts(panel, eval_splits(spark, sf)))[0]


@query(
    "entity_forecast_metrics",
    f"""WITH {BASE}, o AS (SELECT model, split, rgi_id, rgi_name, uf, {ERR} FROM fc GROUP BY 1, 2, 3, 4, 5),
        t AS (SELECT split, rgi_id, count(*) AS expected_rows FROM mp GROUP BY 1, 2)
        SELECT o.*, expected_rows, round(n_predictions / CAST(expected_rows AS DOUBLE), 6) AS forecast_row_coverage FROM o JOIN t USING (split, rgi_id)""",
)
def entity_forecast_metrics(spark, sf):
    panel = pinned_panel(spark, sf)
    return E.evaluate_panel_forecasts(panel, baseline_forecasts(panel, eval_splits(spark, sf)))[1]


@query(
    "horizon_rmse",
    f"""WITH {BASE} SELECT step AS horizon_step, 'q' || step AS horizon_label, {ERR} FROM fc WHERE split = 'test' AND model = 'moving_average_4w' GROUP BY step""",
)
def horizon_rmse(spark, sf):
    return E.horizon_rmse(baselines(spark, sf), "test", model="moving_average_4w")


R2 = """CASE WHEN count(*) >= 2 AND var_pop(actual) > 0 THEN round(1 - avg((actual - prediction) * (actual - prediction)) / var_pop(actual), 5) END AS r2"""


@query(
    "split_metrics",
    f"""WITH {BASE} SELECT split, {ERR}, {R2}, CASE split WHEN 'validation' THEN 1 ELSE 2 END AS split_order FROM fc GROUP BY 1""",
)
def split_metrics(spark, sf):
    return short_r2(E.split_metrics(baselines(spark, sf)))


def grouped_baselines(spark, sf):
    """Baselines with group and architecture columns, as the pooled models have them."""
    panel, _ = grouped(spark, sf)
    members = panel.select("rgi_id", "group_name").distinct()
    made = baseline_forecasts(panel, eval_splits(spark, sf)).join(members, "rgi_id")
    return panel, made.withColumn("architecture", F.col("model"))


GBASE = f"""{RANKED}, {BASE[len(MODEL_CTE) + 1:]},
gf AS (SELECT fc.*, group_name, model AS architecture FROM fc JOIN gr USING (rgi_id))"""


def _group_metrics(spark, sf, grain):
    panel, forecasts = grouped_baselines(spark, sf)
    return short_r2(E.evaluate_group_forecasts(panel, forecasts, {"validation": 52, "test": 52})[grain])


@query(
    "group_overall_metrics",
    f"""WITH {GBASE}, o AS (SELECT model, architecture, split, {ERR}, {R2}, count(DISTINCT group_name) AS n_groups_with_predictions FROM gf GROUP BY 1, 2, 3),
        r AS (SELECT model, split, rgi_id, sqrt(avg((actual - prediction) * (actual - prediction))) AS e FROM gf GROUP BY 1, 2, 3),
        m AS (SELECT model, split, round(avg(e), 6) AS macro_rmse, count(*) AS n_rgis_with_predictions FROM r GROUP BY 1, 2)
        SELECT o.*, macro_rmse, n_rgis_with_predictions, 52 * (SELECT count(*) FROM gr) AS expected_rows,
          round(n_predictions / CAST(52 * (SELECT count(*) FROM gr) AS DOUBLE), 6) AS forecast_row_coverage FROM o JOIN m USING (model, split)""",
)
def group_overall_metrics(spark, sf):
    return _group_metrics(spark, sf, "overall")


@query(
    "group_metrics",
    f"""WITH {GBASE}, o AS (SELECT model, architecture, group_name, split, {ERR}, {R2} FROM gf GROUP BY 1, 2, 3, 4),
        r AS (SELECT model, group_name, split, rgi_id, sqrt(avg((actual - prediction) * (actual - prediction))) AS e FROM gf GROUP BY 1, 2, 3, 4),
        m AS (SELECT model, group_name, split, round(avg(e), 6) AS macro_rmse, count(*) AS n_rgis_with_predictions FROM r GROUP BY 1, 2, 3),
        c AS (SELECT group_name, count(*) AS n_group_rgis FROM gr GROUP BY 1)
        SELECT o.*, macro_rmse, n_rgis_with_predictions, n_group_rgis, 52 * n_group_rgis AS expected_rows,
          round(n_predictions / CAST(52 * n_group_rgis AS DOUBLE), 6) AS forecast_row_coverage FROM o JOIN m USING (model, group_name, split) JOIN c USING (group_name)""",
)
def group_metrics(spark, sf):
    return _group_metrics(spark, sf, "group")


@query(
    "entity_metric_report",
    f"""WITH {GBASE} SELECT split, group_name, model, architecture, rgi_id, rgi_name, uf, {ERR}, {R2}, round(count(*) / 52.0::DOUBLE, 6) AS forecast_row_coverage
        FROM gf GROUP BY 1, 2, 3, 4, 5, 6, 7""",
)
def entity_metric_report(spark, sf):
    return E.metric_report(_group_metrics(spark, sf, "region"))


@query(
    "group_horizon_metrics",
    f"""WITH {GBASE} SELECT model, architecture, group_name, split, step AS horizon_step, {ERR}, {R2} FROM gf GROUP BY 1, 2, 3, 4, 5""",
)
def group_horizon_metrics(spark, sf):
    return _group_metrics(spark, sf, "horizon")


@query(
    "comparison_frame",
    f"""WITH {GBASE}, wk AS (SELECT DISTINCT week_start FROM gf WHERE split = 'test' ORDER BY 1 LIMIT 8)
        SELECT group_name, architecture, rgi_id, rgi_name, uf, CAST(week_start AS VARCHAR) AS week_start, round(avg(actual), 6) AS actual, round(avg(prediction), 6) AS prediction
        FROM gf WHERE split = 'test' AND week_start IN (SELECT week_start FROM wk) GROUP BY 1, 2, 3, 4, 5, 6""",
)
def comparison_frame(spark, sf):
    return E.comparison_frame(grouped_baselines(spark, sf)[1])


@query(
    "entity_errors",
    f"""WITH {BASE}, e AS (SELECT split, rgi_id, avg(abs(actual - prediction)) AS mae, sqrt(avg((actual - prediction) * (actual - prediction))) AS rmse,
          CASE WHEN count(*) >= 2 AND var_pop(actual) > 0 THEN 1 - avg((actual - prediction) * (actual - prediction)) / var_pop(actual) END AS r2 FROM fc GROUP BY 1, 2),
        m AS (SELECT split, round(avg(mae), 6) AS macro_mae, round(avg(rmse), 6) AS macro_rmse, round(avg(r2), 6) AS macro_r2 FROM e GROUP BY 1)
        SELECT split, round(avg(abs(actual - prediction)), 6) AS mae, {ERR}, {R2}, any_value(macro_mae) AS macro_mae, any_value(macro_rmse) AS macro_rmse, any_value(macro_r2) AS macro_r2
        FROM fc JOIN m USING (split) GROUP BY 1""",
)
def entity_errors(spark, sf):
    """Pooled and entity-mean errors per split."""
    return short_r2(E.evaluate_entities(baselines(spark, sf), "rgi_id")[0])


@query(
    "run_manifest",
    f"""WITH {GBASE} SELECT group_name, architecture, CAST(0 AS BIGINT) AS n_predictions_train, count(*) FILTER (WHERE split = 'validation') AS n_predictions_validation,
        count(*) FILTER (WHERE split = 'test') AS n_predictions_test FROM gf GROUP BY 1, 2""",
)
def run_manifest(spark, sf):
    scored = E.evaluate_by(grouped_baselines(spark, sf)[1], ["group_name", "architecture", "split"])
    return E.run_manifest(scored, ["group_name", "architecture"])


