"""Supervised samples from dense panels.

Each entity's series is as long as the calendar, so windows partitioned by
entity hold a bounded number of rows however many events an entity has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidentpanel.functions.clean import seconds_of_day
from incidentpanel.functions.temporal import calendar_cycles
from incidentpanel.operators.calendar_tables import HOLIDAY_FEATURES
from incidentpanel.operators.windows import full_windows, halo_blocks, lookback_blocks, open_windows, reach, step_at
from incidentpanel.skew import latest_by
from incidentpanel.sources.readers import WEATHER_VARIABLES

# The optional weather channels, in the order of the raw variables.
WEATHER_CHANNELS = [
    "target_max_temp_c",
    "target_min_temp_c",
    "target_max_wind_speed_kmh",
    "target_sunrise_seconds",
    "target_sunset_seconds",
    "target_precipitation_mm",
    "target_precipitation_hours",
]
EXOGENOUS = ["non_working_day_weight", "days_off_ahead", "days_off_before"]
TINY = 1e-8
# Weeks of a block of weekly samples.
WEEK_SPAN = 128


def weather_features(weather: DataFrame, entity: str, order: Sequence[Column], day: str = "accident_date") -> DataFrame:
    """Model-ready weather per entity and day; the last row per key by ``order`` wins."""
    last = latest_by(weather, [entity, "weather_date"], order)
    columns = []
    for source, target in zip(WEATHER_VARIABLES, WEATHER_CHANNELS):
        value = seconds_of_day(source) if source in ("sunrise", "sunset") else F.col(source).cast("double")
        columns.append(value.alias(target))
    return last.select(entity, F.to_date("weather_date").alias(day), *columns)


def weather_coverage(panel: DataFrame) -> DataFrame:
    complete = F.lit(True)
    for c in WEATHER_CHANNELS:
        complete = complete & F.col(c).isNotNull()
    return panel.agg(F.avg(complete.cast("double")).alias("weather_complete_row_share"))


def train_zscores(
    panel: DataFrame, entity: str, columns: Sequence[str], split: str = "split", suffix: str = "_z"
) -> DataFrame:
    """Z-scores per entity from train rows only; missing values become the train mean.

    Adds ``<c>_mean``, ``<c>_std`` and ``<c><suffix>``.  A deviation below 1e-8 counts as 1.
    """
    w = Window.partitionBy(entity)
    stats: dict[str, Column] = {}
    for c in columns:
        train = F.when(F.col(split) == "train", F.col(c).cast("double"))
        spread = F.stddev_pop(train).over(w)
        stats[f"{c}_mean"] = F.coalesce(F.avg(train).over(w), F.lit(0.0))
        stats[f"{c}_std"] = F.when(spread >= TINY, spread).otherwise(F.lit(1.0))
    scored = panel.withColumns(stats)
    return scored.withColumns(
        {
            f"{c}{suffix}": (F.coalesce(F.col(c).cast("double"), F.col(f"{c}_mean")) - F.col(f"{c}_mean"))
            / F.col(f"{c}_std")
            for c in columns
        }
    )


def daily_blocks(
    panel: DataFrame,
    entity: str,
    day: str,
    lookback: int,
    target: str = "accident_count",
    weather: bool = False,
    span: int | None = None,
) -> DataFrame:
    """Blocks that hold the daily samples of a panel (see ``windows.lookback_blocks``).

    10 (or 17 with weather) channels; the counts are scaled by train statistics, and
    ``y_mean`` and ``y_std`` undo it.  A table of blocks is little more than the panel.
    """
    extra = WEATHER_CHANNELS if weather else []
    scored = train_zscores(panel, entity, [target, *extra])
    channels = [F.col(f"{target}_z"), *calendar_cycles(day).values(), *[F.col(c) for c in EXOGENOUS]]
    channels += [F.col(f"{c}_z") for c in extra]
    named = scored.withColumns(
        {
            "y_raw": F.col(target).cast("double"),
            "y_scaled": F.col(f"{target}_z"),
            "y_mean": F.col(f"{target}_mean"),
            "y_std": F.col(f"{target}_std"),
        }
    )
    return lookback_blocks(named, entity, day, channels, lookback, [day, "split", "y_raw", "y_scaled", "y_mean", "y_std"], span)


def daily_samples(
    panel: DataFrame,
    entity: str,
    day: str,
    lookback: int,
    target: str = "accident_count",
    weather: bool = False,
) -> DataFrame:
    """One row per entity and day with a full window: channels x lookback and targets.

    For inspection and small tables; models take ``daily_blocks`` and cut the windows
    out inside their tasks.
    """
    blocks = daily_blocks(panel, entity, day, lookback, target, weather)
    return open_windows(blocks, entity, 17 if weather else 10).select(
        entity, day, "split", "sequence", "y_raw", "y_scaled", "y_mean", "y_std"
    )


def target_scale(panel: DataFrame, entity: str = "rgi_id", count: str = "accident_count") -> Column:
    """max(1, 1 + mean train count) per entity."""
    train = F.when(F.col("split") == "train", F.col(count))
    return F.greatest(F.lit(1.0), F.lit(1.0) + F.avg(train).over(Window.partitionBy(entity)))


def static_scaler(panel: DataFrame, column: str = "br101_length_km_in_rgi") -> DataFrame:
    """Mean and deviation of a static feature over train rows, one row."""
    spread = F.stddev_pop(column)
    return panel.filter(F.col("split") == "train").agg(
        F.avg(column).alias("mean"), F.when(spread > 0, spread).otherwise(F.lit(1.0)).alias("std")
    )


def weekly_samples(
    panel: DataFrame,
    ranges: Mapping[str, tuple[date, date]],
    history: int,
    gap: int,
    horizon: int,
    seasonal_lags: Sequence[int] = (52, 104, 156),
    strides: Mapping[str, int] | None = None,
    entity: str = "rgi_id",
    week: str = "week_start",
) -> DataFrame:
    """History, seasonal, holiday and target windows for each forecast origin.

    The history ends ``gap`` weeks before the origin; targets cover ``horizon``
    weeks from it and must end inside the origin's split; origins are aligned to
    the split start by the split's stride.  Windows are cut from blocks with a halo,
    and only for origins.
    """
    strides = strides or {"train": 1, "validation": horizon, "test": horizon}
    order = Window.partitionBy(entity).orderBy(week)
    scaled = panel.withColumn("target_scale", target_scale(panel, entity)).withColumn(
        "__s", F.col("accident_count") / F.col("target_scale")
    )
    lags = F.array(*[F.coalesce(F.lag("__s", k).over(order), F.lit(0.0)).cast("float") for k in seasonal_lags])
    # The last week its targets may end in, for rows that are forecast origins.
    until = F.lit(None).cast("date")
    for name, (lo, hi) in ranges.items():
        aligned = F.floor(F.datediff(F.col(week), F.lit(lo)) / 7) % strides.get(name, 1) == 0
        until = F.when((F.col("split") == name) & aligned, F.lit(hi)).otherwise(until)
    framed = scaled.withColumns(
        {"__lags": lags, "__hol": F.array(*[F.col(c).cast("float") for c in HOLIDAY_FEATURES]), "__until": until}
    )
    meta = [c for c in ("group_name", "rgi_name", "uf", "rgi_index", "split") if c in panel.columns]
    used = ["accident_count", "target_scale", "__s", "__lags", "__hol", "__until", "week_end", "year_week", "br101_length_km_in_rgi"]
    before, after = gap + history - 1, horizon - 1
    blocks = halo_blocks(framed.select(entity, week, *meta, *used), entity, week, before, after, WEEK_SPAN)
    origins = full_windows(before, after, lambda i: step_at(i + after, week) <= step_at(i, "__until"))

    def sample(i: Column) -> Column:
        return F.struct(
            *[step_at(i, c).alias(c) for c in meta],
            step_at(i, week).alias("forecast_batch_start"),
            step_at(i - gap, week).alias("cutoff_week_start"),
            reach(i, 0, after, week).alias("target_week_starts"),
            reach(i, 0, after, "week_end").alias("target_week_ends"),
            reach(i, 0, after, "year_week").alias("target_year_weeks"),
            reach(i, -before, -gap, "__s", "float").alias("recent_history"),
            reach(i, 0, after, "__lags").alias("seasonal_context"),
            reach(i, 0, after, "__hol").alias("future_holiday"),
            step_at(i, "br101_length_km_in_rgi").cast("float").alias("road_length"),
            F.log1p(step_at(i, "target_scale")).cast("float").alias("scale_feature"),
            reach(i, 0, after, "__s", "float").alias("targets"),
            reach(i, 0, after, "accident_count", "float").alias("actual_targets"),
            step_at(i, "target_scale").cast("float").alias("target_scale"),
        )

    made = blocks.select(entity, F.inline(F.transform(origins, sample)))
    lead = [c for c in ("group_name", entity, "rgi_name", "uf", "rgi_index", "split") if c in made.columns]
    return made.select(*lead, *[c for c in made.columns if c not in lead])


def one_hot(index: Column, size: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.when(i == index, 1.0).otherwise(0.0))


def feature_matrix(
    samples: DataFrame, history: int, horizon: int, lags: int, width: int = 0
) -> DataFrame:
    """One flat column per feature and step; ``width`` > 0 adds that many one-hot identity columns."""
    cols = [F.col(c) for c in samples.columns if c in ("split", "group_name", "rgi_id", "rgi_name", "uf")]
    cols += [F.col(c) for c in ("forecast_batch_start", "cutoff_week_start", "road_length", "scale_feature")]
    if "rgi_index" in samples.columns:
        cols.append(F.col("rgi_index"))
    cols += [
        F.get("recent_history", F.lit(history - i)).alias(f"recent_history_t_minus_{i}") for i in range(1, history + 1)
    ]
    for step in range(1, horizon + 1):
        cols += [
            F.get(F.get("seasonal_context", F.lit(step - 1)), F.lit(lag)).alias(f"seasonal_lag_{lag + 1}_step_{step}")
            for lag in range(lags)
        ]
    for step in range(1, horizon + 1):
        cols += [
            F.get(F.get("future_holiday", F.lit(step - 1)), F.lit(i)).alias(f"{name}_step_{step}")
            for i, name in enumerate(HOLIDAY_FEATURES)
        ]
    cols += [(F.col("rgi_index") == i).cast("double").alias(f"rgi_one_hot_{i + 1:02d}") for i in range(width)]
    for name, source in (("target_scaled", "targets"), ("actual_target", "actual_targets")):
        cols += [F.get(source, F.lit(s - 1)).alias(f"{name}_step_{s}") for s in range(1, horizon + 1)]
    return samples.select(*cols)
