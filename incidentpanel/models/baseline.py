"""Seasonal naive and moving-average baselines in one pass over the panel."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidentpanel.functions.temporal import iso_week_label
from incidentpanel.operators.calendar_tables import forecast_origins

FORECAST_COLUMNS = [
    "model",
    "split",
    "rgi_id",
    "rgi_name",
    "uf",
    "week_start",
    "week_end",
    "year_week",
    "forecast_batch_start",
    "cutoff_week_start",
    "horizon_step",
    "prediction",
    "actual",
    "is_available",
    "metadata",
]


def baseline_forecasts(
    panel: DataFrame,
    ranges: Mapping[str, tuple[date, date]],
    horizon: int = 4,
    gap: int = 4,
    season: int = 52,
    window: int = 4,
) -> DataFrame:
    """Both baselines for every complete batch of the given splits, in long form.

    The panel is dense, so the value ``k`` weeks earlier is ``lag(k)`` and the
    cutoff of step ``s`` lies ``gap + s - 1`` rows back; no self-join is needed.
    """
    order = Window.partitionBy("rgi_id").orderBy("week_start")
    recent = order.rowsBetween(-(window - 1), 0)
    base = panel.withColumns(
        {
            "__ma": F.avg("accident_count").over(recent),
            "__rows": F.count("accident_count").over(recent),
            "__season": F.lag("accident_count", season).over(order),
        }
    )
    origins: dict[str, Column] = {}
    for name in ("forecast_batch_start", "cutoff_week_start", "horizon_step"):
        chosen = F.lit(None)
        for split, (lo, hi) in ranges.items():
            made = forecast_origins(F.lit(lo), F.lit(hi), "week_start", horizon, gap)[name]
            chosen = F.when(F.col("split") == split, made).otherwise(chosen)
        origins[name] = chosen
    placed = base.withColumns(origins)

    def at_cutoff(c: str) -> Column:
        value = F.lit(None)
        for step in range(1, horizon + 1):
            value = F.when(F.col("horizon_step") == step, F.lag(c, gap + step - 1).over(order)).otherwise(value)
        return value

    # The seasonal source must not lie after the cutoff.
    known = F.date_sub("week_start", 7 * season) <= F.col("cutoff_week_start")
    ready = placed.withColumns(
        {
            "__average": at_cutoff("__ma"),
            "__history": F.coalesce(at_cutoff("__rows"), F.lit(0)),
            "__seasonal": F.when(known, F.col("__season")).cast("double"),
        }
    ).filter(F.col("horizon_step").isNotNull() & F.col("split").isin(list(ranges)))
    source = iso_week_label(F.date_sub("week_start", 7 * season))
    models = F.array(
        F.struct(
            F.lit("seasonal_naive").alias("model"),
            F.col("__seasonal").alias("prediction"),
            F.concat(F.lit("seasonal_source_week="), source).alias("metadata"),
        ),
        F.struct(
            F.lit(f"moving_average_{window}w").alias("model"),
            F.col("__average").alias("prediction"),
            F.concat(F.lit("history_rows="), F.col("__history").cast("string")).alias("metadata"),
        ),
    )
    kept = [c for c in FORECAST_COLUMNS if c in ready.columns]
    return (
        ready.withColumn("actual", F.col("accident_count").cast("double"))
        .select(*kept, "actual", F.inline(models))
        .withColumn("is_available", F.col("prediction").isNotNull())
        .select(*FORECAST_COLUMNS)
    )
