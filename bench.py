"""Headline queries on one data folder; prints one JSON line with seconds per query."""

from __future__ import annotations

import json
import os
import time

from incidentpanel.catalog import QUERIES
from incidentpanel.session import build_session

HEADLINE = [
    "clean_numeric",
    "clean_strings",
    "parse_timestamps",
    "classify_events",
    "exclusion_anti_join",
    "entity_day_counts",
    "entity_day_panel",
    "entity_week_panel",
    "section_week_panel",
    "coverage_review",
    "category_profile",
    "panel_diagnostics",
    "exact_quantiles",
    "iqr_outliers",
    "days_off_streaks",
    "weekly_holiday_features",
    "points_in_corridor",
    "point_in_polygon",
    "clip_road",
    "nearest_section",
    "nearest_cell_match",
    "activity_groups",
    "lookback_samples",
    "weekly_samples",
    "baseline_forecasts",
    "group_metrics",
    "forecast_merge",
    "period_delta",
    "selected_vs_mean",
    "latest_upsert",
    "stream_daily_counts",
    "minirocket_features",
    "ridge_per_entity",
    "recursive_forecast",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One throw-away run starts the JVM's code paths before the clock does.
    QUERIES["time_bounds"](spark, sf_dir).collect()
    seconds = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
