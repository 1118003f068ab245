"""Weekly region modelling: from canonical events to samples, forecasts and manifests."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentpanel.models.pooled import comparison_key, pooled_forecasts, step_rows
from incidentpanel.operators import activity as A
from incidentpanel.operators import evaluate as E
from incidentpanel.operators import panel as P
from incidentpanel.operators.calendar_tables import weekly_calendar, weekly_holiday_features
from incidentpanel.operators.keys import apply_rules
from incidentpanel.operators.profile import panel_diagnostics
from incidentpanel.operators.samples import weekly_samples
from incidentpanel.session import checkpointed
from incidentpanel.sources.readers import static_features

# The default exclusion rule.
DEFAULT_RULES = [("exclude_sp_and_rs", [("uf", ["SP", "RS"])])]


def iso_week(year: int, week: int) -> date:
    return date.fromisocalendar(year, week, 1)


def iso_ranges(**bounds: tuple[tuple[int, int], tuple[int, int]]) -> dict[str, tuple[date, date]]:
    """Split name -> (first Monday, last Monday) from ISO (year, week) pairs."""
    return {name: (iso_week(*lo), iso_week(*hi)) for name, (lo, hi) in bounds.items()}


DEFAULT_RANGES = iso_ranges(
    train=((2017, 1), (2023, 52)), validation=((2024, 1), (2024, 52)), test=((2025, 1), (2025, 52))
)


@dataclass(frozen=True)
class WeeklySettings:
    ranges: dict[str, tuple[date, date]] = field(default_factory=lambda: dict(DEFAULT_RANGES))
    history: int = 12
    gap: int = 4
    horizon: int = 4
    seasonal_lags: tuple[int, ...] = (52, 104, 156)
    train_stride: int = 1
    eval_stride: int = 4
    low_share: float = 0.2
    high_share: float = 0.2
    bridge_weight: float = 0.5

    @property
    def strides(self) -> dict[str, int]:
        return {"train": self.train_stride, "validation": self.eval_stride, "test": self.eval_stride}

    @property
    def window(self) -> tuple[date, date]:
        return self.ranges["train"][0], self.ranges["test"][1]

    def expected_rows(self) -> dict[str, int]:
        """Scored rows per region and evaluation split."""
        rows = {}
        for split in ("validation", "test"):
            lo, hi = self.ranges[split]
            weeks = (hi - lo).days // 7 + 1
            starts = max(0, (weeks - self.horizon) // self.eval_stride + 1) if weeks >= self.horizon else 0
            rows[split] = starts * self.horizon
        return rows


def featurise(
    canonical: DataFrame,
    sections: DataFrame,
    settings: WeeklySettings = WeeklySettings(),
    rules: Sequence = DEFAULT_RULES,
    state_holidays: DataFrame | None = None,
    exclusions: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All intermediate tables of the weekly model, samples last."""
    spark = canonical.sparkSession
    lo, hi = (F.lit(d) for d in settings.window)
    static = static_features(sections)
    kept, rule_counts = apply_rules(canonical, rules)
    if exclusions is None:
        exclusions = spark.createDataFrame([], "uf string, year int, exclude_from_modeling boolean")
    events = P.modelling_events(kept, exclusions, static, lo, hi)
    calendar = weekly_calendar(spark, lo, hi)
    targets = P.weekly_targets(events, calendar)
    holidays = weekly_holiday_features(static.select("uf"), lo, hi, state_holidays, bridge=settings.bridge_weight)
    dense = P.with_week_splits(P.dense_weekly_panel(static, targets, holidays, lo, hi), settings.ranges)
    panel = checkpointed(spark, dense)
    groups = A.activity_groups(A.activity_rank(A.activity_summary(panel)), settings.low_share, settings.high_share)
    grouped = checkpointed(spark, A.attach_groups(panel, groups))
    vocabulary = A.entity_vocabulary(grouped)
    indexed = grouped.join(vocabulary.select("rgi_id", "rgi_index"), "rgi_id")
    samples = weekly_samples(
        indexed,
        settings.ranges,
        settings.history,
        settings.gap,
        settings.horizon,
        settings.seasonal_lags,
        settings.strides,
    )
    return {
        "preparation_summary": P.preparation_funnel(kept, exclusions, static, lo, hi),
        "dynamic_exclusion_diagnostics": rule_counts,
        "rgi_static_features": static,
        "modeling_accidents": events,
        "weekly_calendar": calendar,
        "weekly_rgi_target": targets,
        "weekly_holiday_features": holidays,
        "weekly_rgi_panel": panel,
        "weekly_rgi_panel_with_groups": grouped,
        "rgi_activity_summary": groups,
        "group_diagnostics": A.group_diagnostics(grouped, groups),
        "panel_diagnostics": panel_diagnostics(panel),
        "group_rgi_vocabulary": vocabulary,
        "samples": samples,
        "group_sequence_manifest": E.sample_manifest(samples, ["group_name", "split"]),
        "local_sequence_manifest": E.sample_manifest(samples, ["group_name", "rgi_id", "rgi_name", "uf", "rgi_index", "split"]),
    }


def run_experiment(tables: dict[str, DataFrame], settings: WeeklySettings = WeeklySettings()) -> dict[str, DataFrame]:
    """Pooled models per group, metrics at all grains and a manifest per group and family."""
    spark = tables["samples"].sparkSession
    rows, features = step_rows(tables["samples"], settings.history, len(settings.seasonal_lags), settings.horizon)
    forecasts = checkpointed(spark, pooled_forecasts(checkpointed(spark, rows), features))
    metrics = E.evaluate_group_forecasts(tables["weekly_rgi_panel_with_groups"], forecasts, settings.expected_rows())
    counts = tables["group_rgi_vocabulary"].groupBy("group_name").agg(F.count("*").alias("__n"))
    template = comparison_key("%s", settings.history, settings.horizon, settings.gap, settings.seasonal_lags, 0)
    # Three groups at most: the key text is built from the template per row.
    key = F.format_string(template.replace("rgis=0", "rgis=%d"), F.col("group_name"), F.col("__n"))
    by_split = E.evaluate_by(forecasts, ["group_name", "architecture", "split"])
    runs = E.run_manifest(by_split, ["group_name", "architecture"]).join(counts, "group_name")
    return {
        "forecasts": forecasts,
        **{f"{grain}_metrics": frame for grain, frame in metrics.items()},
        "metric_report": E.metric_report(metrics["region"]),
        "comparison": E.comparison_frame(forecasts),
        "split_metrics": by_split,
        "run_manifest": runs.withColumn("comparison_dataset_key", key).drop("__n"),
    }
