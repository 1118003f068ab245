"""Forecast errors at several grains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLIT_ORDER = {"train": 0, "validation": 1, "test": 2}


def error_measures(actual: str = "actual", prediction: str = "prediction", mae: bool = False) -> list[Column]:
    """RMSE, R² (null below two rows or without variance) and row count."""
    residual = F.col(actual) - F.col(prediction)
    spread = F.var_pop(actual)
    r2 = F.when((F.count("*") >= 2) & (spread > 0), F.lit(1.0) - F.avg(residual * residual) / spread)
    measures = [
        F.sqrt(F.avg(residual * residual)).alias("rmse"),
        r2.alias("r2"),
        F.count("*").alias("n_predictions"),
    ]
    return [F.avg(F.abs(residual)).alias("mae"), *measures] if mae else measures


def available(forecasts: DataFrame) -> DataFrame:
    """Rows that can be scored; unavailable baselines stay in the table but not here."""
    return forecasts.filter(F.col("prediction").isNotNull() & F.col("actual").isNotNull())


def evaluate_by(forecasts: DataFrame, keys: Sequence[str], mae: bool = False) -> DataFrame:
    return available(forecasts).groupBy(*keys).agg(*error_measures(mae=mae))


def evaluate_panel_forecasts(panel: DataFrame, forecasts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Overall and per-region RMSE with coverage against the panel's own rows."""
    scored = panel.filter(F.col("split").isin("validation", "test"))
    expected = scored.groupBy("split", "rgi_id").agg(F.count("*").alias("expected_rows"))
    regional = (
        evaluate_by(forecasts, ["model", "split", "rgi_id", "rgi_name", "uf"])
        .drop("r2")
        .join(expected, ["split", "rgi_id"], "left")
        .withColumn("forecast_row_coverage", F.col("n_predictions") / F.col("expected_rows"))
    )
    macro = regional.groupBy("model", "split").agg(
        F.avg("rmse").alias("macro_rgi_rmse"), F.count_distinct("rgi_id").alias("n_rgis_with_predictions")
    )
    targets = scored.groupBy("split").agg(F.count("*").alias("n_target_rows"))
    overall = (
        evaluate_by(forecasts, ["model", "split"])
        .drop("r2")
        .join(macro, ["model", "split"], "left")
        .join(targets, "split", "left")
        .withColumn("forecast_row_coverage", F.col("n_predictions") / F.col("n_target_rows"))
    )
    return overall, regional


def evaluate_group_forecasts(
    panel: DataFrame, forecasts: DataFrame, expected_rows: Mapping[str, int]
) -> dict[str, DataFrame]:
    """Overall, group, region and horizon metrics.  ``expected_rows`` is per region and split."""
    expected = F.lit(None).cast("bigint")
    for split, rows in expected_rows.items():
        expected = F.when(F.col("split") == split, F.lit(rows)).otherwise(expected)

    def covered(df: DataFrame, factor: Column) -> DataFrame:
        return df.withColumn("expected_rows", expected * factor).withColumn(
            "forecast_row_coverage", F.try_divide(F.col("n_predictions"), F.col("expected_rows"))
        )

    base = ["model", "architecture"]
    region = covered(
        evaluate_by(forecasts, [*base, "group_name", "split", "rgi_id", "rgi_name", "uf"]), F.lit(1)
    )
    sizes = panel.groupBy("group_name").agg(F.count_distinct("rgi_id").alias("n_group_rgis"))

    def rolled(keys: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
        macro = region.groupBy(*keys).agg(
            F.avg("rmse").alias("macro_rmse"), F.count_distinct("rgi_id").alias("n_rgis_with_predictions"), *extra
        )
        return evaluate_by(forecasts, keys).join(macro, list(keys), "left")

    group = covered(
        rolled([*base, "group_name", "split"]).join(sizes, "group_name", "left"), F.coalesce("n_group_rgis", F.lit(0))
    )
    total = panel.agg(F.count_distinct("rgi_id")).scalar()
    overall = covered(
        rolled([*base, "split"], [F.count_distinct("group_name").alias("n_groups_with_predictions")]), total
    )
    return {
        "overall": overall,
        "group": group,
        "region": region,
        "horizon": evaluate_by(forecasts, [*base, "group_name", "split", "horizon_step"]),
    }


def evaluate_entities(scored: DataFrame, entity: str, split: str = "split") -> tuple[DataFrame, DataFrame]:
    """Per-entity metrics and, per split, pooled (micro) next to entity-mean (macro) metrics."""
    per_entity = evaluate_by(scored, [split, entity], mae=True)
    macro = per_entity.groupBy(split).agg(
        F.avg("mae").alias("macro_mae"), F.avg("rmse").alias("macro_rmse"), F.avg("r2").alias("macro_r2")
    )
    return evaluate_by(scored, [split], mae=True).join(macro, split), per_entity


def horizon_rmse(forecasts: DataFrame, split: str = "test", **equals: str) -> DataFrame:
    """RMSE per horizon step after equality filters, labelled q1, q2, ..."""
    kept = available(forecasts).filter(F.col("split") == split)
    for name, value in equals.items():
        kept = kept.filter(F.col(name) == value)
    return (
        kept.groupBy("horizon_step")
        .agg(*error_measures())
        .select(
            "horizon_step",
            F.concat(F.lit("q"), F.col("horizon_step").cast("string")).alias("horizon_label"),
            "rmse",
            "n_predictions",
        )
    )


def split_metrics(forecasts: DataFrame) -> DataFrame:
    order = F.coalesce(*[F.when(F.col("split") == s, F.lit(o)) for s, o in SPLIT_ORDER.items()], F.lit(99))
    return evaluate_by(forecasts, ["split"]).withColumn("split_order", order)


def comparison_frame(forecasts: DataFrame, weeks: int = 8) -> DataFrame:
    """Mean actual and prediction per region, architecture and week over the first test weeks."""
    test = forecasts.filter(F.col("split") == "test")
    first = test.groupBy("week_start").agg(F.count("*").alias("n")).orderBy("week_start").limit(weeks)
    keys = ["group_name", "architecture", "rgi_id", "rgi_name", "uf", "week_start"]
    return (
        test.join(first.select("week_start"), "week_start", "left_semi")
        .groupBy(*keys)
        .agg(F.avg("actual").alias("actual"), F.avg("prediction").alias("prediction"))
    )


def metric_report(region_metrics: DataFrame) -> DataFrame:
    columns = ["split", "group_name", "model", "architecture", "rgi_id", "rgi_name", "uf"]
    return region_metrics.select(*columns, "rmse", "r2", "n_predictions", "forecast_row_coverage")


def sample_manifest(samples: DataFrame, keys: Sequence[str], origin: str = "forecast_batch_start") -> DataFrame:
    return samples.groupBy(*keys).agg(
        F.count("*").alias("n_samples"), F.min(origin).alias("min_week_start"), F.max(origin).alias("max_week_start")
    )


def run_manifest(split_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Prediction counts per split next to the run's keys, one row per run."""
    return split_rows.groupBy(*keys).agg(
        *[
            F.sum(F.when(F.col("split") == s, F.col("n_predictions")).otherwise(0)).alias(f"n_predictions_{s}")
            for s in SPLIT_ORDER
        ]
    )


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
