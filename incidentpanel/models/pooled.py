"""One pooled model per activity group and model family, compared on the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentpanel.operators.activity import GROUPS
from incidentpanel.operators.calendar_tables import HOLIDAY_FEATURES
from incidentpanel.operators.keys import union_all

FAMILIES = ("linear", "boosted_trees")


def key_settings(history: int, horizon: int, gap: int, lags: Sequence[int]) -> str:
    """The part of a comparison key between the group and its number of regions."""
    joined = "-".join(str(lag) for lag in lags)
    return f"|history={history}|horizon={horizon}|latency={gap}|lags={joined}|rgis="


def comparison_key(group: str, history: int, horizon: int, gap: int, lags: Sequence[int], regions: int) -> str:
    return f"{group}{key_settings(history, horizon, gap, lags)}{regions}"


def step_rows(samples: DataFrame, history: int, lags: int, horizon: int) -> tuple[DataFrame, list[str]]:
    """One row per sample and horizon step with flat features, and the feature names."""
    steps = samples.select("*", F.posexplode("targets").alias("__i", "target_scaled"))
    features = {f"h{i}": F.get("recent_history", F.lit(history - i)) for i in range(1, history + 1)}
    features |= {f"s{i}": F.get(F.get("seasonal_context", F.col("__i")), F.lit(i)) for i in range(lags)}
    features |= {n: F.get(F.get("future_holiday", F.col("__i")), F.lit(i)) for i, n in enumerate(HOLIDAY_FEATURES)}
    features |= {f"step{i}": (F.col("__i") == i).cast("double") for i in range(1, horizon)}
    named = {k: v.cast("double") for k, v in features.items()}
    named |= {"road": F.col("road_length").cast("double"), "scale": F.col("scale_feature").cast("double")}
    flat = steps.select(
        "group_name",
        "rgi_id",
        "rgi_name",
        "uf",
        "split",
        "forecast_batch_start",
        "cutoff_week_start",
        (F.col("__i") + 1).alias("horizon_step"),
        F.get("target_week_starts", F.col("__i")).alias("week_start"),
        F.get("actual_targets", F.col("__i")).cast("double").alias("actual"),
        F.col("target_scale").cast("double").alias("target_scale"),
        F.col("target_scaled").cast("double").alias("target_scaled"),
        *[c.alias(n) for n, c in named.items()],
    )
    return flat, list(named)


def _family(name: str, seed: int):
    if name == "linear":
        return LinearRegression(labelCol="target_scaled", regParam=0.1)
    return GBTRegressor(labelCol="target_scaled", maxIter=10, maxDepth=3, seed=seed)


def pooled_forecasts(rows: DataFrame, features: Sequence[str], families: Sequence[str] = FAMILIES, seed: int = 101) -> DataFrame:
    """Fit every family on each group's train rows and score all its splits.

    The training itself is distributed; the loop runs over three groups times the families.
    """
    made = []
    for group in GROUPS:
        part = rows.filter(F.col("group_name") == group).cache()
        try:
            train = part.filter(F.col("split") == "train")
            if train.isEmpty():
                continue
            for family in families:
                stages = [VectorAssembler(inputCols=list(features), outputCol="features"), _family(family, seed)]
                model = Pipeline(stages=stages).fit(train)
                scored = model.transform(rows.filter(F.col("group_name") == group)).withColumnRenamed("prediction", "__p")
                made.append(
                    scored.select(
                        F.lit("pooled_group").alias("model"),
                        F.lit(family).alias("architecture"),
                        "group_name",
                        "split",
                        "rgi_id",
                        "rgi_name",
                        "uf",
                        "week_start",
                        "forecast_batch_start",
                        "cutoff_week_start",
                        "horizon_step",
                        F.rint(F.greatest(F.col("__p"), F.lit(0.0)) * F.col("target_scale")).alias("prediction"),
                        "actual",
                        F.lit(True).alias("is_available"),
                    )
                )
        finally:
            part.unpersist()
    return union_all(made)
