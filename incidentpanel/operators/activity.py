"""Train-window activity statistics, ranks and low/mid/high groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from incidentpanel.operators.keys import require_present
from incidentpanel.skew import global_row_number

GROUPS = ["low_activity", "mid_activity", "high_activity"]
ACTIVITY_ORDER = [
    "train_mean_weekly_accidents",
    "train_active_week_share",
    "train_mean_positive_weekly_accidents",
    "rgi_id",
]


def activity_summary(panel: DataFrame) -> DataFrame:
    """Weekly activity per region over the train split only."""
    n = F.col("accident_count")
    return (
        panel.filter(F.col("split") == "train")
        .groupBy("rgi_id", "rgi_name", "uf")
        .agg(
            F.sum(n).alias("train_total_accidents"),
            F.avg(n).alias("train_mean_weekly_accidents"),
            F.median(n).alias("train_median_weekly_accidents"),
            F.avg((n > 0).cast("double")).alias("train_active_week_share"),
            F.avg((n == 0).cast("double")).alias("train_zero_week_share"),
            F.coalesce(F.avg(F.when(n > 0, n)), F.lit(0.0)).alias("train_mean_positive_weekly_accidents"),
            F.min_by("br101_length_km_in_rgi", "week_start").alias("br101_length_km_in_rgi"),
        )
    )


def activity_rank(summary: DataFrame) -> DataFrame:
    """1 for the least active region; ranked without gathering all regions in one task."""
    return global_row_number(summary, [F.col(c) for c in ACTIVITY_ORDER], "activity_rank")


def activity_groups(ranked: DataFrame, low_share: float, high_share: float) -> DataFrame:
    """Low, mid and high groups from the rank; every group keeps at least one region."""
    n = ranked.agg(F.count("*")).scalar()
    low = F.greatest(F.lit(1), F.floor(n * F.lit(low_share)))
    high = F.greatest(F.lit(1), F.floor(n * F.lit(high_share)))
    # Shrink the high group first, then the low one, to leave a middle.
    high = F.greatest(F.lit(1), high - F.greatest(F.lit(0), F.lit(1) - (n - low - high)))
    low = F.greatest(F.lit(1), low - F.greatest(F.lit(0), F.lit(1) - (n - low - high)))
    enough = F.when(n < 3, F.raise_error(F.lit("activity groups need at least three regions")).cast("boolean")).otherwise(
        F.lit(True)
    )
    group = (
        F.when(F.col("activity_rank") > n - high, GROUPS[2])
        .when(F.col("activity_rank") <= low, GROUPS[0])
        .otherwise(GROUPS[1])
    )
    named = ranked.filter(enough).withColumn("group_name", group)
    order = F.array_position(F.array(*[F.lit(g) for g in GROUPS]), F.col("group_name")) - 1
    return named.withColumn("group_order", order.cast("int"))


def attach_groups(panel: DataFrame, groups: DataFrame) -> DataFrame:
    columns = ["rgi_id", "group_name", "group_order", "activity_rank"]
    columns += [c for c in groups.columns if c.startswith("train_")]
    joined = panel.join(groups.select(*columns), "rgi_id", "left")
    return require_present(joined, "group_name", "activity group")


def group_diagnostics(panel: DataFrame, groups: DataFrame) -> DataFrame:
    """Members, mean activity, zero share and train rows per group, in long form."""
    member = groups.groupBy("group_name").agg(
        F.count_distinct("rgi_id").alias("n_rgis"),
        F.avg("train_mean_weekly_accidents").alias("mean_activity"),
        F.avg("train_zero_week_share").alias("zero_share"),
    )
    train = panel.groupBy("group_name").agg(F.count_if(F.col("split") == "train").alias("train_rows"))
    spec = [
        ("membership", "n_rgis", "overall", "n_rgis"),
        ("train_activity", "mean_weekly_accidents_mean", "train", "mean_activity"),
        ("train_activity", "zero_week_share_mean", "train", "zero_share"),
        ("train_panel", "rows", "train", "train_rows"),
    ]
    return member.join(train, "group_name", "left").select(
        "group_name",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(g).alias("diagnostic_group"),
                        F.lit(n).alias("diagnostic_name"),
                        F.lit(s).alias("split"),
                        F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias("value"),
                    )
                    for g, n, s, c in spec
                ]
            )
        ),
    )


def entity_vocabulary(panel: DataFrame) -> DataFrame:
    """Zero-based index of each region inside its group, by state and code.

    The window sees one row per region, and groups hold disjoint regions.
    """
    members = panel.select("group_name", "rgi_id", "rgi_name", "uf").distinct()
    order = Window.partitionBy("group_name").orderBy("uf", "rgi_id")
    return members.withColumn("rgi_index", F.row_number().over(order) - 1)
