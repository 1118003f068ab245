"""Coverage reviews, category profiles, panel diagnostics, feature profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from incidentpanel.functions.labels import DECLARED_OUTSIDE, level_label, safe_share
from incidentpanel.operators.panel import event_measures

SHARES = {
    "fatal_victim_share": ("fatal_victims", "people_involved"),
    "fatal_accident_share": ("fatal_accident_count", "accident_count"),
}

# Support and effect thresholds of the covariate screening.
COUNT_LEVEL_MIN = 250
SEVERITY_LEVEL_MIN = 1000
STRONG_P, MODERATE_P = 0.01, 0.05
STRONG_EFFECT, MODERATE_EFFECT = 0.15, 0.05
SPARSE_SHARE = 0.40


def with_shares(df: DataFrame) -> DataFrame:
    return df.withColumns({name: safe_share(*pair) for name, pair in SHARES.items()})


def coverage_review(
    events: DataFrame, partial_year: int, excluded_states: Sequence[str], state: str = "uf", year: str = "year"
) -> DataFrame:
    """Totals, coordinate and corridor coverage per state and year with year-on-year change.

    Change compares with the state's previous row, whatever year that is.
    """
    grouped = events.groupBy(state, year).agg(
        F.count("*").alias("total_cases"),
        F.sum("fatal_victims_occ").alias("fatal_victims_occ"),
        F.sum("pessoas").alias("total_people_involved"),
        F.count_if(~F.coalesce("has_valid_coords", F.lit(False))).alias("missing_coords_cases"),
        F.count_if("is_declared").alias("declared_cases"),
        F.count_if(F.col("accident_class") == DECLARED_OUTSIDE).alias("declared_outside_corridor"),
        F.count_if("is_canonical").alias("canonical_cases"),
    )
    # At most one row per state and year reaches this window.
    order = Window.partitionBy(state).orderBy(year)

    def change(c: str) -> Column:
        before = F.lag(c).over(order)
        return F.when(before != 0, F.col(c) / before - 1)

    return grouped.withColumns(
        {
            "missing_coords_share": F.col("missing_coords_cases") / F.col("total_cases"),
            "declared_outside_corridor_share": safe_share("declared_outside_corridor", "declared_cases"),
            "cases_pct_change_vs_prev_year": change("total_cases"),
            "fatal_pct_change_vs_prev_year": change("fatal_victims_occ"),
            "is_partial_year": F.coalesce(F.col(year) == partial_year, F.lit(False)),
            "review_rule": F.lit("manual_visual_review_only"),
            "exclude_from_descriptive": F.coalesce(F.col(state).isin(list(excluded_states)), F.lit(False)),
            "exclude_from_modeling": F.coalesce(F.col(state).isin(list(excluded_states)), F.lit(False)),
        }
    )


# The two texts below are fixed values.
def manual_exclusions(coverage: DataFrame, excluded_states: Sequence[str], state: str = "uf", year: str = "year") -> DataFrame:
    listed = F.coalesce(F.col(state).isin(list(excluded_states)), F.lit(False))
    reason = "Excessive missing spatial coverage in point map (manual visual review)."
    evidence = "Coverage point plot indicates clear undercoverage/missingness."
    return coverage.select(
        state,
        year,
        F.when(listed, reason).otherwise("").alias("reason"),
        F.when(listed, evidence).otherwise("").alias("evidence"),
        listed.alias("exclude_from_descriptive"),
        listed.alias("exclude_from_modeling"),
    )


def unpivot_levels(df: DataFrame, categories: Sequence[str], months: Sequence[str] = ("month",)) -> DataFrame:
    """One row per event and category: variable and level text (null levels stay null)."""
    pairs = [
        F.struct(
            F.lit(c).alias("variable"),
            F.when(F.col(c).isNotNull(), level_label(c, two_digits=c in months)).alias("level_label"),
        )
        for c in categories
    ]
    others = [c for c in df.columns if c not in categories]
    return df.select(*others, F.inline(F.array(*pairs)))


def expected_levels(spark: SparkSession, hints: Mapping[str, Sequence[str]]) -> DataFrame:
    rows = [(v, str(level), i) for v, levels in hints.items() for i, level in enumerate(levels)]
    return spark.createDataFrame(rows, "variable string, level_label string, hint_order int")


def ordered_levels(long: DataFrame, hints: DataFrame) -> DataFrame:
    """Hinted levels first in their order, then observed extras by text."""
    observed = long.filter(F.col("level_label").isNotNull()).groupBy("variable", "level_label").agg(
        F.count("*").alias("n")
    )
    return observed.join(hints, ["variable", "level_label"], "full").select(
        "variable",
        "level_label",
        F.coalesce("hint_order", F.lit(1_000_000)).alias("hint_order"),
        F.col("n").isNotNull().alias("observed"),
    )


def level_review(levels: DataFrame) -> DataFrame:
    text = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("hint_order", "level_label"))), lambda s: s["level_label"]),
        " | ",
    )
    return levels.groupBy("variable").agg(
        F.count_if("observed").alias("observed_levels"),
        F.count("*").alias("expected_levels_considered"),
        text.alias("ordered_levels"),
    )


def category_profile(
    events: DataFrame,
    categories: Sequence[str],
    levels: DataFrame,
    deaths: str = "mortos",
    people: str = "pessoas",
) -> DataFrame:
    """Measures per expected level of each category, zero for unobserved levels.

    All categories are aggregated in one pass; a third of the rows sharing a
    level still collapses to one partial row per task.
    """
    long = unpivot_levels(events, categories)
    counts = long.groupBy("variable", "level_label").agg(*event_measures(deaths, people))
    joined = levels.select("variable", "level_label").join(counts, ["variable", "level_label"], "left")
    return _finish_profile(joined)


def category_year_profile(
    events: DataFrame,
    categories: Sequence[str],
    levels: DataFrame,
    deaths: str = "mortos",
    people: str = "pessoas",
    year: str = "year",
) -> DataFrame:
    """The same per year on the complete year x level grid."""
    long = unpivot_levels(events, categories).withColumnRenamed(year, "year")
    counts = long.groupBy("year", "variable", "level_label").agg(*event_measures(deaths, people))
    # A year occurs once per level at most, so the list of years is short.
    years = counts.filter("year IS NOT NULL").agg(F.array_sort(F.collect_set("year"))).scalar()
    grid = levels.select("variable", "level_label", F.explode(years).alias("year"))
    return _finish_profile(grid.join(counts, ["year", "variable", "level_label"], "left"))


def _finish_profile(joined: DataFrame) -> DataFrame:
    filled = joined.fillna(0, ["accident_count", "fatal_accident_count"]).fillna(0.0, ["fatal_victims", "people_involved"])
    return with_shares(filled.withColumn("level_observed", F.col("accident_count") > 0))


def model_frame(events: DataFrame, keys: Sequence[str], deaths: str = "mortos", people: str = "pessoas") -> DataFrame:
    """Measures per combination of the model's categorical keys."""
    return with_shares(events.groupBy(*keys).agg(*event_measures(deaths, people)))


def level_support(frame: DataFrame, categories: Sequence[str], levels: DataFrame) -> DataFrame:
    """Cells, events and people behind each expected level."""
    long = unpivot_levels(frame.select(*categories, "accident_count", "people_involved"), categories)
    support = long.groupBy("variable", "level_label").agg(
        F.count("*").alias("grouped_cells"),
        F.sum("accident_count").alias("total_accidents"),
        F.sum("people_involved").alias("total_people_involved"),
    )
    joined = levels.select("variable", "level_label").join(support, ["variable", "level_label"], "left")
    return joined.fillna(0, ["grouped_cells", "total_accidents"]).fillna(0.0, ["total_people_involved"]).withColumn(
        "is_observed", F.col("grouped_cells") > 0
    )


def reference_levels(frame: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Most frequent level per category (ties: smallest label)."""
    long = unpivot_levels(frame.select(*categories), categories).filter("level_label IS NOT NULL")
    counts = long.groupBy("variable", "level_label").agg(F.count("*").alias("n"))
    return counts.groupBy("variable").agg(
        F.min_by("level_label", F.struct(-F.col("n"), F.col("level_label"))).alias("reference_level_label")
    )


def encoding_audit(frame: DataFrame, categories: Sequence[str], levels: DataFrame, references: DataFrame) -> DataFrame:
    """How each expected level enters a dummy encoding that drops the reference."""
    support = level_support(frame, categories, levels)
    status = (
        F.when(~F.col("is_observed"), "expected_but_unobserved")
        .when(F.col("level_label") == F.col("reference_level_label"), "reference_dropped")
        .when(F.col("reference_level_label").isNotNull(), "encoded_dummy")
        .otherwise("not_encoded")
    )
    return support.join(references, "variable", "left").withColumn("encoding_status", status)


def entity_event_stats(dense_day: DataFrame, dense_week: DataFrame, entity: str, count: str = "accident_count") -> DataFrame:
    """Total plus min, max, mean and median of the daily and weekly series.

    Both series are zero-filled, so a group has one row per period; the exact
    median therefore sees a bounded number of values.
    """
    total = dense_day.groupBy(entity).agg(F.sum(count).alias("total_accidents"), *_spread(count, "daily"))
    return total.join(dense_week.groupBy(entity).agg(*_spread(count, "weekly")), entity)


def _spread(count: str, prefix: str) -> list[Column]:
    return [
        F.min(count).alias(f"{prefix}_min"),
        F.max(count).alias(f"{prefix}_max"),
        F.avg(count).alias(f"{prefix}_mean"),
        F.median(count).alias(f"{prefix}_median"),
    ]


def state_share(events: DataFrame, state: str, column: str = "uf") -> DataFrame:
    inside = F.count_if(F.col(column) == state)
    return events.agg(
        F.count("*").alias("total_events"),
        inside.alias("state_events"),
        F.try_divide(inside * 100.0, F.count("*")).alias("state_pct"),
    )


def panel_stats(panel: DataFrame, keys: Sequence[str], count: str = "accident_count") -> DataFrame:
    return panel.groupBy(*keys).agg(
        F.sum(count).alias("total_accidents"),
        F.avg(count).alias("mean_weekly_accidents"),
        F.median(count).alias("median_weekly_accidents"),
        F.avg((F.col(count) == 0).cast("double")).alias("zero_share"),
    )


def panel_diagnostics(panel: DataFrame, entity: Sequence[str] = ("rgi_id", "rgi_name", "uf"), top: int = 10) -> DataFrame:
    """Long diagnostics table: panel size, target and entity distributions, rankings per split."""
    keys = list(entity)
    ident = keys[0]
    scoped = panel.filter(F.col("split") != "outside_scope")
    value = F.col("accident_count")

    def rows(wide: DataFrame, split: Column, spec: Sequence[tuple[str, str, str]]) -> DataFrame:
        structs = [
            F.struct(F.lit(g).alias("diagnostic_group"), F.lit(n).alias("diagnostic_name"), F.col(c).cast("double").alias("value"))
            for g, n, c in spec
        ]
        return wide.select(split.alias("split"), F.inline(F.array(*structs)))

    def five(c: str, prefix: str) -> list[Column]:
        return [
            F.min(c).alias(f"{prefix}_min"),
            F.max(c).alias(f"{prefix}_max"),
            F.stddev_pop(c).alias(f"{prefix}_std"),
            F.avg(c).alias(f"{prefix}_mean"),
            F.median(c).alias(f"{prefix}_median"),
        ]

    five_names = ["min", "max", "std", "mean", "median"]
    overall = panel.agg(
        F.count("*").alias("rows"),
        F.count_distinct(ident).alias("entities"),
        F.count_distinct("week_start").alias("weeks"),
        *five("accident_count", "t"),
    )
    per_entity = panel_stats(panel, keys)
    entity_wide = per_entity.agg(*five("total_accidents", "n"), *five("mean_weekly_accidents", "m"))
    split_wide = scoped.groupBy("split").agg(
        F.count("*").alias("rows"),
        F.count_distinct("week_start").alias("weeks"),
        F.avg(value).alias("mean"),
        F.var_pop(value).alias("var"),
        F.avg((value == 0).cast("double")).alias("zero"),
    )
    per_split = panel_stats(scoped, ["split", *keys])
    spread = ["total_accidents", "mean_weekly_accidents", "zero_share"]
    distribution = per_split.groupBy("split").agg(
        *[F.avg(c).alias(f"{c}_mean") for c in spread],
        *[F.median(c).alias(f"{c}_median") for c in spread],
        *[F.percentile(c, F.lit(p)).alias(f"{c}_{n}") for c in spread for n, p in (("p10", 0.1), ("p90", 0.9))],
    )
    all_rows = F.lit("overall")
    parts = [
        rows(
            overall,
            all_rows,
            [("panel", "panel_rows", "rows"), ("panel", "retained_rgis", "entities"), ("panel", "total_weeks", "weeks")]
            + [("overall_dense_target", n, f"t_{n}") for n in five_names],
        ),
        rows(
            entity_wide,
            all_rows,
            [("overall_rgi_total_accidents", n, f"n_{n}") for n in five_names]
            + [("overall_rgi_mean_weekly_accidents", n, f"m_{n}") for n in five_names],
        ),
        rows(
            split_wide,
            F.col("split"),
            [
                ("panel", "rows", "rows"),
                ("panel", "weeks", "weeks"),
                ("target", "mean_weekly_accidents", "mean"),
                ("target", "variance_weekly_accidents", "var"),
                ("target", "zero_share", "zero"),
            ],
        ),
        rows(
            distribution,
            F.col("split"),
            [(f"{c}_distribution", n, f"{c}_{n}") for c in spread for n in ("mean", "median", "p10", "p90")],
        ),
    ]
    long = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    ranked = top_and_bottom(per_split, ["split"], "total_accidents", ident, top).select(
        "split",
        F.lit("rgi_rank").alias("diagnostic_group"),
        F.concat(F.col("side"), F.lit("_total_accidents")).alias("diagnostic_name"),
        F.col("total_accidents").cast("double").alias("value"),
        *keys,
        "rank",
    )
    return long.unionByName(ranked, allowMissingColumns=True)


def top_and_bottom(df: DataFrame, by: Sequence[str], value: str, tie: str, n: int = 10) -> DataFrame:
    """The n largest and n smallest rows per group with their rank.

    Spark turns ``row_number <= n`` into a per-task limit before the shuffle, so
    one group never has to be sorted whole.
    """
    sides = []
    for side, order in (("top", F.col(value).desc()), ("bottom", F.col(value).asc())):
        w = Window.partitionBy(*by).orderBy(order, tie)
        sides.append(df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n).withColumn("side", F.lit(side)))
    return sides[0].unionByName(sides[1])


def feature_registry(frame: DataFrame, holiday_prefixes: Sequence[str]) -> DataFrame:
    """Role of every feature-matrix column by its name."""
    rows = [(c, t) for c, t in frame.dtypes]
    table = frame.sparkSession.createDataFrame(rows, "feature_name string, dtype string")
    name = F.col("feature_name")

    def starts(*prefixes: str) -> Column:
        hit = F.lit(False)
        for p in prefixes:
            hit = hit | name.startswith(p)
        return hit

    role = (
        F.when(starts("recent_history_"), "recent_history_feature")
        .when(starts("seasonal_lag_"), "seasonal_feature")
        .when(starts(*holiday_prefixes), "future_holiday_feature")
        .when(starts("rgi_one_hot_") | (name == "rgi_index"), "rgi_identity_feature")
        .when(name.isin("road_length", "scale_feature"), "static_feature")
        .when(starts("target_", "actual_target_"), "target")
        .otherwise("metadata")
    )
    return table.withColumn("role", role).withColumn("included_in_model", F.col("role").endswith("_feature"))


def feature_profile(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts, moments, range and distinct values per column.

    Moments come from one aggregate over the rows (a running variance, exact for large
    means too), distinct values from a second one that counts values first.
    """
    long = frame.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("feature_name"), F.col(c).cast("double").alias("v")) for c in columns])
        )
    )
    moments = long.groupBy("feature_name").agg(
        F.count("v").alias("non_null_count"),
        F.count_if(F.col("v").isNull()).alias("null_count"),
        F.avg("v").alias("mean"),
        F.stddev_pop("v").alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )
    # Counting values first keeps distinct counting skew-free.
    distinct = long.select("feature_name", "v").distinct().groupBy("feature_name").agg(F.count("v").alias("n_unique"))
    return moments.join(distinct, "feature_name")


def feature_tiers(coefficients: DataFrame, audit: DataFrame, label: str) -> DataFrame:
    """Strong, moderate, weak or low evidence per categorical variable.

    ``coefficients`` is the audit joined with pvalue and
    abs_pct_change_vs_reference; ``label`` is "count" or "severity".
    """
    support, least = (
        ("total_accidents", COUNT_LEVEL_MIN) if label == "count" else ("total_people_involved", SEVERITY_LEVEL_MIN)
    )
    shape = audit.groupBy("variable").agg(
        F.max("reference_level_label").alias("reference_level"),
        F.count_if("is_observed").alias("observed_levels"),
        F.count_if(F.col("encoding_status") == "encoded_dummy").alias("dummy_levels"),
        F.count_if(F.col("encoding_status") == "expected_but_unobserved").alias("unobserved_expected_levels"),
        F.coalesce(F.avg(F.when(F.col("is_observed"), (F.col(support) < least).cast("double"))), F.lit(0.0)).alias(
            "sparse_level_share"
        ),
    )
    evidence = (
        coefficients.filter(F.col("encoding_status") == "encoded_dummy")
        .groupBy("variable")
        .agg(
            F.count_if(F.col("pvalue") < STRONG_P).alias("significant_levels_p01"),
            F.count_if(F.col("pvalue") < MODERATE_P).alias("significant_levels_p05"),
            F.coalesce(F.max("abs_pct_change_vs_reference"), F.lit(0.0)).alias("max_abs_pct_change_vs_reference"),
        )
    )
    joined = (
        shape.join(evidence, "variable", "left")
        .fillna(0, ["significant_levels_p01", "significant_levels_p05"])
        .fillna(0.0, ["max_abs_pct_change_vs_reference"])
    )
    effect = F.col("max_abs_pct_change_vs_reference")
    strong = (F.col("significant_levels_p01") > 0) & (effect >= STRONG_EFFECT) & (
        F.col("sparse_level_share") <= SPARSE_SHARE
    )
    some = F.col("significant_levels_p05") > 0
    tier = (
        F.when(strong, "strong")
        .when(some & (effect >= MODERATE_EFFECT), "moderate")
        .when(some | (effect >= MODERATE_EFFECT), "weak")
        .otherwise("low")
    )
    score = F.when(tier == "strong", 3).when(tier == "moderate", 2).when(tier == "weak", 1).otherwise(0)
    done = joined.withColumns({"candidate_tier": tier, "candidate_score": score})
    return done.select("variable", *[F.col(c).alias(f"{label}_{c}") for c in done.columns if c != "variable"])


def overall_ranking(count_tiers: DataFrame, severity_tiers: DataFrame) -> DataFrame:
    """Both screenings side by side with a joint priority and conclusion."""
    joined = count_tiers.join(severity_tiers, "variable", "full")
    score = F.coalesce("count_candidate_score", F.lit(0)) + F.coalesce("severity_candidate_score", F.lit(0))

    def by_score(high: str, mid: str, low: str, none: str) -> Column:
        s = F.col("overall_candidate_score")
        return F.when(s >= 5, high).when(s >= 3, mid).when(s >= 1, low).otherwise(none)

    return joined.withColumn("overall_candidate_score", score).withColumns(
        {
            "reference_level": F.coalesce("count_reference_level", "severity_reference_level"),
            "overall_candidate_tier": by_score("high_priority", "promising", "watchlist", "low_priority"),
            "automatic_conclusion": by_score(
                "retain for both count and severity models",
                "retain selectively and check sparse levels before production use",
                "borderline signal; keep only with domain justification",
                "low-priority covariate candidate",
            ),
        }
    )


