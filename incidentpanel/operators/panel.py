"""Event counts and dense entity x time panels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentpanel.functions import temporal as T
from incidentpanel.functions.clean import clean_text, code_text
from incidentpanel.functions.labels import safe_share, split_by_range
from incidentpanel.operators.calendar_tables import HOLIDAY_FEATURES, spine
from incidentpanel.operators.keys import apply_exclusions, require_unique

MEASURES = ["accident_count", "fatal_victims", "people_involved", "fatal_accident_count"]


def with_victims(events: DataFrame, deaths: str = "mortos", people: str = "pessoas") -> DataFrame:
    """Missing victim counts are zero; flag fatal events."""
    return events.withColumns(
        {
            deaths: F.coalesce(F.col(deaths).cast("double"), F.lit(0.0)),
            people: F.coalesce(F.col(people).cast("double"), F.lit(0.0)),
            "has_fatality": F.coalesce(F.col(deaths).cast("double"), F.lit(0.0)) > 0,
        }
    )


def event_measures(deaths: str = "mortos", people: str = "pessoas") -> list[Column]:
    fatal = F.coalesce(F.col(deaths).cast("double"), F.lit(0.0))
    return [
        F.count("*").alias("accident_count"),
        F.sum(fatal).alias("fatal_victims"),
        F.sum(F.coalesce(F.col(people).cast("double"), F.lit(0.0))).alias("people_involved"),
        F.count_if(fatal > 0).alias("fatal_accident_count"),
    ]


def count_events(events: DataFrame, keys: Sequence[str], deaths: str = "mortos", people: str = "pessoas") -> DataFrame:
    """The four measures per key (entity x day, entity x week, section x week).

    Partial aggregation runs before the shuffle, so a hot entity costs at most
    one row per task and period.
    """
    return events.groupBy(*keys).agg(*event_measures(deaths, people))


def zero_filled(grid: DataFrame, counts: DataFrame, keys: Sequence[str], measures: Sequence[str] = MEASURES) -> DataFrame:
    joined = grid.join(counts.select(*keys, *measures), list(keys), "left")
    return joined.withColumns(
        {m: F.coalesce(F.col(m), F.lit(0).cast(counts.schema[m].dataType)) for m in measures}
    )


def day_panel(entities: DataFrame, counts: DataFrame, entity: str, day: str, lo: Column, hi: Column) -> DataFrame:
    """Every entity on every day, zero-filled."""
    grid = spine(entities, lo, hi, day)
    return zero_filled(grid, counts, [entity, day]).withColumns(
        {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}
    )


def week_panel(entities: DataFrame, counts: DataFrame, entity: str, lo: Column, hi: Column, week: str = "week_start") -> DataFrame:
    """Every entity (or section) in every week, zero-filled, with shares."""
    grid = spine(entities, lo, hi, week, 7)
    return zero_filled(grid, counts, [entity, week]).withColumns(
        {
            "week_end": F.date_add(week, 6),
            "year": F.year(week),
            "month": F.month(week),
            "quarter": F.quarter(week),
            "fatal_victim_share": safe_share("fatal_victims", "people_involved"),
            "fatal_accident_share": safe_share("fatal_accident_count", "accident_count"),
            "level_observed": F.col("accident_count") > 0,
        }
    )


def territory_metadata(sections: DataFrame, territory: str, labels: Sequence[str]) -> DataFrame:
    """Road length, section count and labels per territory that owns a section."""
    return sections.groupBy(territory).agg(
        *[F.min_by(c, "section_id").alias(c) for c in labels],
        F.sum(F.coalesce("road_length_m", F.lit(0.0))).alias("road_length_m"),
        F.count("*").alias("section_count"),
    )


def weekly_targets(events: DataFrame, calendar: DataFrame, entity: str = "rgi_id") -> DataFrame:
    """Sparse weekly event counts with their calendar labels."""
    counts = events.groupBy(entity, "week_start").agg(F.count("*").alias("accident_count"))
    return counts.join(calendar.select("week_start", "week_end", "year_week", "iso_year", "iso_week"), "week_start", "left")


def modelling_events(
    canonical: DataFrame, exclusions: DataFrame, static: DataFrame, lo: Column, hi: Column
) -> DataFrame:
    """Valid, not excluded, in-window events of known regions, with static features."""
    state = clean_text("uf", upper=True)
    usable = (
        canonical.filter(F.col("timestamp").isNotNull())
        .withColumns({"uf": state, "accident_uf": state, "year": F.col("year").cast("int")})
        .filter(F.col("year").isNotNull())
    )
    kept = (
        apply_exclusions(usable, exclusions, "exclude_from_modeling")
        .withColumns({"rgi_id": code_text("codigo_rgi"), "week_start": T.week_start("timestamp")})
        .filter(F.col("week_start").between(lo, hi) & F.col("rgi_id").isNotNull())
    )
    features = static.select("rgi_id", "rgi_name", F.col("uf").alias("__uf"), "br101_length_km_in_rgi")
    return (
        kept.join(features, "rgi_id")
        .withColumns({"uf": F.col("__uf"), "rgi_name": F.coalesce("rgi_name", "nome_rgi")})
        .select(
            "id", "timestamp", "year", "accident_uf", "uf", "rgi_id", "rgi_name", "week_start", "br101_length_km_in_rgi"
        )
    )


def funnel_flags(
    canonical: DataFrame, exclusions: DataFrame, static: DataFrame, lo: Column, hi: Column
) -> tuple[DataFrame, dict[str, Column]]:
    """Events with the lookups of the preparation steps, and each step as a flag.

    The lookups are left joins on small distinct keys, so the events keep their rows.
    """
    listed = (
        exclusions.filter(F.coalesce("exclude_from_modeling", F.lit(False)))
        .select(F.col("uf").alias("__uf"), F.col("year").alias("__year"))
        .distinct()
        .withColumn("__excluded", F.lit(True))
    )
    regions = (
        static.select(
            F.col("rgi_id").alias("__rgi"),
            F.struct(F.col("rgi_name").alias("rgi_name"), F.col("uf").alias("uf"), "br101_length_km_in_rgi").alias("__static"),
        )
        .groupBy("__rgi")
        .agg(F.min("__static").alias("__static"))
        .withColumn("__known", F.lit(True))
    )
    flagged = (
        canonical.withColumns({"__state": clean_text("uf", upper=True), "__region": code_text("codigo_rgi")})
        .join(listed, F.col("__state").eqNullSafe(F.col("__uf")) & F.col("year").eqNullSafe(F.col("__year")), "left")
        .join(regions, F.col("__region") == F.col("__rgi"), "left")
    )
    valid = F.col("timestamp").isNotNull()
    kept = valid & F.col("__excluded").isNull()
    used = kept & F.col("year").isNotNull() & F.col("__known").isNotNull() & T.week_start("timestamp").between(lo, hi)
    return flagged, {"valid": valid, "kept": kept, "used": used}


def modelling_columns(used: DataFrame) -> DataFrame:
    """The modelling event set from flagged events that are used."""
    return used.select(
        "id",
        "timestamp",
        F.col("year").cast("int").alias("year"),
        F.col("__state").alias("accident_uf"),
        F.col("__static.uf").alias("uf"),
        F.col("__region").alias("rgi_id"),
        F.coalesce(F.col("__static.rgi_name"), F.col("nome_rgi")).alias("rgi_name"),
        T.week_start("timestamp").alias("week_start"),
        F.col("__static.br101_length_km_in_rgi").alias("br101_length_km_in_rgi"),
    )


def preparation_funnel(
    canonical: DataFrame, exclusions: DataFrame, static: DataFrame, lo: Column, hi: Column
) -> DataFrame:
    """Rows left after each preparation step, in long form, from one pass over the events."""
    flagged, flags = funnel_flags(canonical, exclusions, static, lo, hi)
    valid, kept, used = flags["valid"], flags["kept"], flags["used"]
    row = flagged.agg(
        F.count("*").alias("canonical_accidents_loaded"),
        F.count_if(valid).alias("rows_with_valid_timestamp"),
        F.count_if(kept).alias("rows_after_manual_exclusions"),
        F.count_if(used).alias("rows_after_outer_window_filter"),
        F.count_distinct(F.when(used, F.col("__region"))).alias("retained_rgis"),
    )
    return stack_row(row, "step", "rows")


def stack_row(row: DataFrame, key: str, value: str, kind: str = "bigint") -> DataFrame:
    """Turn one wide row into (name, value) rows."""
    return row.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias(key), F.col(c).cast(kind).alias(value)) for c in row.columns]))
    )


def dense_weekly_panel(
    static: DataFrame, targets: DataFrame, holidays: DataFrame, lo: Column, hi: Column, grouped: bool = False
) -> DataFrame:
    """Region x week modelling panel; fails unless it is unique per region and week.

    ``grouped`` tells that the targets were just grouped by region and week.
    """
    grid = spine(require_unique(static, ["rgi_id"], "static features"), lo, hi, "week_start", 7).withColumns(
        {
            "week_end": F.date_add("week_start", 6),
            "iso_year": T.iso_year("week_start"),
            "iso_week": F.weekofyear("week_start"),
            "year_week": T.iso_week_label("week_start"),
            "week_index": (F.datediff("week_start", lo) / 7).cast("int"),
        }
    )
    counts = targets if grouped else require_unique(targets, ["rgi_id", "week_start"], "weekly targets")
    counted = grid.join(counts.select("rgi_id", "week_start", "accident_count"), ["rgi_id", "week_start"], "left")
    joined = counted.join(holidays.select("uf", "week_start", *HOLIDAY_FEATURES), ["uf", "week_start"], "left")
    return joined.withColumn("accident_count", F.coalesce("accident_count", F.lit(0)).cast("int")).fillna(
        0.0, subset=HOLIDAY_FEATURES
    )


def with_week_splits(panel: DataFrame, ranges: Mapping[str, tuple[date, date]]) -> DataFrame:
    labelled = panel.withColumn("split", split_by_range("week_start", ranges))
    return labelled.withColumns({f"is_{name}": F.col("split") == name for name in ranges})


def split_manifest(panel: DataFrame) -> DataFrame:
    columns = ["rgi_id", "rgi_name", "uf", "week_start", "week_end", "year_week", "split"]
    return panel.select(*columns, "is_train", "is_validation", "is_test")
