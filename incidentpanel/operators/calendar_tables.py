"""Spines, holiday tables, day weights, streaks and forecast origins.

All tables here are bounded by the calendar (dates or weeks, times the few
states), never by the number of events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from incidentpanel.functions import temporal as T
from incidentpanel.functions.clean import col
from incidentpanel.operators.keys import require_unique

# National holidays on a fixed date (name, month, day, first year).
FIXED_HOLIDAYS = [
    ("Confraternização Universal", 1, 1, 1890),
    ("Tiradentes", 4, 21, 1890),
    ("Dia do Trabalhador", 5, 1, 1925),
    ("Independência do Brasil", 9, 7, 1890),
    ("Nossa Senhora Aparecida", 10, 12, 1980),
    ("Finados", 11, 2, 1890),
    ("Proclamação da República", 11, 15, 1890),
    ("Dia Nacional de Zumbi e da Consciência Negra", 11, 20, 2024),
    ("Natal", 12, 25, 1922),
]

# National holidays relative to Easter Sunday (name, offset in days).
EASTER_HOLIDAYS = [("Sexta-feira Santa", -2)]

HOLIDAY_FEATURES = [
    "prev_week_non_work_day_share",
    "prev_week_longest_non_work_streak",
    "curr_week_non_work_day_share",
    "curr_week_longest_non_work_streak",
    "next_week_non_work_day_share",
    "next_week_longest_non_work_streak",
]


def time_bounds(events: DataFrame, day: str, week: str | None = None, both: bool = False) -> DataFrame:
    """First and last day and week over all events, one row.

    ``both`` restricts to events that have a day and a week.
    """
    w = F.col(week) if week else T.week_start(day)
    d = F.to_date(day)
    usable = (d.isNotNull() & w.isNotNull()) if both else F.lit(True)
    return events.filter(usable).agg(
        F.min(d).alias("min_date"), F.max(d).alias("max_date"), F.min(w).alias("min_week"), F.max(w).alias("max_week")
    )


def spine(frame: DataFrame, lo: Column, hi: Column, name: str, days: int = 1) -> DataFrame:
    """Repeat every row for each step of a date range (a generator, not a join)."""
    step = F.expr(f"interval {int(days)} days")
    return frame.withColumn(name, F.explode(F.sequence(lo, hi, step)))


def date_range(spark: SparkSession, lo: Column, hi: Column, name: str = "date", days: int = 1) -> DataFrame:
    return spine(spark.range(1).drop("id"), lo, hi, name, days)


def weekly_calendar(spark: SparkSession, lo: Column, hi: Column) -> DataFrame:
    """Mondays from ``lo`` to ``hi`` with end, ISO year and week, label and index."""
    weeks = date_range(spark, lo, hi, "week_start", 7)
    return weeks.withColumns(
        {
            "week_end": F.date_add("week_start", 6),
            "iso_year": T.iso_year("week_start"),
            "iso_week": F.weekofyear("week_start"),
            "year_week": T.iso_week_label("week_start"),
            "week_index": (F.datediff("week_start", lo) / 7).cast("int"),
        }
    )


def holiday_table(
    states: DataFrame, first_year: Column, last_year: Column, extras: DataFrame | None = None, state: str = "uf"
) -> DataFrame:
    """Distinct (state, date) holidays: national rules plus an optional extras table.

    ``extras`` has columns state, ``month`` and ``day`` for state holidays.
    """
    years = states.select(state).distinct().withColumn("year", F.explode(F.sequence(first_year, last_year)))
    fixed = F.array(
        *[
            F.struct(F.lit(m).alias("month"), F.lit(d).alias("day"), F.lit(y).alias("since"))
            for _, m, d, y in FIXED_HOLIDAYS
        ]
    )
    on_date = (
        years.select(state, "year", F.inline(fixed))
        .filter(F.col("year") >= F.col("since"))
        .select(state, F.make_date("year", "month", "day").alias("date"))
    )
    offsets = F.array(*[F.lit(offset) for _, offset in EASTER_HOLIDAYS])
    moving = years.select(state, T.easter("year").alias("easter"), F.explode(offsets).alias("offset")).select(
        state, F.date_add("easter", F.col("offset")).alias("date")
    )
    found = on_date.unionByName(moving)
    if extras is not None:
        own = years.join(extras.select(state, "month", "day"), state).select(
            state, F.make_date("year", "month", "day").alias("date")
        )
        found = found.unionByName(own)
    return found.distinct()


def holiday_status(days: DataFrame, holidays: DataFrame, day: str, state: str = "uf") -> DataFrame:
    """Holiday, eve, day after or regular, in that order.

    Each holiday is spread to its three roles, the strongest role per date wins,
    and one equi-join labels the days.
    """
    roles = F.array(
        F.struct(F.lit(0).alias("shift"), F.lit(1).alias("rank"), F.lit("holiday").alias("label")),
        F.struct(F.lit(-1).alias("shift"), F.lit(2).alias("rank"), F.lit("holiday_eve").alias("label")),
        F.struct(F.lit(1).alias("shift"), F.lit(3).alias("rank"), F.lit("day_after_holiday").alias("label")),
    )
    labelled = (
        holidays.select(state, "date", F.inline(roles))
        .withColumn(day, F.date_add("date", F.col("shift")))
        .groupBy(state, day)
        .agg(F.min_by("label", "rank").alias("holiday_status"))
    )
    joined = days.join(labelled, [state, day], "left")
    known = F.col(state).isNotNull() & F.col(day).isNotNull()
    fallback = F.when(known, "regular_day").otherwise("unknown")
    return joined.withColumn("holiday_status", F.coalesce("holiday_status", fallback))


def day_weights(
    days: DataFrame, holidays: DataFrame, state: str = "uf", bridge: float = 0.5, name: str = "weight"
) -> DataFrame:
    """1 for weekends and holidays, ``bridge`` for a workday between two of them, else 0.

    ``days`` holds consecutive dates per state in column ``date``.
    """
    off = holidays.withColumn("is_holiday", F.lit(True))
    order = Window.partitionBy(state).orderBy("date")
    core = F.col("is_weekend") | F.col("is_holiday")
    return (
        days.join(off, [state, "date"], "left")
        .withColumns({"is_weekend": F.weekday("date") >= 5, "is_holiday": F.coalesce("is_holiday", F.lit(False))})
        .withColumn("is_non_work", core)
        .withColumns(
            {
                "before_off": F.lag("is_non_work", 1, False).over(order),
                "after_off": F.lead("is_non_work", 1, False).over(order),
            }
        )
        .withColumn("is_bridge_day", ~F.col("is_non_work") & F.col("before_off") & F.col("after_off"))
        .withColumn(name, F.when(F.col("is_non_work"), 1.0).when(F.col("is_bridge_day"), float(bridge)).otherwise(0.0))
        .drop("before_off", "after_off")
    )


def off_day_streaks(weighted: DataFrame, state: str = "uf", weight: str = "weight", longest: int = 30) -> DataFrame:
    """Weighted off-day stretch directly after and directly before each date.

    A stretch ends at the first workday; at most ``longest`` days count.
    Running zero counts name the stretches, so this is two ordered passes.
    """
    forward = Window.partitionBy(state).orderBy("date")
    backward = Window.partitionBy(state).orderBy(F.col("date").desc())
    work = (F.col(weight) == 0).cast("int")
    runs = weighted.withColumns({"__f": F.sum(work).over(forward), "__b": F.sum(work).over(backward)})
    span = (-(longest - 1), 0)
    ending = F.sum(weight).over(Window.partitionBy(state, "__f").orderBy("date").rowsBetween(*span))
    starting = F.sum(weight).over(Window.partitionBy(state, "__b").orderBy(F.col("date").desc()).rowsBetween(*span))
    return (
        runs.withColumns({"__ending": ending, "__starting": starting})
        .withColumns(
            {
                "days_off_ahead": F.lead("__starting", 1, 0.0).over(forward),
                "days_off_before": F.lag("__ending", 1, 0.0).over(forward),
            }
        )
        .drop("__f", "__b", "__ending", "__starting")
    )


def date_features(
    states: DataFrame,
    lo: Column,
    hi: Column,
    extras: DataFrame | None = None,
    state: str = "uf",
    bridge: float = 0.5,
    longest: int = 30,
) -> DataFrame:
    """Weight and streaks per state and date between ``lo`` and ``hi``.

    The range is widened before the streaks are taken and cut back afterwards.
    """
    margin = longest + 2
    first, last = F.date_sub(lo, margin), F.date_add(hi, margin)
    days = spine(states.select(state).distinct(), first, last, "date")
    holidays = holiday_table(states, F.year(first) - 1, F.year(last) + 1, extras, state)
    weighted = day_weights(days, holidays, state, bridge, "non_working_day_weight")
    streaks = off_day_streaks(weighted, state, "non_working_day_weight", longest)
    return streaks.filter(F.col("date").between(lo, hi)).select(
        state, "date", "non_working_day_weight", "days_off_ahead", "days_off_before"
    )


def longest_streak(scored: DataFrame, keys: Sequence[str], order: str, score: str, name: str) -> DataFrame:
    """Largest sum over consecutive positive scores per group."""
    stops = Window.partitionBy(*keys).orderBy(order)
    run = F.sum((F.col(score) <= 0).cast("int")).over(stops)
    return (
        scored.withColumn("__run", run)
        .groupBy(*keys, "__run")
        .agg(F.sum(F.greatest(F.col(score), F.lit(0.0))).alias("__total"))
        .groupBy(*keys)
        .agg(F.max("__total").alias(name))
    )


def weekly_holiday_features(
    states: DataFrame,
    lo: Column,
    hi: Column,
    extras: DataFrame | None = None,
    state: str = "uf",
    bridge: float = 0.5,
) -> DataFrame:
    """Share of off days and longest streak for the previous, current and next week.

    Weeks outside ``lo``..``hi`` count as zero.
    """
    first, last = F.date_sub(lo, 7), F.date_add(hi, 13)
    days = spine(states.select(state).distinct(), first, last, "date")
    holidays = holiday_table(states, F.year(first), F.year(last), extras, state)
    scored = (
        day_weights(days, holidays, state, bridge, "score")
        .withColumn("week_start", T.week_start("date"))
        .filter(F.col("week_start").between(lo, hi))
    )
    keys = [state, "week_start"]
    share = scored.groupBy(*keys).agg(F.avg("score").alias("share"))
    weekly = share.join(longest_streak(scored, keys, "date", "score", "streak"), keys)
    order = Window.partitionBy(state).orderBy("week_start")
    around = {}
    for when, shift in (("prev", F.lag), ("curr", None), ("next", F.lead)):
        for short, long in (("share", "non_work_day_share"), ("streak", "longest_non_work_streak")):
            value = F.col(short) if shift is None else shift(short, 1, 0.0).over(order)
            around[f"{when}_week_{long}"] = value
    return weekly.withColumns(around).select(
        state,
        "week_start",
        F.date_add("week_start", 6).alias("week_end"),
        T.iso_week_label("week_start").alias("year_week"),
        *HOLIDAY_FEATURES,
    )


def forecast_origins(split_start: Column, split_end: Column, week: Column | str, horizon: int, gap: int) -> dict[str, Column]:
    """Batch start, cutoff and step of a target week; null in an incomplete batch."""
    w = col(week)
    offset = F.floor(F.datediff(w, split_start) / 7).cast("int")
    batch = F.floor(offset / horizon).cast("int")
    start = F.date_add(split_start, batch * (7 * horizon))
    complete = (w >= split_start) & (F.date_add(start, 7 * (horizon - 1)) <= split_end)
    return {
        "forecast_batch_start": F.when(complete, start),
        "cutoff_week_start": F.when(complete, F.date_sub(start, 7 * gap)),
        "horizon_step": F.when(complete, offset % horizon + 1),
    }


def forecast_batches(spark: SparkSession, split_start: Column, split_end: Column, horizon: int, gap: int) -> DataFrame:
    """Non-overlapping batches of ``horizon`` weeks; the last incomplete one is dropped."""
    last = F.date_sub(split_end, 7 * (horizon - 1))
    starts = date_range(spark, split_start, F.greatest(last, split_start), "forecast_batch_start", 7 * horizon)
    return starts.filter(F.col("forecast_batch_start") <= last).withColumn(
        "cutoff_week_start", F.date_sub("forecast_batch_start", 7 * gap)
    )


def future_rows(
    panel: DataFrame,
    static: Sequence[str],
    entity: str,
    day: str,
    horizon: int,
    target: str,
    features: DataFrame | None = None,
    state: str = "uf",
) -> DataFrame:
    """Observed panel followed by ``horizon`` days per entity with unknown target.

    ``features`` holds calendar features per state and ``date``.
    """
    cutoff = panel.agg(F.max(day)).scalar()
    entities = panel.groupBy(entity).agg(
        *[F.max_by(c, day).alias(c) for c in static if c != entity]
    )
    future = spine(entities, F.date_add(cutoff, 1), F.date_add(cutoff, horizon), day).withColumns(
        {
            "year": F.year(day),
            "month": F.month(day),
            "day": F.dayofmonth(day),
            target: F.lit(0).cast(panel.schema[target].dataType),
            "split": F.lit("forecast"),
        }
    )
    if features is not None:
        future = future.join(
            require_unique(features, [state, "date"], "date features").withColumnRenamed("date", day), [state, day], "left"
        )
    return panel.unionByName(future, allowMissingColumns=True)
