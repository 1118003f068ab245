"""The dashboard's and the API's queries as DataFrame functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidentpanel.functions.clean import first_available
from incidentpanel.functions.temporal import week_start
from incidentpanel.operators.calendar_tables import spine

# Labels shown to users.
HISTORICAL, FORECAST = "histórico", "previsão"
NO_REGION, OTHERS = "Sem região", "Demais"
DATE_ALIASES = ["accident_date", "date", "data", "prediction_date", "ds"]
VALUE_ALIASES = ["accident_count", "predicted_accident_count", "prediction", "yhat", "forecast"]


def metric_frame(panel: DataFrame, entity: str, metric: str) -> DataFrame:
    """Missing entity labels get a name; the metric becomes a number."""
    return panel.withColumns(
        {
            entity: F.coalesce(F.col(entity).cast("string"), F.lit(NO_REGION)),
            metric: F.coalesce(F.col(metric).cast("string").try_cast("double"), F.lit(0.0)),
        }
    )


def by_period(panel: DataFrame, day: str, entity: str, metric: str) -> DataFrame:
    return metric_frame(panel, entity, metric).groupBy(day, entity).agg(F.sum(metric).alias(metric))


def normalise_forecast(forecast: DataFrame, weekly: bool = False, day: str | None = None) -> DataFrame | None:
    """Map alias columns, tag the source; weekly forecasts sum the days of each Monday week."""
    target = day or ("week_start" if weekly else "accident_date")
    source_day = first_available(forecast, [target, *DATE_ALIASES])
    source_value = first_available(forecast, VALUE_ALIASES)
    if source_day is None or source_value is None or "codigo_municipio" not in forecast.columns:
        return None
    when = F.col(source_day).cast("string").try_cast("date")
    names = [c for c in ("nome_municipio",) if c in forecast.columns]
    prepared = forecast.select(
        F.col("codigo_municipio").cast("string").alias("codigo_municipio"),
        *names,
        (week_start(when) if weekly else when).alias(target),
        F.col(source_value).cast("string").try_cast("double").alias("accident_count"),
        F.lit(FORECAST).alias("fonte"),
    ).filter(F.col(target).isNotNull() & F.col("accident_count").isNotNull())
    if not weekly:
        return prepared
    keys = ["codigo_municipio", target, "fonte", *names]
    return (
        prepared.groupBy(*keys)
        .agg(F.sum("accident_count").alias("accident_count"))
        .withColumn("week_end", F.date_add(target, 6))
    )


def merge_forecast(panel: DataFrame, forecast: DataFrame, day: str) -> DataFrame:
    """Panel plus the forecast rows after its last period, same columns."""
    history = panel if "fonte" in panel.columns else panel.withColumn("fonte", F.lit(HISTORICAL))
    cutoff = panel.agg(F.max(day)).scalar()
    labels = [c for c in ("nome_municipio", "sg_uf", "cd_rgint", "nm_rgint") if c in panel.columns]
    towns = panel.groupBy("codigo_municipio").agg(*[F.max_by(c, day).alias(f"__{c}") for c in labels])
    future = forecast.filter(F.col(day) > cutoff).join(towns, "codigo_municipio", "left")
    filled = {c: F.coalesce(c, f"__{c}") if c in forecast.columns else F.col(f"__{c}") for c in labels}
    future = future.withColumns(filled).drop(*[f"__{c}" for c in labels])
    future = future.select(*[c for c in history.columns if c in future.columns])
    return history.unionByName(future, allowMissingColumns=True)


def period_sources(panel: DataFrame, day: str) -> DataFrame:
    """Histórico, Previsão, Misto or - for every period."""
    old = F.count_if(F.col("fonte") == HISTORICAL)
    new = F.count_if(F.col("fonte") == FORECAST)
    known = F.count("fonte")
    label = (
        F.when(known == 0, "-").when(old == known, "Histórico").when(new == known, "Previsão").otherwise("Misto")
    )
    return panel.filter(F.col(day).isNotNull()).groupBy(day).agg(label.alias("source_label"))


def filter_periods(sources: DataFrame, wanted: str) -> DataFrame:
    return sources if wanted == "Todos" else sources.filter(F.col("source_label") == wanted)


def period_rows(panel: DataFrame, day: str, period: Column) -> DataFrame:
    return panel.filter(F.col(day) == period)


def periods(panel: DataFrame, day: str) -> DataFrame:
    return panel.filter(F.col(day).isNotNull()).select(day).distinct().orderBy(day)


def entities(panel: DataFrame, entity: str) -> DataFrame:
    return panel.select(F.coalesce(F.col(entity).cast("string"), F.lit(NO_REGION)).alias(entity)).distinct().orderBy(entity)


def period_kpis(panel: DataFrame, day: str, period: Column, entity: str, metric: str) -> DataFrame:
    """Metric total, active entities, top entity and sources of one period."""
    order = F.struct(F.col(metric), F.col(entity))
    return period_rows(panel, day, period).agg(
        F.coalesce(F.sum(metric), F.lit(0)).alias("metric_total"),
        F.count_if(F.col("accident_count") > 0).alias("active_entities"),
        F.max_by(entity, order).alias("top_entity"),
        F.array_join(F.array_sort(F.collect_set("fonte")), ", ").alias("sources"),
    )


def default_entity(panel: DataFrame, day: str, period: Column, entity: str, metric: str) -> DataFrame:
    rows = by_period(period_rows(panel, day, period), day, entity, metric)
    return rows.orderBy(F.col(metric).desc(), entity).limit(1).select(entity, metric)


def previous_period(panel: DataFrame, day: str, period: Column) -> Column:
    return panel.filter(F.col(day) < period).agg(F.max(day)).scalar()


def last_periods(panel: DataFrame, day: str, period: Column, n: int | None) -> DataFrame:
    """Rows of the last ``n`` periods up to and including ``period``."""
    upto = panel.filter(F.col(day) <= period)
    if n is None:
        return upto
    kept = upto.select(day).distinct().orderBy(F.col(day).desc()).limit(n)
    return upto.filter(F.col(day) >= kept.agg(F.min(day)).scalar())


def ranking(panel: DataFrame, day: str, period: Column, entity: str, metric: str, selected: str) -> DataFrame:
    rows = by_period(period_rows(panel, day, period), day, entity, metric)
    return rows.select(
        entity, metric, F.when(F.col(entity) == selected, "Selecionado").otherwise(OTHERS).alias("destaque")
    ).orderBy(metric, entity)


def period_delta(
    panel: DataFrame, day: str, current: Column, previous: Column, entity: str, metric: str, selected: str, top: int = 18
) -> DataFrame:
    """Change between two periods with status; the largest changes plus the selected entity.

    Both periods are summed in one aggregate; an entity absent in one counts as 0.
    """
    scoped = metric_frame(panel.filter(F.col(day).isin(current, previous)), entity, metric)

    def total(period: Column) -> Column:
        return F.sum(F.when(F.col(day) == period, F.col(metric)).otherwise(0.0))

    change = F.col("variacao")
    delta = (
        scoped.groupBy(entity)
        .agg(total(current).alias("atual"), total(previous).alias("anterior"))
        .withColumn("variacao", F.col("atual") - F.col("anterior"))
        .withColumn(
            "status",
            F.when(F.col(entity) == selected, "Selecionado")
            .when(change > 0, "Aumento")
            .when(change < 0, "Redução")
            .otherwise("Estável"),
        )
    )
    # One row per entity: a single pass ranks the others and keeps the selected one.
    is_own = F.col(entity) == selected
    others = Window.partitionBy(is_own).orderBy(F.abs(change).desc(), entity)
    return delta.withColumn("__n", F.row_number().over(others)).filter(is_own | (F.col("__n") <= top)).drop("__n")


def series_by_source(panel: DataFrame, day: str, entity: str, metric: str) -> DataFrame:
    frame = panel if "fonte" in panel.columns else panel.withColumn("fonte", F.lit(HISTORICAL))
    return metric_frame(frame, entity, metric).groupBy(day, entity, "fonte").agg(F.sum(metric).alias(metric))


def selected_vs_mean(panel: DataFrame, day: str, entity: str, metric: str, selected: str, rolling: int = 4) -> DataFrame:
    """One entity against the mean of all entities, both with a rolling mean.

    Absent entity-periods count as zero, so the mean divides by all entities.
    The rolling windows see one row per period.
    """
    grouped = by_period(panel, day, entity, metric)
    n = grouped.agg(F.count_distinct(entity)).scalar()
    per_period = grouped.groupBy(day).agg(
        F.sum(F.when(F.col(entity) == selected, F.col(metric)).otherwise(0.0)).alias("selected"),
        (F.sum(metric) / n).alias("average"),
    )
    frame = Window.orderBy(day).rowsBetween(-(rolling - 1), 0)
    return per_period.withColumns(
        {"selected_rolling": F.avg("selected").over(frame), "average_rolling": F.avg("average").over(frame)}
    )


def share_over_time(panel: DataFrame, day: str, entity: str, metric: str, selected: str, top: int = 8) -> DataFrame:
    """Share of the largest entities per period; all others form one bucket."""
    grouped = by_period(panel, day, entity, metric)
    totals = grouped.groupBy(entity).agg(F.sum(metric).alias("__t"))
    kept = totals.orderBy(F.col("__t").desc(), entity).limit(top).select(entity, F.lit(True).alias("__kept"))
    # ``top`` rows: small by construction.
    marked = grouped.join(F.broadcast(kept), entity, "left")
    group = F.when(F.col("__kept") | (F.col(entity) == selected), F.col(entity)).otherwise(OTHERS)
    collapsed = marked.groupBy(day, group.alias("grupo")).agg(F.sum(metric).alias(metric))
    total = F.sum(metric).over(Window.partitionBy(day))
    order = F.when(F.col("grupo") == selected, 0).when(F.col("grupo") == OTHERS, 99).otherwise(1)
    return collapsed.withColumns(
        {"participacao": F.col(metric) / F.when(total != 0, total).otherwise(1.0), "ordem": order}
    )


def heatmap(panel: DataFrame, day: str, entity: str, metric: str, values: Sequence[object] | None = None) -> DataFrame:
    """Entity x period matrix with the entity total for ordering.

    Long form by default.  With the list of periods given, one column per period.
    """
    grouped = by_period(panel, day, entity, metric)
    totals = grouped.groupBy(entity).agg(F.sum(metric).alias("total"))
    if values is None:
        lo, hi = grouped.agg(F.min(day)).scalar(), grouped.agg(F.max(day)).scalar()
        observed = grouped.select(day).distinct()
        grid = spine(totals, lo, hi, day).join(observed, day, "left_semi")
        filled = grid.join(grouped, [entity, day], "left")
        return filled.withColumn(metric, F.coalesce(metric, F.lit(0.0)))
    wide = grouped.groupBy(entity).pivot(day, list(values)).agg(F.sum(metric)).fillna(0.0)
    return wide.join(totals, entity).orderBy(F.col("total").desc(), entity)


def period_table(panel: DataFrame, day: str, period: Column, name: str = "nome_municipio") -> DataFrame:
    columns = [name, day, "accident_count", "fatal_accident_count", "fatal_victims", "people_involved", "fonte"]
    return (
        period_rows(panel, day, period)
        .select(*columns)
        .orderBy(F.col("accident_count").desc(), F.col("fatal_victims").desc(), name)
    )


def forecast_lookup(
    forecast: DataFrame,
    entity: str | None = None,
    start: object = None,
    end: object = None,
    limit: int | None = None,
    code: str = "codigo_municipio",
    day: str = "accident_date",
) -> DataFrame:
    """Filtered forecast; ``limit`` takes the first rows by date and code."""
    kept = forecast
    if entity is not None:
        kept = kept.filter(F.col(code).cast("string") == str(entity))
    if start is not None:
        kept = kept.filter(F.col(day).cast("date") >= F.lit(start).cast("date"))
    if end is not None:
        kept = kept.filter(F.col(day).cast("date") <= F.lit(end).cast("date"))
    ordered = kept.orderBy(day, code)
    return ordered.limit(limit) if limit is not None else ordered


def forecast_freshness(panel: DataFrame, manifest: DataFrame, horizon: int, day: str, end: str | None = None) -> DataFrame:
    """Whether the forecast's cutoff is the last period (or lies in it) and the horizon fits."""
    last = panel.agg(F.max(end or day).alias("last_date"), F.max(day).alias("last_start"))
    cutoff = F.col("source_panel_max_date").cast("string").try_cast("date")
    fits = cutoff.between(F.col("last_start"), F.col("last_date")) if end else cutoff == F.col("last_date")
    last_row = last.select(F.struct("*")).scalar()
    checked = manifest.withColumns({"last_date": last_row["last_date"], "last_start": last_row["last_start"]})
    same = F.coalesce(F.col("horizon_days").cast("int"), F.lit(0)) == horizon
    return checked.withColumn("is_current", F.coalesce(fits, F.lit(False)) & same)
