"""Seasonal ARIMA models: candidate grid, validation search, refit per origin.

Orders follow the usual (p, d, q) x (P, D, Q, season) grid with orders of 0 and 1.  Each
candidate is fitted by its exact likelihood (``statespace``) and refitted at every
origin; all origins of a series are filtered in one pass.  Spark spreads the pairs of an entity and a way to
difference its series; the candidates of a pair share one differenced series and are
fitted together.  A series is as long as the calendar.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import date
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentpanel.models import statespace
from incidentpanel.operators.calendar_tables import forecast_batches
from incidentpanel.operators.evaluate import evaluate_by

ORDER_FIELDS = ["p", "d", "q", "sp", "sd", "sq"]


def candidate_grid() -> list[tuple[int, ...]]:
    """All 63 non-empty 0/1 order combinations."""
    return [c for c in product([0, 1], repeat=6) if any(c)]


def order_label(order: tuple[int, ...], season: int) -> str:
    p, d, q, sp, sd, sq = order
    return f"({p}, {d}, {q}) x ({sp}, {sd}, {sq}, {season})"


def differenced(y: np.ndarray, d: int, sd: int, season: int) -> list[np.ndarray]:
    """The series and its successive differences, the last one stationary by assumption."""
    levels = [np.asarray(y, dtype=float)]
    for lag in [1] * d + [season] * sd:
        if len(levels[-1]) <= lag:
            raise ValueError("history too short for differencing")
        levels.append(_difference(levels[-1], lag))
    return levels


def undo(levels: list[np.ndarray], d: int, sd: int, season: int, ahead: np.ndarray) -> np.ndarray:
    """Forecasts of the series from those of its last difference."""
    for level, lag in zip(reversed(levels[:-1]), reversed([1] * d + [season] * sd), strict=True):
        known = list(level)
        for step in ahead:
            known.append(known[-lag] + step)
        ahead = np.asarray(known[len(level) :])
    return ahead


def _difference(y: np.ndarray, lag: int) -> np.ndarray:
    return y[lag:] - y[:-lag]


def _lagged(y: np.ndarray, lags: list[int], start: int) -> np.ndarray:
    return np.column_stack([y[start - k : len(y) - k] for k in lags]) if lags else np.empty((len(y) - start, 0))


def fit_forecast(y: np.ndarray, order: tuple[int, ...], season: int, steps: int) -> np.ndarray:
    """Fit one candidate by least squares on lags (quick, conditional) and extend it by ``steps`` values.

    Moving-average terms use the residuals of a first long regression (Hannan-Rissanen).
    """
    p, d, q, sp, sd, sq = order
    levels = differenced(y, d, sd, season)
    z = levels[-1]
    ar = [1] * p + [season] * sp
    ma = [1] * q + [season] * sq
    resid = np.zeros_like(z)
    start = max(ar + ma, default=0)
    if ma:
        long_lags = [1, 2, 3, 4]
        if len(z) <= start + len(long_lags) + 2:
            raise ValueError("history too short for moving-average terms")
        design = _lagged(z, long_lags, 4)
        beta = np.linalg.lstsq(design, z[4:], rcond=None)[0]
        resid[4:] = z[4:] - design @ beta
    if len(z) <= start + len(ar) + len(ma) + 1:
        raise ValueError("history too short")
    weights = np.empty(0)
    if ar or ma:
        design = np.hstack([_lagged(z, ar, start), _lagged(resid, ma, start)])
        weights = np.linalg.lstsq(design, z[start:], rcond=None)[0]
    values, errors = list(z), list(resid)
    for _ in range(steps):
        terms = [values[-k] for k in ar] + [errors[-k] for k in ma]
        values.append(float(np.dot(weights, terms)) if terms else 0.0)
        errors.append(0.0)
    ahead = np.asarray(values[len(z) :])
    ahead = undo(levels, d, sd, season, ahead)
    if not np.all(np.isfinite(ahead)):
        raise ValueError("forecast diverged")
    return ahead


def entity_series(panel: DataFrame) -> DataFrame:
    """One row per entity with its ordered weekly series (length bounded by the calendar)."""
    step = F.struct("week_start", F.col("accident_count").cast("double").alias("n"))
    return (
        panel.groupBy("rgi_id", "rgi_name", "uf")
        .agg(F.array_sort(F.collect_list(step)).alias("__s"))
        .select(
            "rgi_id",
            "rgi_name",
            "uf",
            F.transform("__s", lambda s: s["week_start"]).alias("weeks"),
            F.transform("__s", lambda s: s["n"]).alias("counts"),
        )
    )


def _with_batches(tasks: DataFrame, split: str, bounds: tuple[date, date], horizon: int, gap: int) -> DataFrame:
    spark = tasks.sparkSession
    batches = forecast_batches(spark, F.lit(bounds[0]), F.lit(bounds[1]), horizon, gap)
    listed = batches.agg(F.array_sort(F.collect_list(F.struct("forecast_batch_start", "cutoff_week_start")))).scalar()
    return tasks.withColumns({"split": F.lit(split), "batches": listed})


def exact_forecasts(
    y: np.ndarray, ends: list[int], orders: list[tuple[int, ...]], season: int, steps: int, tolerance: float = 1e-3
) -> np.ndarray:
    """Forecasts (origins, candidates, steps) of candidates that difference alike, fitted by exact likelihood.

    At each origin the series is its first ``ends[k]`` values.  A candidate whose forecast
    is not finite, or which has no more values than parameters, gets NaN there.
    """
    _, d, _, _, sd, _ = orders[0]
    lost = d + season * sd
    if min(ends) <= lost:
        raise ValueError("history too short for differencing")
    z = differenced(y, d, sd, season)[-1]
    used = np.array([[o[0], o[2], o[3], o[5]] for o in orders], dtype=bool)
    lengths = np.array(ends) - lost
    free = statespace.fit_origins(z, used, season, lengths, tolerance)
    ahead = statespace.extend(z, free.reshape(-1, free.shape[2]), season, steps, np.repeat(lengths, len(orders)))
    made = ahead.reshape(len(ends), len(orders), steps)
    for k, end in enumerate(ends):
        levels = differenced(y[:end], d, sd, season)
        made[k] = [undo(levels, d, sd, season, values) for values in made[k]]
        made[k, lengths[k] <= used.sum(axis=1) + 1] = np.nan
    return made


def _forecaster(season: int, horizon: int, gap: int, tolerance: float):
    """Batch function: one input row is one entity with candidates that difference alike."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for task in frame.itertuples(index=False):
                orders = [tuple(int(o[f]) for f in ORDER_FIELDS) for o in task.orders]
                weeks = np.asarray(task.weeks, dtype="datetime64[D]")
                counts = np.asarray(task.counts, dtype=float)
                where = {w: i for i, w in enumerate(weeks)}
                made: list[list[tuple]] = [[] for _ in orders]
                failures: list[str | None] = [None] * len(orders)
                try:
                    cutoffs = [np.datetime64(batch["cutoff_week_start"], "D") for batch in task.batches]
                    ends = [int((weeks <= cutoff).sum()) for cutoff in cutoffs]
                    ahead = exact_forecasts(counts, ends, orders, season, gap + horizon - 1, tolerance) if ends else []
                    for batch, cutoff, forecast in zip(task.batches, cutoffs, ahead, strict=True):
                        start = np.datetime64(batch["forecast_batch_start"], "D")
                        for k, values in enumerate(forecast[:, gap - 1 :]):
                            if not np.all(np.isfinite(values)):
                                failures[k] = failures[k] or "ValueError: no finite forecast"
                                continue
                            for step in range(horizon):
                                target = start + np.timedelta64(7 * step, "D")
                                actual = counts[where[target]] if target in where else None
                                made[k].append((start, cutoff, target, step + 1, max(float(values[step]), 0.0), actual))
                except Exception as problem:  # a failed candidate must not stop the search
                    failures = [f"{type(problem).__name__}: {problem}"] * len(orders)
                for order, predictions, failure in zip(orders, made, failures, strict=True):
                    base = (task.rgi_id, task.rgi_name, task.uf, task.split, order_label(order, season), *order)
                    if failure is None:
                        rows += [(*base, "success", "", *m) for m in predictions]
                    else:
                        rows.append((*base, "failed", failure, *([None] * 6)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _SCHEMA.split(", ")])

    return run


_SCHEMA = ", ".join(
    [
        "rgi_id string",
        "rgi_name string",
        "uf string",
        "split string",
        "spec string",
        *[f"{f} int" for f in ORDER_FIELDS],
        "status string",
        "failure_reason string",
        "forecast_batch_start date",
        "cutoff_week_start date",
        "week_start date",
        "horizon_step int",
        "prediction double",
        "actual double",
    ]
)


def candidate_forecasts(
    series: DataFrame,
    candidates: list[tuple[int, ...]],
    split: str,
    bounds: tuple[date, date],
    horizon: int = 4,
    gap: int = 4,
    season: int = 52,
    tolerance: float = 1e-3,
) -> DataFrame:
    """Forecasts of every candidate for every entity over one split's batches."""
    alike: dict[tuple[int, int], list[tuple[int, ...]]] = {}
    for c in candidates:
        alike.setdefault((c[1], c[4]), []).append(c)

    def listed(orders: list[tuple[int, ...]]) -> Column:
        return F.array(*[F.struct(*[F.lit(v).alias(f) for f, v in zip(ORDER_FIELDS, c, strict=True)]) for c in orders])

    tasks = series.select("*", F.explode(F.array(*[listed(x) for x in alike.values()])).alias("orders"))
    # Heavy work on few rows: one partition for each entity and way to difference.
    keys = ["rgi_id", F.col("orders")[0]["d"], F.col("orders")[0]["sd"]]
    tasks = tasks.repartition(max(1, 4 * series.sparkSession.sparkContext.defaultParallelism), *keys)
    batched = _with_batches(tasks, split, bounds, horizon, gap)
    return batched.mapInPandas(_forecaster(season, horizon, gap, tolerance), _SCHEMA)


def select_candidates(validation: DataFrame) -> DataFrame:
    """Diagnostics per entity and candidate; the lowest validation RMSE is selected.

    Failed candidates stay as rows.  Ties go to the first candidate in grid order.
    """
    keys = ["rgi_id", "rgi_name", "uf", "spec", *ORDER_FIELDS, "status", "failure_reason"]
    scored = evaluate_by(validation, ["rgi_id", "spec"]).select("rgi_id", "spec", F.col("rmse").alias("validation_rmse"))
    counts = validation.groupBy(*keys).agg(F.count("prediction").alias("n_predictions"))
    joined = counts.join(scored, ["rgi_id", "spec"], "left")
    best = (
        joined.filter(F.col("validation_rmse").isNotNull())
        .groupBy("rgi_id")
        .agg(F.min_by("spec", F.struct("validation_rmse", *ORDER_FIELDS)).alias("__best"))
    )
    return (
        joined.join(best, "rgi_id", "left")
        .withColumn("is_selected", F.coalesce(F.col("spec") == F.col("__best"), F.lit(False)))
        .drop("__best")
    )


def selected_forecasts(
    series: DataFrame,
    diagnostics: DataFrame,
    ranges: Mapping[str, tuple[date, date]],
    horizon: int = 4,
    gap: int = 4,
    season: int = 52,
    tolerance: float = 1e-3,
) -> DataFrame:
    """Refit each entity's selected candidate at every origin of the given splits."""
    chosen = diagnostics.filter("is_selected").select("rgi_id", F.array(F.struct(*ORDER_FIELDS)).alias("orders"))
    tasks = series.join(chosen, "rgi_id")
    made = None
    for split, bounds in ranges.items():
        part = _with_batches(tasks, split, bounds, horizon, gap).mapInPandas(_forecaster(season, horizon, gap, tolerance), _SCHEMA)
        made = part if made is None else made.unionByName(part)
    return made.filter(F.col("status") == "success").select(
        F.lit("sarima").alias("model"),
        "split",
        "rgi_id",
        "rgi_name",
        "uf",
        "week_start",
        "forecast_batch_start",
        "cutoff_week_start",
        "horizon_step",
        "prediction",
        "actual",
        F.lit(True).alias("is_available"),
        F.col("spec").alias("metadata"),
    )
