"""One ridge regression per entity, scoring as expressions, recursive forecasts."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from incidentpanel.models import minirocket
from incidentpanel.operators.windows import is_blocks, keep_rows, unpack

# Default ridge penalties.
ALPHAS = (10.0, 30.0, 100.0, 300.0, 1000.0, 3000.0, 10000.0, 30000.0)


def solve_path(x: np.ndarray, y: np.ndarray, alphas: Sequence[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coefficients, intercepts and leave-one-out errors for all penalties from one decomposition."""
    x_mean, y_mean = x.mean(axis=0), y.mean()
    centred = x - x_mean
    if x.shape[1] > x.shape[0]:
        # More features than rows: the small Gram matrix gives the same decomposition.
        squares, u = np.linalg.eigh(centred @ centred.T)
        squares = np.maximum(squares, 0.0)
    else:
        u, s, _ = np.linalg.svd(centred, full_matrices=False)
        squares = s**2
    rotated = u.T @ (y - y_mean)
    coefs, intercepts, loo = [], [], []
    for alpha in alphas:
        shrink = squares / (squares + alpha)
        beta = centred.T @ (u @ (rotated / (squares + alpha)))
        leverage = ((u**2) * shrink).sum(axis=1) + 1.0 / len(y)
        fitted = u @ (shrink * rotated) + y_mean
        coefs.append(beta)
        intercepts.append(y_mean - x_mean @ beta)
        loo.append(np.mean(((y - fitted) / np.maximum(1.0 - leverage, 1e-12)) ** 2))
    return np.array(coefs), np.array(intercepts), np.array(loo)


def _rows(group: pa.Table, entity: str, rocket: minirocket.Rocket | None) -> tuple[pa.Table, np.ndarray]:
    """Columns of a group's samples, and their features as given or the windows to make them from."""
    if rocket is not None:
        return unpack(group, entity)
    flat = group.column("features").combine_chunks()
    return group, flat.flatten().to_numpy(zero_copy_only=False).reshape(len(group), -1)


def _matrix(values: np.ndarray, rocket: minirocket.Rocket | None) -> np.ndarray:
    return values.astype(float) if rocket is None else minirocket.features_of(values, rocket)


def train_per_entity(
    features: DataFrame,
    entity: str,
    alphas: Sequence[float] = ALPHAS,
    selection_split: str = "validation",
    rocket: minirocket.Rocket | None = None,
) -> DataFrame:
    """One model row per entity.

    With ``rocket`` the rows are blocks or carry sequences, and features are made inside
    the entity's task: neither they nor the windows of blocks are stored or shuffled.

    The penalty with the lowest error on the selection split wins; without such
    rows the leave-one-out error decides.  A group holds one entity's windows,
    at most one per calendar day.
    """
    grid = [float(a) for a in alphas]
    kind = features.schema[entity].dataType
    shared = features.sparkSession.sparkContext.broadcast(rocket)

    def fit(group: pa.Table) -> pa.Table:
        group, values = _rows(group, entity, shared.value)
        split = np.array(group.column("split").to_pylist(), dtype=object)
        learn = np.flatnonzero(split == "train")
        if not len(learn):
            return target.empty_table()
        train = group.take(learn)
        y = train.column("y_scaled").to_numpy()
        coefs, intercepts, loo = solve_path(_matrix(values[learn], shared.value).astype(float), y, grid)
        check = np.flatnonzero(split == selection_split)
        chosen = group.take(check)
        if not len(chosen):
            best, score = int(np.argmin(loo)), None
        else:
            made = _matrix(values[check], shared.value) @ coefs.T + intercepts
            errors = ((made - chosen.column("y_scaled").to_numpy()[:, None]) ** 2).mean(axis=0)
            best, score = int(np.argmin(errors)), float(errors.min())
        first = train.slice(0, 1).select([entity, "y_mean", "y_std"]).to_pylist()[0]
        row = [first[entity], grid[best], score, len(train), coefs[best].tolist(), float(intercepts[best]), first["y_mean"], first["y_std"]]
        return pa.Table.from_pylist([dict(zip(target.names, row))], target)

    schema = T.StructType(
        [
            T.StructField(entity, kind),
            T.StructField("alpha", T.DoubleType()),
            T.StructField("selection_score", T.DoubleType()),
            T.StructField("n_train", T.LongType()),
            T.StructField("coefficients", T.ArrayType(T.DoubleType())),
            T.StructField("intercept", T.DoubleType()),
            T.StructField("y_mean", T.DoubleType()),
            T.StructField("y_std", T.DoubleType()),
        ]
    )
    target = to_arrow_schema(schema)
    if is_blocks(features):
        needed = keep_rows(features, lambda r: r["split"].isin("train", selection_split))
    else:
        needed = features.filter(F.col("split").isin("train", selection_split)).select(
            entity, "split", "features" if rocket is None else "sequence", "y_scaled", "y_mean", "y_std"
        )
    return needed.groupBy(entity).applyInArrow(fit, schema)


def score_samples(samples: DataFrame, models: DataFrame, entity: str, rocket: minirocket.Rocket) -> DataFrame:
    """Like ``score`` for blocks or rows with sequences: each entity meets its model in one task.

    Entities without a model have no rows.
    """
    kept = [f for f in samples.schema.fields if f.name not in ("sequence", "block", "lookback", "series", "rows")]
    if is_blocks(samples):
        kept += [f for f in samples.schema["rows"].dataType.elementType.fields if f.name != "at"]
    schema = T.StructType([*kept, T.StructField("prediction_scaled", T.DoubleType())])
    target = to_arrow_schema(schema)
    shared = samples.sparkSession.sparkContext.broadcast(rocket)

    def run(rows: pa.Table, model: pa.Table) -> pa.Table:
        if not len(rows) or not len(model):
            return target.empty_table()
        weights = np.array(model.column("coefficients")[0].as_py())
        rows, values = _rows(rows, entity, shared.value)
        made = _matrix(values, shared.value) @ weights + model.column("intercept")[0].as_py()
        return rows.append_column("prediction_scaled", pa.array(made)).select(target.names).cast(target)

    pairs = samples.groupBy(entity).cogroup(models.select(entity, "coefficients", "intercept").groupBy(entity))
    return (
        pairs.applyInArrow(run, schema)
        .withColumn("prediction", F.col("prediction_scaled") * F.col("y_std") + F.col("y_mean"))
        .withColumn("predicted_accident_count", F.greatest("prediction", F.lit(0.0)))
    )


def score(features: DataFrame, models: DataFrame, entity: str, strict: bool = True) -> DataFrame:
    """Scaled and raw predictions: a join and a dot product, no Python.

    ``prediction`` stays unclipped for evaluation; ``predicted_accident_count``
    is clipped at zero.  An entity without a model stops the job when ``strict``.
    """
    joined = features.join(models.select(entity, "coefficients", "intercept"), entity, "left")
    if strict:
        absent = F.raise_error(F.concat(F.lit("no model for "), F.col(entity).cast("string"))).cast("boolean")
        joined = joined.filter(F.when(F.col("coefficients").isNull(), absent).otherwise(F.lit(True)))
    products = F.zip_with("features", "coefficients", lambda f, c: f * c)
    scaled = F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v) + F.col("intercept")
    return (
        joined.withColumn("prediction_scaled", scaled)
        .withColumn("prediction", F.col("prediction_scaled") * F.col("y_std") + F.col("y_mean"))
        .withColumn("predicted_accident_count", F.greatest("prediction", F.lit(0.0)))
        .drop("features", "coefficients", "intercept")
    )


def recursive_forecast(
    panel: DataFrame,
    models: DataFrame,
    rocket: minirocket.Rocket,
    entity: str,
    day: str,
    channels: Sequence[str],
    lookback: int,
    target: str = "accident_count",
) -> DataFrame:
    """Day-by-day forecast of the rows whose split is ``forecast``.

    Entities are independent, so each runs its whole horizon inside one task:
    every clipped prediction becomes history for the next window.  ``channels``
    are the exogenous columns behind the scaled count, in training order.  Only
    the last ``lookback`` observed days and the horizon enter the group.
    """
    kind = panel.schema[entity].dataType
    first = panel.filter(F.col("split") == "forecast").agg(F.min(day)).scalar()
    recent = panel.filter(F.col(day) >= F.date_sub(first, lookback)).select(entity, day, "split", target, *channels)
    joined = recent.join(models.select(entity, "coefficients", "intercept", "y_mean", "y_std"), entity)
    shared = panel.sparkSession.sparkContext.broadcast(rocket)
    names = list(channels)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(day).reset_index(drop=True)
        head = frame.iloc[0]
        mean, std = float(head["y_mean"]), float(head["y_std"])
        weights, bias = np.asarray(head["coefficients"], dtype=float), float(head["intercept"])
        counts = frame[target].to_numpy(float)
        outside = frame[names].to_numpy(np.float32).T
        rows = []
        for at in np.flatnonzero((frame["split"] == "forecast").to_numpy()):
            if at < lookback:
                raise ValueError(f"not enough history: need {lookback} days, found {at}")
            window = np.vstack([(counts[at - lookback : at] - mean) / std, outside[:, at - lookback : at]])
            made = minirocket.transform(window[None].astype(np.float32), shared.value)[0]
            scaled = float(made @ weights + bias)
            raw = scaled * std + mean
            counts[at] = max(raw, 0.0)
            rows.append((head[entity], frame[day][at], counts[at], raw, scaled, len(rows) + 1))
        return pd.DataFrame(rows, columns=[f.name for f in schema.fields])

    schema = T.StructType(
        [
            T.StructField(entity, kind),
            T.StructField(day, T.DateType()),
            T.StructField("predicted_accident_count", T.DoubleType()),
            T.StructField("prediction_raw", T.DoubleType()),
            T.StructField("prediction_scaled", T.DoubleType()),
            T.StructField("forecast_horizon_day", T.IntegerType()),
        ]
    )
    return joined.groupBy(entity).applyInPandas(run, schema)
