"""MiniRocket features (Dempster, Schmidt, Webb 2021) for channel x time samples.

The fit needs only a bounded sample of training windows; the transform runs as
Arrow batches on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidentpanel.operators.windows import is_blocks, unpack

# All ways to place three weights of 2 among nine taps; the rest weigh -1.
TRIPLES = np.array(list(combinations(range(9), 3)))


@dataclass
class Rocket:
    """Fitted kernels: per dilation and triple the channels, biases and padding flag."""

    dilations: list[int]
    channels: list[list[np.ndarray]]
    biases: list[list[np.ndarray]]

    @property
    def n_features(self) -> int:
        return sum(len(b) for per_dilation in self.biases for b in per_dilation)


def _plan(length: int, n_features: int, max_dilations: int) -> tuple[list[int], list[int]]:
    """Dilations spaced exponentially and the number of biases for each."""
    per_kernel = max(n_features // len(TRIPLES), 1)
    limit = np.log2((length - 1) / 8) if length > 9 else 0.0
    count = min(per_kernel, max_dilations)
    raw = np.logspace(0, limit, count, base=2).astype(int)
    dilations, times = np.unique(raw, return_counts=True)
    shares = (times * (per_kernel / count)).astype(int)
    shares[: per_kernel - shares.sum()] += 1
    return dilations.tolist(), shares.tolist()


def _taps(x: np.ndarray, dilation: int) -> list[np.ndarray]:
    """Nine shifted views of the zero-padded series, each (channels, time, samples)."""
    reach = 4 * dilation
    padded = np.pad(x, ((0, 0), (reach, reach), (0, 0)))
    return [padded[:, k * dilation : k * dilation + x.shape[1]] for k in range(9)]


def _response(taps: list[np.ndarray], total: np.ndarray, triple: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Convolution output (time, samples): 3 * sum of the triple's taps - sum of all taps."""
    first, *rest = ((tap, c) for tap in triple for c in used)
    made = taps[first[0]][first[1]].copy()
    for tap, c in rest:
        made += taps[tap][c]
    made *= 3
    for c in used:
        made -= total[c]
    return made


def _by_time(x: np.ndarray) -> np.ndarray:
    """(samples, channels, time) to (channels, time, samples), so sums over time run along memory."""
    return np.ascontiguousarray(x.transpose(1, 2, 0))


def fit(sample: np.ndarray, n_features: int = 10_000, seed: int = 101, max_dilations: int = 32) -> Rocket:
    """Draw channel subsets and take bias quantiles from random sample windows."""
    rng = np.random.default_rng(seed)
    _, n_channels, length = sample.shape
    dilations, shares = _plan(length, n_features, max_dilations)
    most = np.log2(min(n_channels, 9) + 1)
    golden = (np.sqrt(5) + 1) / 2
    all_channels, all_biases, drawn = [], [], 0
    for dilation, share in zip(dilations, shares):
        channels = [
            rng.choice(n_channels, min(n_channels, max(1, int(2 ** rng.uniform(0, most)))), replace=False) for _ in TRIPLES
        ]
        biases = []
        for triple, used in zip(TRIPLES, channels):
            # A window of its own for every kernel and dilation.
            picked = sample[rng.integers(len(sample), size=1)]
            taps = _taps(_by_time(picked), dilation)
            response = _response(taps, sum(taps), triple, used)
            # Low-discrepancy quantiles in (0, 1).
            q = ((drawn + np.arange(1, share + 1)) * golden) % 1
            drawn += share
            biases.append(np.quantile(response[:, 0], q).astype(np.float32))
        all_channels.append(channels)
        all_biases.append(biases)
    return Rocket(dilations, all_channels, all_biases)


def transform(x: np.ndarray, rocket: Rocket) -> np.ndarray:
    """Proportion of positive values per kernel and bias: (samples, features)."""
    series = _by_time(x)
    length = series.shape[1]
    made = np.empty((rocket.n_features, len(x)), np.float32)
    at = 0
    for d, (dilation, channels, biases) in enumerate(zip(rocket.dilations, rocket.channels, rocket.biases)):
        reach = 4 * dilation
        taps = _taps(series, dilation)
        total = sum(taps)
        for k, (triple, used, bias) in enumerate(zip(TRIPLES, channels, biases)):
            response = _response(taps, total, triple, used)
            padded = (d + k) % 2 == 0 or length <= 2 * reach
            window = response if padded else response[reach:-reach]
            # Counts of a short window fit a byte, which adds up fastest.
            kind = np.uint8 if len(window) < 256 else np.uint32
            for b in bias:
                made[at] = (window > b).sum(axis=0, dtype=kind) / np.float32(len(window))
                at += 1
    return np.ascontiguousarray(made.T)


def fit_on(samples: DataFrame, n_features: int, seed: int, sample_size: int = 256) -> Rocket:
    """Fit from a fixed-size, reproducible sample of training windows.

    ``samples`` are rows with a ``sequence`` or blocks; of blocks only the picked windows
    are cut out.  The windows only give bias quantiles, without labels; ``sample_size``
    bounds what the driver reads (a setting of the daily plan).
    """
    unkeyed = ("sequence", "y_raw", "y_scaled", "y_mean", "y_std", "split", "at")
    if is_blocks(samples):
        outer = [c for c in samples.columns if c not in ("block", "lookback", "series", "rows")]
        listed = samples.select(*outer, "block", F.inline("rows"))
        keys = [c for c in listed.columns if c not in (*unkeyed, "block")]
        order = [F.xxhash64(F.lit(seed), *keys), *keys]
        chosen = listed.filter(F.col("split") == "train").orderBy(*order).limit(sample_size).select(*outer, "block", "at", *keys[len(outer) :])
        # At most ``sample_size`` rows are broadcast.
        window = F.slice("series", F.col("at") - F.col("lookback") + 1, F.col("lookback"))
        met = samples.drop("rows").join(F.broadcast(chosen), [*outer, "block"])
        picked = met.orderBy(*order).select(window.alias("steps")).toArrow()
        cube = np.array(picked.column("steps").to_pylist(), dtype=np.float32)
        cube = cube.transpose(0, 2, 1) if cube.ndim == 3 else cube
    else:
        keys = [c for c in samples.columns if c not in unkeyed]
        train = samples.filter(F.col("split") == "train")
        picked = train.orderBy(F.xxhash64(F.lit(seed), *keys), *keys).limit(sample_size).select("sequence").toArrow()
        cube = np.array(picked.column("sequence").to_pylist(), dtype=np.float32)
    if not len(cube):
        raise ValueError("no training windows to fit on")
    return fit(cube, n_features, seed)


def features_of(cube: np.ndarray, rocket: Rocket, chunk: int = 256) -> np.ndarray:
    """Features of many windows, made some hundred at a time."""
    parts = [transform(np.ascontiguousarray(cube[at : at + chunk]), rocket) for at in range(0, len(cube), chunk)]
    return np.concatenate(parts) if parts else np.zeros((0, rocket.n_features), np.float32)


def featurize(samples: DataFrame, rocket: Rocket, chunk: int = 256) -> DataFrame:
    """Rows with ``features`` for rows with a ``sequence`` or for blocks; Arrow batches, no shuffle."""
    shared = samples.sparkSession.sparkContext.broadcast(rocket)
    if is_blocks(samples):
        outer = [f for f in samples.schema.fields if f.name not in ("block", "lookback", "series", "rows")]
        kept = outer + [f for f in samples.schema["rows"].dataType.elementType.fields if f.name != "at"]
    else:
        outer, kept = [], [f for f in samples.schema.fields if f.name != "sequence"]
    schema = T.StructType([*kept, T.StructField("features", T.ArrayType(T.FloatType()))])
    names, entity = [f.name for f in kept], outer[0].name if outer else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # One block at a time, or as many rows as are worked on at once.
            step = 1 if entity else chunk
            for first in range(0, batch.num_rows, step):
                rows, cube = unpack(batch.slice(first, step), entity)
                rows = rows.combine_chunks()
                for at in range(0, len(cube), chunk):
                    made = features_of(cube[at : at + chunk], shared.value, chunk)
                    offsets = pa.array(np.arange(0, made.size + 1, made.shape[1], dtype=np.int32))
                    features = pa.ListArray.from_arrays(offsets, pa.array(made.ravel()))
                    part = rows.slice(at, chunk).combine_chunks()
                    columns = [pa.concat_arrays(part.column(n).chunks) for n in names]
                    yield pa.RecordBatch.from_arrays([*columns, features], [*names, "features"])

    return samples.mapInArrow(run, schema)
