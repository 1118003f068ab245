"""Windows cut from halo blocks, against windows cut from whole series."""

from __future__ import annotations

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from incidentpanel.models import minirocket, ridge
from incidentpanel.operators import windows as N

ENTITIES = {"a": 50, "b": 7, "c": 8, "d": 31, "e": 1}


def panel(spark):
    rng = random.Random(2)
    rows = [(e, date(2020, 1, 1) + timedelta(days=i), float(rng.randint(0, 9)), float(i)) for e, n in ENTITIES.items() for i in range(n)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "town string, day date, x double, y double").withColumn(
        "split", F.when(F.col("day") < "2020-01-21", "train").otherwise("validation")
    )


def plain_windows(rows, lookback):
    made = {}
    for entity in ENTITIES:
        own = sorted(r[1:] for r in rows if r[0] == entity)
        for i in range(lookback, len(own)):
            made[entity, own[i][0]] = [[r[k] for r in own[i - lookback : i]] for k in (1, 2)]
    return made


@pytest.mark.parametrize(("lookback", "span"), [(7, 7), (7, 8), (7, None), (5, 13), (1, 4), (30, None)])
def test_windows_across_block_edges(spark, lookback, span):
    rows, df = panel(spark)
    blocks = N.lookback_blocks(df, "town", "day", [F.col("x"), F.col("y")], lookback, ["day", "split"], span)
    opened = {(r.town, r.day): r.sequence for r in N.open_windows(blocks, "town", 2).collect()}
    assert opened == plain_windows(rows, lookback)
    # What is stored is the panel and its halos, not a copy of every window.
    held = blocks.agg(F.sum(F.size("series")), F.sum(F.size("rows"))).first()
    width = max(lookback, span or N.SPANS * lookback)
    assert held[0] <= len(rows) * (1 + lookback / width) + len(ENTITIES) * lookback
    assert held[1] == len(opened)


def test_tasks_unpack_the_same_windows(spark):
    rows, df = panel(spark)
    blocks = N.lookback_blocks(df, "town", "day", [F.col("x"), F.col("y")], 7, ["day", "split"], 9)
    kept, cube = N.unpack(blocks.toArrow(), "town")
    want = plain_windows(rows, 7)
    assert kept.column_names == ["town", "day", "split"] and len(cube) == len(want)
    for k, row in enumerate(kept.to_pylist()):
        assert cube[k].tolist() == want[row["town"], row["day"]]


def test_reach_before_and_after(spark):
    rows, df = panel(spark)
    blocks = N.halo_blocks(df.select("town", "day", "x"), "town", "day", before=4, after=2, span=5)
    cut = F.transform(N.full_windows(4, 2), lambda i: F.struct(N.step_at(i, "day").alias("day"), N.reach(i, -4, -2, "x").alias("past"), N.reach(i, 0, 2, "x").alias("next")))
    got = {(r.town, r.day): (r.past, r.next) for r in blocks.select("town", F.inline(cut)).collect()}
    want = {}
    for entity in ENTITIES:
        own = sorted(r[1:] for r in rows if r[0] == entity)
        for i in range(4, len(own) - 2):
            want[entity, own[i][0]] = ([r[1] for r in own[i - 4 : i - 1]], [r[1] for r in own[i : i + 3]])
    assert got == want and len(want) > 60


def test_models_take_blocks_or_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(e, date(2020, 1, 1) + timedelta(days=i), float(rng.poisson(3)), float(i % 7)) for e in ("a", "b") for i in range(80)]
    df = spark.createDataFrame(rows, "town string, day date, x double, y double").withColumns(
        {
            "split": F.when(F.col("day") < "2020-02-20", "train").when(F.col("day") < "2020-03-01", "validation").otherwise("test"),
            "y_raw": F.col("x"), "y_scaled": F.col("x"), "y_mean": F.lit(0.0), "y_std": F.lit(1.0),
        }
    )
    keep = ["day", "split", "y_raw", "y_scaled", "y_mean", "y_std"]
    blocks = N.lookback_blocks(df, "town", "day", [F.col("x"), F.col("y")], 12, keep, 15)
    opened = N.open_windows(blocks, "town", 2)
    rocket = minirocket.fit_on(blocks, 168, seed=3, sample_size=16)
    assert all(np.array_equal(a, b) for x, y in zip(rocket.biases, minirocket.fit_on(opened, 168, seed=3, sample_size=16).biases, strict=True) for a, b in zip(x, y, strict=True))
    by_key = [
        {(r.town, r.day): (r.split, r.features) for r in minirocket.featurize(samples, rocket, chunk=5).collect()} for samples in (blocks, opened)
    ]
    assert by_key[0] == by_key[1] and len(by_key[0]) == 136
    models = [ridge.train_per_entity(samples, "town", [1.0, 10.0], rocket=rocket).orderBy("town").collect() for samples in (blocks, opened)]
    for one, other in zip(*models, strict=True):
        assert (one.alpha, one.n_train) == (other.alpha, other.n_train) and np.allclose(one.coefficients, other.coefficients)
    table = ridge.train_per_entity(blocks, "town", [1.0, 10.0], rocket=rocket)
    scored = [{(r.town, r.day): r.prediction for r in ridge.score_samples(s, table, "town", rocket).collect()} for s in (blocks, opened)]
    assert scored[0].keys() == scored[1].keys() and all(scored[0][k] == pytest.approx(scored[1][k]) for k in scored[0])
    only = N.keep_rows(blocks, lambda r: r["split"] == "test")
    assert {r.split for r in N.open_windows(only, "town", 2).select("split").collect()} == {"test"}
