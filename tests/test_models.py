"""Models against direct numpy solutions."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from incidentpanel.models import glm, minirocket, pooled, ridge, seasonal
from incidentpanel.operators import evaluate as E


def test_ridge_path_solves_the_normal_equations():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(40, 7)), rng.normal(size=40)
    alphas = [0.1, 5.0]
    coefs, intercepts, loo = ridge.solve_path(x, y, alphas)
    for k, alpha in enumerate(alphas):
        xc, yc = x - x.mean(0), y - y.mean()
        beta = np.linalg.solve(xc.T @ xc + alpha * np.eye(7), xc.T @ yc)
        assert np.allclose(coefs[k], beta)
        assert intercepts[k] == pytest.approx(y.mean() - x.mean(0) @ beta)
        errors = []
        for i in range(40):
            keep = np.arange(40) != i
            xi, yi = x[keep], y[keep]
            b = np.linalg.solve((xi - xi.mean(0)).T @ (xi - xi.mean(0)) + alpha * np.eye(7), (xi - xi.mean(0)).T @ (yi - yi.mean()))
            errors.append((y[i] - (yi.mean() + (x[i] - xi.mean(0)) @ b)) ** 2)
        # The closed form keeps the centring of the full data; it is close, not equal.
        assert loo[k] == pytest.approx(np.mean(errors), rel=0.05)


def feature_rows(spark, with_selection=True):
    rng = np.random.default_rng(4)
    rows = []
    for town in ("4201", "4202"):
        for i in range(60):
            split = "train" if i < 40 else ("validation" if i < 50 and with_selection else "test")
            f = [float(v) for v in rng.normal(size=3)]
            y = 2.0 * f[0] - f[1] + 0.01 * float(rng.normal())
            rows.append((town, date(2023, 1, 1) + timedelta(days=i), split, f, y * 3 + 5, y, 5.0, 3.0))
    return spark.createDataFrame(
        rows,
        "codigo_municipio string, accident_date date, split string, features array<float>, y_raw double, y_scaled double, y_mean double, y_std double",
    )


@pytest.mark.parametrize("with_selection", [True, False])
def test_one_ridge_per_entity(spark, with_selection):
    df = feature_rows(spark, with_selection)
    models = ridge.train_per_entity(df, "codigo_municipio", [0.1, 1000.0])
    made = {r["codigo_municipio"]: r for r in models.collect()}
    assert set(made) == {"4201", "4202"}
    for r in made.values():
        assert r["alpha"] == 0.1 and r["n_train"] == 40
        assert (r["selection_score"] is None) == (not with_selection)
        assert np.allclose(r["coefficients"], [2, -1, 0], atol=0.05)
    scored = ridge.score(df, models, "codigo_municipio")
    overall, per_town = E.evaluate_entities(scored.withColumn("actual", F.col("y_raw")), "codigo_municipio")
    mean = per_town.groupBy("split").agg(F.avg("r2").alias("m"))
    for r in overall.join(mean, "split").collect():
        assert r["macro_r2"] == pytest.approx(r["m"]) and r["r2"] > 0.99


def test_missing_model_is_an_error(spark):
    df = feature_rows(spark)
    models = ridge.train_per_entity(df, "codigo_municipio", [1.0]).filter("codigo_municipio = '4201'")
    with pytest.raises(Exception, match="no model for 4202"):
        ridge.score(df, models, "codigo_municipio").collect()


def test_minirocket_definition():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(12, 3, 40)).astype(np.float32)
    rocket = minirocket.fit(x, 252, seed=9)
    made = minirocket.transform(x, rocket)
    assert made.shape == (12, rocket.n_features) and rocket.n_features == 252
    assert made.min() >= 0 and made.max() <= 1
    again = minirocket.fit(x, 252, seed=9)
    assert np.array_equal(minirocket.transform(x, again), made)
    # One feature by direct convolution.
    d, k = 0, 5
    dilation, used, bias = rocket.dilations[d], rocket.channels[d][k], rocket.biases[d][k][0]
    weights = np.full(9, -1.0)
    weights[minirocket.TRIPLES[k]] = 2.0
    reach = 4 * dilation
    response = np.zeros((12, 40))
    padded = np.pad(x[:, used], ((0, 0), (0, 0), (reach, reach)))
    for tap in range(9):
        response += weights[tap] * padded[:, :, tap * dilation : tap * dilation + 40].sum(axis=1)
    window = response if (d + k) % 2 == 0 else response[:, reach:-reach]
    column = sum(len(b) for b in rocket.biases[d][:k])
    assert np.allclose(made[:, column], (window > bias).mean(axis=1), atol=1 / 30)


def test_minirocket_on_spark_equals_local(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(30, 4, 20)).astype(np.float32)
    rows = [(i, "train" if i < 20 else "test", [[float(v) for v in c] for c in x[i]]) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, split string, sequence array<array<float>>").repartition(3)
    rocket = minirocket.fit_on(df, 168, seed=3, sample_size=8)
    got = {r["id"]: np.array(r["features"]) for r in minirocket.featurize(df, rocket, chunk=7).collect()}
    want = minirocket.transform(x, rocket)
    assert all(np.allclose(got[i], want[i]) for i in range(30))
    assert minirocket.fit_on(df.repartition(5), 168, seed=3, sample_size=8).biases[0][0] == pytest.approx(rocket.biases[0][0])


def test_recursive_forecast_feeds_back(spark):
    rng = np.random.default_rng(10)
    lookback, horizon = 10, 4
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(30 + horizon)]
    rows, series = [], {}
    for town in ("a", "b"):
        counts = [float(v) for v in rng.poisson(2, 30)] + [0.0] * horizon
        series[town] = counts
        rows += [(town, d, "forecast" if i >= 30 else "train", counts[i], float(i % 7)) for i, d in enumerate(days)]
    panel = spark.createDataFrame(rows, "code string, day date, split string, accident_count double, ch double")
    cube = np.stack([[[(c - 2) / 1.5 for c in series["a"][i : i + lookback]], [float(j % 7) for j in range(i, i + lookback)]] for i in range(15)])
    rocket = minirocket.fit(cube.astype(np.float32), 84, seed=1)
    weights = [float(v) for v in rng.normal(0, 0.2, rocket.n_features)]
    models = spark.createDataFrame(
        [(t, weights, 0.1, 2.0, 1.5) for t in ("a", "b")], "code string, coefficients array<double>, intercept double, y_mean double, y_std double"
    )
    got = {(r["code"], r["forecast_horizon_day"]): r for r in ridge.recursive_forecast(panel, models, rocket, "code", "day", ["ch"], lookback).collect()}
    for town in ("a", "b"):
        counts = list(series[town])
        for step in range(horizon):
            at = 30 + step
            window = np.array([[(c - 2.0) / 1.5 for c in counts[at - lookback : at]], [float(j % 7) for j in range(at - lookback, at)]])
            raw = float(minirocket.transform(window[None].astype(np.float32), rocket)[0] @ np.array(weights) + 0.1) * 1.5 + 2.0
            counts[at] = max(raw, 0.0)
            r = got[(town, step + 1)]
            assert r["prediction_raw"] == pytest.approx(raw, abs=1e-5) and r["predicted_accident_count"] == pytest.approx(counts[at], abs=1e-5)
            assert r["day"] == days[at]


def test_seasonal_forecasts_of_exact_series():
    assert len(seasonal.candidate_grid()) == 63
    t = np.arange(60)
    assert np.allclose(seasonal.fit_forecast(3.0 + 2.0 * t, (1, 1, 0, 0, 0, 0), 12, 5), 3.0 + 2.0 * np.arange(60, 65))
    wave = np.tile([1.0, 5.0, 2.0, 0.0], 12)
    assert np.allclose(seasonal.fit_forecast(wave, (0, 0, 0, 0, 1, 0), 4, 6), np.tile([1.0, 5.0, 2.0, 0.0], 2)[:6])
    y = np.empty(80)
    y[0] = 10.0
    for i in range(1, 80):
        y[i] = 0.9 * y[i - 1]
    assert np.allclose(seasonal.fit_forecast(y, (1, 0, 0, 0, 0, 0), 52, 3), y[-1] * 0.9 ** np.arange(1, 4))
    with pytest.raises(ValueError):
        seasonal.fit_forecast(np.ones(10), (0, 0, 0, 1, 1, 0), 52, 3)


def test_candidate_search_keeps_failures(spark):
    monday = date(2024, 1, 1)
    rows = [("r1", "n", "SC", monday + timedelta(weeks=i), [1, 5, 2, 0][i % 4]) for i in range(40)]
    panel = spark.createDataFrame(rows, "rgi_id string, rgi_name string, uf string, week_start date, accident_count int")
    bounds = (monday + timedelta(weeks=28), monday + timedelta(weeks=35))
    grid = [(0, 0, 0, 0, 1, 0), (1, 0, 0, 0, 0, 0), (0, 0, 0, 1, 1, 1)]
    series = seasonal.entity_series(panel)
    made = seasonal.candidate_forecasts(series, grid, "validation", bounds, horizon=4, gap=2, season=4)
    picked = seasonal.select_candidates(made)
    best = picked.filter("is_selected").collect()
    assert [r["spec"] for r in best] == [seasonal.order_label(grid[0], 4)] and best[0]["validation_rmse"] == pytest.approx(0.0)
    far = seasonal.candidate_forecasts(series, grid, "validation", bounds, 4, 2, season=52)
    failed = seasonal.select_candidates(far).filter("status = 'failed'")
    assert failed.filter("failure_reason LIKE 'ValueError%'").count() >= 1
    final = seasonal.selected_forecasts(series, picked, {"test": (monday + timedelta(weeks=32), monday + timedelta(weeks=39))}, 4, 2, 4)
    assert final.count() == 8 and final.filter("abs(prediction - actual) > 1e-6").count() == 0


def test_poisson_glm_matches_irls(spark):
    rng = np.random.default_rng(12)
    rows = []
    for _ in range(400):
        a, b = rng.choice(["x", "y", "z"]), int(rng.integers(1, 4))
        rate = np.exp(0.3 + {"x": 0.0, "y": 0.5, "z": -0.4}[a] + 0.2 * b)
        rows.append((str(a), b, int(rng.poisson(rate))))
    frame = spark.createDataFrame(rows, "kind string, month int, accident_count int")
    terms = [("kind", "y"), ("kind", "z"), ("month", "02"), ("month", "03")]
    model = glm.fit_glm(glm.design(frame, terms), "poisson", "accident_count")
    x = np.array([[1, a == "y", a == "z", b == 2, b == 3] for a, b, _ in rows], dtype=float)
    y = np.array([n for _, _, n in rows], dtype=float)
    beta = np.zeros(5)
    for _ in range(50):
        mu = np.exp(x @ beta)
        beta += np.linalg.solve(x.T @ (x * mu[:, None]), x.T @ (y - mu))
    table = {(r["variable"], r["level_label"]): r for r in glm.coefficient_table(model, terms, spark).collect()}
    for i, term in enumerate(terms):
        assert table[term]["coefficient"] == pytest.approx(beta[i + 1], abs=1e-5)
        assert table[term]["abs_pct_change_vs_reference"] == pytest.approx(abs(np.exp(beta[i + 1]) - 1), abs=1e-5)


def test_comparison_key():
    assert pooled.comparison_key("low_activity", 2, 1, 1, (1, 2), 3) == "low_activity|history=2|horizon=1|latency=1|lags=1-2|rgis=3"


def test_minirocket_draws_a_window_for_each_kernel_and_dilation():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 2, 90)).astype(np.float32)
    rocket = minirocket.fit(x, 84 * 12, seed=5)
    assert len(rocket.dilations) > 2 and rocket.n_features == 84 * 12
    # Windows of very different size: the size of a kernel's biases tells which window they came from.
    scaled = x[:10] * (10.0 ** np.arange(10))[:, None, None].astype(np.float32)
    rocket = minirocket.fit(scaled, 84 * 12, seed=5)
    for biases in rocket.biases:
        assert len({round(float(np.log10(np.abs(b).max()))) for b in biases}) > 5


def test_wide_ridge_equals_the_primal_solution():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(20, 50)), rng.normal(size=20)
    coefs, intercepts, _ = ridge.solve_path(x, y, [0.5, 20.0])
    for k, alpha in enumerate((0.5, 20.0)):
        xc, yc = x - x.mean(0), y - y.mean()
        beta = np.linalg.solve(xc.T @ xc + alpha * np.eye(50), xc.T @ yc)
        assert np.allclose(coefs[k], beta) and intercepts[k] == pytest.approx(y.mean() - x.mean(0) @ beta)


def test_samples_are_fitted_and_scored_like_their_features(spark):
    rng = np.random.default_rng(7)
    rows = []
    for town in ("a", "b"):
        for i in range(50):
            split = "train" if i < 35 else ("validation" if i < 43 else "test")
            sequence = [[float(v) for v in rng.normal(size=20)] for _ in range(2)]
            rows.append((town, i, split, sequence, float(rng.normal()), float(rng.normal()), 1.0, 2.0))
    df = spark.createDataFrame(
        rows, "town string, i int, split string, sequence array<array<float>>, y_raw double, y_scaled double, y_mean double, y_std double"
    )
    rocket = minirocket.fit_on(df, 168, seed=1)
    features = minirocket.featurize(df, rocket)
    stored = {r["town"]: r for r in ridge.train_per_entity(features, "town").collect()}
    models = ridge.train_per_entity(df, "town", rocket=rocket)
    for r in models.collect():
        assert r["alpha"] == stored[r["town"]]["alpha"] and np.allclose(r["coefficients"], stored[r["town"]]["coefficients"], atol=1e-6)
    want = {(r["town"], r["i"]): r["prediction"] for r in ridge.score(features, models, "town").collect()}
    got = {(r["town"], r["i"]): r["prediction"] for r in ridge.score_samples(df, models, "town", rocket).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-4) for k in want)
