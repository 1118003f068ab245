"""Small panels with known answers."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from incidentpanel.functions import ptbr
from incidentpanel.functions import temporal as T
from incidentpanel.models.baseline import baseline_forecasts
from incidentpanel.operators import calendar_tables as K
from incidentpanel.operators import dashboard as D
from incidentpanel.operators import evaluate as E
from incidentpanel.operators import samples as S
from incidentpanel.plans import weekly_model as W

DAYS = (
    [date(2023, 1, d) for d in range(1, 6)] + [date(2024, 1, 1), date(2024, 1, 2)] + [date(2025, 1, 1), date(2025, 1, 2)]
)
SPLIT = {2023: "train", 2024: "validation", 2025: "test"}


def day_panel(spark, weather=False):
    rows = [
        (code, d, d.year, float(i + k), SPLIT[d.year], 0.0, 0.0, 0.0)
        for k, code in enumerate(("4201", "4202"))
        for i, d in enumerate(DAYS)
    ]
    df = spark.createDataFrame(
        rows,
        "codigo_municipio string, accident_date date, year int, accident_count double, split string, "
        "non_working_day_weight double, days_off_ahead double, days_off_before double",
    )
    if weather:
        values = [25.0, 18.0, 30.0, 21600.0, 64800.0, 1.0, 2.0]
        df = df.withColumns({c: F.lit(v) for c, v in zip(S.WEATHER_CHANNELS, values)})
    return df


def test_daily_samples(spark):
    made = S.daily_samples(day_panel(spark), "codigo_municipio", "accident_date", 2)
    train = made.filter("codigo_municipio = '4201' AND split = 'train'").orderBy("accident_date").collect()
    assert [r["y_raw"] for r in train] == [2.0, 3.0, 4.0]
    assert all(len(r["sequence"]) == 10 and all(len(c) == 2 for c in r["sequence"]) for r in train)
    assert np.allclose(train[0]["sequence"][0], (np.array([0.0, 1.0]) - 2.0) / np.std([0, 1, 2, 3, 4]))
    held = made.filter("codigo_municipio = '4202' AND split = 'validation'").orderBy("accident_date").collect()
    assert [r["y_raw"] for r in held] == [6.0, 7.0] and held[0]["y_mean"] == 3.0


def test_weather_channels_are_finite(spark):
    made = S.daily_samples(day_panel(spark, weather=True), "codigo_municipio", "accident_date", 2, weather=True)
    rows = made.filter("codigo_municipio = '4201' AND split = 'train'").collect()
    assert len(rows) == 3
    for r in rows:
        cube = np.array(r["sequence"])
        assert cube.shape == (17, 2) and np.isfinite(cube).all()


def test_iso_weeks(spark):
    days = [date(2020, 12, 31), date(2021, 1, 3), date(2021, 1, 4), date(2024, 12, 30), date(2016, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date").select(
        "d", T.iso_week_label("d").alias("l"), T.iso_week_monday(T.iso_year("d"), F.weekofyear("d")).alias("m")
    )
    for r in df.collect():
        y, w, _ = r["d"].isocalendar()
        assert r["l"] == f"{y}-W{w:02d}" and r["m"] == date.fromisocalendar(y, w, 1)


def test_easter(spark):
    known = {2017: (4, 16), 2019: (4, 21), 2023: (4, 9), 2024: (3, 31), 2025: (4, 20), 2026: (4, 5), 2038: (4, 25), 1954: (4, 18)}
    df = spark.createDataFrame([(y,) for y in known], "y int").select("y", T.easter("y").alias("e"))
    assert {r["y"]: (r["e"].month, r["e"].day) for r in df.collect()} == known


def test_day_weights_and_streaks(spark):
    states = spark.createDataFrame([("SC",)], "uf string")
    lo, hi = F.lit(date(2024, 10, 1)), F.lit(date(2025, 1, 31))
    rows = {r["date"]: r for r in K.date_features(states, lo, hi).collect()}
    assert len(rows) == 123
    holidays = {date(2024, 10, 12), date(2024, 11, 2), date(2024, 11, 15), date(2024, 11, 20), date(2024, 12, 25), date(2025, 1, 1)}

    def off(d):
        return d.weekday() >= 5 or d in holidays

    def weight(d):
        one = timedelta(days=1)
        return 1.0 if off(d) else (0.5 if off(d - one) and off(d + one) else 0.0)

    for d, r in rows.items():
        ahead = before = 0.0
        for k in range(1, 31):
            if weight(d + timedelta(days=k)) == 0:
                break
            ahead += weight(d + timedelta(days=k))
        for k in range(1, 31):
            if weight(d - timedelta(days=k)) == 0:
                break
            before += weight(d - timedelta(days=k))
        assert (r["non_working_day_weight"], r["days_off_ahead"], r["days_off_before"]) == (weight(d), ahead, before), d


def test_streak_is_capped(spark):
    days = spark.createDataFrame([("X", date(2024, 1, 1) + timedelta(days=i), 0.0 if i in (0, 50) else 1.0) for i in range(52)], "uf string, date date, weight double")
    made = {r["date"]: r for r in K.off_day_streaks(days).collect()}
    assert made[date(2024, 1, 1)]["days_off_ahead"] == 30.0
    assert made[date(2024, 1, 1) + timedelta(days=50)]["days_off_before"] == 30.0
    assert made[date(2024, 1, 1) + timedelta(days=40)]["days_off_ahead"] == 9.0


def test_longest_streak(spark):
    scores = [1.0, 1.0, 0.5, 0.0, 1.0, 0.0, 1.0]
    df = spark.createDataFrame([("k", i, s) for i, s in enumerate(scores)], "g string, i int, s double")
    assert K.longest_streak(df, ["g"], "i", "s", "m").first()["m"] == 2.5


def test_weekly_features_are_zero_beyond_the_window(spark):
    states = spark.createDataFrame([("SC",)], "uf string")
    lo, hi = date(2024, 12, 23), date(2025, 1, 6)
    rows = K.weekly_holiday_features(states, F.lit(lo), F.lit(hi)).orderBy("week_start").collect()
    assert [r["week_start"] for r in rows] == [lo, date(2024, 12, 30), hi]
    assert rows[0]["prev_week_non_work_day_share"] == 0.0 and rows[-1]["next_week_non_work_day_share"] == 0.0
    assert rows[0]["curr_week_non_work_day_share"] == pytest.approx(3 / 7)
    assert rows[0]["next_week_longest_non_work_streak"] == rows[1]["curr_week_longest_non_work_streak"] == 2.0


EVENT_COUNTS = {"11001": [0, 1, 0, 1, 1, 1, 1, 1], "11002": [1, 1, 1, 2, 2, 2, 2, 2], "11003": [2, 2, 3, 3, 3, 3, 4, 4]}
SETTINGS = W.WeeklySettings(
    ranges=W.iso_ranges(train=((2024, 1), (2024, 4)), validation=((2024, 5), (2024, 6)), test=((2024, 7), (2024, 8))),
    history=2,
    gap=1,
    horizon=1,
    seasonal_lags=(1, 2),
    train_stride=1,
    eval_stride=1,
    low_share=0.34,
    high_share=0.33,
)


def weekly_inputs(spark):
    events, number = [], 0
    for code, counts in EVENT_COUNTS.items():
        for week, n in enumerate(counts):
            start = datetime(2024, 1, 1) + timedelta(weeks=week)
            for k in range(n):
                number += 1
                events.append((number, start + timedelta(days=k), start.year, "SC", code, f"RGI {code}"))
    events.append((999, datetime(2024, 1, 2), 2024, "SP", "11001", "RGI 11001"))
    sections = [(f"s{c}", c, f"RGI {c}", "SC", "42", "INT", 1000.0 * (i + 1)) for i, c in enumerate(EVENT_COUNTS)]
    return (
        spark.createDataFrame(events, "id long, timestamp timestamp, year int, uf string, codigo_rgi string, nome_rgi string"),
        spark.createDataFrame(
            sections, "section_id string, codigo_rgi string, nome_rgi string, sg_uf string, cd_rgint string, nm_rgint string, road_length_m double"
        ),
    )


@pytest.fixture(scope="module")
def weekly(spark):
    return W.featurise(*weekly_inputs(spark), SETTINGS)


def test_weekly_model_features(weekly):
    panel = weekly["weekly_rgi_panel_with_groups"]
    assert {r["group_name"] for r in panel.select("group_name").distinct().collect()} == {"low_activity", "mid_activity", "high_activity"}
    got = {}
    for r in panel.orderBy("week_start").collect():
        got.setdefault(r["rgi_id"], []).append(r["accident_count"])
    assert got == EVENT_COUNTS
    manifest = weekly["group_sequence_manifest"].collect()
    assert {r["split"] for r in manifest} == {"train", "validation", "test"}
    assert [r["rows_excluded"] for r in weekly["dynamic_exclusion_diagnostics"].collect()] == [1]
    funnel = {r["step"]: r["rows"] for r in weekly["preparation_summary"].collect()}
    assert funnel["rows_after_outer_window_filter"] == sum(map(sum, EVENT_COUNTS.values())) and funnel["retained_rgis"] == 3


def test_weekly_samples_by_hand(weekly):
    made = {(r["rgi_id"], r["forecast_batch_start"]): r for r in weekly["samples"].collect()}
    counts = EVENT_COUNTS["11003"]
    scale = 1 + np.mean(counts[:4])
    start = date(2024, 1, 1) + timedelta(weeks=4)
    r = made[("11003", start)]
    assert r["split"] == "validation" and r["cutoff_week_start"] == start - timedelta(weeks=1)
    assert np.allclose(r["recent_history"], np.array(counts[2:4]) / scale)
    assert np.allclose(r["seasonal_context"], [np.array([counts[3], counts[2]]) / scale])
    assert r["actual_targets"] == [counts[4]] and np.allclose(r["targets"], counts[4] / scale)
    assert r["road_length"] == 3.0 and np.isclose(r["scale_feature"], np.log1p(scale))
    # Two weeks of history and one of gap: the first origin is the third week.
    assert min(k[1] for k in made) == date(2024, 1, 15)


def test_weekly_experiment(weekly):
    made = W.run_experiment(weekly, SETTINGS)
    runs = made["run_manifest"].collect()
    assert len(runs) == 6
    assert {r["comparison_dataset_key"] for r in runs} == {f"{g}|history=2|horizon=1|latency=1|lags=1-2|rgis=1" for g in ("low_activity", "mid_activity", "high_activity")}
    overall = {(r["architecture"], r["split"]): r for r in made["overall_metrics"].collect()}
    assert overall[("linear", "test")]["forecast_row_coverage"] == 1.0
    assert made["forecasts"].filter("prediction < 0 OR prediction != rint(prediction)").count() == 0


def long_forecast(spark):
    rows = []
    for arch, shift in (("gru", 0), ("lstm", 1)):
        for rgi, base in (("11001", 1), ("11002", 3)):
            for step in range(8):
                week = date(2024, 2, 12) + timedelta(weeks=step)
                rows.append(("group", arch, "low_activity", "test", rgi, f"N{rgi}", "SC", week, step % 4 + 1, float(base + step + shift), float(base + step)))
    return spark.createDataFrame(
        rows,
        "model string, architecture string, group_name string, split string, rgi_id string, rgi_name string, uf string, "
        "week_start date, horizon_step int, prediction double, actual double",
    )


def test_comparison_frame(spark):
    made = E.comparison_frame(long_forecast(spark)).collect()
    assert len({r["architecture"] for r in made}) == 2 and len({r["week_start"] for r in made}) == 8
    assert len({r["rgi_id"] for r in made}) == 2
    assert {round(r["prediction"] - r["actual"]) for r in made if r["architecture"] == "lstm"} == {1}


def test_metrics_edge_cases(spark):
    df = spark.createDataFrame(
        [("one", 1.0, 2.0), ("flat", 2.0, 1.0), ("flat", 2.0, 3.0), ("ok", 1.0, 1.0), ("ok", 3.0, 2.0), ("gap", None, 1.0)],
        "k string, actual double, prediction double",
    )
    made = {r["k"]: r for r in E.evaluate_by(df, ["k"]).collect()}
    assert made["one"]["r2"] is None and made["flat"]["r2"] is None and "gap" not in made
    assert made["ok"]["r2"] == pytest.approx(0.5) and made["ok"]["rmse"] == pytest.approx(np.sqrt(0.5))


def test_baselines(spark):
    monday = date(2022, 1, 3)
    rows = [("r", "n", "SC", monday + timedelta(weeks=i), i % 9) for i in range(70)]
    split = (monday + timedelta(weeks=54), monday + timedelta(weeks=64))
    panel = spark.createDataFrame(rows, "rgi_id string, rgi_name string, uf string, week_start date, accident_count int").withColumns(
        {
            "week_end": F.date_add("week_start", 6),
            "year_week": T.iso_week_label("week_start"),
            "split": F.when(F.col("week_start").between(F.lit(split[0]), F.lit(split[1])), "validation").otherwise("train"),
        }
    )
    made = baseline_forecasts(panel, {"validation": split}).collect()
    # Eleven weeks hold two complete batches of four.
    assert len(made) == 16
    for r in made:
        i = (r["week_start"] - monday).days // 7
        cut = 54 + (i - 54) // 4 * 4 - 4
        want = (i - 52) % 9 if r["model"] == "seasonal_naive" else np.mean([w % 9 for w in range(cut - 3, cut + 1)])
        assert r["prediction"] == pytest.approx(want) and r["actual"] == i % 9
        assert r["cutoff_week_start"] == monday + timedelta(weeks=cut)


def test_forecast_weekly_rollup(spark):
    df = spark.createDataFrame(
        [
            ("4205407", "Florianópolis", "2026-06-08", 1.25),
            ("4205407", "Florianópolis", "2026-06-09", 2.75),
            ("4202008", "Balneário Camboriú", "2026-06-14", 1.0),
        ],
        "codigo_municipio string, nome_municipio string, accident_date string, predicted_accident_count double",
    )
    r = {x["codigo_municipio"]: x for x in D.normalise_forecast(df, weekly=True).collect()}["4205407"]
    assert (r["week_start"], r["week_end"], r["accident_count"], r["fonte"]) == (date(2026, 6, 8), date(2026, 6, 14), 4.0, "previsão")
    assert D.normalise_forecast(df.drop("codigo_municipio")) is None


@pytest.mark.parametrize(
    "sources, label", [(["histórico"], "Histórico"), (["previsão"], "Previsão"), (["histórico", "previsão"], "Misto"), ([None], "-")]
)
def test_source_labels(spark, sources, label):
    df = spark.createDataFrame([(date(2026, 1, 1), s) for s in sources], "d date, fonte string")
    assert D.period_sources(df, "d").first()["source_label"] == label


@pytest.mark.parametrize(
    "cutoff, horizon, weekly, current",
    [
        ("2026-06-08", 30, False, True),
        ("2026-06-07", 30, False, False),
        ("2026-06-08", 14, False, False),
        ("2026-02-28", 30, True, True),
        ("2026-02-22", 30, True, False),
    ],
)
def test_freshness(spark, cutoff, horizon, weekly, current):
    manifest = spark.createDataFrame([(cutoff, horizon)], "source_panel_max_date string, horizon_days int")
    if weekly:
        panel = spark.createDataFrame([(date(2026, 2, 23), date(2026, 3, 1)), (date(2026, 2, 16), date(2026, 2, 22))], "s date, e date")
        row = D.forecast_freshness(panel, manifest, 30, "s", "e").first()
    else:
        row = D.forecast_freshness(spark.createDataFrame([(date(2026, 6, 8),)], "s date"), manifest, 30, "s").first()
    assert row["is_current"] is current


def test_delta_keeps_the_selected_entity(spark):
    rows = [(date(2024, 1, d), f"e{i:02d}", float(i * (d == 2))) for i in range(25) for d in (1, 2)]
    df = spark.createDataFrame(rows, "d date, e string, m double")
    made = D.period_delta(df, "d", F.lit(date(2024, 1, 2)), F.lit(date(2024, 1, 1)), "e", "m", "e00", top=5).collect()
    assert {r["e"] for r in made} == {"e00", "e24", "e23", "e22", "e21", "e20"}
    assert {r["status"] for r in made} == {"Selecionado", "Aumento"}


def test_portuguese_text(spark):
    r = (
        spark.createDataFrame([(1234567.891, date(2024, 3, 9), None)], "n double, d date, e date")
        .select(
            ptbr.number_text("n").alias("a"),
            ptbr.number_text("n", 2).alias("b"),
            ptbr.date_text("d").alias("c"),
            ptbr.period_text("d", F.date_add("d", 6)).alias("p"),
            ptbr.period_text("d", "e").alias("q"),
            ptbr.number_text(F.lit(None).cast("double")).alias("x"),
        )
        .first()
    )
    assert tuple(r) == ("1.234.568", "1.234.567,89", "09/03/2024", "09/03/2024 a 15/03/2024", "09/03/2024", "-")
