"""Skew helpers, quantiles, key checks and upserts."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from incidentpanel.operators import keys as K
from incidentpanel.skew import global_row_number, latest_by, salted_join


def test_salted_join_equals_plain_join(spark):
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    lookup = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        got = salted_join(facts, lookup, ["k"], ["id"], how).select("id", "k", "v")
        want = facts.join(lookup, "k", how).select("id", "k", "v")
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    semi = salted_join(facts, lookup, ["k"], ["id"], "left_semi", F.col("r.v") > 10)
    assert semi.count() == facts.join(lookup.filter("v > 10"), "k", "left_semi").count()


def test_quantiles_match_numpy_with_a_hot_value(spark):
    rng = np.random.default_rng(2)
    values = np.concatenate([np.full(4000, 1.5), rng.normal(0, 10, 8000)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double").withColumn("w", F.col("v") * 3).union(
        spark.createDataFrame([(None, None)], "v double, w double")
    )
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r["variable"], r["p"]): r["quantile"] for r in K.exact_quantiles(df, ["v", "w"], probs).collect()}
    for p in probs:
        assert got[("v", p)] == pytest.approx(np.quantile(values, p))
        assert got[("w", p)] == pytest.approx(np.quantile(values * 3, p))


def test_iqr_filter(spark):
    values = [float(v) for v in range(100)] + [1000.0, -1000.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    q1, q3 = np.quantile(values, [0.25, 0.75])
    want = [v for v in values if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
    assert sorted(r["v"] for r in K.iqr_filter(df, ["v"]).collect()) == sorted(want)


def test_global_row_number(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("k")).repartition(13)
    got = global_row_number(df, [F.col("k").desc(), F.col("id")], "n").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(1, 5001))
    assert [(r["k"], r["id"]) for r in got] == sorted(((r["k"], r["id"]) for r in got), key=lambda t: (-t[0], t[1]))


def test_unique_key_checks(spark):
    good = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    bad = good.union(good)
    left = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert K.validated_left_join(left, good, ["k"]).count() == 3
    with pytest.raises(Exception, match="not unique"):
        K.validated_left_join(left, bad, ["k"]).collect()
    with pytest.raises(Exception, match="no v"):
        K.require_present(left.join(good, "k", "left"), "v", "lookup").collect()


def test_null_safe_exclusions(spark):
    df = spark.createDataFrame([(1, "SC", 2020), (2, None, 2020), (3, "SC", None), (4, "RS", 2020)], "id int, uf string, year int")
    ex = spark.createDataFrame(
        [("SC", 2020, True), (None, 2020, True), ("RS", 2020, False), ("RS", 2020, None)], "uf string, year int, flag boolean"
    )
    assert {r["id"] for r in K.apply_exclusions(df, ex, "flag").collect()} == {3, 4}


def test_rules_count_overlaps_and_reject_unknown_columns(spark):
    df = spark.createDataFrame([("SP", 1), (" sp ", 2), ("RS", 2), (None, 2)], "uf string, n int")
    kept, counts = K.apply_rules(df, [("a", [("uf", ["SP"])]), ("b", [("n", ["2"]), ("uf", ["sp", "rs"])])])
    assert {r["rule_name"]: r["rows_excluded"] for r in counts.collect()} == {"a": 2, "b": 2}
    assert [r["uf"] for r in kept.collect()] == [None]
    with pytest.raises(KeyError):
        K.apply_rules(df, [("c", [("missing", ["1"])])])


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, t int, v string")
    new = spark.createDataFrame([("a", 2, "z"), ("c", 1, "w")], "k string, t int, v string")
    order = [F.col("t"), F.col("v")]
    once = K.upsert(old, new, ["k"], order)
    twice = K.upsert(once, new, ["k"], order)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [("a", 2, "z"), ("b", 1, "y"), ("c", 1, "w")]
    assert latest_by(old, ["k"], order, smallest=True).count() == 2


def test_feature_profile_of_large_values(spark):
    from incidentpanel.operators.profile import feature_profile

    df = spark.createDataFrame([(1e9,), (1e9 + 1,), (1e9 + 2,), (None,), (1e9,)], "v double")
    r = feature_profile(df, ["v"]).collect()[0]
    assert (r["non_null_count"], r["null_count"], r["n_unique"]) == (4, 1, 3)
    assert r["std"] == pytest.approx(0.829156, abs=1e-6) and r["mean"] == pytest.approx(1e9 + 0.75)


def test_scratch_folder_is_required():
    from types import SimpleNamespace

    from incidentpanel.session import scratch_root

    context = SimpleNamespace(getConf=lambda: SimpleNamespace(get=lambda k: None), getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(session)
