"""Counts that ride on the write: right numbers from one scan of the events."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from incidentpanel.operators import keys as K
from incidentpanel.operators import observed as B
from incidentpanel.operators import panel as P
from incidentpanel.session import scratch_path

RULES = [("a", [("uf", ["SP"])]), ("b", [("n", ["2"]), ("uf", ["sp", "rs"])]), ("none", [("n", ["99"])])]


def plans(monkeypatch):
    """The plans of everything the module stores."""
    seen = []
    stored = B._stored

    def watch(df, path, mode="overwrite"):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, path, mode)

    monkeypatch.setattr(B, "_stored", watch)
    return seen


def on_disk(spark, rows, schema):
    path = scratch_path(spark, "events")
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.read.parquet(path), path.rsplit("/", 1)[-1]


def scans(plan, folder):
    return sum("FileScan" in line and folder[:20] in line for line in plan.splitlines())


def test_rules_are_counted_by_the_write(spark, monkeypatch):
    rows = [(1, "SP"), (2, "sp"), (2, "RS"), (2, None), (None, "RS"), (3, "SC")] * 5
    df, folder = on_disk(spark, rows, "n int, uf string")
    seen = plans(monkeypatch)
    kept, counts = B.apply_rules_on_write(df, RULES, scratch_path(spark, "kept"))
    plain, diagnostics = K.apply_rules(df, RULES)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, diagnostics.collect()))
    assert len(seen) == 1 and scans(seen[0], folder) == 1 and "CollectMetrics" in seen[0]
    everything, none = B.apply_rules_on_write(df, [], scratch_path(spark, "kept"))
    assert everything.count() == len(rows) and none.count() == 0
    nothing, zeros = B.apply_rules_on_write(df.filter("false"), RULES, scratch_path(spark, "kept"))
    assert nothing.count() == 0 and {r.rows_excluded for r in zeros.collect()} == {0}


def test_a_lookup_with_repeated_keys_is_refused(spark, monkeypatch):
    left, folder = on_disk(spark, [(1, "a"), (2, "b"), (None, "c"), (9, "d")], "k int, v string")
    seen = plans(monkeypatch)
    once = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (None, 40)], "k int, w int")
    made = B.left_join_on_write(left, once, ["k"], scratch_path(spark, "joined"))
    assert {(r.v, r.w) for r in made.collect()} == {("a", 10), ("b", 20), ("c", None), ("d", None)}
    assert scans(seen[0], folder) == 1 and seen[0].count("CollectMetrics") == 2
    with pytest.raises(B.RepeatedKeys, match="towns is not unique at k: 4 rows became 5"):
        B.left_join_on_write(left, once.union(once.filter("k = 2")), ["k"], scratch_path(spark, "joined"), "towns")
    # A repeated key that no row asks for changes nothing.
    assert B.left_join_on_write(left, once.union(once.filter("k = 3")), ["k"], scratch_path(spark, "joined")).count() == 4


def test_funnel_and_events_come_from_one_pass(spark, monkeypatch):
    rows = [(i, f"2024-01-{1 + i % 28:02d} 10:00:00" if i % 5 else None, " sc" if i % 2 else "RS", 2024 if i % 7 else None, str(i % 4), "n") for i in range(200)]
    events, folder = on_disk(spark, rows, "id int, t string, uf string, year int, codigo_rgi string, nome_rgi string")
    events = events.withColumn("timestamp", F.col("t").cast("timestamp")).drop("t")
    exclusions = spark.createDataFrame([("RS", 2024, True), ("SC", 2024, False)], "uf string, year int, exclude_from_modeling boolean")
    static = spark.createDataFrame([("0", "zero", "SC", 1.0), ("1", None, "SC", 2.0), ("3", "three", "RS", 3.0)], "rgi_id string, rgi_name string, uf string, br101_length_km_in_rgi double")
    span = F.lit("2024-01-08").cast("date"), F.lit("2024-01-31").cast("date")
    seen = plans(monkeypatch)
    made, funnel = B.modelling_events_on_write(events, exclusions, static, *span, scratch_path(spark, "events"))
    assert len(seen) == 1 and scans(seen[0], folder) == 1 and "CollectMetrics" in seen[0]
    want = P.modelling_events(events, exclusions, static, *span)
    assert made.columns == want.columns
    assert sorted(map(tuple, made.collect()), key=str) == sorted(map(tuple, want.collect()), key=str) and made.count() > 10
    assert sorted(map(tuple, funnel.collect())) == sorted(map(tuple, P.preparation_funnel(events, exclusions, static, *span).collect()))
