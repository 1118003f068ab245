"""Checks that ride on a write: the job that stores a table also counts what it saw.

Each function reads its events once: counts are observed metrics of the writing job, so
neither a funnel, nor rule counts, nor a key check scans the input again.  Results are
written below a path the caller names and read back from there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from incidentpanel.functions.labels import rule_condition
from incidentpanel.operators.panel import funnel_flags, modelling_columns


class RepeatedKeys(ValueError):
    """A lookup gave a row more than one partner."""


def _stored(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _long_form(df: DataFrame, names: Sequence[str], counts: Mapping[str, int], label: str, value: str) -> DataFrame:
    rows = [(name, int(counts[f"c{i}"] or 0)) for i, name in enumerate(names)]
    return df.sparkSession.createDataFrame(rows, f"{label} string, {value} long")


def apply_rules_on_write(
    df: DataFrame, rules: Sequence[tuple[str, Sequence[tuple[str, Sequence[object]]]]], path: str
) -> tuple[DataFrame, DataFrame]:
    """Rows kept by all rules, stored, and how many rows of the whole frame each rule hits."""
    hits = {name: rule_condition(df, conditions) for name, conditions in rules}
    if not hits:
        return _stored(df, path), df.sparkSession.createDataFrame([], "rule_name string, rows_excluded long")
    seen = Observation()
    watched = df.observe(seen, *[F.count_if(hit).alias(f"c{i}") for i, hit in enumerate(hits.values())])
    dropped = F.lit(False)
    for hit in hits.values():
        dropped = dropped | hit
    kept = _stored(watched.filter(~dropped), path)
    return kept, _long_form(df, list(hits), seen.get, "rule_name", "rows_excluded")


def modelling_events_on_write(
    canonical: DataFrame, exclusions: DataFrame, static: DataFrame, lo: Column, hi: Column, path: str
) -> tuple[DataFrame, DataFrame]:
    """The modelling event set, stored, and the preparation funnel of the rows it was made from."""
    flagged, flags = funnel_flags(canonical, exclusions, static, lo, hi)
    steps = {
        "canonical_accidents_loaded": F.count("*"),
        "rows_with_valid_timestamp": F.count_if(flags["valid"]),
        "rows_after_manual_exclusions": F.count_if(flags["kept"]),
        "rows_after_outer_window_filter": F.count_if(flags["used"]),
        # At most one entry per region.
        "retained_rgis": F.size(F.collect_set(F.when(flags["used"], F.col("__region")))),
    }
    seen = Observation()
    watched = flagged.observe(seen, *[c.alias(f"c{i}") for i, c in enumerate(steps.values())])
    events = _stored(modelling_columns(watched.filter(flags["used"])), path)
    return events, _long_form(canonical, list(steps), seen.get, "step", "rows")


def left_join_on_write(left: DataFrame, right: DataFrame, keys: Sequence[str], path: str, what: str = "lookup") -> DataFrame:
    """Many-to-one left join, stored; refused afterwards if the lookup repeated a key that is in use.

    The rows are counted before and after the join by the job that writes it.
    """
    before, after = Observation(), Observation()
    joined = left.observe(before, F.count("*").alias("n")).join(right, list(keys), "left").observe(after, F.count("*").alias("n"))
    made = _stored(joined, path)
    rows = (before.get["n"], after.get["n"])
    if rows[0] != rows[1]:
        raise RepeatedKeys(f"{what} is not unique at {', '.join(keys)}: {rows[0]} rows became {rows[1]}")
    return made
