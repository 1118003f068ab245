"""Helpers that keep hot keys from landing in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidentpanel.session import checkpointed

MIN_SALTS, MAX_SALTS = 8, 64


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    condition: Column | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Join a large fact side to a smaller side whose keys may be hot.

    Each fact row takes one of ``salts`` sub-keys from a hash of ``spread_by``;
    every lookup row is repeated once per sub-key, so one key is shared between
    ``salts`` tasks (by default as many as the cluster runs at once, between 8
    and 64); AQE splits what is still too large.  Both inputs stay whole.  Spark
    may still choose a broadcast join when its own size check allows one.
    """
    salt = "__salt"
    if salts is None:
        salts = max(MIN_SALTS, min(MAX_SALTS, facts.sparkSession.sparkContext.defaultParallelism))
    left = facts.withColumn(salt, F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    right = lookup.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    on = [salt, *keys]
    if condition is None:
        return left.join(right, on, how).drop(salt)
    left_alias, right_alias = left.alias("l"), right.alias("r")
    equal = F.lit(True)
    for key in on:
        equal = equal & (F.col(f"l.{key}") == F.col(f"r.{key}"))
    joined = left_alias.join(right_alias, equal & condition, how)
    if how in ("left_semi", "left_anti"):
        return joined.drop(salt)
    kept = [F.col(f"l.{c}") for c in left.columns if c != salt]
    kept += [F.col(f"r.{c}") for c in right.columns if c not in left.columns]
    return joined.select(*kept)


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    *,
    smallest: bool = False,
) -> DataFrame:
    """Keep one whole row per key: the row with the largest ordering tuple.

    Written as a ``max_by`` aggregate instead of a ranking window, so rows of a
    hot key are reduced before the shuffle.  Nulls sort lowest.
    """
    pick = F.min_by if smallest else F.max_by
    payload = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in payload])
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    picked = df.groupBy(*keys).agg(pick(row, rank).alias("__row"))
    return picked.select(*[F.col(k) for k in keys], *[F.col(f"__row.{c}").alias(c) for c in payload]).select(*df.columns)


def global_row_number(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number rows 1..n in a total order without a single-task window.

    The range sort spreads the rows; a checkpoint pins which row landed in which
    partition; one small table of partition sizes then gives each its offset.
    ``order`` must end in a unique column.
    """
    spark = df.sparkSession
    placed = checkpointed(
        spark,
        df.orderBy(*order).withColumn("__pos", F.monotonically_increasing_id()),
    )
    part = F.shiftright(F.col("__pos"), 33)
    inside = F.col("__pos") - F.shiftleft(part, 33)
    numbered = placed.withColumn("__part", part).withColumn("__in", inside)
    sizes = numbered.groupBy("__part").agg(F.count("*").alias("__n"))
    # One row per partition: bounded by the number of tasks, not by the data.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return (
        numbered.join(F.broadcast(offsets), "__part")
        .withColumn(name, (F.col("__off") + F.col("__in") + 1).cast("bigint"))
        .drop("__pos", "__part", "__in", "__off")
    )

