"""Key checks, de-duplication, exclusion joins, upserts, exact quantiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidentpanel.functions.labels import rule_condition
from incidentpanel.session import checkpointed
from incidentpanel.skew import latest_by
from incidentpanel.sources.writers import align_to


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "table") -> DataFrame:
    """The same rows; the job fails if a key occurs twice.

    The check rides on the data: a counting window would sort, so duplicates are
    found by a partial aggregate that is joined back as a scalar.
    """
    copies = duplicate_keys(df, keys).agg(F.count("*").alias("n")).scalar()
    message = F.lit(f"{what} is not unique at {', '.join(keys)}")
    return df.filter(F.when(copies > 0, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def validated_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], what: str = "lookup") -> DataFrame:
    """Many-to-one left join that refuses a lookup with repeated keys."""
    return left.join(require_unique(right, keys, what), list(keys), "left")


def require_present(df: DataFrame, column: str, what: str) -> DataFrame:
    """Fail on rows that got no value from a join."""
    missing = F.raise_error(F.concat(F.lit(f"{what}: no {column}"))).cast("boolean")
    return df.filter(F.when(F.col(column).isNull(), missing).otherwise(F.lit(True)))


def anti_join_null_safe(df: DataFrame, excluded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows whose key tuple is listed; null keys match null keys."""
    left, right = df.alias("l"), excluded.select(*keys).distinct().alias("r")
    same = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    return left.join(right, same, "left_anti")


def apply_exclusions(df: DataFrame, exclusions: DataFrame, flag: str, keys: Sequence[str] = ("uf", "year")) -> DataFrame:
    active = exclusions.filter(F.coalesce(F.col(flag), F.lit(False)))
    return anti_join_null_safe(df, active, keys)


def apply_rules(
    df: DataFrame, rules: Sequence[tuple[str, Sequence[tuple[str, Sequence[object]]]]]
) -> tuple[DataFrame, DataFrame]:
    """Rows kept by all rules, and how many rows of the whole frame each rule hits."""
    if not rules:
        return df, df.sparkSession.createDataFrame([], "rule_name string, rows_excluded bigint")
    hits = {name: rule_condition(df, conditions) for name, conditions in rules}
    dropped = reduce(lambda a, b: a | b, hits.values())
    counted = df.agg(*[F.count_if(hit).alias(f"r{i}") for i, hit in enumerate(hits.values())])
    diagnostics = counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("rule_name"), F.col(f"r{i}").alias("rows_excluded"))
                    for i, name in enumerate(hits)
                ]
            )
        )
    )
    return df.filter(~dropped), diagnostics


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return latest_by(df, keys, order, smallest=True)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return latest_by(df, keys, order)


def upsert(existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Union of both, newest row per key.  ``order`` must be total."""
    if existing is None:
        return latest_by(incoming, keys, order)
    both = align_to(existing, incoming.schema).unionByName(incoming, allowMissingColumns=True)
    return latest_by(both, keys, order)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Exact interpolated quantiles of whole columns, one row per column and probability.

    Equal values are counted before they move, so a hot value is one row.  One range sort
    orders the distinct values; a checkpoint pins which partition holds which, and the
    partitions' sizes, one row each, turn places inside a partition into ranks.  The input
    is read once.
    """
    pair = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in columns]
    counted = (
        df.select(F.inline(F.array(*pair)))
        .filter(F.col("value").isNotNull())
        .groupBy("variable", "value")
        .agg(F.count("*").alias("copies"))
    )
    placed = checkpointed(
        df.sparkSession, counted.orderBy("variable", "value").withColumn("__part", F.spark_partition_id())
    )
    sizes = placed.groupBy("variable", "__part").agg(F.sum("copies").alias("__n"))
    # One row per partition and column: bounded by the number of tasks.
    earlier = Window.partitionBy("variable").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "variable",
        "__part",
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__n").over(Window.partitionBy("variable")).alias("__total"),
    )
    before = Window.partitionBy("variable", "__part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("__before") + F.coalesce(F.sum("copies").over(before), F.lit(0))
    ranked = (
        placed.join(F.broadcast(offsets), ["variable", "__part"])
        .withColumn("first", first)
        .withColumn("last", F.col("first") + F.col("copies") - 1)
    )
    asked = F.array(
        *[
            F.struct(F.lit(float(p)).alias("p"), (F.lit(float(p)) * (F.col("__total") - 1)).alias("position"))
            for p in probabilities
        ]
    )

    def holds(rank: Column) -> Column:
        return rank.between(F.col("first"), F.col("last"))

    hits = F.filter(asked, lambda o: holds(F.floor(o["position"])) | holds(F.ceil(o["position"])))
    near = ranked.select("variable", "value", "first", "last", F.inline(hits))
    picked = near.groupBy("variable", "p", "position").agg(
        F.max(F.when(holds(F.floor("position")), F.col("value"))).alias("lo"),
        F.max(F.when(holds(F.ceil("position")), F.col("value"))).alias("hi"),
    )
    found = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("position") - F.floor("position"))
    return picked.select("variable", "p", found.alias("quantile"))


def iqr_filter(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Rows inside the interquartile fences of every column."""
    # Two numbers per column reach the driver; as literals the fences prune the scan.
    quantiles = {(r["variable"], r["p"]): r["quantile"] for r in exact_quantiles(df, columns, [0.25, 0.75]).collect()}
    for c in columns:
        q1, q3 = quantiles[(c, 0.25)], quantiles[(c, 0.75)]
        df = df.filter(F.col(c).between(q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)))
    return df
