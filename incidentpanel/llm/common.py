"""Helpers the operators of this package share: session settings, pinned tables, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentpanel.session import checkpointed, own_scratch, scratch_path, tune

# Whole texts travel to Python workers, so batches are bounded by bytes as well as rows.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}

# Fixed value: the white space that separates words everywhere in this package.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Library settings, small Arrow batches, and a scratch folder where a local session has none."""
    tune(own_scratch(spark))
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    return spark


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def pinned(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage, survives lost executors."""
    return checkpointed(df.sparkSession, df)


_areas: list[list[str]] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside the block are removed at its end; what leaves it must be pinned by then."""
    made: list[str] = []
    _areas.append(made)
    try:
        yield
    finally:
        _areas.remove(made)
        for path in made:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Like ``pinned`` for wide or large rows: a compressed Parquet table in the shared folder."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _areas:
        _areas[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action made inside the block go when it ends, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


# The largest table to broadcast, in bytes of its rows' content.
BROADCAST_BYTES = 16 << 20


def join_sized(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", weight=None) -> DataFrame:
    """Join a pinned, usually small table whose size is measured first.

    Up to ``BROADCAST_BYTES`` it is broadcast, so the big side (often whole texts) stays
    where it is; beyond that both sides are shuffled, and adaptive execution splits the
    hot keys of the big side.  ``weight`` gives a row's bytes (by default 16).
    """
    size = small.agg(F.sum(F.lit(16) if weight is None else weight)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return big.join(F.broadcast(small), keys, how)
    return big.join(small, keys, how)


def bucket(column: str, modulus: int):
    """crc32 of a key written as text, modulo ``modulus`` (null stays null)."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(modulus))


def ascii_lower(column):
    """Lower-case A-Z only, whatever the locale or script."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _stars(edges: DataFrame) -> bool:
    """Whether every node of distinct edges ``(u, v)`` is either a root or has one edge, to a root."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("root"))
    each = ends.union(edges.select("v", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    return (each.agg(F.max(F.col("up") + F.col("root"))).first()[0] or 0) <= 1


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``(a, b)`` pairs as ``(node, root)``.

    ``root`` is the smallest node reachable; nodes without an edge do not
    appear.  Alternating large-star and small-star rounds: each round is two
    grouped minima and two joins on the edge list, which never leaves the
    executors; the driver only learns whether every edge leads to a root by now.
    """
    now = pinned(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    while not _stars(now):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = pinned(small.union(lowest.select("u", F.col("m").alias("v"))).distinct())
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
