"""Writers: partitioned tables, staged publication, dual formats, manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidentpanel.session import scratch_path


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", order: Sequence[str] = ()
) -> str:
    """Partitioned Parquet.

    Rows keep their shuffle layout, so a hot partition value is written by many
    tasks instead of one; ``order`` sorts rows inside each file.
    """
    if order:
        df = df.sortWithinPartitions(*partition_by, *order)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return path


def refresh_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """Replace only the partitions present in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    return path


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Replace a dataset that ``df`` may itself read from: stage first, then overwrite."""
    spark = df.sparkSession
    staged = scratch_path(spark, "staged")
    write_table(df, staged, partition_by)
    return write_table(spark.read.schema(df.schema).parquet(staged), path, partition_by)


def save_frame(df: DataFrame, folder: str, name: str) -> tuple[str, str]:
    """The same rows as Parquet and as CSV."""
    base = f"{folder.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(f"{base}.parquet")
    df.write.mode("overwrite").option("header", True).csv(f"{base}.csv")
    return f"{base}.parquet", f"{base}.csv"


def save_samples(samples: DataFrame, path: str, partition_by: Sequence[str] = ("group_name", "split")) -> str:
    """Sample tensors stay array columns, partitioned for training reads."""
    return write_table(samples, path, partition_by)


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast known columns to a target schema; absent ones become null."""
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in df.columns]
    known = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name in df.columns]
    return df.select(*known, *missing).select(*[f.name for f in schema.fields])


def manifest(df: DataFrame, measures: dict[str, Column], **facts: object) -> DataFrame:
    """One row of run facts: computed measures next to given values."""
    return df.agg(*[c.alias(n) for n, c in measures.items()]).select(
        "*", *[F.lit(v).alias(n) for n, v in facts.items()]
    )


def write_manifest(row: DataFrame, path: str) -> str:
    row.coalesce(1).write.mode("overwrite").json(path)
    return path
