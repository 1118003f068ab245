"""Named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidentpanel.session import own_scratch, tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text, floats rounded to six digits, for stable comparison."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the equivalent statement over the same tables."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from incidentpanel.catalog.roles import forget_schemas

            tune(own_scratch(spark))
            forget_schemas()
            return plain(fn(spark, sf_dir))

        run.__doc__ = fn.__doc__
        run.__name__ = fn.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
