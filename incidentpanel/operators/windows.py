"""Sliding windows over ordered series, cut from blocks with a halo.

Each entity's rows are numbered in order and cut into blocks of ``span`` rows; a block
also holds the rows its windows reach before and after it (the halo), so every window
lies inside one block and blocks are worked on independently.  A table of blocks is
the panel's size times ``1 + (before + after) / span``; windows are only cut out of a
block where they are used, and only for the rows that ask for one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A block of daily windows covers this many lookbacks, so the halo adds a quarter.
SPANS = 4


def halo_blocks(rows: DataFrame, entity: str, order: str, before: int, after: int, span: int) -> DataFrame:
    """``(entity, block, steps)``: rows of a block and its halo as structs in order.

    ``steps`` has ``pos`` (the row's number from 0), ``own`` (false in the halo) and all
    other columns.  The rows of an entity are numbered in one window, so ``rows`` must
    hold a bounded number for each entity (one per period of a calendar); the blocks
    reuse that partitioning.  Rows of an entity with equal ``order`` keep no set order.
    """
    number = F.row_number().over(Window.partitionBy(entity).orderBy(order)) - 1
    first = F.greatest(F.lit(0), F.floor((F.col("pos") - after) / span)).cast("int")
    last = F.floor((F.col("pos") + before) / span).cast("int")
    spread = rows.withColumn("pos", number).withColumn("block", F.explode(F.sequence(first, last)))
    own = F.floor(F.col("pos") / span).cast("int") == F.col("block")
    step = F.struct("pos", own.alias("own"), *[c for c in rows.columns if c != entity])
    blocks = spread.groupBy(entity, "block").agg(F.array_sort(F.collect_list(step)).alias("steps"))
    return blocks.filter(F.exists("steps", lambda s: s["own"]))


def full_windows(before: int, after: int, wanted: Callable[[Column], Column] | None = None) -> Column:
    """Places in ``steps`` of the block's own rows whose whole reach is there and that ``wanted`` (of a place) accepts."""
    size = F.size("steps")

    def usable(i: Column) -> Column:
        inside = F.get("steps", i)["own"] & (i >= before) & (i + after < size)
        return inside if wanted is None else inside & F.coalesce(wanted(i), F.lit(False))

    return F.filter(F.sequence(F.lit(0), size - 1), usable)


def step_at(i: Column, field: str) -> Column:
    return F.get("steps", i)[field]


def reach(i: Column, first: int, last: int, field: str, kind: str | None = None) -> Column:
    """Values of a field from ``first`` to ``last`` rows after place ``i``."""
    picked = F.slice("steps", i + first + 1, F.lit(last - first + 1))
    return F.transform(picked, lambda s: s[field] if kind is None else s[field].cast(kind))


def lookback_blocks(
    rows: DataFrame, entity: str, order: str, channels: Sequence[Column], lookback: int, keep: Sequence[str], span: int | None = None
) -> DataFrame:
    """``(entity, block, lookback, series, rows)``: what windows of the last ``lookback`` rows are cut from.

    ``series`` lists the channels (32-bit) of each step; ``rows`` has for each own row
    with a full window its place ``at`` in the series (its window ends before it) and
    the ``keep`` columns.
    """
    span = max(lookback, span or SPANS * lookback)
    narrow = rows.select(entity, F.col(order).alias("__order"), F.array(*[c.cast("float") for c in channels]).alias("__step"), *keep)
    blocks = halo_blocks(narrow, entity, "__order", lookback, 0, span)
    described = F.transform(
        full_windows(lookback, 0), lambda i: F.struct(i.alias("at"), *[step_at(i, c).alias(c) for c in keep])
    )
    made = blocks.select(
        entity, "block", F.lit(lookback).alias("lookback"), F.transform("steps", lambda s: s["__step"]).alias("series"), described.alias("rows")
    )
    return made.filter(F.size("rows") > 0)


def open_windows(blocks: DataFrame, entity: str, channels: int, name: str = "sequence") -> DataFrame:
    """One row per window: entity, a channels x lookback matrix and the kept columns."""
    fields = [f.name for f in blocks.schema["rows"].dataType.elementType.fields if f.name != "at"]

    def cut(row: Column) -> Column:
        steps = F.slice("series", row["at"] - F.col("lookback") + 1, F.col("lookback"))
        matrix = F.transform(F.sequence(F.lit(0), F.lit(channels - 1)), lambda c: F.transform(steps, lambda s: F.get(s, c)))
        return F.struct(matrix.alias(name), *[row[f].alias(f) for f in fields])

    return blocks.select(entity, F.inline(F.transform("rows", cut)))


def keep_rows(blocks: DataFrame, wanted: Callable[[Column], Column]) -> DataFrame:
    """Blocks with only the rows that ``wanted`` accepts; blocks left without one go."""
    return blocks.withColumn("rows", F.filter("rows", wanted)).filter(F.size("rows") > 0)


def is_blocks(samples: DataFrame) -> bool:
    return "series" in samples.columns


def unpack(table: pa.Table | pa.RecordBatch, entity: str | None) -> tuple[pa.Table, np.ndarray]:
    """Inside a task: the kept columns of each window, and the windows as (windows, channels, steps).

    Takes rows with a ``sequence`` or blocks; a group of blocks is as long as the
    calendar, so its windows fit a task.
    """
    if isinstance(table, pa.RecordBatch):
        table = pa.Table.from_batches([table])
    if "series" not in table.schema.names:
        column = table.column("sequence").combine_chunks()
        flat = column.flatten().flatten().to_numpy(zero_copy_only=False)
        channels = len(column[0]) if len(column) else 1
        cube = flat.reshape(len(column), channels, -1 if len(flat) else 1).astype(np.float32, copy=False)
        return table.drop_columns(["sequence"]), cube
    kept, cubes = [], []
    for k in range(len(table)):
        series = table.column("series")[k].values
        steps = len(series)
        values = series.flatten().to_numpy(zero_copy_only=False).reshape(steps, -1).astype(np.float32, copy=False)
        lookback = table.column("lookback")[k].as_py()
        rows = pa.Table.from_struct_array(table.column("rows")[k].values)
        if entity is not None:
            rows = rows.add_column(0, entity, pa.repeat(table.column(entity)[k], len(rows)))
        views = np.lib.stride_tricks.sliding_window_view(values, lookback, axis=0)
        cubes.append(views[rows.column("at").to_numpy() - lookback])
        kept.append(rows.drop_columns(["at"]))
    if not kept:
        return table.schema.empty_table(), np.zeros((0, 1, 1), np.float32)
    return pa.concat_tables(kept), np.concatenate(cubes)
