"""Approximate nearest neighbours by counting collisions on single projections.

Every vector is projected on ``PROJECTIONS`` directions.  A block of vectors has one
sorted array for each direction; a query opens a window centred on its own projection
in each array, half ``WIDTH`` times a radius to both sides, and a vector collides in a
direction if it lies in the window.  Virtual rehashing: the radius of a query grows from
round to round, windows only open wider.  Vectors that collide in at least
``threshold`` directions are verified with the original vectors.

The threshold is such that a vector within the radius is missed with probability
``MISS`` at most.  A query ends once its k-th verified neighbour lies within its radius:
all nearer vectors then lie within it too.  The next radius is twice the last, or the
k-th verified distance if that is less; a query that still has too few neighbours after
the last round opens its windows to everything, so none goes without and nothing is
capped.  Inside a task the radius shrinks to the k-th distance found so far.

Only the first k + 1 rows of equal vectors are indexed (no more can be among the k
nearest of anything), and equal queries are searched once.  The index is sorted by the
cells of its leading directions, so that a block is left out by all queries whose
windows meet too few of its arrays.  Queries go to the tasks in chunks of
``CHUNK_BYTES``; each chunk passes over the blocks of all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidentpanel.llm.common import pinned, stored
from incidentpanel.session import scratch_path
from incidentpanel.skew import salted_join

NEAREST = 10
PROJECTIONS = 64
WIDTH = 3.2
MISS = 0.05
ROUNDS = 4
BLOCK = 8192
CHUNK_BYTES = 16 << 20
SAMPLE = 256
CELLS = 8


def threshold(directions: int, width: float, miss: float) -> int:
    """The most collisions that a vector at the radius reaches with probability 1 - miss."""
    p = math.erf(width / 2 / math.sqrt(2))
    left, count = 1.0, 0
    for k in range(directions):
        left -= math.comb(directions, k) * p**k * (1 - p) ** (directions - k)
        if left < 1 - miss:
            break
        count = k + 1
    return max(1, count)


def directions(width: int, count: int, seed: int = 7) -> np.ndarray:
    """Columns of random rotations, scaled so that a distance d projects to about N(0, d)."""
    rng = np.random.default_rng(seed)
    turns = [np.linalg.qr(rng.normal(size=(width, width)))[0] for _ in range(-(-count // width))]
    return np.concatenate(turns, axis=1)[:, :count] * math.sqrt(width)


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(lists: pa.Array, width: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Vectors in double precision, short ones padded with zeros, and their lengths."""
    sizes = np.diff(lists.offsets.to_numpy())
    made = np.zeros((len(lists), width))
    made[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return made * scale, sizes


def _column(table: pa.Table, name: str) -> pa.Array:
    return pa.concat_arrays(table.column(name).chunks)


class Queries:
    """A chunk of queries: row ids, vectors, lengths and radii, and the best k rows found for each."""

    def __init__(self, rows: np.ndarray, vectors: np.ndarray, sizes: np.ndarray, radii: np.ndarray, keep: int):
        self.rows, self.vectors, self.sizes, self.radii, self.keep = rows, vectors, sizes, radii, keep

    def search(self, blocks: Iterator[tuple[np.ndarray, ...]], turn: np.ndarray, need: int, half: float) -> Iterator[np.ndarray]:
        """Yields for each query with a verified row: its place, distances, null ids, and (id, row) of the nearest rows."""
        places = self.vectors @ turn
        count = len(self.rows)
        best = [np.zeros((0, 2)) for _ in range(count)]
        ids = [np.zeros((0, 2), np.int64) for _ in range(count)]
        reach = self.radii.copy()
        for x, sizes, vec_ids, nulls, rows in blocks:
            at = (x @ turn).T
            order = np.argsort(at, axis=1, kind="stable").astype(np.uint16 if len(x) <= 1 << 16 else np.int32)
            arrays = np.take_along_axis(at, order.astype(np.int64), axis=1)
            # Rounding must not push a vector at the very edge out of a window.
            width = half * reach + 1e-9 * (1 + np.abs(places).max(axis=1))
            low = np.array([np.searchsorted(a, p - width) for a, p in zip(arrays, places.T, strict=True)])
            high = np.array([np.searchsorted(a, p + width, "right") for a, p in zip(arrays, places.T, strict=True)])
            for q in np.flatnonzero((high > low).sum(axis=0) >= need):
                hits = np.zeros(len(x), np.int16)
                sure = 0
                for o, a, b in zip(order, low[:, q], high[:, q], strict=True):
                    if b - a <= len(x) >> 1:
                        hits[o[a:b]] += 1
                    else:  # the rest of the array is shorter than the window
                        sure += 1
                        hits[o[:a]] -= 1
                        hits[o[b:]] -= 1
                found = np.flatnonzero((hits >= need - sure) & (sizes == self.sizes[q]))
                if not len(found):
                    continue
                distance = np.sqrt(((x[found] - self.vectors[q]) ** 2).sum(axis=1))
                if len(best[q]) == self.keep:
                    near = distance <= best[q][-1, 0]
                    found, distance = found[near], distance[near]
                elif len(found) > 4 * self.keep:
                    near = distance <= np.partition(distance, self.keep)[self.keep]
                    found, distance = found[near], distance[near]
                far = np.concatenate([best[q], np.stack([distance, nulls[found]], axis=1)])
                own = np.concatenate([ids[q], np.stack([vec_ids[found], rows[found]], axis=1)])
                ranked = np.lexsort((own[:, 1], own[:, 0], far[:, 1], far[:, 0]))[: self.keep]
                best[q], ids[q] = far[ranked], own[ranked]
                if len(ranked) == self.keep:
                    reach[q] = min(reach[q], far[ranked[-1], 0])
        for q in range(count):
            if len(best[q]):
                yield q, best[q][:, 0], best[q][:, 1] > 0, ids[q]


def _blocks(batches: Iterator[pa.RecordBatch], width: int, scale: float) -> Iterator[tuple[np.ndarray, ...]]:
    """Batches gathered to blocks of about ``BLOCK`` vectors."""
    held: list[tuple[np.ndarray, ...]] = []
    count = 0
    for batch in batches:
        if not len(batch):
            continue
        x, sizes = _matrix(batch.column("v"), width, scale)
        vec_ids = batch.column("vec_id")
        held.append((x, sizes, vec_ids.fill_null(0).to_numpy(), vec_ids.is_null().to_numpy(zero_copy_only=False), batch.column("row").to_numpy()))
        count += len(x)
        if count >= BLOCK:
            yield tuple(np.concatenate(parts) for parts in zip(*held, strict=True))
            held, count = [], 0
    if held:
        yield tuple(np.concatenate(parts) for parts in zip(*held, strict=True))


def _sorted_index(rows: DataFrame, width: int, scale: float, turn: np.ndarray, cell: float, count: int) -> DataFrame:
    """Rows sorted by the cells of the leading directions, in partitions of at most some dozen blocks."""
    leading = turn[:, :CELLS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                at = _matrix(batch.column("v"), width, scale)[0] @ leading
                cells = np.floor(at / cell).astype(np.int64) if cell else np.zeros(at.shape, np.int64)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, cells.size + 1, cells.shape[1], dtype=np.int32)), pa.array(cells.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, flat], [*batch.schema.names, "cells"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    placed = stored(rows.mapInArrow(run, f"{kinds}, cells array<bigint>"), "ann-cells")
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(-(-count // (BLOCK // 2)), max(2 * tasks, -(-count // (32 * BLOCK)))))
    # The row makes keys unique, so neither equal vectors nor a full cell end in one partition.
    return pinned(placed.repartitionByRange(parts, "cells", "row").sortWithinPartitions("cells", "row").drop("cells"))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = NEAREST,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    projections: int = PROJECTIONS,
    width: float = WIDTH,
    miss: float = MISS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest rows found for each row that ``is_query`` marks.

    All rows but the query's own are candidates, if their vectors have the query's
    length; ``score`` is the Euclidean distance in double precision, ties go to the
    smaller id (null last).  A query with fewer candidates gets all of them.  Vectors
    that are null, empty, zero or hold null or non-finite components take no part.  A
    repeated row is another candidate (and another query); a null ``is_query`` counts
    as false; an empty table gives an empty result; other columns are only read by
    ``is_query``.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[vector_column].dataType.elementType.simpleString()
    vector = F.col(vector_column) if kind in ("float", "double") else F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = stored(rows.where(_usable(F.col("v"))).select("*", F.monotonically_increasing_id().alias("row")), "ann-vectors")
    rows = rows.withColumn("mark", F.xxhash64("v"))
    size, largest = rows.agg(F.max(F.size("v")), F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))))).first()
    empty = "query_id long, rank int, vec_id long, score double"
    if size is None:
        return spark.createDataFrame([], empty)
    # A power of two keeps squares of extreme components finite and all others as they are.
    scale = 2.0 ** -math.frexp(largest)[1] if largest > 1e100 else 1.0
    turn = directions(size, projections)
    need = threshold(projections, width, miss)
    keep = k + 1
    same = Window.partitionBy("mark", "v").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    listed = rows.withColumn("place", F.row_number().over(same)).where(F.col("place") <= keep).select("vec_id", "v", "row")
    listed = stored(listed, "ann-listed")
    total = listed.count()
    sample = _matrix(_column(listed.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).toArrow(), "v"), size, scale)[0]
    middle = float(np.median(np.sqrt(((sample[:, None] - sample[None]) ** 2).sum(axis=2))))
    index = _sorted_index(listed, size, scale, turn, middle, total)

    asked = rows.where("asks")
    heads = pinned(asked.groupBy("mark", "v").agg(F.min("row").alias("head")))
    members = salted_join(asked.select("mark", "v", "row", "vec_id"), heads, ["mark", "v"], ["row"]).select("head", "row", "vec_id")
    chunks = max(1, -(-heads.count() * size * 8 // CHUNK_BYTES))
    path = scratch_path(spark, "ann-found")
    schema = "head long, score double, null_id boolean, id long, row long"
    for chunk in range(chunks):
        # Bounded: about CHUNK_BYTES of vectors reach the driver and the tasks at a time.
        table = heads.where(F.pmod(F.xxhash64("head"), F.lit(chunks)) == chunk).select("head", "v").toArrow()
        if not len(table):
            continue
        ids = table.column("head").to_numpy()
        x, sizes = _matrix(_column(table, "v"), size, scale)
        radii = np.full(len(ids), middle / 2 ** (ROUNDS - 1))
        for turns in range(1, 2 * ROUNDS):
            last = turns >= 2 * ROUNDS - 1
            if last:
                radii[:] = np.inf
            state = spark.sparkContext.broadcast(Queries(ids, x, sizes, radii, keep))
            found = stored(index.mapInArrow(_search(state, turn, need, width / 2, size, scale), schema), "ann-round")
            found = _best(found, keep)
            far = found.where(F.size("found") == keep).select("head", F.element_at("found", -1)["score"].alias("far")).toArrow()
            known = dict(zip(far.column("head").to_pylist(), far.column("far").to_pylist(), strict=True))
            worst = np.array([known.get(h, np.inf) for h in ids.tolist()]) * scale
            done = (worst <= radii) | np.isinf(radii)
            ended = spark.createDataFrame(pa.table({"head": ids[done]}))
            found.join(F.broadcast(ended), "head").write.mode("append").parquet(path)
            ids, x, sizes, radii, worst = (a[~done] for a in (ids, x, sizes, radii, worst))
            if not len(ids):
                break
            # Enough were found farther out: that distance is the radius.  Too few: twice the radius, at last everything.
            radii = np.where(2 * radii > 2 * middle, np.inf, 2 * radii)
            radii = np.minimum(radii, worst)
    if not heads.count():
        return spark.createDataFrame([], empty)
    answers = spark.read.schema(found.schema).parquet(path)
    lists = salted_join(members, answers, ["head"], ["row"])
    others = F.slice(F.filter("found", lambda f: f["row"] != F.col("row")), 1, k)
    return lists.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("place", "f")).select(
        "query_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.when(~F.col("f.null_id"), F.col("f.id")).alias("vec_id"),
        F.col("f.score").alias("score"),
    )


def _search(state, turn: np.ndarray, need: int, half: float, size: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = state.value
        for q, distance, nulls, own in queries.search(_blocks(batches, size, scale), turn, need, half):
            head = np.full(len(distance), queries.rows[q])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (head, distance / scale, nulls, own[:, 0], own[:, 1])], ["head", "score", "null_id", "id", "row"]
            )

    return run


def _best(found: DataFrame, keep: int) -> DataFrame:
    """(head, found): the first ``keep`` of what all tasks found for a query; each sent at most that many."""
    order = Window.partitionBy("head").orderBy("score", "null_id", "id", "row")
    first = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
    listed = F.array_sort(F.collect_list(F.struct("score", "null_id", "id", "row")))
    return stored(first.groupBy("head").agg(listed.alias("found")), "ann-best")
