"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors with cosine c lie sqrt(2 - 2c) apart, so the cosine threshold is a distance
eps.  Vectors are turned onto their principal axes (a rotation, distances stay), put
into grid cells of side eps on the leading axes, and sorted by label and cell: the
epsilon grid order.  The sequence is cut into intervals of ``LEAF`` vectors, ``FAN`` of
which make an interval of the next level, and so on up to the whole sequence.

The join starts from the pair (whole, whole) and replaces each pair of intervals by the
pairs of their parts, dropping those that are provably farther apart than eps (their
labels do not meet, or the boxes around them on the leading axes do not).  What is left
at the lowest level are pairs of leaves, which are compared exactly by one matrix
product each.  A pair of leaves returns a count for each vector and the edges of a
spanning forest, at most one for each vector: groups of near copies never expand into
all their pairs, yet counts and components lose nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentpanel.llm.common import components, pinned, stored
from incidentpanel.skew import global_row_number

COSINE = 0.93
LEAF = 512
FAN = 8
AXES = 12
SLACK = 1e-9


def _usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, and not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _matrix(batch: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    """Rows of a list column as unit vectors in double precision, short ones padded with zeros."""
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy())
    made = np.zeros((len(lists), width))
    made[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    # Scaling by the largest component first keeps squares finite.
    made /= np.abs(made).max(axis=1, keepdims=True)
    return made / np.linalg.norm(made, axis=1, keepdims=True)


def principal_axes(vectors: DataFrame, width: int, axes: int) -> np.ndarray:
    """Leading eigenvectors of the second moments of all unit vectors, largest first.

    Tasks return the cells of a width x width matrix, which Spark adds up; the driver
    holds that one matrix, whatever the number of vectors.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            if len(batch):
                x = _matrix(batch, "v", width)
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], ["cell", "x"])

    rows = vectors.select("v").mapInArrow(moments, "cell long, x double").groupBy("cell").agg(F.sum("x").alias("x")).collect()
    matrix = np.zeros(width * width)
    for cell, x in rows:
        matrix[cell] = x
    values, columns = np.linalg.eigh(matrix.reshape(width, width))
    return columns[:, np.argsort(-values)[:axes]]


def _placed(vectors: DataFrame, width: int, turn: np.ndarray) -> DataFrame:
    """Adds ``at``, the coordinates on the leading axes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            at = _matrix(batch, "v", width) @ turn
            flat = pa.array(at.ravel())
            offsets = pa.array(np.arange(0, at.size + 1, turn.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, flat)], [*batch.schema.names, "at"])

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields)
    return vectors.mapInArrow(run, f"{kind}, at array<double>")


def _boxes(rows: DataFrame, interval: Column, axes: int) -> DataFrame:
    """Interval, first and last label, and the box around its vectors."""
    low = F.array(*[F.min(F.get("low", F.lit(i))) for i in range(axes)])
    high = F.array(*[F.max(F.get("high", F.lit(i))) for i in range(axes)])
    return rows.groupBy(interval.alias("i")).agg(
        F.min("from").alias("from"), F.max("to").alias("to"), low.alias("low"), high.alias("high")
    )


def _may_touch(eps: float) -> Column:
    """Labels meet and the gap between two boxes is at most eps; l and r are the sides."""
    gap = F.zip_with(
        F.zip_with("l.low", "r.high", lambda a, b: a - b),
        F.zip_with("r.low", "l.high", lambda a, b: a - b),
        lambda a, b: F.pow(F.greatest(a, b, F.lit(0.0)), F.lit(2.0)),
    )
    near = F.aggregate(gap, F.lit(0.0), lambda s, x: s + x) <= eps * eps + SLACK
    return (F.col("l.from") <= F.col("r.to")) & (F.col("r.from") <= F.col("l.to")) & near


def leaf_pairs(leaves: DataFrame, axes: int, eps: float, fan: int = FAN) -> DataFrame:
    """Pairs (a <= b) of leaf intervals that may hold vectors within eps of each other."""
    levels = [pinned(leaves)]
    top = levels[0].agg(F.max("i")).first()[0]
    while top is not None and top > 0:
        levels.append(pinned(_boxes(levels[-1], F.expr(f"i div {fan}"), axes)))
        top //= fan
    pairs = levels[-1].select(F.col("i").alias("a"), F.col("i").alias("b"))
    for boxes in reversed(levels[:-1]):
        first, last = F.col("a") * fan, F.col("b") * fan
        wider = pairs.select(F.explode(F.sequence(first, first + (fan - 1))).alias("a"), last.alias("b"))
        wider = wider.select("a", F.explode(F.sequence(F.col("b"), F.col("b") + (fan - 1))).alias("b"))
        sides = (
            wider.where("a <= b")
            .join(boxes.select(F.col("i").alias("a"), F.struct(*boxes.columns).alias("l")), "a")
            .join(boxes.select(F.col("i").alias("b"), F.struct(*boxes.columns).alias("r")), "b")
        )
        pairs = pinned(sides.where(_may_touch(eps)).select("a", "b"))
    return pairs


def _forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the graph between rows and columns of a boolean matrix."""
    rows, columns = linked.any(axis=1), linked.any(axis=0)
    left, right = [], []
    while rows.any():
        front = np.flatnonzero(rows)[:1]
        rows[front] = False
        while len(front):
            reach = linked[front]
            new = np.flatnonzero(reach.any(axis=0) & columns)
            columns[new] = False
            left.append(front[reach[:, new].argmax(axis=0)] if len(new) else new)
            right.append(new)
            back = linked[:, new]
            front = np.flatnonzero(back.any(axis=1) & rows) if len(new) else new
            rows[front] = False
            left.append(front)
            right.append(new[back[front].argmax(axis=1)] if len(front) else front)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _compare(pairs: DataFrame, width: int, cosine: float) -> DataFrame:
    """Rows (pos, n, other): links counted in this pair of leaves; ``other`` set for forest edges."""

    def side(batch: pa.RecordBatch, k: int, name: str):
        value = batch.column(name)[k]
        pos = np.frombuffer(value["pos"].as_py(), np.int64)
        mark = np.frombuffer(value["mark"].as_py(), np.int64)
        x = np.frombuffer(value["x"].as_py(), np.float32).reshape(len(pos), width).astype(np.float64)
        # Like _matrix: scale, then normalise in double precision.
        x = x / np.abs(x).max(axis=1, keepdims=True)
        return pos, mark, x / np.linalg.norm(x, axis=1, keepdims=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                pa_, ma, xa = side(batch, k, "l")
                pb, mb, xb = side(batch, k, "r")
                linked = (xa @ xb.T >= cosine) & (ma[:, None] == mb[None, :])
                same = pa_[0] == pb[0]
                if same:
                    np.fill_diagonal(linked, False)
                if not linked.any():
                    continue
                i, j = _forest(linked)
                pos, n = [pa_, pa_[i]], [linked.sum(axis=1), np.zeros(len(i), np.int64)]
                other = [np.full(len(pa_), -1), pb[j]]
                if not same:
                    pos.append(pb)
                    n.append(linked.sum(axis=0))
                    other.append(np.full(len(pb), -1))
                pos, n, other = (np.concatenate(x).astype(np.int64) for x in (pos, n, other))
                keep = (n > 0) | (other >= 0)
                yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (pos, n, other)], ["pos", "n", "other"])

    return pairs.mapInArrow(run, "pos long, n long, other long")


def _payload(rows: DataFrame, width: int) -> DataFrame:
    """One row per leaf: positions, group marks and vectors as bytes; at most LEAF vectors each."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        sizes = np.array([len(v) for v in table.column("v")])
        x = np.zeros((len(sizes), width), np.float32)
        x[np.arange(width) < sizes[:, None]] = np.concatenate([v.values.to_numpy(zero_copy_only=False) for v in table.column("v")])
        made = {"i": [table.column("i")[0].as_py()]}
        for name, value in (("pos", table.column("pos").to_numpy()), ("mark", table.column("mark").to_numpy()), ("x", x)):
            made[name] = [np.ascontiguousarray(value).tobytes()]
        return pa.table(made, schema=pa.schema([("i", pa.int64()), ("pos", pa.binary()), ("mark", pa.binary()), ("x", pa.binary())]))

    return rows.groupBy("i").applyInArrow(pack, "i long, pos binary, mark binary, x binary")


def near_duplicates(
    vectors: DataFrame,
    cosine: float = COSINE,
    axes: int = AXES,
    leaf: int = LEAF,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row.

    Rows link when their labels are equal and not null, their vectors have the same
    length, and the cosine is at least ``cosine``.  Null or zero vectors and vectors
    with null or non-finite components link with nothing.  A repeated row is another
    vector (it links with its copy); a null id is never a component's id unless all its
    ids are null; an empty table gives an empty result; other columns are not read.
    """
    eps = math.sqrt(max(0.0, 2 - 2 * cosine))
    rows = vectors.select(
        F.col(id_column).alias("vec_id"), F.col(label_column).alias("label"), F.col(vector_column).cast("array<float>").alias("v")
    ).withColumn("usable", F.coalesce(_usable(F.col("v")) & F.col("label").isNotNull(), F.lit(False)))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    usable = rows.where("usable").select("row", F.xxhash64("label", F.size("v")).alias("mark"), "v")
    width = usable.agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"), F.lit(True).alias("kept")
        )
    axes = min(axes, width)
    turn = principal_axes(usable, width, axes)
    placed = _placed(usable, width, turn)
    # Epsilon grid order: label first, then the cells on the leading axes.
    cells = [F.floor(F.get("at", F.lit(i)) / eps) if eps else F.get("at", F.lit(i)) for i in range(axes)]
    ordered = stored(
        global_row_number(placed, [F.col("mark"), *cells, F.col("row")], "pos").withColumn("i", F.expr(f"(pos - 1) div {leaf}")),
        "grid-order",
    )
    spots = ordered.select("i", F.col("mark").alias("from"), F.col("mark").alias("to"), F.col("at").alias("low"), F.col("at").alias("high"))
    pairs = leaf_pairs(_boxes(spots, F.col("i"), axes), axes, eps)
    payload = stored(_payload(ordered.select("i", "pos", "mark", "v"), width), "leaves")
    body = F.struct("pos", "mark", "x")
    sides = pairs.join(payload.select(F.col("i").alias("a"), body.alias("l")), "a").join(
        payload.select(F.col("i").alias("b"), body.alias("r")), "b"
    )
    found = pinned(_compare(sides.select("l", "r"), width, cosine))
    counts = found.groupBy("pos").agg(F.sum("n").alias("n_links"))
    roots = components(found.where("other >= 0").select(F.col("pos").alias("a"), F.col("other").alias("b")))
    known = pinned(
        rows.join(ordered.select("row", "pos"), "row", "left")
        .join(counts, "pos", "left")
        .join(roots.withColumnRenamed("node", "pos"), "pos", "left")
        .select("vec_id", "row", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "root")
    )
    least = known.where("root is not null").groupBy("root").agg(F.min("vec_id").alias("least"))
    out = known.join(least, "root", "left").select(
        "vec_id", "n_links", F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("least")).cast("long").alias("component_id")
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
