"""Merkle manifest of a dataset: one tree per group, one tree over the groups, a proof per row.

Slot pivot.  The nodes of a level are numbered; ``fanout`` consecutive ones have one
parent, and a node's place among them is its slot.  Conditional aggregates over the
children of a parent, one for each slot, spread their digests into ``fanout`` columns:
the columns joined in order hash to the parent, and the columns without the own slot
are the siblings a proof lists.

Levels are worked on in bands.  A band deals nodes out by blocks of ``BAND`` (64 leaves
with two children a parent) and sorts each block once by the digits of its numbers; the
conditional aggregates of all its levels are windows keyed by ever shorter prefixes of
these digits, so a band of many levels takes one shuffle and one sort.  Its blocks are
the nodes of the next band.  Proofs go back down by one join a band.  The largest group
of rows anywhere is a block, whatever the sizes of the groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidentpanel.llm.common import join_sized, pinned, stored
from incidentpanel.skew import global_row_number

FANOUT = 2
BAND = 64
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_PROOF = "array<struct<left: binary, right: binary>>"


def digest(content: Column) -> Column:
    """SHA-256 of a text or of bytes, as 32 bytes."""
    return F.unhex(F.sha2(content, 256))


def as_text(value: Column) -> Column:
    """A digest as lower-case hex text."""
    return F.lower(F.hex(value))


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """Digest of a row's values; the lengths keep neighbouring values apart."""
    return digest(F.concat(*[field(v) for v in values]))


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, start, lambda node, step: digest(as_text(F.concat(step["left"], node, step["right"]))))


def siblings(proof: Column) -> Column:
    """All digests of a proof in order, as one hex text."""
    return F.array_join(F.transform(proof, lambda step: as_text(F.concat(step["left"], step["right"]))), "")


def _depth(fanout: int) -> int:
    depth = 1
    while fanout ** (depth + 1) <= BAND:
        depth += 1
    return depth


def _band(nodes: DataFrame, fanout: int, depth: int) -> DataFrame:
    """Adds ``block``, the block's digest ``up``, and ``proof``, the node's siblings inside the block.

    ``nodes`` has g (group), i (number from 0), n (nodes of the group on this level) and
    d (digest); a level of one node is a root and stays as it is.
    """
    digits = [F.expr(f"cast(i div {fanout**k} % {fanout} as int)").alias(f"t{k}") for k in range(depth)]
    names = [f"t{k}" for k in reversed(range(depth))]
    rows = nodes.select("*", F.expr(f"i div {fanout**depth}").alias("block"), *digits)
    rows = rows.repartition("g", "block").sortWithinPartitions("g", "block", *names)
    empty = F.lit(b"")
    rows = rows.withColumn("up", F.col("d")).withColumn("proof", F.array().cast(_PROOF))
    for k in range(depth):
        family = Window.partitionBy("g", "block", *names[: depth - 1 - k])
        rows = rows.select(
            "*", *[F.max(F.when(F.col(f"t{k}") == s, F.col("up"))).over(family).alias(f"slot{s}") for s in range(fanout)]
        )
        slots = [F.coalesce(F.col(f"slot{s}"), empty) for s in range(fanout)]
        left = F.concat(*[F.when(F.col(f"t{k}") > s, slots[s]).otherwise(empty) for s in range(fanout)])
        right = F.concat(*[F.when(F.col(f"t{k}") < s, slots[s]).otherwise(empty) for s in range(fanout)])
        many = F.expr(f"(n + {fanout**k - 1}) div {fanout**k} > 1")
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        rows = rows.withColumns(
            {
                "proof": F.when(many, F.concat("proof", step)).otherwise(F.col("proof")),
                "up": F.when(many, digest(as_text(F.concat(*slots)))).otherwise(F.col("up")),
            }
        ).drop(*[f"slot{s}" for s in range(fanout)])
    return rows.drop(*names)


def _trees(nodes: DataFrame, most: int, fanout: int, name: str) -> tuple[DataFrame, DataFrame]:
    """(nodes with their proofs up to their group's root, one row per group with its root)."""
    depth = _depth(fanout)
    width = fanout**depth
    bands = []
    while most > 1:
        bands.append(stored(_band(nodes, fanout, depth), f"{name}-{len(bands)}"))
        nodes = bands[-1].groupBy("g", F.col("block").alias("i")).agg(
            F.max(F.expr(f"(n + {width - 1}) div {width}")).alias("n"), F.max("up").alias("d")
        )
        most = -(-most // width)
    roots = pinned(nodes.select("g", F.col("d").alias("subroot")))
    if not bands:
        return nodes.withColumn("proof", F.array().cast(_PROOF)).drop("n"), roots
    path = bands.pop().drop("block", "up", "n")
    while bands:
        above = path.select("g", F.col("i").alias("block"), F.col("proof").alias("rest"))
        below = bands.pop().drop("up", "n")
        path = below.join(above, ["g", "block"]).withColumn("proof", F.concat("proof", "rest")).drop("rest", "block")
    return path, roots


def manifest(
    rows: DataFrame,
    key: str = "doc_id",
    group: str = "lang",
    columns: tuple[str, ...] = COLUMNS,
    fanout: int = FANOUT,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per input row: key, ``leaf``, ``subroot``, ``root``, ``proof`` and what ``carry`` names.

    A leaf is the digest of ``columns``.  The leaves of a group ascend by key (null
    first; rows with one key by their leaf); the groups ascend bytewise, null first,
    and their roots are the leaves of the last tree.  ``leaf``, ``subroot`` and
    ``root`` are bytes; ``proof`` lists for each level the digests left and right of
    the own one, up to the root; a lone leaf is its group's root and a lone group's
    root is the root.

    Nulls are values of their own; empty texts differ from null.  Repeated rows are
    leaves of their own with equal digests.  An empty table gives an empty result.
    Only ``columns``, key, group and what ``carry`` reads are used; other columns,
    whatever they are called, are not.  ``carry`` maps new names to expressions over
    ``rows`` and must not use the names of the result.
    """
    carry = carry or {}
    parts = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    leaves = stored(
        rows.select(
            F.col(key).alias("__key"),
            parts.alias("g"),
            leaf(*[F.col(c) for c in columns]).alias("d"),
            F.monotonically_increasing_id().alias("__row"),
            *[expression.alias(f"__carry_{name}") for name, expression in carry.items()],
        ),
        "leaves",
    )
    placed = global_row_number(leaves, [F.col("g"), F.col("__key"), F.col("d"), F.col("__row")], "at")
    groups = pinned(placed.groupBy("g").agg(F.min("at").alias("first"), F.count("*").alias("n")))
    ranked = pinned(global_row_number(groups.select("g"), [F.col("g")], "rank"))
    many, most = groups.agg(F.count("*"), F.max("n")).first()
    nodes = join_sized(placed, groups, ["g"], weight=F.octet_length("g") + 24)
    nodes = nodes.withColumn("i", F.col("at") - F.col("first")).drop("at", "first", "__row").withColumn("leaf", F.col("d"))
    under, subroots = _trees(nodes, most or 0, fanout, "tree")
    tops = subroots.join(ranked, "g").select(
        F.lit("").alias("g"), (F.col("rank") - 1).alias("i"), F.lit(many).cast("long").alias("n"), F.col("subroot").alias("d"),
        F.col("g").alias("of"), "subroot",
    )
    over, root = _trees(tops, many, fanout, "groups")
    top = root.first()  # one row, or none for an empty table
    above = over.select(
        F.col("of").alias("g"), "subroot", F.lit(bytes(top[1]) if top else None).cast("binary").alias("root"), F.col("proof").alias("rest")
    )
    made = join_sized(under, pinned(above), ["g"], weight=F.octet_length("g") + 64 * (F.size("rest") + 2))
    return made.select(
        F.col("__key").alias(key),
        "leaf",
        "subroot",
        "root",
        F.concat("proof", "rest").alias("proof"),
        *[F.col(f"__carry_{name}").alias(name) for name in carry],
    )


def audit(rows: DataFrame, changed: dict[str, Column], altered: Column, **settings) -> DataFrame:
    """The manifest of ``rows``, and for each row the root its proof leads to after a change.

    ``changed`` maps columns to what they become where ``altered`` is true; the proof
    stays that of the unchanged table, so ``verified`` tells rows that were altered.
    A null ``altered`` counts as false.
    """
    columns = settings.get("columns", COLUMNS)
    now = leaf(*[F.when(altered, changed[c].cast("string")).otherwise(F.col(c).cast("string")) if c in changed else F.col(c) for c in columns])
    made = manifest(rows, carry={"now": now}, **settings)
    return made.withColumn("folded_root", fold(F.col("now"), F.col("proof"))).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    ).drop("now")
