"""Mixing sources to target weights.

Sizes are words.  Sources in code point order (null last) take the weights 3, 1, 2
in turn and share a budget of 1.5 times all sizes; no target may exceed twice its
source's size, and what is cut off is shared again by weight among the others until
none is above.  A source's rate is target / size; a document is taken floor(rate)
times, plus once more if a hash of its id falls below the fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentpanel.llm.common import WORD, pinned
from incidentpanel.skew import global_row_number, salted_join

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
CEILING = 2.0
SEED = "mix-1"
# More sources than this are joined by a shuffle.
BROADCAST_ROWS = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, ceiling: float = CEILING) -> DataFrame:
    """``(source, source_size, target)`` from rows ``(source, size)``.

    The shared level (words per unit of weight) is found by raising it over the
    sources that are not yet at their ceiling; a round is one aggregate over the
    source table, and the driver holds three numbers.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_row_number(totals, [F.col("source").asc_nulls_last()], "rank")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") - 1).cast("int") % len(weights) + 1)
    table = pinned(ranked.select("source", "source_size", turn.alias("weight"), (F.col("source_size") * ceiling).alias("most")))
    total, weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    level, before = 0.0, None
    left = budget * float(total or 0)
    while total and weight and before != level:
        before, level = level, left / weight
        full = F.col("most") <= F.lit(level) * F.col("weight")
        row = table.agg(F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))).first()
        left, weight = budget * float(total) - float(row[0] or 0.0), row[1]
    if total and not weight:
        level = float("inf")
    target = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.least("most", F.lit(level) * F.col("weight")))
    return table.select("source", "source_size", target.alias("target"))


def draw(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) fixed by the key: the first 32 bits of an MD5."""
    text = F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _with_rates(rows: DataFrame, targets: DataFrame, columns: list[str]) -> DataFrame:
    """Adds target columns to rows by source, null matching null.

    The targets are broadcast only after their rows were counted; a longer table is
    joined with the hot sources salted.
    """
    key = F.when(F.col("source").isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col("source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    by = targets.select(key.alias("__mix_key"), rate.alias("__mix_rate"), *columns)
    keyed = rows.withColumn("__mix_key", key)
    if targets.count() <= BROADCAST_ROWS:
        return keyed.join(F.broadcast(by), "__mix_key").drop("__mix_key")
    return salted_join(keyed, by, ["__mix_key"], ["doc_id"]).drop("__mix_key")


def _taken(seed: str) -> Column:
    whole = F.floor("__mix_rate")
    return whole + (draw(F.col("doc_id"), seed) < F.col("__mix_rate") - whole).cast("long")


def mix_plan(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, ceiling: float = CEILING, seed: str = SEED) -> DataFrame:
    """``(doc_id, size, source_size, target, copies, taken)``, one row per input row.

    Null texts have size 0; null sources are one source, last in order; rows that
    repeat an id share its draw; a null id has a draw of its own; an empty table
    gives an empty plan.  A source without words has target 0 and is not taken.
    """
    sized = pinned(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    targets = source_targets(sized, weights, budget, ceiling)
    planned = _with_rates(sized, targets, ["source_size", "target"]).withColumn("copies", _taken(seed))
    return planned.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, ceiling: float = CEILING, seed: str = SEED) -> DataFrame:
    """The documents themselves, each repeated as often as it is taken, with its ``copy`` number from 1.

    The cases of ``mix_plan`` hold here too: a source without words is not taken, and an
    empty document of another source follows that source's rate.  If the documents have
    a column ``copy``, the number is called ``mix_copy``, or if they have that too,
    ``mix_mix_copy``; other columns may have any names.
    """
    sizes = docs.select("source", word_count(F.col("text")).alias("size")).groupBy("source").agg(F.sum("size").alias("size"))
    targets = source_targets(sizes, weights, budget, ceiling)
    name = "copy"
    while name in docs.columns:
        name = f"mix_{name}"
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__own"), "source", "doc_id")
    rated = _with_rates(rows, targets, []).withColumn("__mix_taken", _taken(seed).cast("int")).where("__mix_taken > 0")
    own = [F.col("__own")[c].alias(c) for c in docs.columns]
    return rated.select(*own, F.explode(F.sequence(F.lit(1), F.col("__mix_taken"))).alias(name))
