"""URL rules by a sort-merge range join, with DataFrame functions only.

A rule is a host and a path prefix; it fits that host and all its subdomains.  The
canonical key of a host is its labels reversed, each closed by a dot
(``org.example.``), so a rule's host and subdomains are exactly the keys that start
with its own key: an interval of the sorted key order.  Such intervals are nested or
disjoint.  ``sweep`` sorts points and interval ends together by range partitions and
keeps a stack of the open intervals with one slot for each level of nesting; every
partition starts from the slots left open by the ones before it.

The first sweep gives each page the rule hosts that hold it.  Path prefixes under one
host are intervals of the same kind, so a second sweep over host and path as one key
finds the longest prefix under each of these hosts, and the longest rule wins.  No
array of the rules of a host is ever built, and a hot host is cut over many
partitions because the sort has the row as its last key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from incidentpanel.llm.common import ascii_lower, load, pinned

DEFAULT_VERDICT = "allow"

# Ends the host in a key of host and path: no host or path holds it.
EDGE = "\u0001"
# Sorts after every text that continues a key.
LAST = "\U0010ffff" * 4

CLOSE, OPEN, POINT = 0, 1, 2


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """``example.org`` as ``org.example.``"""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def sweep(points: DataFrame, intervals: DataFrame) -> DataFrame:
    """Adds ``stack``: the interval keys, outermost first, that ``key`` starts with.

    ``points`` has a text ``key`` and any other columns; ``intervals`` one text
    column ``key``.
    """
    own = [c for c in points.columns if c != "key"]
    starts = intervals.select("key").distinct()
    marks = starts.select("key", F.lit(OPEN).alias("__kind")).union(
        starts.select(F.concat("key", F.lit(LAST)), F.lit(CLOSE))
    )
    events = points.withColumn("__kind", F.lit(POINT)).unionByName(marks, allowMissingColumns=True)
    placed = pinned(
        events.withColumn("__tie", F.xxhash64(*own))
        .repartitionByRange("key", "__kind", "__tie")
        .withColumn("__part", F.spark_partition_id())
    )
    step = F.when(F.col("__kind") == OPEN, 1).when(F.col("__kind") == CLOSE, -1).otherwise(0)
    so_far = (
        Window.partitionBy("__part").orderBy("key", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # One row per partition, so these windows and broadcasts are bounded by the number of tasks.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("__part").agg(F.sum(step).alias("__step"))
    depth = parts.select("__part", F.coalesce(F.sum("__step").over(before), F.lit(0)).alias("__base"))
    levels = placed.join(F.broadcast(depth), "__part").withColumn("__level", F.col("__base") + F.sum(step).over(so_far))
    opened = pinned(levels.where(F.col("__kind") == OPEN).select("__part", "key", "__level"))
    deepest = opened.agg(F.max("__level")).first()[0] or 0
    if not deepest:
        return points.withColumn("stack", F.array().cast("array<string>"))
    # Keys are swept in ascending order: the last interval opened is the largest key so far.
    at = {d: F.when(F.col("__level") == d, F.col("key")) for d in range(1, deepest + 1)}
    ends = depth.select("__part").join(
        opened.groupBy("__part").agg(*[F.max(c).alias(f"__end{d}") for d, c in at.items()]), "__part", "left"
    )
    carried = ends.select("__part", *[F.max(f"__end{d}").over(before).alias(f"__from{d}") for d in at])
    own_open = {d: F.when((F.col("__kind") == OPEN) & (F.col("__level") == d), F.col("key")) for d in at}
    swept = (
        levels.join(F.broadcast(carried), "__part")
        .withColumns({f"__slot{d}": F.greatest(F.max(c).over(so_far), F.col(f"__from{d}")) for d, c in own_open.items()})
        .where(F.col("__kind") == POINT)
    )
    slots = F.array(*[F.when(F.col("__level") >= d, F.col(f"__slot{d}")) for d in at])
    active = F.filter(slots, lambda k: k.isNotNull() & F.col("key").startswith(k))
    return swept.select("key", *own, active.alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict)``, one row per input row.

    ``rules`` has the texts host, path and verdict; of fitting rules the one with the
    longest text wins, then the longer host.  A rule with a null field is ignored; of
    equal rules the verdict last in order counts.  Null urls and urls without
    ``://`` have an empty host and path; repeated rows stay repeated; pages that no
    rule fits, and all pages without rules, get a null rule and ``default``.
    """
    known = (
        rules.select(ascii_lower(F.col("host")).alias("h"), F.col("path").alias("p"), "verdict")
        .dropna()
        .groupBy("h", "p")
        .agg(F.max("verdict").alias("v"))
        .withColumn("hk", host_key(F.col("h")))
    )
    urls = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("u"))
    parsed = pinned(
        urls.select(
            F.monotonically_increasing_id().alias("row"), "page_id", host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path")
        )
    )
    held = sweep(
        parsed.withColumn("key", host_key(F.col("host"))), known.select(F.col("hk").alias("key"))
    )
    below = held.select("row", F.explode("stack").alias("hk"), "path").select(
        "row", F.concat("hk", F.lit(EDGE), "path").alias("key")
    )
    ruled = known.withColumn("key", F.concat("hk", F.lit(EDGE), "p"))
    longest = sweep(below, ruled).select("row", F.try_element_at("stack", F.lit(-1)).alias("key")).where("key is not null")
    # One row for each page and rule host that holds it: at most the labels of its host.
    fits = longest.join(ruled, "key").groupBy("row").agg(
        F.max(F.struct(F.length("h") + F.length("p"), F.length("h"), F.concat("h", "p").alias("rule"), "v")).alias("best")
    )
    return parsed.join(fits, "row", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.v", F.lit(default)).alias("verdict")
    )


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (host, path, verdict)."""
    return spark.createDataFrame(rules, "host string, path string, verdict string")
