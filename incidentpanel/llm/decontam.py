"""Benchmark decontamination as a prefix-filtered set join, with DataFrame functions only.

A window of a benchmark item is the set of its word shingles with their offsets; a text
contains the window only if it has all of them.  So the rarest one is enough to find
every candidate:

1. the shingles of all texts meet the shingles of the benchmark once (positions and
   64-bit hashes only); the matches, a small share of all positions, are pinned;
2. shingles are ordered by the number of texts that have them, and each window keeps
   its rarest as the prefix token (for containment of all tokens one is necessary and
   enough);
3. matches of a prefix token give candidates: the window must start at the position
   less the token's offset, not before the text's start, and end within its length;
4. candidates are verified word by word against the text.

Copies of a text share a key, so they are compared once.  Matching and verification cut
the same words and lower-case A-Z alone: lower-casing other letters depends on what stands
around them (a Greek final sigma), so equal words would not stay equal.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentpanel.llm.common import ascii_lower, join_sized, pinned

WINDOW = 10
SHINGLE = 3

# Fixed value: words are runs of these characters after lower-casing A-Z.
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same words before lower-casing.
RAW_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORDS), F.lit(0))


def _hashes(words: Column, size: int) -> Column:
    """Hash of every shingle of ``size`` words, in order."""
    starts = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(size)]))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(item, wkey, len, folded)``: each item's windows; ``wkey`` is the window's text.

    An item with fewer words than ``window``, but not none, is one window.
    """
    worded = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w")).where(
        F.size("w") > 0
    )
    length = F.least(F.size("w"), F.lit(window))
    starts = worded.select("item", "w", length.alias("len"), F.explode(F.sequence(F.lit(1), F.size("w") - length + 1)).alias("at"))
    return starts.select(
        "item", F.array_join(F.slice("w", F.col("at"), F.col("len")), " ").alias("wkey"), "len"
    ).distinct()


def with_hits(docs: DataFrame, windows: DataFrame, shingle: int = SHINGLE, text_column: str = "text") -> DataFrame:
    """Adds ``__key`` (hash of the text) and ``__hits``, an array of (start, len, wkey), null if none.

    All columns and rows of ``docs`` stay.
    """
    text = F.col(text_column)
    keyed = docs.withColumn("__key", F.xxhash64(text))
    unique = pinned(windows.select("wkey", "len").distinct())
    sizes = [r[0] for r in unique.select(F.least("len", F.lit(shingle)).alias("k")).distinct().collect()]
    if not sizes:
        return keyed.withColumn("__hits", F.lit(None).cast("array<struct<start:int,len:int,wkey:string>>"))
    tokens = pinned(
        reduce(
            DataFrame.union,
            [
                unique.where(F.least("len", F.lit(shingle)) == k)
                .select("wkey", "len", F.split("wkey", " ").alias("w"))
                .select("wkey", "len", F.posexplode(_hashes(F.col("w"), k)).alias("offset", "h"))
                for k in sorted(sizes)
            ],
        )
    )
    wanted = pinned(tokens.select("h").distinct())
    slim = keyed.select("__key", words_of(text).alias("w"))
    matches = pinned(
        reduce(
            DataFrame.union,
            [
                join_sized(
                    slim.select("__key", F.size("w").alias("n"), F.posexplode(_hashes(F.col("w"), k)).alias("pos", "h")),
                    wanted,
                    ["h"],
                ).select("__key", "n", "pos", "h")
                for k in sorted(sizes)
            ],
        ).distinct()
    )
    rarity = matches.groupBy("h").agg(F.count("*").alias("texts"))
    ranked = tokens.join(rarity, "h", "left")
    prefix = (
        ranked.groupBy("wkey", "len")
        .agg(F.min(F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), "h", "offset")).alias("p"))
        .select("wkey", "len", "p.h", "p.offset")
    )
    start = F.col("pos") - F.col("offset")
    candidates = (
        matches.join(prefix, "h")
        .where((start >= 0) & (start + F.col("len") <= F.col("n")))
        .select("__key", F.struct(start.alias("start"), "len", "wkey").alias("c"))
    )
    # Bounded by the length of one text.
    lists = pinned(candidates.groupBy("__key").agg(F.collect_set("c").alias("__candidates")))
    size = F.aggregate("__candidates", F.lit(16), lambda s, c: s + F.length(c["wkey"]) + 32)
    joined = join_sized(keyed, lists, ["__key"], "left", size).withColumn(
        "__words", F.when(F.col("__candidates").isNotNull(), words_of(text))
    )
    words = F.col("__words")
    real = F.filter(
        "__candidates", lambda c: F.array_join(F.slice(words, c["start"] + 1, c["len"]), " ") == c["wkey"]
    )
    return joined.withColumn("__hits", F.when(F.size(real) > 0, real)).drop("__words", "__candidates")


def _covered(hits: Column) -> Column:
    """Words inside any window: lengths of the union of the intervals."""
    zero = F.struct(F.lit(0).cast("long").alias("covered"), F.lit(0).cast("long").alias("upto"))

    def step(acc: Column, hit: Column) -> Column:
        end = (hit["start"] + hit["len"]).cast("long")
        fresh = F.greatest(F.lit(0).cast("long"), end - F.greatest(hit["start"].cast("long"), acc["upto"]))
        return F.struct((acc["covered"] + fresh).alias("covered"), F.greatest(acc["upto"], end).alias("upto"))

    return F.coalesce(F.aggregate(F.array_sort(hits), zero, step, lambda acc: acc["covered"]), F.lit(0).cast("long"))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items, items_sha256, contaminated)``, one row per input row.

    Null and empty texts have no words and no hits; repeated rows stay repeated; items
    that repeat an id count once, and an item without an id marks words but is not
    counted; an empty benchmark marks nothing; other columns are not looked at.
    """
    windows = pinned(benchmark_windows(benchmark, window))
    marked = pinned(
        with_hits(docs.select("doc_id", "text"), windows, shingle).select(
            "doc_id",
            "__key",
            F.coalesce(F.regexp_count("text", F.lit(RAW_WORDS)), F.lit(0)).cast("long").alias("n_words"),
            _covered(F.col("__hits")).alias("n_hit"),
            F.array_distinct(F.transform("__hits", lambda h: h["wkey"])).alias("found"),
        )
    )
    found = marked.where("found is not null").select("__key", F.explode("found").alias("wkey")).distinct()
    items = pinned(
        found.join(windows.select("wkey", "item"), "wkey")
        .groupBy("__key")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    size = F.aggregate("items", F.lit(16), lambda s, x: s + F.length(x) + 16)
    joined = join_sized(marked, items, ["__key"], "left", size)
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(listed).cast("long").alias("n_items"),
        listed.alias("items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """The documents without any benchmark window, all columns kept.

    Null and empty texts and repeated rows stay; an empty benchmark removes nothing, an
    empty table stays empty; columns may have any names.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__own"), F.col("text").alias("__text"))
    marked = with_hits(rows, pinned(benchmark_windows(benchmark, window)), shingle, "__text")
    return marked.where(F.col("__hits").isNull()).select(*[F.col("__own")[c].alias(c) for c in docs.columns])
