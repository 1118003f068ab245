"""Near-duplicate texts by SimHash fingerprints, joined over a covering code.

The 64 fingerprint bits are cut into blocks, each with a perfect binary code: two
Golay codes of 23 bits (radius 3) leave 18 bits for which the code has a single
word.  The product of the codes covers the space, and its words are the anchors.
A fingerprint's home is the anchor nearest to it, within the covering radius; by
the triangle inequality everything within ``threshold`` bits of it lies within
radius + threshold of that home.  So every fingerprint is replicated to all
anchors within radius + threshold (block by block, the excess over the radii
summing to at most the threshold) and compared, anchor by anchor, with the
fingerprints at home there.  No link can be missed, and each is found once.

A fingerprint has about 61 replicas and there are 2^24 anchors; ``FINE`` adds a
Hamming code of 15 bits (153 replicas, 2^35 anchors) for corpora of more than
some hundred million distinct fingerprints.  Both give the same links.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidentpanel.llm import overlap
from incidentpanel.llm.common import components, join_sized, pinned, staging, stored

SHINGLE = 3
THRESHOLD = 2
SEED = 42
BLOCK = 1 << 16

# Perfect codes: length, covering radius, generator polynomial (published constants).
GOLAY = (23, 3, 0b101011100011)
HAMMING = (15, 1, 0b10011)
COARSE = (GOLAY, GOLAY)
FINE = (GOLAY, GOLAY, HAMMING)


def text_fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Fingerprint of one text as an unsigned 64-bit number; no words give zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    # bytes.split() also breaks at nothing but the six ASCII white-space bytes.
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(size, len(words))
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    votes, count = np.zeros(64, np.int64), 0
    while part := [digest(joined[a:b], SEED) for a, b in itertools.islice(spans, BLOCK)]:
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
        count += len(part)
    return int(np.packbits(votes * 2 > count, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """64-bit SimHash of a text column as a signed long; null and empty texts give 0."""

    @F.pandas_udf(T.LongType())
    def run(texts: pd.Series) -> pd.Series:
        made = np.array([text_fingerprint(x, size) for x in texts], np.uint64)
        return pd.Series(made.view(np.int64))

    return run(text)


@lru_cache
def _code(length: int, radius: int, generator: int, threshold: int):
    """Per syndrome all error patterns of weight up to radius + threshold, lightest first."""
    degree = generator.bit_length() - 1
    unit = []
    value = 1
    for _ in range(length):
        unit.append(value)
        value <<= 1
        if value >> degree:
            value ^= generator
    low = (length + 1) // 2

    def table(bits: Sequence[int]) -> np.ndarray:
        made = np.zeros(1, np.int64)
        for b in bits:
            made = np.concatenate([made, made ^ b])
        return made

    patterns, syndromes, weights = [], [], []
    for weight in range(radius + threshold + 1):
        for chosen in itertools.combinations(range(length), weight):
            pattern = syndrome = 0
            for i in chosen:
                pattern |= 1 << i
                syndrome ^= unit[i]
            patterns.append(pattern)
            syndromes.append(syndrome)
            weights.append(max(0, weight - radius))
    patterns, syndromes, excess = (np.array(x, np.int64) for x in (patterns, syndromes, weights))
    order = np.lexsort((excess, syndromes))
    patterns, syndromes, excess = patterns[order], syndromes[order], excess[order]
    size = 1 << degree
    first = np.searchsorted(syndromes, np.arange(size))
    within = np.stack([np.bincount(syndromes[excess <= t], minlength=size) for t in range(threshold + 1)])
    return low, table(unit[:low]), table(unit[low:]), patterns, excess, first, within


def anchors(prints: np.ndarray, codes=COARSE, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, excess) for all anchors within radius + threshold of each uint64 fingerprint."""
    row = np.arange(len(prints))
    anchor = np.zeros(len(prints), np.int64)
    used = np.zeros(len(prints), np.int64)
    shift = 0
    for length, radius, generator in codes:
        low, left, right, patterns, excess, first, within = _code(length, radius, generator, threshold)
        part = ((prints >> np.uint64(shift)) & np.uint64((1 << length) - 1)).astype(np.int64)
        syndrome = (left[part & ((1 << low) - 1)] ^ right[part >> low])[row]
        many = within[threshold - used, syndrome]
        ends = np.cumsum(many)
        inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - many, many)
        at = np.repeat(first[syndrome], many) + inside
        row, anchor, used = np.repeat(row, many), np.repeat(anchor, many), np.repeat(used, many) + excess[at]
        anchor |= (part[row] ^ patterns[at]) << shift
        shift += length
    return row, anchor, used


def _spread(prints: DataFrame, codes, threshold: int, home: bool) -> DataFrame:
    """Rows (anchor, fp): each fingerprint at its home only, or at all anchors in reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            for begin in range(0, len(values), 2000):
                part = values[begin : begin + 2000]
                row, anchor, _ = anchors(part.view(np.uint64), codes, 0 if home else threshold)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(part[row])], ["anchor", "fp"])

    return prints.select("fp").mapInArrow(run, "anchor long, fp long")


def fingerprint_links(prints: DataFrame, codes=COARSE, threshold: int = THRESHOLD) -> DataFrame:
    """All pairs (a < b) of distinct fingerprints that differ in at most ``threshold`` bits."""
    home = _spread(prints, codes, threshold, True).withColumnRenamed("fp", "a")
    near = _spread(prints, codes, threshold, False).withColumnRenamed("fp", "b")
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= threshold)
    # Home rows are few and evenly spread, so the replicas need no sort.
    return home.hint("shuffle_hash").join(near, (home.anchor == near.anchor) & close).select("a", "b")


def groups(marked: DataFrame, id_column: str = "doc_id", codes=COARSE, threshold: int = THRESHOLD) -> DataFrame:
    """One row per distinct fingerprint: ``(fp, root, component_id)``.

    ``marked`` has the id and the long ``fp``.  Copies share a fingerprint and are
    collapsed first, so a third of all rows being copies is one row here.  ``root``
    names the component; ``component_id`` is its smallest id (null ids only if it
    has no other).
    """
    prints = pinned(marked.groupBy("fp").agg(F.min(id_column).alias("least_id")))
    roots = components(fingerprint_links(prints, codes, threshold))
    rooted = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least_id"
    )
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.drop("least_id").join(least, "root")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", codes=COARSE, threshold: int = THRESHOLD) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per input row.

    Null and empty texts have fingerprint zero and link like any other; repeated
    rows stay repeated; a null id is never chosen while the group has another;
    an empty table gives an empty result; further columns are not looked at.
    """
    marked = pinned(docs.select(F.col(id_column).alias("doc_id"), fingerprint(F.col(text_column)).alias("fp")))
    found = groups(marked, "doc_id", codes, threshold)
    return marked.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _candidates(marked: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct sets ``node`` in one group of fingerprints, each with the set of the group's smallest id.

    ``marked`` has ``doc_id``, ``node`` and ``fp``.  A group of n sets has n - 1 pairs.
    """
    sets = pinned(marked.groupBy("node", "fp").agg(F.min("doc_id").alias("least_id")))
    member = pinned(sets.join(groups(sets, "least_id"), "fp"))
    heads = member.where(F.col("least_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min("node").alias("head"))
    pairs = member.join(heads, "root").where("node <> head")
    return pairs.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Near copies have sets of five-word shingles with a Jaccard similarity of 0.8 or more,
    directly or by a chain.  Every text gets its fingerprint, and the groups of fingerprints
    are found as in ``near_duplicates``; their members are candidates, confirmed by their whole
    sets.  Anchors cannot carry the bits that copies of this similarity may differ in, so the
    candidates of the set join are compared as well (see ``overlap``).

    Keeps every column.  Of rows repeated under that same id one stays; null and empty
    texts are one group; an empty table gives an empty table.  Rows are
    named by 96 bits of hashes over id and text, so null ids work too; texts are read in
    place, and what is staged on the way is removed at the end.
    """
    name, check = "__simhash_row", "__simhash_check"
    named = docs.withColumns({name: F.xxhash64("doc_id", "text"), check: F.hash("text", "doc_id")})
    with staging(docs.sparkSession):
        slim = stored(overlap.marked(named, ["doc_id", name, check], text_fingerprint).withColumn("row", F.monotonically_increasing_id()), "simhash-prefixes")
        picked = slim.groupBy("node").agg(
            F.min("doc_id").alias("least_id"), F.first("size").alias("size"), F.min(F.struct(name, check)).alias("pick"), F.min("row").alias("row")
        )
        nodes = pinned(picked)
        # One row of each set brings its prefix and its map.
        prefixes, maps = (join_sized(slim.select("row", "node", "size", c), nodes.select("row"), ["row"], "left_semi") for c in ("prefix", "bits"))
        roots = overlap.linked(nodes, prefixes, maps, named, [name, check], _candidates(slim))
        rooted = nodes.select("node", "least_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
        found = rooted.drop("least_id").join(least, "root")
        first = slim.select("doc_id", name, check, "node").join(found, "node").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        chosen = first.groupBy("root").agg(F.min(F.struct(name, check)).alias("row")).select("row.*")
        chosen = pinned(chosen)
        copies = slim.groupBy(name, check).agg(F.count("*").alias("n")).where("n > 1").select(name, check)
        repeated = pinned(chosen.join(copies, [name, check], "left_semi"))
    own = [F.col(f"`{c}`") for c in docs.columns]
    # Texts stay where they are; only rows that are repeated as a whole meet to leave one.
    single = join_sized(named, chosen.join(repeated, [name, check], "left_anti"), [name, check], "left_semi")
    several = join_sized(named, repeated, [name, check], "left_semi").dropDuplicates([name, check])
    return single.select(*own).union(several.select(*own))
