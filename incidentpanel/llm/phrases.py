"""Phrase collocations by best-first branch-and-bound growth.

A phrase of two to four words grows word by word from its prefixes.  What is known of a
prefix bounds all that can grow from it: with A occurrences of the prefix and f of its
first word, no extension has more than A occurrences, and the cut after the first word
gives each at most ``SCALE * A / (f + A)`` points.  Growth is best first: with a
threshold for each language, prefixes whose bound reaches it are expanded (their
extensions are counted), and every phrase scored at least the threshold has its longer
neighbours counted on both sides, which settles whether it survives.  When a language
has enough survivors at or above its threshold, whatever was not expanded lies below
them, ties included, and the language is settled; otherwise its threshold falls, at last
to zero.

Texts are read twice: to count words, and to write frequent words as 64-bit hashes
(which hold the language, so every count is one of its language).  All further passes
read those.  A pass adds up its task's own counts before Spark sums them; only phrases
whose parts may be frequent are counted.  Sets of parts reach the tasks as bit maps of a
fixed size (``Sieve``) that may let a phrase too many through but keep none out:
what passes is counted exactly and then joined with exact tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentpanel.llm.common import join_sized, pinned, stored
from incidentpanel.llm.sieve import Sieve
from incidentpanel.llm.tokens import LOWER, Tally, pair, runs, span_hashes, text_blocks
from incidentpanel.skew import global_row_number

LEAST = 30
LONGEST = 4
TOP = 2000
SCALE = 2_000_000
# Keys a task adds up before it hands them on.
HELD = 1 << 18

# Bytes that end a piece of text, and the further ones that end a word.
ENDS = np.zeros(256, bool)
ENDS[list(b".,;:!?\n\x0b\x0c\r")] = True
GAPS = ENDS.copy()
GAPS[[0x20, 0x09]] = True


def _words(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of words: hash with language, language, start, end, true where the next word follows in the piece, lowered bytes."""
    languages = batch.column("lg").to_numpy().view(np.uint64)
    for first, end, offsets, data in text_blocks(batch, "text"):
        starts, ends, rows = runs(~GAPS[data], offsets)
        if not len(starts):
            continue
        lowered = LOWER[data]
        piece = np.cumsum(ENDS[data])[starts]
        follows = np.zeros(len(starts), bool)
        follows[:-1] = (rows[1:] == rows[:-1]) & (piece[1:] == piece[:-1])
        language = languages[first:end][rows]
        yield pair(language, span_hashes(lowered, starts, ends)), language, starts, ends, follows, lowered


def _flush(tally: Tally, names: list[str]) -> Iterator[pa.RecordBatch]:
    columns = tally.take()
    if columns is not None:
        whole = pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names)
        for at in range(0, len(whole), 1 << 16):
            yield whole.slice(at, 1 << 16)


def count_words(docs: DataFrame) -> DataFrame:
    """(h, lg, f): occurrences of each word of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(HELD)
        for batch in batches:
            for h, language, *_ in _words(batch):
                tally.add(h, np.ones(len(h), np.int64), language)
                if tally.full():
                    yield from _flush(tally, ["h", "f", "lg"])
        yield from _flush(tally, ["h", "f", "lg"])

    return docs.mapInArrow(run, "h long, f long, lg long").groupBy("h", "lg").agg(F.sum("f").alias("f"))


def encode(docs: DataFrame, frequent: Broadcast) -> DataFrame:
    """Rows with ``tokens`` (hashes of neighbouring frequent words, zero between stretches) and rows with a ``word`` of hash ``h``."""
    schema = pa.schema([("tokens", pa.binary()), ("h", pa.int64()), ("word", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve, known = frequent.value, np.zeros(0, np.uint64)
        for batch in batches:
            for h, _, starts, ends, follows, lowered in _words(batch):
                keep = sieve(h)
                unique, first = np.unique(h[keep], return_index=True)
                new = ~np.isin(unique, known, assume_unique=True)
                at = np.flatnonzero(keep)[first[new]]
                known = np.union1d(known, unique[new])
                words = [lowered[starts[i] : ends[i]].tobytes().decode() for i in at]
                # A word belongs to a stretch if it and a neighbour are frequent.
                joined = follows & keep
                joined[:-1] &= keep[1:]
                inside = joined.copy()
                inside[1:] |= joined[:-1]
                tokens = np.zeros(2 * len(h), np.uint64)
                tokens[::2] = np.where(inside, h, 0)
                wanted = np.zeros(2 * len(h), bool)
                wanted[::2] = inside
                wanted[1::2] = inside & ~joined
                packed = tokens[wanted].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([packed] + [None] * len(words), pa.binary()),
                        pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(unique[new].view(np.int64))]),
                        pa.array([None, *words], pa.string()),
                    ],
                    schema=schema,
                )

    return docs.mapInArrow(run, "tokens binary, h long, word string")


def _grams(batch: pa.RecordBatch, size: int, stretch: int = 1 << 15) -> Iterator[dict[str, np.ndarray]]:
    """For each run of ``size`` words its words w1.., the keys g1_2 .. of all its parts of two words or more.

    A block is worked on ``stretch`` words at a time, with the few words after it.
    """
    for packed in batch.column("tokens"):
        block = np.frombuffer(packed.as_buffer(), np.uint64)
        for begin in range(0, len(block) - size + 1, stretch):
            tokens = block[begin : begin + stretch + size - 1]
            count = len(tokens) - size + 1
            whole = np.ones(count, bool)
            for k in range(size):
                whole &= tokens[k : k + count] != 0
            at = np.flatnonzero(whole)
            made = {f"w{k + 1}": tokens[at + k] for k in range(size)}
            for first in range(1, size + 1):
                key = made[f"w{first}"]
                for last in range(first + 1, size + 1):
                    key = pair(key, made[f"w{last}"])
                    made[f"g{first}_{last}"] = key
            yield made


def count_phrases(encoded: DataFrame, size: int, wanted: Callable[[dict[str, np.ndarray]], np.ndarray], least: int) -> DataFrame:
    """(key, a): phrases of ``size`` words that ``wanted`` lets through, if they occur ``least`` times."""
    whole = f"g1_{size}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(HELD)
        for batch in batches:
            for grams in _grams(batch, size):
                key = grams[whole][wanted(grams)]
                tally.add(key, np.ones(len(key), np.int64))
                if tally.full():
                    yield from _flush(tally, ["key", "a"])
        yield from _flush(tally, ["key", "a"])

    counts = encoded.where("tokens is not null").select("tokens").mapInArrow(run, "key long, a long")
    return pinned(counts.groupBy("key").agg(F.sum("a").alias("a")).where(F.col("a") >= least))


def _witnesses(encoded: DataFrame, keys: DataFrame, size: int) -> DataFrame:
    """(key, words, parts): each task shows the phrases of ``keys`` that it meets once."""
    sieve = Sieve.of(keys)
    names = [f"w{k}" for k in range(1, size + 1)]
    names += [f"g{a}_{b}" for a in range(1, size + 1) for b in range(a + 1, size + 1) if b - a < size - 1]
    whole = f"g1_{size}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep, known = sieve.value, np.zeros(0, np.uint64)
        for batch in batches:
            for grams in _grams(batch, size):
                met = np.flatnonzero(keep(grams[whole]))
                unique, first = np.unique(grams[whole][met], return_index=True)
                new = ~np.isin(unique, known, assume_unique=True)
                if not new.any():
                    continue
                known = np.union1d(known, unique[new])
                at = met[first[new]]
                columns = [unique[new], *[grams[n][at] for n in names]]
                yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], ["key", *names])

    kinds = ", ".join(f"{n} long" for n in ["key", *names])
    seen = encoded.mapInArrow(run, kinds)
    return seen.groupBy("key").agg(*[F.min(n).alias(n) for n in names])


def describe(encoded: DataFrame, counted: DataFrame, size: int) -> DataFrame:
    """``counted`` with the words and the parts of each phrase.

    One occurrence is enough for a phrase, so an eighth of the blocks is asked first and
    all blocks only for what is not in it; tasks then do not all show the same phrases.
    """
    blocks = encoded.where("tokens is not null").select("tokens")
    some = blocks.where(F.pmod(F.shiftright(F.octet_length("tokens"), 3), F.lit(8)) == 0)
    first = pinned(_witnesses(some, counted, size))
    rest = pinned(counted.join(first, "key", "left_anti").select("key"))
    found = first if rest.isEmpty() else first.union(_witnesses(blocks, rest, size).join(rest, "key", "left_semi"))
    return counted.join(found, "key")


def _points(a: str, l: str, r: str) -> Column:
    """floor(SCALE * a / (l + r)) of named columns, in decimals."""
    return F.expr(f"cast({SCALE} as decimal(10,0)) * cast({a} as decimal(19,0)) div cast({l} + {r} as decimal(20,0))")


def _scored(phrases: DataFrame, cuts: list[tuple[str, str]]) -> DataFrame:
    """Adds l, r and ``score`` of the lowest cut (the first of equal ones), and ``bound`` for what grows from the phrase."""
    made = [
        F.struct(_points("a", l, r).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r"))
        for k, (l, r) in enumerate(cuts)
    ]
    return (
        phrases.withColumn("cut", F.array_min(F.array(*made)) if len(made) > 1 else made[0])
        .withColumns({"l": F.col("cut.l"), "r": F.col("cut.r"), "score": F.col("cut.score"), "bound": _points("a", "f1", "a")})
        .drop("cut")
    )


def _counts(phrases: DataFrame, table: DataFrame, key: str, name: str, *more: str) -> DataFrame:
    """The count of a part of each phrase, looked up in an exact table of (key, a)."""
    part = table.select(F.col("key").alias(key), F.col("a").alias(name), *more)
    return join_sized(phrases, part, [key], weight=F.lit(24))


def _surviving(candidates: DataFrame, longer: DataFrame, parts: list[str]) -> DataFrame:
    """Candidates that no phrase longer by one word holds at four fifths of their count (then none longer does)."""
    held = None
    for part in parts:
        seen = longer.select(F.col(part).alias("key"), F.col("a").alias("most"))
        held = seen if held is None else held.union(seen)
    most = held.groupBy("key").agg(F.max("most").alias("most"))
    return candidates.join(most, "key", "left").where(F.expr("most is null or 100 * most < 80 * a")).drop("most")


def _edge(score: str) -> Column:
    """A score rounded down to its two leading digits."""
    step = F.expr(f"cast(rpad('1', greatest(1, length(cast({score} as string)) - 1), '0') as bigint)")
    return F.col(score) - F.pmod(F.col(score), step)


def _levels(phrases: DataFrame) -> dict[int, list[tuple[int, int]]]:
    """For each language (rounded score, phrases) from the highest; some hundred pairs a language, whatever the data."""
    made: dict[int, list[tuple[int, int]]] = {}
    for lg, edge, n in phrases.groupBy("lg", _edge("score").alias("edge")).agg(F.count("*").alias("n")).collect():
        made.setdefault(lg, []).append((edge, n))
    return {lg: sorted(x, reverse=True) for lg, x in made.items()}


def _bar(levels: list[tuple[int, int]], wanted: float) -> int:
    """The highest rounded score that ``wanted`` phrases reach, 0 if there are fewer."""
    total = 0
    for edge, n in levels:
        total += n
        if total >= wanted:
            return edge
    return 0


_KEPT = ["lg", "a", "l", "r", "score", "w1", "w2", "w3", "w4"]


def _expand(encoded: DataFrame, vocabulary: DataFrame, two: DataFrame, pairs: Broadcast, bars: DataFrame, least: int) -> DataFrame:
    """All surviving phrases scored at least the threshold of their language (``bars``: lg, bar)."""

    def high(table: DataFrame, what: str) -> DataFrame:
        return table.join(F.broadcast(bars), "lg").where(F.col(what) >= F.col("bar")).drop("bar")

    grow, held = Sieve.of(high(two, "bound")), Sieve.of(high(two, "score"))

    def threes(g: dict[str, np.ndarray]) -> np.ndarray:
        return (grow.value(g["g1_2"]) & pairs.value(g["g2_3"])) | (held.value(g["g2_3"]) & pairs.value(g["g1_2"]))

    three = describe(encoded, count_phrases(encoded, 3, threes, least), 3)
    for key, name in (("g1_2", "f12"), ("g2_3", "f23")):
        three = _counts(three, two, key, name)
    three = _counts(_counts(three, vocabulary, "w1", "f1", "lg"), vocabulary, "w3", "f3")
    three = pinned(_scored(three, [("f1", "f23"), ("f12", "f3")]))
    grow_3, held_3 = Sieve.of(high(three, "bound")), Sieve.of(high(three, "score"))

    def fours(g: dict[str, np.ndarray]) -> np.ndarray:
        return (grow_3.value(g["g1_3"]) & pairs.value(g["g3_4"])) | (held_3.value(g["g2_4"]) & pairs.value(g["g1_2"]))

    four = pinned(describe(encoded, count_phrases(encoded, 4, fours, least), 4))
    # Only phrases grown from a prefix can reach the threshold; the others show what they hold.
    grown = _counts(_counts(four, vocabulary, "w1", "f1", "lg"), vocabulary, "w4", "f4")
    for table, key, name in ((three, "g1_3", "f13"), (two, "g1_2", "f12"), (two, "g3_4", "f34")):
        grown = _counts(grown, table, key, name)
    grown = grown.withColumns({"s2": _points("a", "f12", "f34"), "s3": _points("a", "f13", "f4")})
    grown = pinned(grown.join(F.broadcast(bars), "lg").where("s2 >= bar and s3 >= bar").drop("bar", "s2", "s3"))
    # The first cut needs the count of the last three words, which need not have been expanded.
    missing = pinned(grown.select(F.col("g2_4").alias("key")).distinct().join(three, "key", "left_anti"))
    tails = three.select("key", "a")
    if not missing.isEmpty():
        ask = Sieve.of(missing)
        late = count_phrases(encoded, 3, lambda g: ask.value(g["g1_3"]), least)
        tails = tails.union(late.join(missing, "key", "left_semi"))
    grown = _scored(_counts(grown, tails, "g2_4", "f24"), [("f1", "f24"), ("f12", "f34"), ("f13", "f4")])
    none = F.lit(None).cast("long")
    return pinned(
        _surviving(high(two, "score"), three, ["g1_2", "g2_3"])
        .withColumns({"w3": none, "w4": none})
        .select(_KEPT)
        .union(_surviving(high(three, "score"), four, ["g1_3", "g2_4"]).withColumn("w4", none).select(_KEPT))
        .union(high(grown, "score").select(_KEPT))
    )


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best ``top`` phrases of each language.

    Null texts and texts without a word add nothing; a null language is ``und``.
    Repeated rows count each time.  Phrases of one score and count are ranked by their
    bytes, so ranks never tie.  A language without a phrase that occurs ``least`` times
    does not appear; an empty table gives an empty result; other columns are not read.
    Words and phrases are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    rows = rows.withColumn("lg", F.xxhash64("lang"))
    languages = pinned(rows.select("lg", "lang").distinct())
    counts = pinned(count_words(rows.select("lg", "text")))
    totals = pinned(counts.groupBy("lg").agg(F.sum("f").alias("n")))
    vocabulary = pinned(counts.where(F.col("f") >= least).select(F.col("h").alias("key"), F.col("f").alias("a"), "lg"))
    encoded = stored(encode(rows.select("lg", "text"), Sieve.of(vocabulary)), "phrases-tokens")
    two = describe(encoded, count_phrases(encoded, 2, lambda g: np.ones(len(g["w1"]), bool), least), 2)
    two = _counts(_counts(two, vocabulary, "w1", "f1", "lg"), vocabulary, "w2", "f2")
    two = pinned(_scored(two, [("f1", "f2")]).withColumn("g1_2", F.col("key")))
    pairs = Sieve.of(two)
    levels, wanted, found = _levels(two), 1.5 * top, None
    while levels:
        bars = {lg: _bar(x, wanted) for lg, x in levels.items()}
        table = spark.createDataFrame(list(bars.items()), "lg long, bar long")
        alive = _expand(encoded, vocabulary, two, pairs, table, least)
        enough = {lg: n for lg, n in alive.groupBy("lg").count().collect()}
        settled = [lg for lg, bar in bars.items() if bar == 0 or enough.get(lg, 0) >= top]
        if settled:
            done = alive.where(F.col("lg").isin(settled))
            found = done if found is None else found.union(done)
        levels = {lg: x for lg, x in levels.items() if lg not in settled}
        wanted *= 4
    if found is None:
        return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    # No phrase below the rounded score that ``top`` survivors reach can be among the first.
    least_scores = [(lg, _bar(x, top)) for lg, x in _levels(found).items()]
    if least_scores:
        found = found.join(F.broadcast(spark.createDataFrame(least_scores, "lg long, bar long")), "lg").where("score >= bar").drop("bar")
    spelled = encoded.where("word is not null").select("h", "word").dropDuplicates(["h"])
    found = found.withColumn("id", F.monotonically_increasing_id())
    found = pinned(found)
    words = found.select("id", F.posexplode(F.array_compact(F.array("w1", "w2", "w3", "w4"))).alias("place", "h")).join(spelled, "h")
    phrases = words.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("words"))
    phrases = phrases.select("id", F.array_join("words.word", " ").alias("phrase"))
    best = join_sized(found.join(phrases, "id"), languages, ["lg"], weight=F.octet_length("lang") + 8)
    placed = pinned(
        global_row_number(best, [F.col("lang"), F.col("score").desc(), F.col("a").desc(), F.col("phrase"), F.col("id")], "at")
    )
    starts = placed.groupBy("lg").agg(F.min("at").alias("start")).join(totals, "lg")
    made = join_sized(placed, pinned(starts), ["lg"], weight=F.lit(24)).withColumn("rank", F.col("at") - F.col("start") + 1)
    return made.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
