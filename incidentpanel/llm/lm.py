"""Language model scores by a probabilistic suffix tree.

States of the tree are contexts of zero, one or two preceding tokens.  A context is
a candidate if it occurs at least ``MIN_COUNT`` times; it becomes a state if its
next-symbol distribution diverges from the one of its longest shorter state: the
log-likelihood it gains on the training tokens must pay for the symbols it lists
(half the logarithm of its count each).  A state lists the symbols it was followed by
at least ``MIN_COUNT`` times; the others share, by absolute discounting, the mass left
over in proportion to the next shorter state; the empty context is the add-one
unigram.  Each token is scored in its longest suffix state.

Counting passes send tasks' own sums of token, pair and triple hashes to Spark, where
they are added; a pair is only counted if its tokens may be frequent enough for it to
count, a triple if its pairs may be (bit maps of a fixed size tell).  The tree is a
table in the shared folder and grows with the corpus.

A score is a sum over independent lookups: the logarithm of a token's unigram, of what
each state it is in leaves to shorter ones, and, where a state lists it, of the factor by
which that raises it.  Tasks hold the largest states, as far as ``HELD`` states and ``HELD``
listed symbols of each order go, and the most frequent tokens (a share of ``P_MIN``, or half of ``HELD``);
all other lookups a text needs are keys of one join, so no result depends on either.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentpanel.llm.common import bucket, shuffles_removed, stored
from incidentpanel.llm.sieve import Sieve
from incidentpanel.llm.tokens import LOWER, SPACE, Places, Tally, lookup, mix, pair, runs, span_hashes, text_blocks

# How much of the tree tasks hold; no result depends on these two.
P_MIN = 1e-6
HELD = 1 << 21
BITS = 1 << 26
MIN_COUNT = 4
DISCOUNT = 0.75

END = mix(np.array([1], np.uint64))[0]
START = mix(np.array([2], np.uint64))[0]
# Tell keys of contexts and of listed symbols of both orders apart, and from tokens.
TAGS = [(0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179), (0x3C6EF372FE94F82B, 0x510E527FADE682D1)]


def token_stream(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of consecutive texts: hash, row, hash before, hash of the pair before (0 at a start)."""
    starts, ends, rows = runs(~SPACE[data], offsets)
    hashes = span_hashes(LOWER[data], starts, ends)
    texts = len(offsets) - 1
    many = np.bincount(rows, minlength=texts) + 1
    stops = np.cumsum(many) - 1
    token = np.empty(len(hashes) + texts, np.uint64)
    token[np.arange(len(hashes)) + rows] = hashes
    token[stops] = END
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[stops - many + 1] = START
    two = np.zeros_like(token)
    two[1:] = pair(before[:-1], before[1:])
    two[stops - many + 1] = 0
    return token, np.repeat(np.arange(texts), many), before, two


def _count(docs: DataFrame, find, schema: str) -> DataFrame:
    """Adds up what ``find(token, before, two)`` returns for each block: (key, *carried columns)."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()

        def out() -> Iterator[pa.RecordBatch]:
            made = tally.take()
            if made is not None:
                _, n, *carried = made
                yield pa.RecordBatch.from_arrays([*(pa.array(c.view(np.int64)) for c in carried), pa.array(n)], names)

        for batch in batches:
            for _, _, offsets, data in text_blocks(batch, "text"):
                token, _, before, two = token_stream(offsets, data)
                key, *carried = find(token, before, two)
                tally.add(key, np.ones(len(key), np.int64), *carried)
                if tally.full():
                    yield from out()
        yield from out()

    parts = docs.select("text").mapInArrow(run, schema)
    return parts.groupBy(*names[:-1]).agg(F.sum("n").alias("n"))


def _arrays(df: DataFrame, *columns: str) -> list[np.ndarray]:
    """Columns of a bounded table, sorted by the first as unsigned."""
    table = df.select(*columns).toArrow()
    order = np.argsort(table.column(columns[0]).to_numpy().astype(np.int64).view(np.uint64))
    made = [table.column(c).to_numpy()[order] for c in columns]
    made[0] = made[0].astype(np.int64).view(np.uint64)
    del table
    pa.default_memory_pool().release_unused()
    return made


class Tree:
    """Sorted arrays of what tasks hold: tokens with counts, and for each order its states and listed symbols.

    All values are decimal logarithms: of the unigram, of what a state leaves, of the factor on a listed symbol.
    ``tables`` has all states ``(context, left)`` and symbols ``(context, symbol, mass, key)`` of each order,
    ``values`` the lookups ``(key, value)`` of states that are not held, ``rest`` their keys as a bit map, if any.
    """

    def __init__(self, total: int, distinct: int, least: int, tokens: np.ndarray, counts: np.ndarray):
        self.total, self.distinct, self.least = total, distinct, least
        self.tokens, self.unigram = Places(tokens), np.log10((counts + 1.0) / (total + distinct + 1.0))
        self.states: list[tuple[np.ndarray, ...]] = []
        self.places: list[tuple[Places, Places]] = []
        self.masses: list[list[np.ndarray]] = []
        self.rest: Sieve | None = None
        self.tables: list[tuple[DataFrame, DataFrame]] = []
        self.values: list[DataFrame] = []

    def __getstate__(self) -> dict:
        return {**self.__dict__, "tables": [], "values": [], "masses": []}

    def add(self, contexts: np.ndarray, left: np.ndarray, symbols: np.ndarray, raised: np.ndarray) -> None:
        self.states.append((contexts, left, symbols, raised))
        self.places.append((Places(contexts), Places(symbols)))

    def lookups(self, token: np.ndarray, before: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, ...]:
        """Sums of the lookups that are held, the place of each token, and (position, key) of all others.

        A token that is not held is among the others, and has no unigram in its sum.
        """
        at = self.tokens(token)
        made = np.where(at >= 0, self.unigram[at] if len(self.unigram) else 0.0, 0.0)
        later = np.flatnonzero(at < 0)
        others = [(later, token[later])]
        for context, (_, left, _, raised), (states, symbols), tags in zip((before, two), self.states, self.places, TAGS, strict=False):
            state = states(context)
            inside = np.flatnonzero(state >= 0)
            entry = symbols(pair(context[inside], token[inside]))
            listed = np.where(entry >= 0, raised[entry] if len(raised) else 0.0, 0.0)
            made[inside] += left[state[inside]] + listed
            if self.rest is None:
                continue
            later = np.flatnonzero(state < 0)
            key = context[later] ^ np.uint64(tags[0])
            may = self.rest(key)
            others.append((later[may], key[may]))
            # Symbols that are not held belong to states that are not, or to small ones that are.
            later = np.concatenate([inside[entry < 0], later[may]])
            key = pair(context[later], token[later]) ^ np.uint64(tags[1])
            may = self.rest(key)
            others.append((later[may], key[may]))
        return made, at, *(np.concatenate(x) for x in zip(*others, strict=True))

    def probabilities(self, token: np.ndarray, before: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each token in any two of the states that are held; a token that is not held gets the factor on its unigram.

        The sums of ``lookups`` are the logarithms of these where ``before`` ends ``two``, as it does in a text;
        the masses, which these do not need, are read from the tables at the first call.
        """
        if not self.masses:
            self.masses = [_arrays(symbols, "key", "mass") for _, symbols in self.tables]
        at = self.tokens(token)
        p = np.where(at >= 0, 10.0 ** (self.unigram[at] if len(self.unigram) else 0.0), 1.0)
        for context, (_, left, _, _), (states, _), (keys, mass) in zip((before, two), self.states, self.places, self.masses, strict=False):
            state = states(context)
            inside = np.flatnonzero(state >= 0)
            entry = lookup(keys, pair(context[inside], token[inside]))
            listed = np.where(entry >= 0, mass[entry] if len(mass) else 0.0, 0.0)
            p[inside] = listed + 10.0 ** left[state[inside]] * p[inside]
        return p, at


def _retained(listed: DataFrame, sizes: DataFrame) -> DataFrame:
    """Divergence test of contexts: rows (context, symbol, n, lower) with their context's size.

    ``lower`` is the symbol's probability in the longest shorter state.
    """
    every = listed.join(sizes, "context")
    size = F.col("size")
    rest = F.greatest(F.lit(0.0), F.col("size") - F.sum("n"))
    rest_lower = F.greatest(F.lit(1e-9), 1 - F.sum("lower"))
    gain = F.sum(F.col("n") * F.log(F.col("n") / (size * F.col("lower")))) + F.when(
        rest > 0, rest * F.log(rest / (size * rest_lower))
    ).otherwise(0.0)
    kept = (
        every.groupBy("context", "size")
        .agg(gain.alias("gain"), F.count("*").alias("symbols"), (size - F.sum("n") + DISCOUNT * F.count("*")).alias("left"))
        .where(F.col("gain") > 0.5 * F.log("size") * F.col("symbols"))
    )
    return kept.select("context", "size", "symbols", (F.col("left") / F.col("size")).alias("left"))


def _least_level(counted: list[tuple[int, int]], held: int) -> int:
    """Of (level, n) the lowest level so that it and those above have at most ``held``; 0 if all have."""
    room = 0
    for level, n in sorted(counted, reverse=True):
        room += n
        if room > held:
            return level + 1
    return 0


def train(docs: DataFrame, p_min: float = P_MIN, min_count: int = MIN_COUNT, held: int = HELD) -> tuple[Tree, DataFrame]:
    """The tree of all texts of ``docs`` and the whole vocabulary ``(token, n)``."""
    spark = docs.sparkSession
    vocabulary = stored(_count(docs, lambda t, b, w: (t, t), "token long, n long"), "vocabulary")
    total, distinct, texts = vocabulary.agg(
        F.sum("n"), F.count("*"), F.sum(F.when(F.col("token") == F.lit(int(END.view(np.int64))), F.col("n")))
    ).first()
    total = total or 0
    # Tokens are held by powers of two of their count.
    level = _least_level([tuple(r) for r in vocabulary.groupBy(F.floor(F.log2("n"))).count().collect()], held // 2)
    least = min(max(min_count, int(np.ceil(p_min * total))), 1 << level)
    tree = Tree(total, distinct, least, *_arrays(vocabulary.where(F.col("n") >= least), "token", "n"))
    if not total:
        return tree, vocabulary
    often = Sieve.of(vocabulary.where(F.col("n") >= min_count), "token", BITS)

    def pairs(token, before, two):
        keep = ((before == START) | often.value(before)) & often.value(token)
        return pair(before[keep], token[keep]), before[keep], token[keep]

    seconds = stored(_count(docs, pairs, "context long, symbol long, n long").where(F.col("n") >= min_count), "pairs")
    sizes = vocabulary.select(F.col("token").alias("context"), F.col("n").alias("size")).union(
        spark.range(1).select(F.lit(int(START.view(np.int64))).alias("context"), F.lit(texts).alias("size"))
    )
    lower = vocabulary.select(
        F.col("token").alias("symbol"), ((F.col("n") + 1.0) / F.lit(float(total + distinct + 1))).alias("lower")
    )
    _grow(tree, stored(seconds.join(lower, "symbol"), "pairs-lower"), sizes, held)

    # A context of two tokens is named by the hash of the pair, as in token_stream.
    named = stored(seconds.mapInArrow(_pair_names, "context long, size long"), "pair-names")
    bigrams = Sieve.of(named, "context", BITS)

    def triples(token, before, two):
        keep = np.flatnonzero(bigrams.value(two))
        keep = keep[bigrams.value(pair(before[keep], token[keep]))]
        return pair(two[keep], token[keep]), two[keep], before[keep], token[keep]

    thirds = stored(
        _count(docs, triples, "context long, before long, symbol long, n long").where(F.col("n") >= min_count), "triples"
    )
    _grow(tree, stored(_in_states(thirds.join(lower, "symbol"), *tree.tables[0]), "triples-lower"), named, held)
    if tree.values:
        keys = [x.select("key") for x in tree.values]
        tree.rest = Sieve.of(reduce(DataFrame.union, keys), "key", BITS).value
    return tree, vocabulary


def _in_states(made: DataFrame, states: DataFrame, symbols: DataFrame) -> DataFrame:
    """Rows (symbol, before, lower) with ``lower`` brought from the unigram to the state of one token, by joins."""
    state = states.select(F.col("context").alias("before"), "left")
    listed = symbols.select(F.col("context").alias("before"), "symbol", "mass")
    made = made.join(state, "before", "left").join(listed, ["before", "symbol"], "left")
    p = F.when(F.col("left").isNull(), F.col("lower")).otherwise(F.coalesce("mass", F.lit(0.0)) + F.col("left") * F.col("lower"))
    return made.withColumn("lower", p).drop("left", "mass")


def _names(batch: pa.RecordBatch) -> pa.Array:
    name = pair(*(batch.column(c).to_numpy().view(np.uint64) for c in ("context", "symbol")))
    return pa.array(name.view(np.int64))


def _pair_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([_names(batch), batch.column("n")], ["context", "size"])


def _with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.append_column("key", _names(batch))


def _grow(tree: Tree, listed: DataFrame, sizes: DataFrame, held: int) -> None:
    """Test the contexts of one order and add its states with their listed symbols."""
    context_tag, symbol_tag = (int(np.uint64(x).view(np.int64)) for x in TAGS[len(tree.states)])
    kept = stored(_retained(listed, sizes), "states")
    mass = (F.col("n") - DISCOUNT) / F.col("size")
    raised = F.log10(1 + mass / (F.col("left") * F.col("lower")))
    rows = listed.join(kept.select("context", "size", "left"), "context")
    rows = rows.select("context", "symbol", "size", mass.alias("mass"), raised.alias("raised"))
    rows = stored(rows.mapInArrow(_with_keys, "context long, symbol long, size long, mass double, raised double, key long"), "symbols")
    tree.tables.append((kept.select("context", "left"), rows.select("context", "symbol", "mass", "key")))
    # The largest states are held, and of those the listed symbols; both by steps of an eighth of a power of two of their size.
    level = F.floor(8 * F.log2("size"))
    levels = kept.groupBy(level.alias("level")).agg(F.count("*").alias("states"), F.sum("symbols").alias("symbols")).collect()
    least_state, least_symbol = (_least_level([(r.level, r[n]) for r in levels], held) for n in ("states", "symbols"))
    states = kept.select("context", F.log10("left").alias("left"), level.alias("level"))
    symbols = rows.select("key", "raised", level.alias("level"))
    arrays: list[np.ndarray] = []
    for df, key, tag, value, least in ((states, "context", context_tag, "left", least_state), (symbols, "key", symbol_tag, "raised", least_symbol)):
        arrays += _arrays(df.where(F.col("level") >= least), key, value)
        if least:
            small = df.where(F.col("level") < least)
            tree.values.append(small.select(F.col(key).bitwiseXOR(F.lit(tag)).alias("key"), F.col(value).alias("value")))
    tree.add(*arrays)


def _lists(row: np.ndarray, texts: int, values: np.ndarray) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=texts))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def score(docs: DataFrame, tree: Tree, vocabulary: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` plus n_tokens, n_known, train_tokens, base_score and score, one row per row."""
    held = docs.sparkSession.sparkContext.broadcast(tree)
    scale = float(np.log10(tree.total + tree.distinct + 1.0))
    extra = "n_tokens long, n_held long, base double, model double, keys array<long>"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = held.value
        for batch in batches:
            for first, end, offsets, data in text_blocks(batch, "text"):
                token, row, before, two = token_stream(offsets, data)
                texts = end - first
                log_p, at, position, key = tree.lookups(token, before, two)
                known = at >= 0
                base = np.where(known, tree.unigram[at] if len(tree.unigram) else 0.0, -scale)
                # What the join adds for a token is log10(c + 1); its constant part is added here.
                log_p -= scale * ~known
                order = np.argsort(position, kind="stable")
                sums = [
                    pa.array(np.bincount(row, minlength=texts)),
                    pa.array(np.bincount(row[known], minlength=texts)),
                    pa.array(np.bincount(row, base, texts)),
                    pa.array(np.bincount(row, log_p, texts)),
                    _lists(row[position[order]], texts, key[order]),
                ]
                own = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [*(own.column(c) for c in [*keep, "__row"]), *sums],
                    [*keep, "__row", "n_tokens", "n_held", "base", "model", "keys"],
                )

    numbered = docs.select(*keep, F.monotonically_increasing_id().alias("__row"), "text")
    made = stored(numbered.mapInArrow(run, f"{fields}, `__row` long, {extra}"), "lm-scores")
    words = vocabulary.where(F.col("n") < tree.least).select(F.col("token").alias("key"), F.log10(F.col("n") + 1.0).alias("value"), F.lit(1).alias("word"))
    values = reduce(DataFrame.union, [words, *(x.withColumn("word", F.lit(0)) for x in tree.values)])
    wanted = made.select("__row", F.explode("keys").alias("key"))
    # Keys of the values are distinct and evenly spread, so what is wanted needs no sort.
    found = (
        wanted.join(values.hint("shuffle_hash"), "key")
        .groupBy("__row")
        .agg(F.sum("word").alias("known"), F.sum(F.col("value") * F.col("word")).alias("more"), F.sum("value").alias("more_model"))
    )
    return made.join(found, "__row", "left").select(
        *keep,
        "n_tokens",
        (F.col("n_held") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(int(tree.total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("model") + F.coalesce("more_model", F.lit(0.0))).alias("score"),
    )


def held_out(id_column: str, modulus: int = 7, remainder: int = 2) -> Column:
    return F.coalesce(bucket(id_column, modulus) == remainder, F.lit(False))


def score_all(docs: DataFrame, modulus: int = 7, remainder: int = 2) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one row per input row.

    Learns from the rows that are not held out; null ids are never held out.  Null texts
    are empty and have the end token alone; repeated rows count each time; without any
    training row all tokens are unknown and have the probability 1; other columns are
    not read.
    """
    rows = docs.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "text")
    # Each step is stored, so what it shuffled is not needed any more.
    with shuffles_removed(docs.sparkSession):
        tree, vocabulary = train(rows.where("not held_out"))
    return score(rows, tree, vocabulary, ["doc_id", "held_out"])
