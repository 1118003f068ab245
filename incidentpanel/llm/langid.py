"""Language identification: known words first, shorter and shorter character n-grams for the rest.

Words are runs of letters, lower-cased.  Training counts, per language, the words of all
training texts and the n-grams of one to four letters inside them; tasks add up their own
counts before Spark does.  The model keeps every word and n-gram that occurs ``MIN_COUNT``
times, however large the table is, with their smoothed log frequency per language.  The
most frequent ones, up to ``HOT_BYTES``, are broadcast; the others stay a Spark table, and
the words that are not among the frequent ones are scored by joins.  A text's score for a
language is the sum over its words: a known word counts with its log frequency; an unseen
one with the mean of its known four-letter n-grams, or if there are none, of three, two,
one.  The scores become probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentpanel.llm.common import bucket, join_sized, pinned, staging, stored
from incidentpanel.llm.tokens import Tally, lookup, mix, runs, span_hashes

LONGEST = 4
WHOLE = 8
MIN_COUNT = 2
# The largest part of the model to broadcast, in bytes of its matrices.
HOT_BYTES = 32 << 20
SMOOTHING = 0.5
UNKNOWN = "und"
# Texts are worked on in runs of about this many characters.
BLOCK = 1 << 18


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _blocks(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, offsets, lower-cased code points)."""
    first = 0
    while first < len(texts):
        end, size = first, 0
        while end < len(texts) and (end == first or size + len(texts[end]) <= BLOCK):
            size += len(texts[end])
            end += 1
        lowered = [t.lower() for t in texts[first:end]]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in lowered])]).astype(np.int64)
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        yield first, end, offsets, points
        first = end


def _grams(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the word, hash) of every n-gram inside the given words."""
    many = np.maximum(0, ends - starts - n + 1)
    word = np.repeat(np.arange(len(starts)), many)
    at = np.repeat(starts, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    made = np.full(len(at), n, np.uint64)
    for i in range(n):
        made = mix(made * np.uint64(0x100000001B3) + points[at + i].astype(np.uint64) + np.uint64(1))
    return word, made


def _words(offsets: np.ndarray, points: np.ndarray):
    """Distinct words of a block (hash, start, end), the word and the row of every occurrence."""
    starts, ends, rows = runs(_letters()[points], offsets)
    unique, first, inverse = np.unique(span_hashes(points, starts, ends), return_index=True, return_inverse=True)
    return unique, starts[first], ends[first], inverse, rows


def _count(docs: DataFrame, languages: list[str]) -> DataFrame:
    """``(kind, item, all, by)``: kind 0 for words, n for n-grams of n letters; ``by`` has the counts of languages.

    The kinds from ``WHOLE`` on are the sums of all items, under item 0.
    """
    index = {x: i for i, x in enumerate(languages)}
    names = ["kind", "item", "language", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()

        def out() -> Iterator[pa.RecordBatch]:
            made = tally.take()
            if made is not None:
                _, n, kind, item, language = made
                columns = [kind, item.view(np.int64), language, n]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)

        def add(kind: int, items: np.ndarray, language: np.ndarray, n: np.ndarray) -> None:
            key = mix(items + mix((language * 2 * WHOLE + kind + 1).astype(np.uint64)))
            tally.add(key, n, np.full(len(items), kind), items, language)
            if kind < WHOLE:
                sums = np.bincount(language, n, len(languages)).astype(np.int64)
                add(kind + WHOLE, np.zeros(len(sums), np.uint64), np.arange(len(sums)), sums)

        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "").to_pylist()
            spoken = np.array([index[x] for x in batch.column("lang").to_pylist()], np.int64)
            for first, end, offsets, points in _blocks(texts):
                unique, starts, ends, inverse, rows = _words(offsets, points)
                both, n = np.unique(inverse * len(languages) + spoken[first:end][rows], return_counts=True)
                word, language = np.divmod(both, len(languages))
                add(0, unique[word], language, n)
                for k in range(1, LONGEST + 1):
                    at, grams = _grams(points, starts[word], ends[word], k)
                    add(k, grams, language[at], n[at])
                if tally.full():
                    yield from out()
        yield from out()

    parts = docs.select("text", "lang").mapInArrow(run, "kind long, item long, language long, n long")
    # Tasks have added up their counts, so the one exchange needs no sums before it.
    each = parts.repartition("kind", "item").groupBy("kind", "item", "language").agg(F.sum("n").alias("n"))
    return each.groupBy("kind", "item").agg(F.sum("n").alias("all"), F.collect_list(F.struct("language", "n")).alias("by"))


class Model:
    """Per kind a sorted array of hashes and a matrix of log frequencies, item by language."""

    def __init__(self, languages: list[str]):
        self.languages = languages
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _matrix(self, kind: int, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known, logs = self.tables.get(kind, (np.zeros(0, np.uint64), np.zeros((0, len(self.languages)))))
        return lookup(known, items), logs

    def _word_scores(self, points, unique, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """Log frequency of each word in each language (zeros if not even a letter is known), and whether more than letters is."""
        scores, familiar = np.zeros((len(unique), len(self.languages))), np.zeros(len(unique), bool)
        at, logs = self._matrix(0, unique)
        scores[at >= 0] = logs[at[at >= 0]]
        familiar[at >= 0] = True
        left = np.flatnonzero(at < 0)
        for n in range(LONGEST, 0, -1):
            if not len(left):
                break
            word, grams = _grams(points, starts[left], ends[left], n)
            at, logs = self._matrix(n, grams)
            hit = at >= 0
            many = np.bincount(word[hit], minlength=len(left))
            for k in range(len(self.languages)):
                total = np.bincount(word[hit], logs[at[hit], k], len(left))
                scores[left, k] = np.where(many > 0, total / np.maximum(many, 1), 0.0)
            familiar[left[many > 0]] = n > 1
            left = left[many == 0]
        return scores, familiar

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Best language, its probability, and whether a word or more than single letters of it is known.

        ``und`` and 0 without a letter or a learned language.
        """
        best, sure, known = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        if not self.languages:
            return best, sure, known
        for first, end, offsets, points in _blocks(texts):
            unique, starts, ends, inverse, rows = _words(offsets, points)
            scores, familiar = self._word_scores(points, unique, starts, ends)
            totals = np.stack([np.bincount(rows, scores[inverse, k], end - first) for k in range(len(self.languages))], axis=1)
            worded = np.bincount(rows, minlength=end - first) > 0
            odds = np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
            for i in np.flatnonzero(worded):
                best[first + i] = self.languages[int(totals[i].argmax())]
            sure[first:end] = np.where(worded, 1 / odds, 0.0)
            known[first:end] = np.bincount(rows, familiar[inverse], end - first) > 0
        return best, sure, known


def _cuts(items: DataFrame, room: int) -> dict[int, int]:
    """Per kind the least power of two so that at most ``room`` items have that count."""
    bins = items.groupBy("kind", F.floor(F.log2("all")).alias("bin")).agg(F.count("*")).collect()
    cuts = {}
    for kind in range(LONGEST + 1):
        left, cuts[kind] = room, 1 << 62
        for size, many in sorted(((r[1], r[2]) for r in bins if r[0] == kind), reverse=True):
            left -= many
            if left < 0:
                break
            cuts[kind] = 1 << size
    return cuts


def train(docs: DataFrame, min_count: int = MIN_COUNT, hot_bytes: int = HOT_BYTES) -> tuple[Model, DataFrame | None]:
    """The model of all texts of ``docs`` (text, lang) with a language, and what is not broadcast.

    The second is a table ``(kind, item, logs)``, or none if the whole model is broadcast.
    Languages tie by order of their names.
    """
    spoken = docs.where(F.col("lang").isNotNull()).select("text", "lang")
    languages = sorted(r[0] for r in spoken.select("lang").distinct().collect())
    model = Model(languages)
    if not languages:
        return model, None
    counted = stored(_count(spoken, languages).where((F.col("all") >= min_count) | (F.col("kind") >= WHOLE)), "langid-counts")
    sums = counted.where(F.col("kind") >= WHOLE).select(F.col("kind") - WHOLE, F.inline("by")).collect()
    items = counted.where(F.col("kind") < WHOLE)
    many = dict(map(tuple, items.groupBy("kind").agg(F.count("*")).collect()))
    cuts = _cuts(items, hot_bytes // (8 * (len(languages) + 1) * (LONGEST + 1)))
    cut = F.get(F.array(*[F.lit(cuts[k]).cast("long") for k in range(LONGEST + 1)]), F.col("kind").cast("int"))
    spread = np.zeros((LONGEST + 1, len(languages)))
    for kind, language, n in sums:
        spread[kind, language] = n
    below = spread + SMOOTHING * (np.array([many.get(k, 0) for k in range(LONGEST + 1)]) + 1)[:, None]
    frame = items.where(F.col("all") >= cut).select("kind", "item", F.inline("by")).toPandas()
    for kind, rows in frame.groupby("kind"):
        known, at = np.unique(rows["item"].to_numpy().astype(np.int64).view(np.uint64), return_inverse=True)
        matrix = np.zeros((len(known), len(languages)))
        matrix[at, rows["language"].to_numpy()] = rows["n"].to_numpy()
        model.tables[int(kind)] = (known, np.log((matrix + SMOOTHING) / below[int(kind)]))
    if sum(len(known) for known, _ in model.tables.values()) == sum(many.values()):
        return model, None
    under = F.get(F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in below]), F.col("kind").cast("int"))

    def log(k: Column) -> Column:
        n = F.aggregate("by", F.lit(0).cast("long"), lambda s, x: s + F.when(x["language"] == k, x["n"]).otherwise(0))
        return F.log((n + SMOOTHING) / F.get(under, k))

    each = F.sequence(F.lit(0), F.lit(len(languages) - 1))
    return model, items.where(F.col("all") < cut).select("kind", "item", F.transform(each, log).alias("logs"))


def _opened(docs: DataFrame, held, keep: list[str]) -> DataFrame:
    """Adds ``worded``, the ``totals`` of the broadcast words, and the other words of each row."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[F.col(f"`{c}`") for c in keep]).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            texts = pc.fill_null(batch.column("__langid_text"), "").to_pylist()
            for first, end, offsets, points in _blocks(texts):
                size = end - first
                unique, starts, ends, inverse, rows = _words(offsets, points)
                at, logs = model._matrix(0, unique)
                scores = np.zeros((len(unique), len(model.languages)))
                scores[at >= 0] = logs[at[at >= 0]]
                totals = np.stack([np.bincount(rows, scores[inverse, k], size) for k in range(len(model.languages))], axis=1)
                other = at[inverse] < 0
                both, times = np.unique(rows[other] * max(1, len(unique)) + inverse[other], return_counts=True)
                row, word = np.divmod(both, max(1, len(unique)))
                letters = {w: points[starts[w] : ends[w]].tobytes().decode("utf-32-le") for w in np.unique(word).tolist()}
                bounds = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=size))]).astype(np.int32))
                familiar = np.bincount(rows, at[inverse] >= 0, size) > 0
                lists = [
                    pa.array(familiar),
                    pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * len(model.languages)), pa.array(totals.ravel().astype(float))),
                    pa.ListArray.from_arrays(bounds, pa.array(unique[word].view(np.int64))),
                    pa.ListArray.from_arrays(bounds, pa.array([letters[w] for w in word.tolist()], pa.string())),
                    pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int64))),
                ]
                own = batch.slice(first, size)
                yield pa.RecordBatch.from_arrays(
                    [*(own.column(c) for c in [*keep, "__langid_row"]), pa.array(np.bincount(rows, minlength=size) > 0), *lists],
                    [*keep, "__langid_row", "__worded", "__familiar", "__totals", "__word", "__letters", "__times"],
                )

    numbered = docs.select(*[F.col(f"`{c}`") for c in keep], F.monotonically_increasing_id().alias("__langid_row"), F.col("text").alias("__langid_text"))
    extra = "`__langid_row` long, `__worded` boolean, `__familiar` boolean, `__totals` array<double>, `__word` array<long>, `__letters` array<string>, `__times` array<long>"
    return stored(numbered.mapInArrow(run, f"{fields}, {extra}"), "langid-words")


def _word_table(words: DataFrame, held, rest: DataFrame) -> DataFrame:
    """``(word, logs, familiar)`` of distinct rows (word, letters): the word's own, or the means of its longest known n-grams.

    Only words that are in no table go on to their n-grams.  What is known of these here
    is one row per word and length; the others are looked up, but no shorter ones than
    the longest that is known here.
    """
    size = len(held.value.languages)
    own = words.join(rest.where(F.col("kind") == 0).select(F.col("item").alias("word"), "logs"), "word", "left")
    own = stored(own.select("word", F.when(F.col("logs").isNull(), F.col("letters")).alias("letters"), "logs"), "langid-own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for whole in batches:
            for begin in range(0, whole.num_rows, 2000):
                batch = whole.slice(begin, 2000)
                texts = batch.column("letters").to_pylist()
                bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
                points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
                word = batch.column("word").to_numpy()
                left = np.arange(len(word))
                for n in range(LONGEST, 0, -1):
                    row, grams = _grams(points, bounds[left], bounds[left + 1], n)
                    at, logs = model._matrix(n, grams)
                    hit = at >= 0
                    known = np.bincount(row[hit], minlength=len(left))
                    some = np.flatnonzero(known)
                    sums = np.stack([np.bincount(row[hit], logs[at[hit], k], len(left)) for k in range(size)], axis=1)[some].astype(float)
                    here = [left[some], np.zeros(len(some), np.int64), known[some], sums]
                    there = [left[row[~hit]], grams[~hit].view(np.int64), np.ones((~hit).sum(), np.int64), np.zeros((0, size))]
                    for (r, i, t, x), many in ((here, size), (there, 0)):
                        ends = pa.array((np.arange(len(r) + 1) * many).astype(np.int32))
                        columns = [pa.array(word[r]), pa.array(np.full(len(r), n)), pa.array(i), pa.array(t), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))]
                        yield pa.RecordBatch.from_arrays(columns, ["word", "kind", "item", "times", "sums"])
                    left = left[known == 0]

    unseen = own.where("letters is not null").select("word", "letters")
    rows = unseen.mapInArrow(run, "word long, kind long, item long, times long, sums array<double>")
    rows = stored(rows, "langid-grams")
    found = rows.where(F.size("sums") > 0).select("word", "kind", "times", "sums").unionByName(
        rows.where(F.size("sums") == 0)
        .drop("sums")
        .join(rest, ["kind", "item"])
        .select("word", "kind", "times", F.transform("logs", lambda x: x * F.col("times")).alias("sums"))
    )
    means = found.groupBy("word", "kind").agg(F.array(*[F.sum(F.get("sums", F.lit(k))) / F.sum("times") for k in range(size)]).alias("logs"))
    longest = means.groupBy("word").agg(F.max_by("logs", "kind").alias("logs"), (F.max("kind") > 1).alias("familiar"))
    return own.where("logs is not null").select("word", "logs", F.lit(True).alias("familiar")).union(longest)


def predicted(docs: DataFrame, trained: tuple[Model, DataFrame | None], keep: list[str]) -> DataFrame:
    """The columns ``keep`` and a struct ``__langid`` (lang_pred, score, known), one row per row."""
    model, rest = trained
    held = docs.sparkSession.sparkContext.broadcast(model)
    if rest is None:

        @F.pandas_udf("lang_pred string, score double, known boolean")
        def run(texts: pd.Series) -> pd.DataFrame:
            best, sure, known = held.value.predict(texts.fillna("").tolist())
            return pd.DataFrame({"lang_pred": best, "score": sure, "known": known})

        return docs.select(*[F.col(f"`{c}`") for c in keep], run(F.col("text")).alias("__langid"))
    made = _opened(docs, held, keep)
    words = made.select(F.explode(F.arrays_zip("__word", "__letters")).alias("w")).select(F.col("w.__word").alias("word"), F.col("w.__letters").alias("letters"))
    table = stored(_word_table(words.dropDuplicates(["word"]), held, rest), "langid-table")
    size = len(model.languages)
    seen = made.select("__langid_row", F.explode(F.arrays_zip("__word", "__times")).alias("w")).select(
        "__langid_row", F.col("w.__word").alias("word"), F.col("w.__times").alias("times")
    )
    more = seen.join(table, "word").groupBy("__langid_row").agg(
        F.array(*[F.sum(F.get("logs", F.lit(k)) * F.col("times")) for k in range(size)]).alias("__more"), F.max("familiar").alias("__other")
    )
    totals = F.when(F.col("__more").isNull(), F.col("__totals")).otherwise(F.zip_with("__totals", "__more", lambda a, b: a + b))
    summed = made.join(more, "__langid_row", "left").withColumn("__sum", totals).withColumn("__most", F.array_max("__sum"))
    odds = F.aggregate("__sum", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("__most")))
    names = F.array(*[F.lit(x) for x in model.languages])
    best = F.get(names, (F.array_position("__sum", F.col("__most")) - 1).cast("int"))
    told = F.struct(
        F.when(F.col("__worded"), best).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(F.col("__worded"), 1 / odds).otherwise(F.lit(0.0)).alias("score"),
        (F.col("__familiar") | F.coalesce("__other", F.lit(False))).alias("known"),
    )
    return summed.select(*[F.col(f"`{c}`") for c in keep], told.alias("__langid"))


def held_out(id_column: str, modulus: int = 4, remainder: int = 2) -> Column:
    return F.coalesce(bucket(id_column, modulus) == remainder, F.lit(False))


def training_rows(docs: DataFrame, modulus: int = 4, remainder: int = 2) -> DataFrame:
    return docs.where(~held_out("doc_id", modulus, remainder)).select("text", "lang")


def identify(docs: DataFrame, modulus: int = 4, remainder: int = 2, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row per input row.

    Learns from text and lang of the rows that are not held out; null ids are never held
    out.  Null texts and texts without a letter get ``und`` and 0; a text of letters that
    were never seen gets the first language with an even score; without any known
    language all get ``und``; other columns are not read.
    """
    trained = train(training_rows(docs, modulus, remainder), hot_bytes=hot_bytes)
    rows = docs.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "text")
    return predicted(rows, trained, ["doc_id", "held_out"]).select("doc_id", "held_out", "__langid.lang_pred", "__langid.score")


def keep_identified(docs: DataFrame, modulus: int = 4, remainder: int = 2, least: float = 0.0, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """The documents that have a language, all columns kept.

    Rejected are null texts, texts without a letter, texts of which the model knows
    nothing longer than single letters, and with ``least`` also texts whose language is
    less probable (a short clean text may be even between two, so by default none goes
    for that).  Repeated rows share their decision and stay repeated; languages tie by
    name, which rejects nothing; without any labelled text all go; an empty table stays
    empty; columns may have any names.

    Texts are read in place: what travels is a key of each row (hashes of id and text)
    and its words; of the keys only those of rejected rows come back.
    """
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__own")
    marks = [F.xxhash64("doc_id", "text").alias("__langid_key"), F.hash("text", "doc_id").alias("__langid_check")]
    keys = ["__langid_key", "__langid_check"]
    good = (F.col("__langid.lang_pred") != UNKNOWN) & (F.col("__langid.score") >= least) & F.col("__langid.known")
    with staging(docs.sparkSession):
        told = predicted(docs.select(*marks, "text"), train(training_rows(docs, modulus, remainder), hot_bytes=hot_bytes), keys)
        rejected = pinned(told.where(~good).select(*keys).distinct())
    kept = join_sized(docs.select(own, *marks), rejected, keys, "left_anti")
    return kept.select(*[F.col("__own")[c].alias(c) for c in docs.columns])
