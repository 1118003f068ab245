"""Quality scores by histogram gradient-boosted trees over document statistics.

The statistics of a text are computed for whole batches at once with numpy.  Training
takes a sample of at most ``SAMPLE`` labelled rows (rows of the smallest hashes of their
id; with fewer labelled rows, all of them), cuts each statistic into at most ``BINS``
quantile bins and boosts trees of fixed depth on the gradient histograms.  The trees are
complete, so a model is three arrays (statistic and threshold per inner node, value per
leaf), and scoring a batch walks all trees of all rows level by level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentpanel.llm.common import bucket, stored
from incidentpanel.llm.tokens import LOWER, SPACE, mix, runs, span_hashes, text_blocks

SAMPLE = 50_000
BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
RIDGE = 5.0

_BYTES = np.arange(256)
DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
UPPER = (_BYTES >= 65) & (_BYTES <= 90)
SMALL = (_BYTES >= 97) & (_BYTES <= 122)
HIGH = _BYTES >= 128
LETTER = UPPER | SMALL | HIGH
MARK = (_BYTES > 32) & (_BYTES < 127) & ~DIGIT & ~UPPER & ~SMALL
STOP = np.isin(_BYTES, list(b".?"))
SYMBOL = np.isin(_BYTES, list(b"#$%&*|@<>{}[]=+~^\\_"))
LINE = np.isin(_BYTES, list(b"\n"))
SHOUT = np.isin(_BYTES, list(b"!"))
BAR = np.isin(_BYTES, list(b"|"))

NAMES = [
    "log_bytes", "log_words", "word_mean", "word_spread", "upper", "digit", "mark", "space", "high", "stop", "symbol", "shout",
    "bar", "lines", "line_mean", "repeated_lines", "distinct_words", "top_word", "distinct_pairs", "short_words", "long_words",
    "capital_words", "letterless_words", "lone_marks", "entropy",
]


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def statistics(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """One row of statistics per text, in the order of NAMES; an empty text has zeros."""
    texts = len(offsets) - 1
    size = np.diff(offsets)

    def inside(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask[data])])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    def counted(rows: np.ndarray) -> np.ndarray:
        return np.bincount(rows, minlength=texts)

    starts, ends, rows = runs(~SPACE[data], offsets)
    length = ends - starts
    words = counted(rows)
    hashes = span_hashes(LOWER[data], starts, ends)

    def within(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask[data])])
        return sums[ends] - sums[starts]

    def distinct(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of distinct values and the largest count of one, per text."""
        keys = mix(values + mix(at.astype(np.uint64)))
        _, first, n = np.unique(keys, return_index=True, return_counts=True)
        most = np.zeros(texts, np.int64)
        np.maximum.at(most, at[first], n)
        return counted(at[first]), most

    mean = _share(np.bincount(rows, length, texts), words)
    spread = np.sqrt(np.maximum(0, _share(np.bincount(rows, length.astype(float) ** 2, texts), words) - mean**2))
    line_starts, line_ends, line_rows = runs(~LINE[data], offsets)
    lines = counted(line_rows)
    line_kinds, _ = distinct(span_hashes(data, line_starts, line_ends), line_rows)
    kinds, most = distinct(hashes, rows)
    follows = np.flatnonzero(rows[1:] == rows[:-1]) if len(rows) else np.zeros(0, np.int64)
    pairs, _ = distinct(mix(hashes[follows] * np.uint64(3) + hashes[follows + 1]), rows[follows])
    letters, capitals, marks = within(LETTER), within(UPPER), within(MARK)
    entropy = np.zeros(texts)
    for i in np.flatnonzero(size):
        n = np.bincount(data[offsets[i] : offsets[i + 1]], minlength=256)
        p = n[n > 0] / size[i]
        entropy[i] = -(p * np.log2(p)).sum()
    columns = [
        np.log1p(size), np.log1p(words), mean, spread,
        *(_share(inside(m), size) for m in (UPPER, DIGIT, MARK, SPACE, HIGH, STOP, SYMBOL, SHOUT, BAR)),
        np.log1p(lines), _share(words, lines), 1 - _share(line_kinds, lines), _share(kinds, words), _share(most, words),
        _share(pairs, np.maximum(words - 1, 0)), _share(counted(rows[length <= 2]), words), _share(counted(rows[length >= 14]), words),
        _share(counted(rows[(capitals == letters) & (letters > 1)]), words), _share(counted(rows[letters == 0]), words),
        _share(counted(rows[marks == length]), words), entropy,
    ]
    made = np.stack([np.asarray(c, np.float64) for c in columns], axis=1)
    made[size == 0] = 0
    return made


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and an array of statistics of the whole text."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, offsets, data in text_blocks(batch, "text"):
                made = statistics(offsets, data).astype(np.float32)
                at = pa.array(np.arange(0, made.size + 1, made.shape[1], dtype=np.int32))
                own = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [*(own.column(c) for c in keep), pa.ListArray.from_arrays(at, pa.array(made.ravel()))], [*keep, "x"]
                )

    return docs.select(*keep, "text").mapInArrow(run, f"{fields}, x array<float>")


class Forest:
    """Complete trees as arrays: inner nodes level by level, then the leaves."""

    def __init__(self, start: float, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray):
        self.start, self.feature, self.threshold, self.value = start, feature, threshold, value

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        total = np.full(len(x), self.start)
        depth = int(np.log2(self.value.shape[1])) if self.value.size else 0
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > threshold[node])
            total += value[node - (value.size - 1)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Forest:
    """Boost log loss on rows x with labels y (0 or 1)."""
    inner, leaves = (1 << depth) - 1, 1 << depth
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    start = float(np.log(share / (1 - share)))
    if not len(x) or len(np.unique(y)) < 2:
        return Forest(start, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(c, np.arange(1, bins) / bins)) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    total, out = np.full(len(x), start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, p * (1 - p)
        node = np.zeros(len(x), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            base, width = (1 << level) - 1, 1 << level
            at = node - base
            best = np.full(width, 1e-6)
            cut = np.zeros(width, np.int64)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                cell = at * bins + binned[:, f]
                g = np.bincount(cell, gradient, width * bins).reshape(width, bins)
                h = np.bincount(cell, weight, width * bins).reshape(width, bins)
                gl, hl = g.cumsum(axis=1), h.cumsum(axis=1)
                gr, hr = gl[:, -1:] - gl, hl[:, -1:] - hl
                gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - gl[:, -1:] ** 2 / (hl[:, -1:] + RIDGE)
                gain = gain[:, : len(e)]
                top = gain.argmax(axis=1)
                won = gain[np.arange(width), top] > best
                best = np.where(won, gain[np.arange(width), top], best)
                feature[base : base + width] = np.where(won, f, feature[base : base + width])
                threshold[base : base + width] = np.where(won, e[top], threshold[base : base + width])
                cut = np.where(won, top, cut)
            split = np.where(np.isinf(threshold[node]), bins, cut[at])
            node = 2 * node + 1 + (binned[np.arange(len(x)), feature[node]] > split)
        leaf = node - inner
        value = rate * np.bincount(leaf, gradient, leaves) / (np.bincount(leaf, weight, leaves) + RIDGE)
        total += value[leaf]
        out.append((feature, threshold, value))
    return Forest(start, *(np.stack(c) for c in zip(*out, strict=True)))


def sample(labelled: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """At most about ``limit`` rows, those with the smallest hashes of their id; all if they are fewer."""
    many = labelled.count()
    if many <= limit:
        return labelled
    # A margin of a fiftieth keeps the expected number below the bound.
    share = 0.98 * limit / many
    return labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))).limit(limit)


def train(scored: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Forest:
    """Fit on rows (doc_id, x) with a label; null ids and null labels teach nothing."""
    known = labels.select("doc_id", F.col("quality").alias("__quality")).dropna().where(F.col("__quality").isin(0, 1))
    rows = sample(scored.join(known, "doc_id").select("doc_id", "x", "__quality"), limit).toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    x = np.stack(rows["x"].to_numpy()) if len(rows) else np.zeros((0, len(NAMES)))
    return fit(x.astype(np.float64), rows["__quality"].to_numpy(dtype=float))


def held_out(id_column: str, modulus: int = 3, remainder: int = 1) -> Column:
    return F.coalesce(bucket(id_column, modulus) == remainder, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, limit: int = SAMPLE) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per input row.

    Learns from labelled rows that are not held out.  Null and empty texts are scored
    like any other, by statistics of zero; repeated ids and repeated labels count each
    time; without labels of both kinds every text gets the share of ones (a half if
    there is no label); other columns are not read.
    """
    rows = docs.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "text")
    scored = stored(with_statistics(rows, ["doc_id", "held_out"]), "statistics")
    forest = docs.sparkSession.sparkContext.broadcast(train(scored.where("not held_out"), labels, limit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), len(NAMES))
            score = forest.value.score(x.astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return scored.select("doc_id", "held_out", "x").mapInArrow(run, f"doc_id {scored.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")
