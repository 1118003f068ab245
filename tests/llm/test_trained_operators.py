"""Suffix tree, language ID and quality: exact parts against brute force, the rest held out."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from incidentpanel.llm import langid, lm, quality
from incidentpanel.llm.common import load
from incidentpanel.llm.tokens import LOWER, SPACE, Places, Tally, lookup, mix, pair, runs, span_hashes

SF = "/root/testdata/sf0.01"
shared = pytest.mark.skipif(not Path(SF).exists(), reason="shared tables are not here")


def held(i, modulus, remainder):
    return i is not None and zlib.crc32(str(i).encode()) % modulus == remainder


def test_span_hashes_are_equal_for_equal_spans():
    rng = np.random.default_rng(0)
    words = [bytes(rng.integers(97, 100, rng.integers(1, 6)).astype(np.uint8)) for _ in range(5000)]
    data = np.frombuffer(b" ".join(words), np.uint8)
    starts, ends, rows = runs(~SPACE[data], np.array([0, len(data)]))
    hashes = span_hashes(LOWER[data], starts, ends)
    assert [bytes(data[a:b]) for a, b in zip(starts, ends, strict=True)] == words
    assert len(set(hashes.tolist())) == len(set(words)) == len({(h, w) for h, w in zip(hashes.tolist(), words, strict=True)})


def test_runs_break_at_rows():
    offsets = np.array([0, 0, 3, 3, 5, 5])
    starts, ends, rows = runs(~SPACE[np.frombuffer(b"abcde", np.uint8)], offsets)
    assert (starts.tolist(), ends.tolist(), rows.tolist()) == ([0, 3], [3, 5], [1, 3])


def test_tally_sums_in_bounded_parts():
    tally, total = Tally(limit=50), Counter()
    rng = np.random.default_rng(0)
    for _ in range(40):
        keys = rng.integers(0, 90, 30).astype(np.uint64)
        tally.add(keys, np.ones(30, np.int64), keys * 2)
        if tally.full():
            for k, n, c in zip(*tally.take(), strict=True):
                assert c == 2 * k
                total[int(k)] += int(n)
    for k, n, _ in zip(*(tally.take() or ((), (), ())), strict=True):
        total[int(k)] += int(n)
    assert sum(total.values()) == 1200
    assert lookup(np.array([1, 5], np.uint64), np.array([0, 1, 5, 9], np.uint64)).tolist() == [-1, 0, 1, -1]


def words_of(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text) + [None]


def texts():
    rng = np.random.default_rng(4)
    states = {"a": "bbbbc", "b": "aaac", "c": "ddda", "d": "abcd"}
    rows = []
    for i in range(120):
        word, out = "a", []
        for _ in range(int(rng.integers(0, 80))):
            out.append(word if rng.random() < 0.9 else f"rare{rng.integers(400)}")
            word = rng.choice(list(states[word]))
        rows.append((i, " ".join(out)))
    rows += [(200, None), (201, ""), (202, "A\u00c9 a\u00e9"), (203, "a b " * 40_000), (None, "a b c"), (5, rows[5][1]), (5, rows[5][1])]
    return rows


def test_base_scores_and_counts(spark):
    rows = texts()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, token string")
    got = lm.score_all(df)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    count = Counter(w for i, t in rows if not held(i, 7, 2) for w in words_of(t))
    total, distinct = sum(count.values()), len(count)
    want = []
    for i, t in rows:
        w = words_of(t)
        base = sum(math.log10((count[x] + 1) / (total + distinct + 1)) for x in w)
        want.append((str(i), held(i, 7, 2), len(w), sum(count[x] > 0 for x in w), total, round(base, 4)))
    found = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got.collect()]
    assert sorted(found) == sorted(want)
    out = got.where("held_out").agg(F.sum("base_score").alias("b"), F.sum("score").alias("s")).first()
    assert out.s > out.b
    assert lm.score_all(df.where("false")).count() == 0


def test_scores_do_not_depend_on_what_tasks_hold(spark):
    """A share of all tokens only decides what tasks hold; rarer contexts and symbols count through the tables."""
    df = spark.createDataFrame([(i, t) for i, t in texts() if i is not None], "doc_id long, text string")

    def scores(**limits):
        tree, vocabulary = lm.train(df.where("doc_id % 7 <> 2"), **limits)
        found = sorted((r.doc_id, r.n_known, r.base_score, r.score) for r in lm.score(df, tree, vocabulary, ["doc_id"]).collect())
        return pytest.approx(np.array(found, float), abs=1e-5)

    whole = scores(p_min=0.0)
    assert np.array(scores(p_min=0.01).expected) == whole
    for held in (8, 0):
        assert np.array(scores(p_min=0.2, held=held).expected) == whole


def plain_scores(rows, trained):
    """A suffix tree in dicts: log10 probability of each text."""
    lines = [[w or "</s>" for w in words_of(t)] for i, t in rows if trained(i)]
    unigram = Counter(w for x in lines for w in x)
    total = sum(unigram.values()) + len(unigram) + 1
    two_before = Counter(), Counter()
    for x in lines:
        x = ["<s>", *x]
        two_before[0].update(((x[k - 1],), x[k]) for k in range(1, len(x)))
        two_before[1].update(((x[k - 2], x[k - 1]), x[k]) for k in range(2, len(x)))
    seen = {**{(w,): n for w, n in unigram.items()}, ("<s>",): len(lines), **{(*c, w): n for (c, w), n in two_before[0].items()}}
    states = {}

    def p(context, w):
        if not context:
            return (unigram[w] + 1) / total
        lower = p(context[1:], w)
        if context not in states:
            return lower
        left, listed = states[context]
        return listed.get(w, 0.0) + left * lower

    for counted in two_before:
        by = {}
        for (context, w), n in counted.items():
            if n >= lm.MIN_COUNT:
                by.setdefault(context, {})[w] = n
        for context, listed in by.items():
            size, some = seen[context], sum(listed.values())
            lower = {w: p(context[1:], w) for w in listed}
            gain = sum(n * math.log(n / (size * lower[w])) for w, n in listed.items())
            if size > some:
                gain += (size - some) * math.log((size - some) / (size * max(1e-9, 1 - sum(lower.values()))))
            if gain > 0.5 * math.log(size) * len(listed):
                left = (size - some + lm.DISCOUNT * len(listed)) / size
                states[context] = left, {w: (n - lm.DISCOUNT) / size for w, n in listed.items()}
    out = []
    for i, t in rows:
        x = ["<s>", *(w or "</s>" for w in words_of(t))]
        out.append((i, sum(math.log10(p(tuple(x[max(0, k - 2) : k]), x[k])) for k in range(1, len(x)))))
    return sorted(out)


def test_scores_equal_a_plain_tree_by_one_join_of_keys(spark):
    rows = [(i, t) for i, t in texts() if i is not None]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = np.array(plain_scores(rows, lambda i: i % 7 != 2))
    for limits in ({}, {"p_min": 0.2, "held": 8}, {"p_min": 0.2, "held": 0}):
        tree, vocabulary = lm.train(df.where("doc_id % 7 <> 2"), **limits)
        out = lm.score(df, tree, vocabulary, ["doc_id"])
        found = np.array(sorted((r.doc_id, r.score) for r in out.collect()))
        assert np.allclose(found, want, rtol=1e-9, atol=1e-6)
        # Keys meet their values once, and rows their sums; whatever the order of the state.
        assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") <= 2


def test_places_find_what_a_search_finds():
    rng = np.random.default_rng(2)
    for size in (0, 1, 2, 700, 5000):
        table = np.unique(np.concatenate([mix(rng.integers(0, 1 << 40, size).astype(np.uint64)), np.arange(size // 9, dtype=np.uint64)]))
        keys = np.concatenate([table, mix(rng.integers(0, 1 << 40, 300).astype(np.uint64)), np.array([0, (1 << 64) - 1], np.uint64)])
        assert Places(table)(keys).tolist() == lookup(table, keys).tolist()


def test_every_state_has_a_distribution(spark):
    df = spark.createDataFrame(texts(), "doc_id long, text string")
    tree, vocabulary = lm.train(df)
    assert len(tree.states) == 2 and all(len(s[0]) for s in tree.states)
    every = np.array([r.token for r in vocabulary.collect()], np.int64).view(np.uint64)
    count = dict((r.token, r.n) for r in vocabulary.collect())
    before = tree.states[0][0]
    two = np.append(tree.states[1][0], np.uint64(0))
    for b in before[:6]:
        for w in two[:6]:
            p, at = tree.probabilities(every, np.full(len(every), b), np.full(len(every), w))
            rare = at < 0
            unigram = np.array([count[int(t)] + 1 for t in every.view(np.int64)]) / (tree.total + tree.distinct + 1)
            unknown, _ = tree.probabilities(mix(np.array([12345], np.uint64)), np.array([b]), np.array([w]))
            whole = p[~rare].sum() + (p[rare] * unigram[rare]).sum() + unknown[0] / (tree.total + tree.distinct + 1)
            assert abs(whole - 1) < 1e-9
    assert pair(before[:1], before[:1]) != pair(before[:1], before[1:2])


def test_language_rows(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("le chat et le chien", "fr"), ("der hund und die katze", "de")] * 12)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "123 !!", "fr"), (103, "le chien", None), (104, "THE DOGS", None), (105, "日本", None), (None, "le chat", "fr"), (3, rows[3][1], "en"), (106, "und die " * 60_000, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score int")
    got = langid.identify(df)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    by = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(rows)
    assert [by[i].lang_pred for i in (100, 101, 102, 103, 104, 106)] == ["und", "und", "und", "fr", "en", "de"]
    assert by[100].score == 0 and all(0 <= r.score <= 1 for r in by.values())
    assert all(r.held_out == held(i, 4, 2) for i, r in by.items())
    assert langid.identify(df.where("false")).count() == 0
    assert {r.lang_pred for r in langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    kept = langid.keep_identified(df)
    assert kept.columns == df.columns and {100, 101, 102}.isdisjoint(r.doc_id for r in kept.collect())


def test_small_languages_keep_their_words(spark):
    rows = [(i, "the cat and the dog run " * 200_000, "en") for i in (0, 1, 3, 4, 5)]
    rows += [(10 + i, f"ο σκύλος τρέχει σπίτι{i}", "gr") for i in range(12)] + [(40 + i, "кот бежит домой", "ru") for i in range(6)]
    rows += [(100, "σκύλος", None), (101, "τρέχουν", None), (102, "кота", None), (103, "dogs run", None), (104, "7", None), (105, "日本", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sum(held(i, 4, 2) for i, *_ in rows[5:23]) < 18 and not all(held(i, 4, 2) for i in range(5))
    whole = {r.doc_id: r for r in langid.identify(df).collect()}
    assert [whole[i].lang_pred for i in range(100, 105)] == ["gr", "gr", "ru", "en", "und"]
    # What is broadcast does not change a result.
    for hot in (0, 2000):
        parts = {r.doc_id: r for r in langid.identify(df, hot_bytes=hot).collect()}
        assert parts.keys() == whole.keys()
        for i, r in whole.items():
            assert (parts[i].held_out, parts[i].lang_pred) == (r.held_out, r.lang_pred) and parts[i].score == pytest.approx(r.score)


@shared
def test_held_out_language(spark):
    docs = load(spark, SF, "documents")
    joined = langid.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in joined]) > 0.97


@shared
def test_held_out_score(spark):
    out = lm.score_all(load(spark, SF, "documents")).where("held_out").agg(F.sum("base_score").alias("b"), F.sum("score").alias("s")).first()
    assert out.s > out.b


def test_statistics_of_odd_texts():
    data = [b"", b"   ", "Ünï 12!! AB\nab | x".encode(), b"x" * 300_000, b"a b a b"]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    made = quality.statistics(offsets, np.frombuffer(b"".join(data), np.uint8))
    assert made.shape == (5, len(quality.NAMES)) and np.isfinite(made).all() and not made[0].any()
    at = {n: i for i, n in enumerate(quality.NAMES)}
    assert made[4, at["distinct_words"]] == 0.5 and made[4, at["word_mean"]] == 1 and made[2, at["lines"]] == pytest.approx(math.log(3))


def test_trees_learn_and_traverse():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4)).round(2)
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.2)).astype(float)
    forest = quality.fit(x[:2000], y[:2000], trees=30)
    assert ((forest.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.95
    assert forest.feature.shape == (30, 15) and forest.value.shape == (30, 16)
    flat = quality.fit(x, np.ones(3000))
    assert np.allclose(flat.score(x), 3001 / 3002)


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for s in np.unique(score):
        rank[score == s] = rank[score == s].mean()
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones))


@shared
def test_held_out_quality(spark):
    docs, labels = load(spark, SF, "documents"), load(spark, SF, "labels")
    got = quality.classify(docs, labels)
    rows = got.where("held_out").join(labels, "doc_id").collect()
    assert auc(np.array([r.score for r in rows]), np.array([r.quality for r in rows])) > 0.85


def test_quality_rows(spark):
    rows = [(i, "Good plain words. " * 5 if i % 2 else "BAD!! ### $$$ " * 5) for i in range(60)] + [(70, None), (71, ""), (None, "x"), (3, "Good"), (3, "Good")]
    df = spark.createDataFrame([(i, t, 0, [1.0]) for i, t in rows], "doc_id long, text string, quality int, x array<double>")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (70, None, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    got = quality.classify(df, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert got.count() == len(rows)
    for r in got.where("doc_id < 60 and doc_id <> 3 and held_out").collect():
        assert r.predicted == r.doc_id % 2
    assert {r.score for r in quality.classify(df, labels.where("false")).collect()} == {0.5}
    assert quality.classify(df.where("false"), labels).count() == 0
