"""SimHash groups and embedding groups against brute force."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from incidentpanel.llm import common, embeddings, overlap, simhash
from incidentpanel.llm.common import components


def brute_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(x) for x in range(n)]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (301, 300), (300, 301)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_finished_components_take_no_round_and_further_links_join_roots(spark, monkeypatch):
    made, pinned = [], common.pinned
    monkeypatch.setattr(common, "pinned", lambda df: made.append(1) or pinned(df))
    stars = components(spark.createDataFrame([(1, 5), (1, 7), (2, 6), (3, 8)], "a long, b long"))
    assert len(made) == 1
    known = pinned(stars)
    assert overlap._joined(known, spark.createDataFrame([], "a long, b long")) is known
    more = spark.createDataFrame([(6, 7), (8, 20), (21, 30), (5, 2)], "a long, b long")
    found = dict(tuple(r) for r in overlap._joined(known, more).collect())
    assert found == {1: 1, 5: 1, 7: 1, 2: 1, 6: 1, 3: 3, 8: 3, 20: 3, 21: 21, 30: 21}


@pytest.mark.parametrize("codes", [simhash.COARSE, simhash.FINE])
def test_anchors_lose_no_link(spark, codes):
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1}
    for p in list(prints):
        for _ in range(3):
            q = p
            for b in rng.sample(range(64), rng.choice([1, 2, 2, 3])):
                q ^= 1 << b
            prints.add(q)
    prints = sorted(prints)
    want = {
        tuple(sorted(np.array([a, b], np.uint64).view(np.int64).tolist()))
        for i, a in enumerate(prints)
        for b in prints[i + 1 :]
        if (a ^ b).bit_count() <= 2
    }
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    got = [tuple(sorted(r)) for r in simhash.fingerprint_links(df, codes).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 200


def documents():
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "été", "ÉTÉ", "x", "don't", "42", "日本語"]
    texts = [None, "", " \t\n", "one", "ONE", "one two", "one two three", "one\u00a0two three"]
    for _ in range(30):
        texts.append(" ".join(rng.choices(words, k=rng.randint(1, 60))))
    base = [f"w{i}" for i in range(3000)]
    texts += [" ".join(base), " ".join(base[:2999]), " ".join(base).upper(), "word " * 50_000]
    texts += texts[8:20]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [rows[9], rows[9]]


def test_groups_against_all_pairs(spark):
    rows = documents()
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, fp int, root string")
    prints = [brute_fingerprint(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    root = roots(len(rows), links)
    least = {r: min(rows[i][0] for i in range(len(rows)) if root[i] == r) for r in root}
    want = sorted((rows[i][0], f"{prints[i]:016x}", least[root[i]]) for i in range(len(rows)))
    got = simhash.near_duplicates(df)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(tuple(r) for r in got.collect()) == want
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))


def test_null_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b c d"), (None, "x y z w"), (3, "a b c d"), (None, None)], "doc_id long, text string")
    got = sorted(map(tuple, simhash.near_duplicates(df).select("doc_id", "component_id").collect()), key=str)
    assert got == sorted([(None, 3), (3, 3), (None, None), (None, None)], key=str)
    assert sorted(str(r.text) for r in simhash.keep_one(df).collect()) == ["None", "a b c d", "x y z w"]
    assert simhash.near_duplicates(df.where("false")).count() == 0
    assert simhash.keep_one(df.where("false")).count() == 0


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1 if words else 0))


def test_kept_documents_against_jaccard_of_all_pairs(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(2000)]
    passage = rng.choices(vocabulary, k=25)
    texts = [None, "", "one two", "One  TWO"]
    for size in (8, 30, 60, 200, 1500):
        for _ in range(6):
            base = rng.choices(vocabulary, k=size) + passage * (size > 50)
            texts.append(" ".join(base))
            for edits in (1, 2, 3, max(1, size // 60), max(1, size // 40)):
                copy = list(base)
                for _ in range(edits):
                    copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
                texts.append(" ".join(copy))
                base = copy if edits == 2 else base
    rng.shuffle(texts)
    sets = [shingles(t) for t in texts]
    links = [(a, b) for a in range(len(texts)) for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    prints = [brute_fingerprint(t) for t in texts]
    assert sum((prints[a] ^ prints[b]).bit_count() > 2 for a, b in links) > 20
    want = sorted(set(roots(len(texts), links)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(df).collect()) == want


def test_a_group_of_loose_copies_makes_few_pairs(spark, monkeypatch):
    """Copies with many edits are mostly not similar to each other; their pairs must not be made one by one."""
    rng = random.Random(23)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(400):
        copy = list(base)
        for k in range(rng.choice([1, 2, 3, 4, 5])):
            copy[rng.randrange(len(copy))] = f"own{len(texts)}x{k}"
        texts.append(" ".join(copy))
    sets = [shingles(t) for t in texts]
    links = [(a, b) for a in range(len(texts)) for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    made = []

    def counting(pairs, *rest):
        made.append(pairs.count())
        return verified(pairs, *rest)

    verified = overlap._verified
    monkeypatch.setattr(overlap, "_verified", counting)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted(set(roots(len(texts), links)))
    assert sorted(r.doc_id for r in simhash.keep_one(df).collect()) == want and len(want) > 20
    assert sum(made) < 5 * len(texts)


def test_kept_documents_run_the_fingerprint_groups(spark, monkeypatch):
    """All texts are grouped by their fingerprints; sets of one group are candidates, and whole sets decide."""
    rng = random.Random(31)
    texts = [None, "", "one two"]
    for _ in range(12):
        base = [f"w{rng.randrange(900)}" for _ in range(600)]
        texts.append(" ".join(base))
        for edits in (1, 2, 4, 30):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = f"own{len(texts)}"
            texts.append(" ".join(copy))
        texts.append(" ".join(base + ["same"] * 400))
        texts.append(" ".join(base[:100] + ["same"] * 90_000))
    texts += texts[5:9]
    rng.shuffle(texts)
    sets, prints = [shingles(t) for t in texts], [brute_fingerprint(t) for t in texts]
    every = [(a, b) for a in range(len(texts)) for b in range(a)]
    grouped = roots(len(texts), [(a, b) for a, b in every if (prints[a] ^ prints[b]).bit_count() <= 2])
    loose = [(a, b) for a, b in every if grouped[a] == grouped[b] and 5 * len(sets[a] & sets[b]) < 4 * len(sets[a] | sets[b])]
    links = [(a, b) for a, b in every if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    seen, linked = [], overlap.linked
    monkeypatch.setattr(overlap, "linked", lambda *x: seen.append([tuple(r) for r in x[5].collect()]) or linked(*x))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(df).collect()) == sorted(set(roots(len(texts), links)))
    # A group of n distinct sets has n - 1 candidates, some of them not similar enough.
    want = sum(len({sets[i] for i in range(len(texts)) if grouped[i] == g}) - 1 for g in set(grouped))
    assert len(seen[0]) == len(set(seen[0])) == want and want > 10 and loose


def brute_vectors(rows, cosine):
    unit = []
    for _, v, _ in rows:
        ok = v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        x = np.array(v, np.float32).astype(float) if ok else None
        unit.append(x / np.linalg.norm(x) if ok else None)
    links = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if unit[a] is not None and unit[b] is not None and rows[a][2] is not None and rows[a][2] == rows[b][2]
        and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine
    ]
    count = [sum(i in x for x in links) for i in range(len(rows))]
    root = roots(len(rows), links)
    least = [min((rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None), default=None) for i in range(len(rows))]
    return sorted(((rows[i][0], count[i], least[i], rows[i][0] == least[i]) for i in range(len(rows))), key=str)


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    rows = []
    for c in range(12):
        centre = rng.normal(size=16)
        for _ in range(25):
            rows.append((len(rows), (centre + rng.normal(size=16) * rng.choice([0.05, 0.25, 0.5])).tolist(), int(c % 4)))
    odd = [None, [], [0.0] * 16, [1.0, None] * 8, [float("nan")] * 16, [float("inf")] * 16, [1.0] * 8, [2.0] * 8, [3e-38] * 16, [3e38] * 16]
    rows += [(len(rows) + i, v, 0) for i, v in enumerate(odd)]
    rows += [(900, rows[0][1], None), (901, rows[0][1], None), rows[5], rows[5], (None, rows[5][1], rows[5][2])]
    df = spark.createDataFrame([(*r, 7, 8) for r in rows], "vec_id long, embedding array<float>, label int, pos int, i int")
    for leaf in (16, 512):
        got = embeddings.near_duplicates(df, leaf=leaf)
        assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute_vectors(rows, 0.93)
    assert embeddings.near_duplicates(df.where("false")).count() == 0
    assert embeddings.near_duplicates(df.where("vec_id = 900")).collect()[0].kept is True


def test_far_blocks_are_skipped(spark):
    rng = np.random.default_rng(2)
    spots = np.repeat(np.eye(8), 64, axis=0) + rng.normal(size=(512, 8)) * 0.01
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(spots)], "vec_id long, embedding array<float>, label int")
    got = embeddings.near_duplicates(df, leaf=32)
    assert {r.n_links for r in got.collect()} == {63}
    boxes = spark.createDataFrame(
        [(k, 1, 1, [float(k)], [k + 0.5]) for k in range(64)], "i long, from long, to long, low array<double>, high array<double>"
    )
    pairs = {tuple(r) for r in embeddings.leaf_pairs(boxes, 1, 0.6).collect()}
    assert pairs == {(k, k) for k in range(64)} | {(k, k + 1) for k in range(63)}


def test_copies_do_not_expand(spark):
    df = spark.range(600).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"), F.lit(1).alias("label"))
    got = embeddings.near_duplicates(df, leaf=64)
    assert {(r.n_links, r.component_id) for r in got.collect()} == {(599, 0)}


def test_bit_maps_exclude_no_similar_pair():
    rng = np.random.default_rng(4)
    excluded = unlike = 0
    for _ in range(3000):
        n = int(rng.integers(1, 400))
        one = rng.integers(0, 1 << 63, n).astype(np.uint64)
        keep = int(round(n * rng.uniform(0.0, 1.0) ** 0.2))
        two = np.concatenate([one[:keep], rng.integers(0, 1 << 63, int(rng.integers(0, n // 4 + 2))).astype(np.uint64)])
        sets = [np.unique(x) for x in (one, two)]
        sizes = np.array([len(x) for x in sets])
        maps = overlap.bit_maps(np.repeat([0, 1], sizes), np.concatenate(sets), sizes).to_pylist()
        alike = 9 * len(np.intersect1d(*sets)) >= 4 * int(sizes.sum())
        possible = overlap.may_be_similar(*maps, *sizes.tolist())
        assert possible or not alike
        unlike += not alike
        excluded += not possible
    assert unlike > 500 and excluded > 0.7 * unlike


def test_texts_of_impossible_pairs_stay(spark):
    """Of pairs that a shingle suggests, only those that can be similar have their texts fetched."""
    texts = [" ".join(f"w{i}x{k}" for k in range(60)) for i in range(20)]
    texts.append(texts[0] + " more")
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    maps = overlap.marked(df, ["id"]).select(F.col("id").alias("node"), "size", "bits")
    pairs = spark.createDataFrame([(a, b) for a in range(21) for b in range(a + 1, 21)], "a long, b long")
    assert [tuple(r) for r in overlap._possible(pairs, maps).collect()] == [(0, 20)]
