"""The Merkle manifest, phrase mining and nearest neighbours against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from incidentpanel.llm import ann, merkle, phrases


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves, fanout):
    """Root, and for each leaf the siblings left and right of it on each level."""
    proofs, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, place in enumerate(at):
            first = place - place % fanout
            proofs[i].append(("".join(level[first:place]), "".join(level[place + 1 : first + fanout])))
        level = [sha("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
        at = [p // fanout for p in at]
    return level[0], proofs


def plain_manifest(rows, fanout):
    groups = defaultdict(list)
    for row in rows:
        doc, text, lang, source, n = row
        content = [field(v) for v in (doc, source, lang, n, text)]
        bent = n + 1 if n is not None and doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0 else n
        content_now = [field(v) for v in (doc, source, lang, bent, text)]
        groups[lang].append((doc is not None, doc or 0, sha("".join(content)), sha("".join(content_now))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        members = sorted(groups[g])
        trees.append((members, *plain_tree([m[2] for m in members], fanout)))
    root, over = plain_tree([t[1] for t in trees], fanout)
    out = []
    for (members, subroot, proofs), rest in zip(trees, over, strict=True):
        for (known, doc, leaf, now), proof in zip(members, proofs, strict=True):
            node = now
            for left, right in proof + rest:
                node = sha(left + node + right)
            out.append((doc if known else None, leaf, subroot, root, sha("".join(a + b for a, b in proof + rest)), node, node == root))
    return out


def documents():
    rng = random.Random(4)
    rows = []
    for i in range(310):
        lang = rng.choice(["en"] * 6 + ["fr", "de", None, "zz", "ünd"])
        rows.append((i * 3 % 997, rng.choice(["a b", "", None, "été " * i]), lang, rng.choice(["s", None, "1:s"]), rng.choice([i, None, -1])))
    rows += [(5000, "alone", "lone", None, 2), (None, "no id", "en", "s", 1), (None, None, None, None, None), (7, "x" * 300_000, "en", "s", 2**63 - 1)]
    rows += [rows[0], rows[0], (rows[0][0], "other text of one id", rows[0][2], "s", 1)]
    return rows


@pytest.mark.parametrize("fanout", [2, 3, 70])
def test_manifest_against_plain_trees(spark, fanout):
    rows = documents()
    names = ["g", "i", "n", "d", "at", "leaf", "proof", "block", "up", "root", "subroot", "__key", "now", "__row", "rest"]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, schema).select("*", *[F.lit(7).alias(n) for n in names])
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    made = merkle.audit(df, {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}, tampered, fanout=fanout)
    got = made.select(
        "doc_id", *[merkle.as_text(F.col(c)) for c in ("leaf", "subroot", "root")],
        F.sha2(merkle.siblings(F.col("proof")), 256), merkle.as_text(F.col("folded_root")), "verified",
    ).collect()
    want = plain_manifest(rows, fanout)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert {w[-1] for w in want} == {True, False}


def test_manifest_of_none_and_one(spark):
    df = spark.createDataFrame(documents()[:1], "doc_id long, text string, lang string, source string, n_chars long")
    assert merkle.manifest(df.where("false")).count() == 0
    (one,) = merkle.manifest(df).collect()
    assert one.leaf == one.subroot == one.root and one.proof == []


def plain_phrases(rows, least, top):
    counts, langs = defaultdict(Counter), defaultdict(int)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            langs[lang] += len(words)
            for k in (1, 2, 3, 4):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        made = []
        for p, a in candidates.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: E731, B023
            if any(len(q) > len(p) and 100 * b >= 80 * a and inside(q) for q, b in candidates.items()):
                continue
            score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            made.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(made)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, langs[lang], -score))
    return sorted(out)


def corpus():
    rng = random.Random(9)
    rows = [(None, "en"), ("", "en"), (" \t ", None), ("...", "fr"), ("one", "xx"), ("rare words only here", "yy")]
    fixed = ["new york city hall", "as soon as possible", "état de l'art", "in order to", "on on on on on"]
    for lang, size in (("en", 60), ("fr", 25), (None, 40), ("", 12)):
        words = [f"w{i}" for i in range(size)] + ["Über", "日本", "a b", "A|B"]
        weights = [1 / (i + 1) for i in range(len(words))]
        for _ in range(120):
            parts = rng.choices(words, weights, k=rng.randint(0, 40))
            for _ in range(rng.randint(0, 3)):
                parts.insert(rng.randint(0, len(parts)), rng.choice(fixed))
            text = "".join(p + rng.choice([" "] * 12 + ["  ", "\t", ", ", ".", "\n", "\x0b", " ! "]) for p in parts)
            rows.append((text if rng.random() < 0.7 else text.upper(), lang))
    rows += rows[10:20] * 3 + [("long text goes on " * 20_000, "en")]
    return rows


@pytest.mark.parametrize(("least", "top"), [(3, 4), (3, 2000), (12, 30)])
def test_phrases_against_all_counts(spark, least, top):
    rows = corpus()
    df = spark.createDataFrame([(t, lang, 1, 2) for t, lang in rows], "text string, lang string, lg int, key int")
    got = phrases.collocations(df, least=least, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, least, top)


def test_phrases_of_nothing(spark):
    df = spark.createDataFrame([("a b c", "en")], "text string, lang string")
    assert phrases.collocations(df).count() == 0
    assert phrases.collocations(df.where("false")).count() == 0


def test_a_full_sieve_keeps_counts_exact(spark, monkeypatch):
    rows = corpus()[:200]
    df = spark.createDataFrame(rows, "text string, lang string")
    made = phrases.Sieve.of
    monkeypatch.setattr(phrases.Sieve, "of", staticmethod(lambda keys, column="key": made(keys, column, 128)))
    assert sorted(map(tuple, phrases.collocations(df, least=3, top=10).collect())) == plain_phrases(rows, 3, 10)


def plain_neighbours(rows, k):
    def vector(v):
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        return np.array(v, float) if ok else None

    out = {}
    made = [vector(v) for _, v in rows]
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is None or vec_id % 100 or made[i] is None:
            continue
        near = [
            (float(np.sqrt(((made[j] - made[i]) ** 2).sum())), rows[j][0] is None, rows[j][0] or 0)
            for j in range(len(rows))
            if j != i and made[j] is not None and len(made[j]) == len(made[i])
        ]
        out.setdefault(vec_id, []).append(sorted(near)[:k])
    return out


def vectors():
    rng = np.random.default_rng(3)
    rows = []
    for c in range(30):
        centre = rng.normal(size=24) * 3
        rows += [(len(rows) + i, (centre + rng.normal(size=24) * 0.3).tolist()) for i in range(40)]
    rows += [(1200 + i, rng.normal(size=24).tolist()) for i in range(600)]
    odd = [None, [], [0.0] * 24, [1.0, None] * 12, [float("nan")] * 24, [float("inf")] * 24]
    rows += [(2000 + 100 * i, v) for i, v in enumerate(odd)]
    # Few of one length, one alone, extreme sizes, many copies, repeated rows and rows without an id.
    rows += [(3000, [1.0, 2.0]), (3001, [1.0, 3.0]), (3002, [1.0, 2.5]), (3100, [5.0]), (3200, [1e-300] * 24)]
    rows += [(4000 + i, rows[5][1]) for i in range(300)] + [rows[100], rows[100], (None, rows[200][1]), (None, rows[200][1])]
    return rows


def test_neighbours_against_all_pairs(spark):
    rows = vectors()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, row int, v int")
    got = ann.nearest(df, F.col("vec_id") % 100 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    found, want = defaultdict(list), plain_neighbours(rows, 10)
    for r in got.collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    hit = total = 0
    for query, lists in want.items():
        mine = sorted(found.pop(query, []))
        total += sum(map(len, lists))
        # A repeated query answers once for each row, all alike.
        assert len(mine) == sum(map(len, lists))
        assert [m[0] for m in mine] == sorted(rank for x in lists for rank in range(1, len(x) + 1))
        true = Counter((round(d, 9), None if null else i) for x in lists for d, null, i in x)
        hit += sum((Counter((round(s, 9), i) for _, i, s in mine) & true).values())
    assert not found and hit >= 0.95 * total
    assert [(r.vec_id, r.score) for r in got.where("query_id = 3000").orderBy("rank").collect()] == [(3002, 0.5), (3001, 1.0)]
    assert {tuple(r) for r in got.where("query_id = 4000").select("vec_id", "score").collect()} == {(5, 0.0), *((4000 + i, 0.0) for i in range(1, 10))}
    assert ann.nearest(df.where("false"), F.col("vec_id") % 100 == 0).count() == 0
    assert ann.nearest(df, F.lit(False)).count() == 0
    assert ann.nearest(df.where("vec_id = 3100"), F.lit(True)).count() == 0


def test_far_blocks_and_extreme_components(spark):
    rows = [(i, [float(1e200 * (i // 50 + 1)), 1e180 * (i % 50 + 1)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in ann.nearest(df, F.col("vec_id") % 100 == 0, k=2).collect()}
    assert got[(100, 1)] == (101, 1e180) and got[(0, 2)][0] == 2 and all(np.isfinite(s) for _, s in got.values())


def test_threshold_keeps_the_promised_share():
    rng = np.random.default_rng(0)
    for m, width in ((64, 3.2), (40, 1.0)):
        hits = (np.abs(rng.normal(size=(20_000, m))) <= width / 2).sum(axis=1)
        assert (hits >= ann.threshold(m, width, 0.05)).mean() >= 0.945
        assert (hits >= ann.threshold(m, width, 0.05) + 1).mean() < 0.955
