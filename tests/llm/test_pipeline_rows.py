"""The rows of the whole pipeline against a plain version of its five stages."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from incidentpanel.llm import langid
from tests.llm.test_archive_and_mix import brute_targets
from tests.llm.test_filters import brute_spans, brute_windows
from tests.llm.test_near_duplicates import roots

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ITEMS = [(1, "seven brown foxes jump over nine lazy dogs in the warm evening light"), (2, "short secret item")]


def documents():
    rng = random.Random(8)
    words = {"en": [f"word{i}ing" for i in range(150)], "fr": [f"mot{i}ère" for i in range(150)]}
    rows = []
    for i in range(60):
        lang = rng.choice(["en", "fr"])
        rows.append([i, " ".join(rng.choices(words[lang], k=rng.randint(40, 80))), lang, f"s{i % 3}"])
    for i in range(60, 72):  # near copies: one or two words differ
        base = rows[i - 60][1].split()
        for _ in range(1 if i % 2 else 2):
            base[rng.randrange(len(base) - 1)] = "changedword"
        rows.append([i, " ".join(base), rows[i - 60][2], "s1"])
    rows += [[80 + i, rows[20][1], "en", "s2"] for i in range(9)]  # exact copies
    rows += [[100, "before " + ITEMS[0][1] + " after", "en", "s0"], [101, "this is a SHORT, secret item; here", "en", "s1"]]
    rows += [[110 + i, rows[30 + i][1] + f" write to user{i}@mail{i}.example.com or 10.0.0.{i}, " + "card 4111 1111 1111 1111 end", "en", "s0"] for i in range(6)]
    rows += [[130, None, "en", "s0"], [131, "", None, "s1"], [132, "12 34 !!", "fr", "s2"], [133, "字字字 字字", None, "s2"], [134, "word1ing", None, None]]
    rows += [rows[3], rows[3], [None, rows[4][1] + " more of it", "en", None]]
    return [(*r, len(r[1]) if r[1] is not None else None) for r in rows]


def plain_run(rows, spoken):
    """Rows (doc_id, text, source, copy) after all stages; ``spoken`` tells texts the language model knows."""
    rows = [r for r in rows if spoken(r[1])]
    shingled = []
    for r in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]).split()
        shingled.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    links = [(a, b) for a in range(len(rows)) for b in range(a) if 5 * len(shingled[a] & shingled[b]) >= 4 * len(shingled[a] | shingled[b])]
    root = roots(len(rows), links)
    kept = {}
    for i, r in enumerate(rows):
        best = kept.get(root[i])
        if best is None or (r[0] is not None and (best[0] is None or r[0] < best[0])):
            kept[root[i]] = r
    rows = list(kept.values())
    dirty = {d[0] for d in brute_windows([(i, r[1]) for i, r in enumerate(rows)], ITEMS) if d[-1]}
    rows = [r for i, r in enumerate(rows) if i not in dirty]
    masked = []
    for doc, text, _, source, _ in rows:
        out, upto = [], 0
        for start, _, kind, end in brute_spans(text):
            if start >= upto:
                out.append(text[upto:start] + f"[{kind.upper()}]")
            upto = max(upto, end)
        masked.append((doc, "".join(out) + text[upto:], source))
    sizes = defaultdict(int)
    for _, text, source in masked:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text))
    target, made = brute_targets(dict(sizes)), []
    for doc, text, source in masked:
        rate = target[source] / sizes[source]
        u = int(hashlib.md5(f"mix-1:{'null' if doc is None else doc}".encode()).hexdigest()[:8], 16) / 2**32
        made += [(doc, text, source, k + 1) for k in range(math.floor(rate) + (u < rate - math.floor(rate)))]
    return made


def test_run_equals_a_plain_version(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy"]
    found = [(r.doc_id, r.text, r.source, r.copy) for r in got.collect()]
    want = plain_run(rows, lambda t: t is not None and any(c.isalpha() for c in t) and "字" not in t)
    assert sorted(found, key=str) == sorted(want, key=str)
    ids = {f[0] for f in found}
    assert ids.isdisjoint({100, 101, 130, 131, 132, 133}) and ids.isdisjoint(range(80, 89))
    # Of the near copies those with one changed word in a long text are within the similarity.
    assert 0 < len(ids & set(range(60, 72))) < 12
    assert all(r.n_chars == len(r.text) for r in got.collect())


def test_language_stage_by_joins_and_by_broadcast(spark):
    extra = [F.lit(f"x{i}").alias(n) for i, n in enumerate(["__langid", "__langid_key", "__langid_check", "__langid_row", "__own", "score", "word"])]
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA).select("*", *extra)
    whole, joined = langid.keep_identified(df), langid.keep_identified(df, hot_bytes=0)
    assert whole.columns == df.columns and whole.select("__langid_key").distinct().collect()[0][0] == "x1"
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, joined.collect()), key=str)
    gone = {r[0] for r in rows} - {r.doc_id for r in whole.collect()}
    assert gone == {130, 131, 132, 133} and whole.where("doc_id = 3").count() == 3
    assert langid.keep_identified(df.where("false")).count() == 0
    assert langid.keep_identified(df.withColumn("lang", F.lit(None).cast("string"))).count() == 0
