"""Archives, mixing, the pipeline, and the queries that have SQL twins."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from incidentpanel.llm import mixing, warc
from incidentpanel.llm.queries import ORACLES, QUERIES
from incidentpanel.session import scratch_path
from tools.compare import TABLES, rows

SF = "/root/testdata/sf0.001"
shared = pytest.mark.skipif(not Path(SF).exists(), reason="shared tables are not here")


@shared
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twins(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    ran = con.execute(ORACLES[name])
    columns = [d[0] for d in ran.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, ran.fetchall())


def pages():
    long = "<p>" + "é" * 60 + "</p>\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"
    made = [
        (5, "http://a.org/", long), (2, "http://b.org/?a b\r\nX: y", long), (9, None, long), (3, "http://c.org/", "short"), (4, "http://c.org/", "short"),
        (6, "http://d.org/", None), (7, "http://d.org/", ""), (8, "http://e.org/é", "x" * 99), (1, "u", "x" * 99), (10, "u", "y" * 100), (11, "u", "y" * 100),
        (None, "http://n.org/", long), (12, "v", "z" * 400_000), (13, "w", "q" * 100),
    ]
    return made + [made[0], made[-1], made[-1]]


def test_round_trip(spark):
    made = pages()
    df = spark.createDataFrame([(*p, 1, "d") for p in made], "page_id long, url string, html string, bytes int, digest string")
    got = warc.round_trip(df)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    first = {}
    for i, _, html in made:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    want = []
    for i, _, html in made:
        data = (html or "").encode()
        again = len(data) >= 100 and i != first[html]
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[html] if again else None))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert warc.round_trip(df.where("false")).count() == 0


def test_archives_are_records_with_true_links(spark):
    made = [p for p in pages()[:14]]
    path = scratch_path(spark, "warc-test")
    warc.write(spark.createDataFrame(made, "page_id long, url string, html string"), path)
    captures = warc.assemble(warc.read(spark, path)).collect()
    by = {c.response and c.metadata.fields.get("page-id"): c for c in captures}
    assert len(captures) == len(made) and all(c.response and c.request and c.metadata for c in captures)
    html = {str(i): (h or "").encode() for i, _, h in made if i is not None}
    for page, c in by.items():
        if page is not None and c.response.record_type == "response":
            assert bytes(c.response.payload) == html[page]
    assert by["5"].response.refers_to == by["2"].capture_id
    assert by["3"].request.target_uri == "http://c.org/"
    lone = warc.read(spark, path).where("record_type <> 'response'")
    assert warc.assemble(lone).where("response is null").count() == sum(c.response.record_type == "response" for c in captures)


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, free, target = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level >= 2 * sizes[s]}
        if not over:
            target |= {s: weight[s] * level for s in free}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_targets_and_draws(spark):
    docs = [(i, "w " * (i % 7), f"s{i % 5}") for i in range(400)] + [(i, "é " * 40, None) for i in range(400, 420)]
    docs += [(900, None, "s1"), (901, "x", "only"), (902, "", "empty"), (None, "a b", "s2"), (None, "a b", "s2"), (903, "w " * 60_000, "huge"), (7, docs[7][1], "s2"), (7, docs[7][1], "s2")]
    df = spark.createDataFrame([(*d, "c", 5) for d in docs], "doc_id long, text string, source string, copy string, size int")
    sizes = defaultdict(int)
    for _, t, s in docs:
        sizes[s] += len((t or "").split())
    want = brute_targets(dict(sizes))
    plan = mixing.mix_plan(df)
    assert plan.columns == ["doc_id", "size", "source_size", "target", "copies", "taken"]
    found = plan.collect()
    assert len(found) == len(docs)
    assert all(r.taken in (0, r.size, 2 * r.size) for r in found)
    got = {r.source: (r.source_size, r.target) for r in mixing.source_targets(df.drop("size").withColumn("size", mixing.word_count(df.text))).collect()}
    for s in sizes:
        assert got[s][0] == sizes[s] and abs(got[s][1] - want[s]) < 1e-6 * max(1, want[s])
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, mixing.mix_plan(df.repartition(5)).collect()), key=str)
    out = mixing.mixed(df)
    assert out.columns == [*df.columns, "mix_copy"]
    assert out.count() == sum(r.copies for r in found)
    assert mixing.mix_plan(df.where("false")).count() == 0 and mixing.mixed(df.where("false")).count() == 0


@shared
def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, SF).cache()
        assert after.columns[: len(columns)] == columns
        if k + 1 < len(corpus_pipeline.STAGES):
            assert after.columns == columns
            assert 0 < after.count() <= before.count()
        if name == "pii":
            assert after.count() == before.count()
        before = after
    assert corpus_pipeline.run(spark, SF).count() == before.count()
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
