"""URL rules, decontamination and personal data against brute force."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from incidentpanel.llm import decontam, mixing, pii, urls


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("example.org", "/en/", "allow"),
    ("a.example.org", "/en/1", "allow"), ("com", "/fr/", "allow"), ("com", "/fr/x/y", "block"), ("com", "/fr/x", "allow"),
    ("example.org", "", "allow"), ("Net", "/n", "block"), ("net", "/n", "allow"), ("x", None, "block"),
]
URLS = [
    None, "", "no scheme", "http://", "http://Example.ORG/es/1", "http://a.example.org/es/", "https://b.a.example.org/en/12?x=/es/",
    "http://example.org", "http://example.org?en", "http://notexample.org/es/", "ftp://x.com/fr/x/yz#://q", "http://x.com/fr/x",
    "http://x.com/fr/", "http://x.com/de/", "http://q.net/n", "http://w/private", "http://../private", "a://b://c/d", "http://example.org/EN/1",
    "http://x.com/fr/\u00e9", "HTTP://org/", "http://com/fr/x/y/z", "http://example.org:80/es/", "http://" + "d." * 60 + "example.org/es/",
]


def brute_judge(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = lower(re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
    best = None
    for h, p, v in RULES:
        if p is None:
            continue
        h = lower(h)
        if (h == host or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1,), (len(h + p), len(h), h + p, v))
    return host, path, best[2] if best else None, best[3] if best else "allow"


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", 1, 2) for i, u in enumerate(URLS + URLS[4:8])], "page_id long, url string, key string, host int, v int")
    got = urls.judge(pages, urls.rule_table(spark, RULES))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = [(i, *brute_judge(u)) for i, u in enumerate(URLS + URLS[4:8])]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_url_rules_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    none = urls.rule_table(spark, RULES[:1]).where("false")
    assert [tuple(r) for r in urls.judge(pages, none).collect()] == [(1, "a.org", "/x", None, "allow")]
    assert urls.judge(pages.where("false"), urls.rule_table(spark, RULES[:2])).count() == 0


def test_sweep_keeps_nested_intervals_over_partitions(spark):
    keys = ["a", "ab", "abc", "b", "bcd", "bcde", "c"]
    points = ["", "a", "aa", "ab", "abcz", "abd", "b", "bcdef", "bcdz", "bz", "c", "d"] * 40
    df = spark.createDataFrame([(p, i) for i, p in enumerate(points)], "key string, n long")
    got = urls.sweep(df, spark.createDataFrame([(k,) for k in keys], "key string"))
    for r in got.collect():
        assert r.stack == [k for k in keys if r.key.startswith(k)]
    assert got.count() == len(points)


def brute_windows(docs, items):
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    windows = {}
    for item, text in items:
        w = find(lower(text))
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item) if item is not None else None)
    out = []
    for doc, text in docs:
        w = find(lower(text))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])] - {None}
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_decontamination(spark):
    item = "The quick brown fox jumps over the lazy dog while the cat sleeps in the warm sun"
    items = [(1, item), (2, "short item"), (10, "Unique"), (3, None), (4, ""), (5, item), (None, "only null has these words here"), (6, "a b c a b c a b c a b c"), (7, "ÉTÉ à la plage"), (1, "second text of one")]
    docs = [
        item, item.upper() + "!!", "x " + item[:60], "short, ITEM; short item", "unique", None, "", "a b c " * 9, "été à la plage", "ÉTÉ À la plage", "ÉTÉ à LA plage",
        "only null has these words here", "K \u212a ıİ short \u0130tem", "the quick brown fox jumps over the lazy dog while", "w " * 30_000 + item, item + " " + item,
    ]
    rows = list(enumerate(docs)) + [(0, docs[0]), (0, docs[0]), (None, docs[0])]
    df = spark.createDataFrame([(i, t, "k", 1, 2) for i, t in rows], "doc_id long, text string, __key string, n int, w int").drop("__key")
    bench = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, len int")
    got = decontam.report(df, bench).drop("items")
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = brute_windows(rows, items)
    assert sorted(map(tuple, got.collect()), key=str) == want
    kept = decontam.clean(df, bench)
    assert kept.columns == df.columns
    assert kept.count() == sum(not w[-1] for w in want)
    assert decontam.report(df, bench.where("false")).where("n_hit = 0 and not contaminated").count() == len(rows)
    assert decontam.report(df.where("false"), bench).count() == 0


def test_decontamination_of_capital_words_that_end_in_sigma(spark):
    items = [(1, "ΟΔΟΣ.ΑΒΓ δύο ΛΟΓΟΣ'ΕΝΑ τρία τέσσερα πέντε ΝΟΜΟΣ:ΔΥΟ εννέα δέκα")]
    docs = [items[0][1], "x y " + items[0][1] + " z", "ΟΔΟΣ ΑΒΓ", "ΟΔΟΣ.ΑΒΓ δύο"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.report(df, bench).drop("items")
    assert sorted(map(tuple, got.collect()), key=str) == brute_windows(list(enumerate(docs)), items)
    assert sorted(r.doc_id for r in decontam.clean(df, bench).collect()) == [2, 3]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or "", re.ASCII):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(d) <= 19 and luhn(d)):
                continue
            if kind == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), k, kind, m.end()))
    return sorted(out)


ODD = [
    None, "", "plain text", "a@b.c@d.e f@g.hi", "x@y@z.com", "a@b.cd-x%y@z.w", "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.0004", "1.2.3.4444",
    "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "4111 1111 1111 1111 4111 1111 1111 1111", "4111  1111 1111 1111 1111", "+1 (555) 123-4567 and +44 20 7946 0958",
    "+1+2+3 +49 30 123456789 ()", "++12345678901", "é日本 a@b.co 10.0.0.1 é +12 345 678 90 ", "5 4111 1111 1111 1111", "1.2.3.4@x.yz 00000000000000", "a" * 60_000 + "@" + "b" * 2000,
    "9" * 30_000, "+" + "1 " * 5000, "😀 a@b.cd 😀 1.1.1.1", "mail:a@b.cd.", "0" * 14 + "-" + "0" * 4,
]


def test_seeds_have_exact_offsets(spark):
    rows = list(enumerate(ODD)) + [(3, ODD[3]), (None, ODD[3])]
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, m string, kind int")
    got = pii.report(df)
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    want = []
    for i, t in rows:
        spans = brute_spans(t)
        joined = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)
        want.append((i, *[sum(s[1] == k for s in spans) for k in range(4)], hashlib.sha256(joined.encode()).hexdigest(), joined))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert pii.report(df.where("false")).count() == 0


def test_contexts_of_seeds_discover_other_forms(spark):
    rows = [(i, f"entry {i} call me at +1 (555) 01{i % 10}-45{i:02d} soon") for i in range(40)]
    rows += [(100 + i, f"entry {i} written to user{i}@mail.example.org yesterday") for i in range(40)]
    rows += [(200, "please call me at 555-010-9988 soon"), (201, "written to bob@intranet yesterday"), (202, "he scored 555-010-9988 points"), (203, "call me at 555-010-9988 soon é")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.report(df).where("doc_id >= 200").collect()}
    assert found[200] == "phone:18:30" and found[201] == "email:11:23"
    # The same value is the same instance wherever it is found.
    assert found[202] == "phone:10:22"
    masked = {r.doc_id: r.text for r in pii.masked(df).where("doc_id >= 200").collect()}
    assert masked[200] == "please call me at [PHONE] soon" and masked[201] == "written to [EMAIL] yesterday"


def test_contexts_of_any_kind_discover_nothing(spark):
    seeds = ["a{}@b.cd", "10.0.0.{}", "+1 555 123 45{:02d}"]
    rows = [(i, "of the " + seeds[i % 3].format(i) + " and so on") for i in range(60)] + [(99, "of the 555-010-9988 and so on")]
    assert pii.report(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id = 99").collect()[0].spans == ""


def test_accepted_values_support_further_contexts(spark):
    contexts = ["please call me at {} soon", "reach our desk {} today", "ask for extension {} again", "or leave word {} there"]
    sizes, rows = [80, 30, 10], [contexts[0].format(f"+1 (555) 2{i:02d}-4500") for i in range(100)]
    rows += [contexts[0].format(f"+1 (555) 3{i:02d}-4500") for i in range(100)]
    for k, size in enumerate(sizes):
        for i in range(size):
            rows += [contexts[j].format(f"555-{k}{i:02d}-9988") for j in (k, k + 1)]
    rows.append(contexts[3].format("777-010-9988"))
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    last = pii.report(df).where(F.col("doc_id") == len(rows) - 1).collect()[0]
    assert last.spans == "phone:14:26"
    assert pii.masked(df).where(~F.col("text").contains("[PHONE]")).count() == 0


def test_masked_texts(spark):
    rows = [(1, "a@b.cd and 10.0.0.1", 3, "s"), (2, "clean", 5, "s"), (3, None, None, None), (4, "+1 555 123 4567", 99, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, rank string")
    got = {r.doc_id: (r.text, r.n_chars, r["rank"]) for r in pii.masked(df).collect()}
    assert got == {1: ("[EMAIL] and [IP]", 16, "s"), 2: ("clean", 5, "s"), 3: (None, None, None), 4: ("[PHONE]", 7, "s")}


def test_card_check_digit(spark):
    numbers = ["4539578763621486", "79927398713", "49927398716", "1234567812345678"]
    df = spark.createDataFrame([(n,) for n in numbers], "d string").select("d", pii._luhn(F.col("d")).alias("ok"))
    assert {r.d: r.ok for r in df.collect()} == {n: luhn(n) for n in numbers}


if __name__ == "__main__":
    pytest.main([__file__])


def test_long_chains_and_many_matches_in_one_text(spark):
    labels = "x@a" + ".a" * 200_000
    many = "".join(f"mail u{i}@host{i}.example.com, " for i in range(8000))
    calls = "".join(f"call 555-123-{i:04d} or +49 30 {i:07d} then " for i in range(3000))
    df = spark.createDataFrame([(1, labels), (2, many), (3, calls)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.report(df).collect()}
    assert got[1].n_email == 1 and got[1].spans == f"email:0:{len(labels)}"
    spans = brute_spans(many)
    assert got[2].n_email == len(spans) == 8000 and got[2].spans == ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
    base = ",".join(f"{k}:{a}:{b}" for a, _, k, b in brute_spans(calls))
    assert got[3].n_phone == 3000 and got[3].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    new = {r.doc_id: r.text for r in pii.masked(df).collect()}
    assert new[1] == "[EMAIL]" and new[2] == "mail [EMAIL], " * 8000
    assert new[3].count("[PHONE]") >= 3000 and "+49" not in new[3]


def test_running_results_over_blocks(spark):
    rows = [([(i * 7919) % 1000 - 500 for i in range(n)],) for n in (0, 1, 2, 511, 512, 513, 1025, 3000)]
    df = spark.createDataFrame(rows, "x array<int>")
    added = df.select("x", pii._running(F.col("x"), pii._add, F.lit(0)).alias("s"), pii._running(F.col("x"), F.greatest, F.lit(-1)).alias("m")).collect()
    for r in added:
        total, most, sums, tops = 0, -1, [], []
        for v in r.x:
            total, most = total + v, max(most, v)
            sums.append(total)
            tops.append(most)
        assert r.s == sums and r.m == tops


def test_columns_of_any_name_stay(spark):
    names = ["__key", "__base", "__loose", "__found", "__own", "__text", "__hits", "__spans", "copy", "mix_copy", "__mix_key", "__mix_rate", "m", "n"]
    made = spark.createDataFrame([(1, "a@b.c and more", "s"), (2, None, "s"), (2, None, "s"), (3, "", None)], "doc_id long, text string, source string")
    df = made.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in names])
    bench = spark.createDataFrame([(1, "one two three"), (2, "and more")], "item_id long, text string")
    masked, kept, copies = pii.masked(df), decontam.clean(df, bench), mixing.mixed(df)
    assert masked.columns == df.columns and kept.columns == df.columns and copies.columns == [*df.columns, "mix_mix_copy"]
    assert sorted((r.doc_id, r.text, r["__key"], r.copy) for r in masked.collect() if r.text) == [(1, "[EMAIL] and more", "__key-1", "copy-1")]
    assert sorted((r.doc_id, r["__key"], r["__hits"]) for r in kept.collect()) == [(2, "__key-2", "__hits-2")] * 2 + [(3, "__key-3", "__hits-3")]
    for r in copies.collect():
        assert (r["__mix_key"], r["__own"], r["mix_copy"]) == (f"__mix_key-{r.doc_id}", f"__own-{r.doc_id}", f"mix_copy-{r.doc_id}")
    for one in (pii.masked(df.where("false")), decontam.clean(df.where("false"), bench)):
        assert one.count() == 0
