"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Seeds are the entities that a strict form alone identifies (email, ip, card, phone).
Everything in a text that has only the loose form of a kind (digit groups without the
country code, addresses without a domain, ...) is a candidate.  Each mention induces two
lexical patterns: the two words before it, and the words on both sides of it.  Patterns
and instances (kind and value) form a bipartite graph that Spark scores in rounds:

- a pattern's confidence for a kind is the share of its instances that are of that
  kind, each weighted with its own score (seeds 1, unknown candidates half a vote
  against), and counts only with ``SUPPORT`` different values of that kind that are
  seeds or accepted;
- a candidate's score is the chance that not all of its confident patterns err; it never
  falls from one round to the next.

Patterns found good in one round make candidates known, which support further patterns
in the next, until no candidate is accepted and no score rises any more.  Candidates at
``ACCEPT`` or above become spans; the seeds' spans always stay.  In text where all kinds
turn up in any context, no pattern is confident.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidentpanel.llm.common import join_sized, pinned

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 8
CONFIDENT = 0.8
ACCEPT = 0.9
# A rise of less than this ends the rounds.
STILL = 1e-6
PRIOR = 1.0
# Running results are made in blocks of this many elements, texts cut in pieces of this many characters.
RUN = 512
CHUNK = 1024

# Unbounded repetitions of a group are possessive: others recurse once for each turn.
# A match starts where a run of these characters starts, or where the match before ended;
# without that a long run would be tried again from each of its characters.
_LOCAL = r"[A-Za-z0-9._%+-]"
_DIGITS = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){%d,%d}(?![\x20-]?[0-9])"

# The forms of the four kinds. Card numbers are runs of digits of this
# length with single spaces or hyphens, so runs of other lengths need no test.
STRICT = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": _DIGITS % (13, 18),
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++(?:@|\(at\)|\[at\])[A-Za-z0-9][A-Za-z0-9.-]*+",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}(?![0-9A-Fa-f:])|(?<![0-9.])[0-9]++(?:\.[0-9]++){3}",
    "card": _DIGITS % (12, 18),
    "phone": r"(?<![0-9+])(?<![0-9][\x20().-])\(?[0-9][\x20().0-9-]{5,20}[0-9](?![\x20().-]?[0-9])",
}
# What a text must hold at least for the form to be looked for.
GUARD = {
    "email": lambda t: t.contains("@") | t.contains("(at)") | t.contains("[at]"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f:]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
    "phone": lambda t: t.rlike(r"[0-9][\x20().0-9-]{5}"),
}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, its digits added; the sum divides by ten."""
    each = F.transform(
        F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c >= "5", 9).otherwise(0)),
    )
    return F.aggregate(each, F.lit(0), lambda s, x: s + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike("^0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})$"))
    if kind == "card":
        return _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _plausible(kind: str, value: Column) -> Column:
    return F.length(_digits(value)).between(7, 15) if kind == "phone" else F.lit(True)


def _running(values: Column, join: Callable[[Column, Column], Column], zero: Column) -> Column:
    """Running result of ``join`` over an array, one value per element, this one included.

    Appending to an array costs its length, so it is done in blocks of ``RUN`` and over
    the blocks' last values.
    """

    def along(part: Column) -> Column:
        start = F.struct(zero.alias("now"), F.array().cast("array<int>").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            now = join(acc["now"], x)
            return F.struct(now.alias("now"), F.concat(acc["out"], F.array(now)).alias("out"))

        return F.aggregate(part, start, step, lambda acc: acc["out"])

    many = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / RUN).cast("int"))
    blocks = F.transform(many, lambda b: along(F.slice(values, b * RUN + 1, F.lit(RUN))))
    ends = along(F.transform(blocks, lambda b: F.element_at(b, -1)))
    whole = F.flatten(
        F.transform(
            F.arrays_zip(blocks.alias("block"), F.slice(F.concat(F.array(zero), ends), F.lit(1), F.size(blocks)).alias("before")),
            lambda z: F.transform(z["block"], lambda x: join(z["before"], x)),
        )
    )
    return F.when(F.size(values) > 0, whole).otherwise(F.array().cast("array<int>"))


def _add(a: Column, b: Column) -> Column:
    return a + b


def _mentions(matches: Column, pieces: Column, kind: str, valid: Callable[[Column], Column]) -> Column:
    """Array of (start, kind, end, value, patterns): offsets add up the lengths of pieces and matches.

    ``pieces`` is the text between matches, so both together are the whole text, and the
    words around a match are the ends of its neighbouring pieces.
    """
    lengths = F.transform(matches, lambda m, i: F.length(F.get(pieces, i)) + F.length(m))
    ends = _running(lengths, _add, F.lit(0))

    def mention(pair: Column, i: Column) -> Column:
        before = F.regexp_extract_all(_plain(F.right(F.get(pieces, i), F.lit(48))), F.lit(r"\S+"), F.lit(0))
        after = F.regexp_extract(_plain(F.left(F.get(pieces, i + 1), F.lit(24))), r"\S+", 0)
        last, second = (F.coalesce(F.get(before, F.size(before) - k), F.lit("^")) for k in (1, 2))
        return F.struct(
            (pair["end"] - F.length(pair["value"])).alias("start"),
            F.lit(KINDS.index(kind)).alias("kind"),
            pair["end"].alias("end"),
            pair["value"].alias("value"),
            F.array(F.concat(F.lit("L "), second, F.lit(" "), last), F.concat(F.lit("B "), last, F.lit(" | "), after)).alias("patterns"),
        )

    placed = F.arrays_zip(matches.alias("value"), ends.alias("end"))
    made = F.filter(F.transform(placed, mention), lambda m: valid(m["value"]))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string,patterns:array<string>>>")
    return F.when(F.size(matches) > 0, made).otherwise(none)


def _plain(words: Column) -> Column:
    return F.regexp_replace(F.lower(words), "[0-9]", "0")


def _clear_of(candidates: Column, spans: Column) -> Column:
    """Candidates that overlap no span.  Both are sorted together once; running ends and starts decide."""
    mark = lambda m, own: F.struct(m["start"].alias("start"), F.lit(own).alias("own"), m["end"].alias("end"), m.alias("m"))
    every = F.array_sort(F.concat(F.transform(spans, lambda m: mark(m, 0)), F.transform(candidates, lambda m: mark(m, 1))))
    reached = _running(F.transform("__every", lambda x: F.when(x["own"] == 0, x["end"]).otherwise(F.lit(-1))), F.greatest, F.lit(-1))
    far = (1 << 31) - 1
    backwards = F.reverse(F.transform("__every", lambda x: F.when(x["own"] == 0, x["start"]).otherwise(F.lit(far))))
    ahead = F.reverse(_running(backwards, F.least, F.lit(far)))
    return every, F.transform(
        F.filter(
            F.arrays_zip(F.col("__every"), reached.alias("reached"), ahead.alias("ahead")),
            lambda z: (z["__every"]["own"] == 1) & (z["reached"] <= z["__every"]["start"]) & (z["ahead"] >= z["__every"]["end"]),
        ),
        lambda z: z["__every"]["m"],
    )


def with_mentions(rows: DataFrame, text_column: str = "text") -> DataFrame:
    """Adds ``__key`` (hash of the text), ``__base`` and ``__loose``: seeds and candidates of each text.

    All columns and rows stay; none of theirs may start with two underscores and a name
    used here (callers with columns of others hand them over as one struct).
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    own = [F.col(f"`{c}`") for c in rows.columns]
    cut = {}
    for form, patterns in (("strict", STRICT), ("loose", LOOSE)):
        for kind, pattern in patterns.items():
            cut[f"__{form}_{kind}"] = F.when(GUARD[kind](text), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    matched = rows.select(*own, F.xxhash64(text_column).alias("__key"), *[c.alias(n) for n, c in cut.items()])
    pieces = {
        f"{name}_pieces": F.when(F.size(name) > 0, F.split(text, (STRICT if "strict" in name else LOOSE)[name.rpartition("_")[2]], -1))
        for name in cut
    }
    parted = matched.withColumns(pieces)
    lists = {"strict": [], "loose": []}
    for name in cut:
        form, kind = name[2:].split("_")
        test = _valid if form == "strict" else _plausible
        lists[form].append(_mentions(F.col(name), F.col(f"{name}_pieces"), kind, lambda v, k=kind, t=test: t(k, v)))
    seeded = parted.withColumns({"__base": F.concat(*lists["strict"]), "__all": F.concat(*lists["loose"])})
    every, free = _clear_of(F.col("__all"), F.col("__base"))
    # Without a seed all candidates stay.
    both = (F.size("__base") > 0) & (F.size("__all") > 0)
    merged = seeded.withColumn("__every", F.when(both, every))
    return merged.select(*own, "__key", "__base", F.when(both, free).otherwise(F.col("__all")).alias("__loose"))


def discover(mentions: DataFrame, support: int = SUPPORT, confident: float = CONFIDENT, accept: float = ACCEPT) -> DataFrame:
    """Candidates to accept, ``(kind, value, score)``, from rows (__base, __loose).

    An instance counts once for each pattern however often it is repeated there.  Scores
    only rise and are at most 1, so the rounds end.
    """
    every = mentions.select(F.explode("__base").alias("m"), F.lit(True).alias("known")).union(
        mentions.select(F.explode("__loose").alias("m"), F.lit(False).alias("known"))
    )
    edges = pinned(
        every.select(F.explode("m.patterns").alias("pattern"), "m.kind", "m.value", "known")
        .groupBy("pattern", "kind", "value")
        .agg(F.max("known").alias("known"), F.max(~F.col("known")).alias("loose"))
    )
    scores = None
    while True:
        scored = edges.withColumn("score", F.lit(0.0)) if scores is None else edges.join(scores, ["kind", "value"], "left")
        weight = F.when(F.col("known"), 1.0).otherwise(F.coalesce("score", F.lit(0.0)))
        sure = F.col("known") | (weight >= accept)
        votes = F.when(sure, 1.0).otherwise(F.greatest(F.lit(0.5), weight))
        sums = scored.groupBy("pattern").agg(
            F.sum(votes).alias("votes"),
            *[F.sum(F.when(F.col("kind") == k, weight)).alias(f"for{k}") for k in range(len(KINDS))],
            *[F.sum(F.when((F.col("kind") == k) & sure, 1)).alias(f"sure{k}") for k in range(len(KINDS))],
        )
        options = F.array(
            *[
                F.struct(
                    F.lit(k).alias("kind"),
                    (F.col(f"for{k}") / (F.col("votes") + PRIOR)).alias("confidence"),
                    F.col(f"sure{k}").alias("sure"),
                )
                for k in range(len(KINDS))
            ]
        )
        good = (
            sums.select("pattern", F.explode(options).alias("o"))
            .where((F.col("o.sure") >= support) & (F.col("o.confidence") >= confident))
            .select("pattern", "o.kind", "o.confidence")
        )
        miss = F.exp(F.sum(F.log(1 - F.col("confidence"))))
        now = edges.where("loose").join(good, ["pattern", "kind"]).groupBy("kind", "value").agg((1 - miss).alias("score"))
        if scores is None:
            before = F.lit(0.0)
        else:
            now = now.join(scores.withColumnRenamed("score", "before"), ["kind", "value"], "full")
            before = F.coalesce("before", F.lit(0.0))
        best = F.greatest(F.coalesce("score", F.lit(0.0)), before)
        made = pinned(now.select("kind", "value", best.alias("score"), (best - before).alias("rise"), ((best >= accept) & (before < accept)).alias("new")))
        scores = made.select("kind", "value", "score")
        if not made.where(F.col("new") | (F.col("rise") > STILL)).count():
            return scores.where(F.col("score") >= accept)


def found_spans(marked: DataFrame, accepted: DataFrame) -> DataFrame:
    """``(__key, __found)``: per text the accepted candidates; of those that overlap the surest stays.

    Candidates are compared inside runs of overlapping ones only.
    """
    hits = (
        marked.select("__key", F.explode("__loose").alias("m"))
        .distinct()
        .join(accepted, (F.col("m.kind") == accepted.kind) & (F.col("m.value") == accepted.value))
        .select("__key", F.struct((-F.col("score")).alias("rank"), "m.start", "m.kind", "m.end", "m.value").alias("s"))
    )
    along = Window.partitionBy("__key").orderBy("s.start", "s.end", "s.kind")
    before = F.max("s.end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opened = hits.withColumn("fresh", F.when(F.col("s.start") >= F.coalesce(before, F.lit(0)), 1).otherwise(0))
    runs = opened.withColumn("run", F.sum("fresh").over(along)).groupBy("__key", "run").agg(F.array_sort(F.collect_list("s")).alias("s"))
    clear = F.aggregate(
        "s",
        F.array().cast("array<struct<rank:double,start:int,kind:int,end:int,value:string>>"),
        lambda out, x: F.when(F.exists(out, lambda o: (o["start"] < x["end"]) & (x["start"] < o["end"])), out).otherwise(
            F.concat(out, F.array(x))
        ),
    )
    return pinned(runs.select("__key", clear.alias("f")).groupBy("__key").agg(F.flatten(F.collect_list("f")).alias("__found")))


def _with_found(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of one text may be a third of all: the few found spans go to the rows, not the other way round."""
    size = F.aggregate("__found", F.lit(16), lambda s, x: s + F.length(x["value"]) + 32)
    return join_sized(rows, found, ["__key"], "left", size)


def _all_spans(base: Column, found: Column) -> Column:
    """Array of (start, kind, end), by start and then by kind."""
    short = lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return F.array_sort(F.concat(F.transform(base, short), F.coalesce(F.transform(found, short), none)))


def _text_of(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def report(docs: DataFrame, **settings) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)``, one row per input row.

    The counts and the digest are those of the seeds; ``spans`` has all spans.  Offsets
    are code points, ends exclusive.  Null and empty texts have no spans; repeated rows
    stay repeated and count once as evidence; an empty table gives an empty result;
    other columns are not read.
    """
    marked = pinned(with_mentions(docs.select("doc_id", "text")).select("doc_id", "__key", "__base", "__loose"))
    found = found_spans(marked, discover(marked, **settings))
    joined = _with_found(marked, found)
    seeds = _all_spans(F.col("__base"), F.lit(None).cast("array<struct<start:int,kind:int,end:int>>"))
    kinds = F.transform("__base", lambda m: m["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)
    ]
    return joined.select(
        "doc_id",
        *counts,
        F.sha2(_text_of(seeds), 256).alias("base_sha256"),
        _text_of(_all_spans(F.col("__base"), F.col("__found"))).alias("spans"),
    )


def _chunked(text: Column) -> Column:
    """The text in pieces of ``CHUNK`` characters, cut in two levels, as finding a place costs its distance."""

    def parts(whole: Column, size: int) -> Column:
        last = F.floor((F.length(whole) - 1) / size).cast("int")
        return F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: F.substring(whole, k * size + 1, F.lit(size)))

    return F.flatten(F.transform(parts(text, CHUNK * 64), lambda part: parts(part, CHUNK)))


def _cut(chunks: Column, start: Column, end: Column) -> Column:
    """Characters from ``start`` up to ``end`` of a chunked text."""
    first, last = (F.floor(x / CHUNK).cast("int") for x in (start, end))
    return F.substring(F.array_join(F.slice(chunks, first + 1, last - first + 1), ""), start % CHUNK + 1, end - start)


def masked(docs: DataFrame, **settings) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; all columns kept.

    Overlapping spans are replaced as one, by the kind of the first.  A column
    ``n_chars`` is brought up to date in the rows that change.  Null and empty texts stay
    as they are; repeated rows stay repeated; an empty table gives an empty result;
    columns may have any names.
    """
    marked = pinned(with_mentions(docs.select("text")).select("__key", "__base", "__loose"))
    found = found_spans(marked, discover(marked, **settings))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__own"), F.col("text").alias("__text"))
    joined = _with_found(with_mentions(rows, "__text").drop("__loose"), found)
    some = (F.size("__base") > 0) | F.col("__found").isNotNull()
    cut = joined.withColumn("__chunks", F.when(some, _chunked(F.col("__text"))))
    # A key is a hash: a span of another text with the same hash would not hold the same value.
    real = F.filter("__found", lambda s: _cut(F.col("__chunks"), s["start"], s["end"]) == s["value"])
    spans = cut.withColumn("__spans", F.when(some, _all_spans(F.col("__base"), real)))
    ends = _running(F.transform("__spans", lambda s: s["end"]), F.greatest, F.lit(0))
    reached = spans.withColumn("__upto", F.when(F.size("__spans") > 0, F.concat(F.array(F.lit(0)), ends)))
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def piece(s: Column, i: Column) -> Column:
        upto = F.get("__upto", i)
        own = F.concat(_cut(F.col("__chunks"), upto, s["start"]), F.get(tags, s["kind"]))
        return F.when(s["start"] < upto, F.lit("")).otherwise(own)

    rest = _cut(F.col("__chunks"), F.element_at("__upto", -1), F.length("__text"))
    changed = F.coalesce(F.size("__spans") > 0, F.lit(False))
    whole = F.concat(F.array_join(F.transform("__spans", piece), ""), rest)
    done = reached.withColumn("__new", F.when(changed, whole).otherwise(F.col("__text"))).withColumn("__changed", changed)
    out = []
    for c in docs.columns:
        own = F.col("__own")[c]
        if c == "text":
            own = F.col("__new")
        elif c == "n_chars":
            own = F.when(F.col("__changed"), F.length("__new").cast(docs.schema[c].dataType)).otherwise(own)
        out.append(own.alias(c))
    return done.select(*out)
