"""The operators as named queries over the shared tables, with SQL twins where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentpanel.llm import ann, decontam, embeddings, langid, lm, merkle, mixing, phrases, pii, quality, simhash, urls, warc
from incidentpanel.llm.common import bucket, load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_simhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents and the groups they form."""
    return simhash.near_duplicates(load(spark, sf_dir, "documents"))


@query("op2_embedding_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all vectors of one label."""
    return embeddings.near_duplicates(load(spark, sf_dir, "embeddings"))


# The rules the contract names: host, path, verdict.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query(
    "op3_url_rules",
    f"""
    WITH r(h, p, v) AS (VALUES {", ".join(str(x) for x in URL_RULES)}),
    u AS (
        SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
    ),
    s AS (
        SELECT row_number() OVER () AS n, page_id,
               translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), '{_UPPER}', '{_LOWER}') AS host,
               coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
        FROM u
    ),
    f AS (
        SELECT n, arg_max(h || p, (length(h || p), length(h))) AS rule, arg_max(v, (length(h || p), length(h))) AS verdict
        FROM s JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        GROUP BY n
    )
    SELECT page_id, host, path, rule, coalesce(verdict, '{urls.DEFAULT_VERDICT}') AS verdict
    FROM s LEFT JOIN f USING (n)
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page url judged by the rules."""
    return urls.judge(load(spark, sf_dir, "pages").select("page_id", "url"), urls.rule_table(spark, URL_RULES))


@query("op4_suffix_tree_score")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the suffix tree and by the unigram base."""
    return lm.score_all(load(spark, sf_dir, "documents"))


@query(
    "op5_decontaminate",
    rf"""
    WITH d AS (
        SELECT row_number() OVER () AS n, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{decontam.WORDS}') AS w
        FROM documents
    ),
    b AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{decontam.WORDS}') AS w
        FROM benchmark
    ),
    c AS (SELECT item_id, w, least(len(w), {decontam.WINDOW}) AS k, unnest(range(1, len(w) - least(len(w), {decontam.WINDOW}) + 2)) AS i FROM b WHERE len(w) > 0),
    v AS (SELECT DISTINCT item_id::VARCHAR AS item, k, array_to_string(w[i:i + k - 1], ' ') AS t FROM c),
    p AS (SELECT n, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM v) WHERE len(w) >= k),
    h AS (SELECT n, i, p.k, item FROM p JOIN v ON v.k = p.k AND v.t = array_to_string(w[i:i + p.k - 1], ' ')),
    x AS (SELECT n, count(DISTINCT pos) AS hit FROM (SELECT n, unnest(range(i, i + k)) AS pos FROM h) GROUP BY n),
    y AS (SELECT n, count(*) AS items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT n, item FROM h) GROUP BY n)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit, 0)::BIGINT AS n_hit, coalesce(items, 0)::BIGINT AS n_items,
           sha256(coalesce(list, '')) AS items_sha256, coalesce(hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN x USING (n) LEFT JOIN y USING (n)
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    return decontam.report(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")).drop("items")


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return langid.identify(load(spark, sf_dir, "documents"))


@query(
    "op7_warc",
    f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    g AS (SELECT *, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM g)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND page_id <> first THEN first END AS refers_to
    FROM f
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived, read back and assembled."""
    return warc.round_trip(load(spark, sf_dir, "pages"))


@query(
    "op8_mix_sources",
    f"""
    WITH d AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size FROM documents
    ),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
    w AS (
        SELECT source, source_size, 2.0 * source_size AS most,
               [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
        FROM s
    ),
    c AS (
        SELECT *, most / weight AS ratio,
               coalesce(sum(most) OVER (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
               sum(weight) OVER (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
               1.5 * (SELECT sum(source_size) FROM s) AS total
        FROM w
    ),
    l AS (
        SELECT coalesce(arg_min((total - filled) / open_weight, (ratio, source)) FILTER (WHERE (total - filled) / open_weight < ratio), 1e300) AS level FROM c
    ),
    t AS (SELECT source, source_size, least(most, level * weight) AS target FROM w, l),
    k AS (
        SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
               ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT / 4294967296.0 AS u
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, size, source_size, target, ((floor(rate) + (u < rate - floor(rate))::INT) * size)::BIGINT AS taken FROM k
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mixing.mix_plan(load(spark, sf_dir, "documents")).drop("copies")


@query("op9_pii")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.report(load(spark, sf_dir, "documents"))


@query("op10_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document."""
    return quality.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query(
    "op11_collocations",
    f"""
    WITH c AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents
    ),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM c),
    g AS (
        SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
        FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k
    ),
    f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
    n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
    p AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS v FROM f WHERE k >= 2 AND f >= {phrases.LEAST}),
    t AS (SELECT *, unnest(range(1, k)) AS cut FROM p),
    s AS (
        SELECT t.lang, t.k, t.phrase, t.a, cut, x.f AS l, y.f AS r, ({phrases.SCALE}::HUGEINT * t.a // (x.f + y.f))::BIGINT AS score
        FROM t JOIN f x ON x.lang = t.lang AND x.phrase = array_to_string(v[:cut], ' ')
        JOIN f y ON y.lang = t.lang AND y.phrase = array_to_string(v[cut + 1:], ' ')
    ),
    m AS (
        SELECT lang, k, phrase, a, min(score) AS score, arg_min(l, (score, cut)) AS l, arg_min(r, (score, cut)) AS r
        FROM s GROUP BY lang, k, phrase, a
    ),
    o AS (
        SELECT * FROM m WHERE NOT EXISTS (
            SELECT 1 FROM p WHERE p.lang = m.lang AND p.k > m.k AND 100 * p.a >= 80 * m.a
            AND contains(' ' || p.phrase || ' ', ' ' || m.phrase || ' ')
        )
    ),
    z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
    SELECT lang, rank, phrase, a, l, r, n, score FROM z JOIN n USING (lang) WHERE rank <= {phrases.TOP}
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 2000 phrases of every language."""
    return phrases.collocations(load(spark, sf_dir, "documents"))


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR END"


# CRC-32 of a text bit by bit (fixed value: the reversed polynomial of the checksum).
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, strlen(doc_id::VARCHAR) + 1),
    lambda p: list_transform(range(8), lambda b: (ascii(substr(doc_id::VARCHAR, p, 1)) >> b) & 1)))),
    lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))))"""


@query(
    "op13_merkle",
    f"""
    WITH RECURSIVE base AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '-') AS g,
               {_field("doc_id")} || {_field("source")} || {_field("lang")} AS head, {_field("n_chars")} AS mid,
               CASE WHEN {_CRC} % 7 = 0 THEN {_field("n_chars + 1")} ELSE {_field("n_chars")} END AS bent,
               {_field("text")} AS tail
        FROM documents
    ),
    hashed AS (SELECT r, doc_id, g, sha256(head || mid || tail) AS leaf, sha256(head || bent || tail) AS now FROM base),
    leaves AS (
        SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i,
               count(*) OVER (PARTITION BY g) AS n
        FROM hashed
    ),
    up(k, g, i, n, d) AS (
        SELECT 0, g, i, n, leaf FROM leaves
        UNION ALL
        SELECT k + 1, g, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY k, g, i // 2, n
    ),
    subs AS (SELECT g, d, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
    tops(k, i, n, d) AS (
        SELECT 0, i, n, d FROM subs
        UNION ALL
        SELECT k + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY k, i // 2, n
    ),
    steps AS (
        SELECT r, 0 AS part, l.k, s.i < l.i >> l.k AS is_left, s.d
        FROM (SELECT r, leaves.g, leaves.i, k FROM leaves JOIN (SELECT DISTINCT g, k FROM up WHERE n > 1) v ON v.g = leaves.g) l
        LEFT JOIN up s ON s.g = l.g AND s.k = l.k AND s.i // 2 = (l.i >> l.k) // 2 AND s.i <> l.i >> l.k
        UNION ALL
        SELECT r, 1, l.k, s.i < l.i >> l.k, s.d
        FROM (SELECT r, subs.i, k FROM leaves JOIN subs ON subs.g = leaves.g, (SELECT DISTINCT k FROM tops WHERE n > 1)) l
        LEFT JOIN tops s ON s.k = l.k AND s.i // 2 = (l.i >> l.k) // 2 AND s.i <> l.i >> l.k
    ),
    proofs AS (
        SELECT r, coalesce(string_agg(d, '' ORDER BY part, k), '') AS flat,
               list(CASE WHEN d IS NULL THEN 'N' WHEN is_left THEN 'L' || d ELSE 'R' || d END ORDER BY part, k) AS path
        FROM steps GROUP BY r
    )
    SELECT doc_id, leaf, s.d AS subroot, t.d AS root, sha256(coalesce(flat, '')) AS proof_sha256,
           list_reduce(list_prepend(now, coalesce(path, [])), lambda a, b: sha256(
               CASE b[1] WHEN 'L' THEN substr(b, 2) || a WHEN 'R' THEN a || substr(b, 2) ELSE a END)) AS folded_root,
           folded_root = root AS verified
    FROM leaves LEFT JOIN proofs USING (r) JOIN subs s ON s.g = leaves.g JOIN tops t ON t.n = 1
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether it still verifies once some were altered."""
    more = {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    made = merkle.audit(load(spark, sf_dir, "documents"), more, bucket("doc_id", 7) == 0)
    return made.select(
        "doc_id",
        *[merkle.as_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
        merkle.as_text(F.col("folded_root")).alias("folded_root"),
        "verified",
    )


@query("op12_nearest")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth vector."""
    return ann.nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
