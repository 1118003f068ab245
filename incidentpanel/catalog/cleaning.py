"""Queries for cleaning, labels and scalar text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from incidentpanel.catalog.registry import query
from incidentpanel.catalog.roles import (
    CORRIDOR,
    INC,
    POINTS,
    ROADS,
    week_splits,
    YEAR_SPLITS,
    incidents,
    located_customers,
    point_segment_sql,
    road_segments,
    split_sql,
    table,
)
from incidentpanel.functions import clean as C
from incidentpanel.functions import labels as L
from incidentpanel.functions import ptbr
from incidentpanel.functions import temporal as T
from incidentpanel.operators.keys import apply_rules
from incidentpanel.operators.observed import apply_rules_on_write
from incidentpanel.session import scratch_path
from incidentpanel.operators.spatial import corridor_flag


@query(
    "clean_numeric",
    """SELECT p_partkey, CASE WHEN p_partkey % 7 IN (0, 1, 2, 3, 6) THEN NULL ELSE round(p_retailprice, 6) END AS price
       FROM part""",
)
def clean_numeric(spark, sf):
    k, price = F.col("p_partkey"), F.col("p_retailprice").cast("string")
    raw = (
        F.when(k % 7 == 1, "")
        .when(k % 7 == 2, "nan")
        .when(k % 7 == 3, " None ")
        .when(k % 7 == 6, "1.234,5")
        .when(k % 7 > 3, F.concat(F.lit(" "), F.translate(price, ".", ",")))
    )
    return table(spark, sf, "part").select("p_partkey", C.numeric_text(raw).alias("price"))


@query(
    "canonical_code",
    r"""SELECT p_partkey,
         CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN NULL
              ELSE CAST(p_size AS VARCHAR) END AS road,
         CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_size AS VARCHAR) END AS code
       FROM part""",
)
def canonical_code(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    raw = F.when(k % 5 == 0, "BR-000").when(k % 5 == 1, "rodovia").otherwise(F.concat(F.lit("BR "), F.lpad(size, 5, "0"), F.lit("/7")))
    code = F.when(k % 3 == 0, "x1").otherwise(F.concat(F.lpad(size, 4, "0"), F.lit(".0")))
    return table(spark, sf, "part").select("p_partkey", C.road_code(raw).alias("road"), C.code_text(code).alias("code"))


@query(
    "clean_strings",
    """SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE upper(trim(source)) END AS source_clean,
         CASE WHEN doc_id % 4 = 1 THEN 'unknown' ELSE trim(lang) END AS lang_known,
         md5(text) AS text_md5, length(text) AS text_chars
       FROM documents""",
)
def clean_strings(spark, sf):
    """Trim, blank to null, unknown label, and mojibake repair over the whole text."""
    k = F.col("doc_id")
    source = F.when(k % 4 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("source"), F.lit("  ")))
    lang = F.when(k % 4 != 1, F.concat(F.lit(" "), F.col("lang")))
    broken = F.decode(F.encode("text", "utf-8"), "iso-8859-1")
    fixed = C.repair_mojibake(broken)
    return table(spark, sf, "documents").select(
        "doc_id",
        C.clean_text(source, upper=True).alias("source_clean"),
        C.or_unknown(lang).alias("lang_known"),
        F.md5(fixed).alias("text_md5"),
        F.length(fixed).alias("text_chars"),
    )


@query(
    "parse_timestamps",
    """WITH t AS (SELECT o_orderkey, o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 AS bad,
           o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS ts FROM orders)
       SELECT o_orderkey, CASE WHEN NOT bad THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts,
         CASE WHEN NOT bad THEN CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS DOUBLE) END AS seconds,
         NOT bad AS has_valid_timestamp FROM t""",
)
def parse_timestamps(spark, sf):
    k = F.col("o_orderkey")
    moment = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (k * 7919 % 86400).cast("decimal(18,6)"))
    day = F.when(k % 13 == 0, "2020-13-45").otherwise(F.date_format("o_orderdate", " yyyy-MM-dd"))
    clock = F.when(k % 11 == 0, " ").otherwise(F.date_format(moment, "HH:mm:ss "))
    ts = C.parse_moment(day, clock)
    return table(spark, sf, "orders").select(
        "o_orderkey", ts.alias("ts"), C.seconds_of_day(ts).alias("seconds"), ts.isNotNull().alias("has_valid_timestamp")
    )


@query(
    "calendar_fields",
    """SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month, quarter(o_orderdate) AS quarter,
         CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS week_start FROM orders""",
)
def calendar_fields(spark, sf):
    fields = T.calendar_fields("o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", *[c.alias(n) for n, c in fields.items()])


@query(
    "iso_week_label",
    """SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
         isoyear(o_orderdate) || '-W' || lpad(CAST(week(o_orderdate) AS VARCHAR), 2, '0') AS year_week,
         CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS monday FROM orders""",
)
def iso_week_label(spark, sf):
    """The label, and the Monday recovered from ISO year and week."""
    day = F.to_date("o_orderdate")
    return (
        table(spark, sf, "orders")
        .select(day.alias("day"))
        .distinct()
        .select(
            "day",
            T.iso_week_label("day").alias("year_week"),
            T.iso_week_monday(T.iso_year("day"), F.weekofyear("day")).alias("monday"),
        )
    )


@query(
    "cyclical_features",
    """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
       SELECT CAST(day AS VARCHAR) AS day,
         round(sin(2 * pi() * (isodow(day) - 1) / 7), 6) AS dow_sin, round(cos(2 * pi() * (isodow(day) - 1) / 7), 6) AS dow_cos,
         round(sin(2 * pi() * day(day) / 31), 6) AS dom_sin, round(cos(2 * pi() * day(day) / 31), 6) AS dom_cos,
         round(sin(2 * pi() * dayofyear(day) / 365.25), 6) AS doy_sin, round(cos(2 * pi() * dayofyear(day) / 365.25), 6) AS doy_cos
       FROM d""",
)
def cyclical_features(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select("day", *[c.alias(n) for n, c in T.calendar_cycles("day").items()])


@query(
    "validate_coords",
    "WITH "
    + POINTS
    + """ SELECT id, lat BETWEEN -35 AND 6 AND lon BETWEEN -75 AND -28 AS has_valid_coords,
         CASE WHEN lat BETWEEN -35 AND 6 AND lon BETWEEN -75 AND -28 THEN round(lat, 6) END AS latitude,
         CASE WHEN lat BETWEEN -35 AND 6 AND lon BETWEEN -75 AND -28 THEN round(lon, 6) END AS longitude FROM pts""",
)
def validate_coords(spark, sf):
    valid = C.coords_valid("lat", "lon")
    return located_customers(spark, sf).select(
        "id",
        valid.alias("has_valid_coords"),
        F.when(valid, F.col("lat")).alias("latitude"),
        F.when(valid, F.col("lon")).alias("longitude"),
    )


@query(
    "classify_events",
    "WITH "
    + POINTS
    + ","
    + ROADS
    + f""", hit AS (SELECT DISTINCT id FROM good, seg WHERE {point_segment_sql('lon', 'lat')} <= {CORRIDOR}),
       f AS (SELECT p.id, g.id IS NOT NULL AS valid, p.declared, h.id IS NOT NULL AS inside
             FROM pts p LEFT JOIN good g ON g.id = p.id LEFT JOIN hit h ON h.id = p.id),
       k AS (SELECT id, CASE WHEN NOT valid THEN 'missing_or_invalid_coords' WHEN declared AND inside THEN 'declared_and_inside'
              WHEN declared THEN 'declared_outside' WHEN inside THEN 'undeclared_inside' ELSE 'outside_all' END AS incident_class FROM f)
       SELECT id, incident_class,
         incident_class IN ('declared_outside', 'undeclared_inside', 'missing_or_invalid_coords') AS review_candidate,
         'strict_declared_and_inside' AS canonical_policy, incident_class = 'declared_and_inside' AS is_canonical FROM k""",
)
def classify_events(spark, sf):
    """Five-way class of every point from validity, declaration and the corridor."""
    points = located_customers(spark, sf).withColumn("valid", C.coords_valid("lat", "lon"))
    points = points.withColumns({"x": F.when(F.col("valid"), F.col("lon")), "y": F.when(F.col("valid"), F.col("lat"))})
    flagged = corridor_flag(points, road_segments(spark, sf), CORRIDOR, name="inside")
    named = flagged.select("id", L.incident_class("valid", "declared", "inside").alias("incident_class"))
    return L.with_review_flags(named)


@query(
    "ptbr_format",
    """SELECT p_partkey, translate(format('{:,.2f}', p_retailprice * 1000), ',.', '.,') AS price_text,
         translate(format('{:,.0f}', CAST(p_partkey * 37 AS DOUBLE)), ',.', '.,') AS count_text,
         CASE WHEN p_partkey % 5 = 0 THEN '-' ELSE strftime(DATE '1995-01-01' + CAST(p_partkey % 900 AS INTEGER), '%d/%m/%Y') END AS day_text,
         strftime(DATE '1995-01-01' + CAST(p_partkey % 900 AS INTEGER), '%d/%m/%Y') || ' a ' ||
         strftime(DATE '1995-01-07' + CAST(p_partkey % 900 AS INTEGER), '%d/%m/%Y') AS period_text FROM part""",
)
def ptbr_format(spark, sf):
    start = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("p_partkey") % 900).cast("int"))
    return table(spark, sf, "part").select(
        "p_partkey",
        ptbr.number_text(F.col("p_retailprice") * 1000, 2).alias("price_text"),
        ptbr.number_text(F.col("p_partkey") * 37).alias("count_text"),
        ptbr.date_text(F.when(F.col("p_partkey") % 5 != 0, start)).alias("day_text"),
        ptbr.period_text(start, F.date_add(start, 6)).alias("period_text"),
    )


@query(
    "lenient_timestamps",
    """SELECT event_id, CASE event_id % 5 WHEN 4 THEN NULL
           WHEN 2 THEN strftime(date_trunc('second', ts) - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S')
           WHEN 3 THEN strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S')
           ELSE strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS ts,
         CASE WHEN event_id % 6 IN (0, 1, 2) THEN NULL ELSE round(value, 6) END AS value,
         round(value / 7, 6) AS coord FROM events""",
)
def lenient_timestamps(spark, sf):
    """Epoch, ISO, zoned and minute texts; non-finite numbers; rounded coordinates."""
    k, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    text = (
        F.when(k % 5 == 0, F.unix_timestamp(ts).cast("string"))
        .when(k % 5 == 1, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .when(k % 5 == 2, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+03:00")))
        .when(k % 5 == 3, F.date_format(ts, "yyyy-MM-dd'T'HH:mm"))
        .otherwise("soon")
    )
    number = F.when(k % 6 == 0, "NaN").when(k % 6 == 1, "Infinity").when(k % 6 == 2, "n/a").otherwise(F.col("value").cast("string"))
    return table(spark, sf, "events").select(
        "event_id",
        C.lenient_timestamp(text).alias("ts"),
        C.finite_double(number).alias("value"),
        C.round_coord(F.col("value") / 7).alias("coord"),
    )


@query(
    "cause_categories",
    """WITH c AS (SELECT p_partkey % 93 AS i, p_retailprice FROM part)
       SELECT CASE WHEN i < 34 THEN 'conduta_ou_condicao_do_condutor' WHEN i < 66 THEN 'condicao_da_via'
           WHEN i < 75 THEN 'condicao_do_veiculo' WHEN i < 85 THEN 'condicao_ou_conduta_do_pedestre_ou_agentes_fora_da_pista'
           WHEN i < 91 THEN 'condicao_ou_fenomeno_da_natureza' ELSE 'unknown' END AS cause_category,
         count(*) AS n, round(sum(p_retailprice), 2) AS price FROM c GROUP BY 1""",
)
def cause_categories(spark, sf):
    """Causes are picked from the fixed list by key; two keys of 93 have no known cause."""
    causes = [c for group in L.CAUSE_CATEGORIES.values() for c in group] + ["outra", "sem registro"]
    cause = F.element_at(F.array(*[F.lit(c) for c in causes]), (F.col("p_partkey") % 93 + 1).cast("int"))
    named = L.with_cause_category(table(spark, sf, "part").withColumn("cause", cause), "cause")
    return named.groupBy("cause_category").agg(
        F.count("*").alias("n"), F.round(F.sum("p_retailprice"), 2).alias("price")
    )


@query(
    "split_labels",
    f"""SELECT o_orderkey, {split_sql("CAST(date_trunc('week', o_orderdate) AS DATE)")} AS week_split,
         CASE WHEN year(o_orderdate) BETWEEN 1995 AND 1998 THEN 'train' WHEN year(o_orderdate) = 1999 THEN 'validation'
              WHEN year(o_orderdate) = 2000 THEN 'test' ELSE 'out_of_range' END AS year_split FROM orders""",
)
def split_labels(spark, sf):
    years = {**YEAR_SPLITS, "test": (2000, 2000)}
    return table(spark, sf, "orders").select(
        "o_orderkey",
        L.split_by_range(T.week_start("o_orderdate"), week_splits(spark, sf)).alias("week_split"),
        L.split_by_year(F.year("o_orderdate"), years).alias("year_split"),
    )


@query(
    "level_labels",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'missing' ELSE lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') END AS month_label,
         CASE WHEN o_orderkey % 7 = 0 THEN 'missing' ELSE o_orderpriority END AS phase_label,
         o_orderkey % 4 < 2 AS in_scope FROM orders""",
)
def level_labels(spark, sf):
    k = F.col("o_orderkey")
    state = F.element_at(F.array(F.lit("SC"), F.lit("BA"), F.lit("MG"), F.lit(None)), (k % 4 + 1).cast("int"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        L.level_label(F.when(k % 9 != 0, F.month("o_orderdate").cast("double")), two_digits=True).alias("month_label"),
        L.level_label(F.when(k % 7 != 0, F.col("o_orderpriority"))).alias("phase_label"),
        C.in_scope(state).alias("in_scope"),
    )


@query(
    "prediction_rounding",
    """SELECT l_orderkey, l_linenumber, round_even(greatest((l_quantity - 10) * 0.5, 0.0), 0) AS predicted_count,
         CASE WHEN l_tax > 0 THEN round(l_discount / l_tax, 6) END AS share FROM lineitem""",
)
def prediction_rounding(spark, sf):
    """Clip, rescale, round half to even; ratio that is null for a zero denominator."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        C.prediction_to_count(F.col("l_quantity") - 10, 0.5).alias("predicted_count"),
        L.safe_share("l_discount", "l_tax").alias("share"),
    )


RULES = [
    ("states", [("uf", ["r1", " R3 "])]),
    ("urgent_early", [("fase_dia", ["1-urgent"]), ("year", ["1995", "1996", "x"])]),
    ("segment", [("segmento", ["MACHINERY"]), ("condicao", ["P"])]),
]
RULE_SQL = {
    "states": "uf IN ('R1', 'R3')",
    "urgent_early": "fase_dia = '1-URGENT' AND year IN (1995, 1996)",
    "segment": "segmento = 'MACHINERY' AND condicao = 'P'",
}


@query(
    "exclusion_rules",
    f"WITH {INC} SELECT id, uf, fase_dia, year FROM inc WHERE NOT (" + " OR ".join(f"({r})" for r in RULE_SQL.values()) + ")",
)
def exclusion_rules(spark, sf):
    kept, _ = apply_rules(incidents(spark, sf, victims=False), RULES)
    return kept.select("id", "uf", "fase_dia", "year")


@query(
    "rule_diagnostics",
    f"WITH {INC} "
    + " UNION ALL ".join(f"SELECT '{n}' AS rule_name, count(*) AS rows_excluded FROM inc WHERE {r}" for n, r in RULE_SQL.items()),
)
def rule_diagnostics(spark, sf):
    """Counted by the job that stores the rows kept."""
    return apply_rules_on_write(incidents(spark, sf, victims=False), RULES, scratch_path(spark, "rules"))[1]
