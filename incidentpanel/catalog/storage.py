"""Queries that write tables, read them back and describe runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidentpanel.catalog.registry import query
from incidentpanel.catalog.roles import INC, POLYGONS, incidents, nation_polygons, supplier_roads, table
from incidentpanel.operators.weather import weather_table
from incidentpanel.session import scratch_path
from incidentpanel.sources import readers as R
from incidentpanel.sources import writers as W


def order_rows(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.year("o_orderdate").alias("br"),
        F.month("o_orderdate").alias("month"),
        F.col("o_totalprice").alias("price"),
    )


@query(
    "partition_pruned_read",
    "SELECT o_orderkey AS id, month(o_orderdate) AS month, round(o_totalprice, 6) AS price, 1997 AS br FROM orders WHERE year(o_orderdate) = 1997",
)
def partition_pruned_read(spark, sf):
    """Partitioned write, then a read that touches one partition."""
    path = W.write_table(order_rows(spark, sf), scratch_path(spark, "orders"), ["br"], order=["id"])
    return R.read_road_partition(spark, path, 1997)


@query(
    "refresh_partitions",
    """SELECT year(o_orderdate) AS br, count(*) AS rows, round(sum(CASE WHEN year(o_orderdate) = 1998 THEN 0 ELSE o_totalprice END), 2) AS price
       FROM orders WHERE year(o_orderdate) <> 1998 OR o_orderkey % 2 = 0 GROUP BY 1""",
)
def refresh_partitions(spark, sf):
    """One year is replaced, the others stay; then the table is republished from itself."""
    rows = order_rows(spark, sf)
    path = W.write_table(rows, scratch_path(spark, "orders"), ["br"])
    newer = rows.filter((F.col("br") == 1998) & (F.col("id") % 2 == 0)).withColumn("price", F.lit(0.0))
    W.refresh_partitions(newer, path, ["br"])
    W.publish(R.read_table(spark, path, path), path, ["br"])
    final = R.read_table(spark, path, path)
    return final.groupBy("br").agg(F.count("*").alias("rows"), F.round(F.sum("price"), 2).alias("price"))


@query(
    "multi_format_read",
    """SELECT f.format, s.n, s.price FROM (SELECT count(*) AS n, round(sum(o_totalprice), 2) AS price FROM orders) s,
       (VALUES ('parquet'), ('csv'), ('json'), ('folder')) f(format)""",
)
def multi_format_read(spark, sf):
    """The same rows through every forecast format; an unknown suffix gives none."""
    rows = order_rows(spark, sf)
    folder = scratch_path(spark, "formats")
    parquet, csv = W.save_frame(rows, folder, "forecast")
    rows.write.json(f"{folder}/forecast.json")
    rows.write.parquet(f"{folder}/plain")
    paths = {"parquet": parquet, "csv": csv, "json": f"{folder}/forecast.json", "folder": f"{folder}/plain"}
    assert R.read_forecast(spark, f"{folder}/forecast.xlsx") is None
    assert R.read_table(spark, f"{folder}/absent") is None
    made = None
    for name, path in paths.items():
        part = R.read_forecast(spark, path).agg(F.count("*").alias("n"), F.round(F.sum("price"), 2).alias("price"))
        part = part.withColumn("format", F.lit(name))
        made = part if made is None else made.unionByName(part)
    return made


@query(
    "delimited_read",
    """SELECT year(o_orderdate) AS source_year_file, count(*) AS n, round(sum(o_totalprice), 2) AS price,
         count(DISTINCT o_orderpriority || ' ção') AS labels FROM orders GROUP BY 1""",
)
def delimited_read(spark, sf):
    """Semicolon files in Latin-1, one folder per year, read in one scan as text."""
    from incidentpanel.functions.clean import numeric_text

    rows = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"),
        F.translate(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), ".", ",").alias("price"),
        F.concat("o_orderpriority", F.lit(" ção")).alias("label"),
    )
    folder = scratch_path(spark, "csv")
    rows.write.partitionBy("year").options(header=True, sep=";", encoding="ISO-8859-1").csv(folder)
    back = R.read_delimited(spark, [f"{folder}/year=*"])
    return back.filter(F.col("label").endswith("ção")).groupBy("source_year_file").agg(
        F.count("*").alias("n"),
        F.round(F.sum(numeric_text("price")), 2).alias("price"),
        F.count_distinct("label").alias("labels"),
    )


def weather_files(spark, sf):
    """Weather payloads from the event feed: one JSON object per cell, one array entry per day."""
    daily = table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.max("value").alias("warm"), F.count("*").alias("n")
    )
    entry = F.struct(F.col("day").cast("string").alias("d"), "warm", "n")
    cells = daily.groupBy("user_id").agg(F.array_sort(F.collect_list(entry)).alias("a"))
    u = F.col("user_id")

    def series(fn):
        return F.transform("a", fn)

    warm = series(lambda e: e["warm"].cast("string"))
    payload = cells.select(
        (F.lit(-30.0) + (u * 13 % 101) / F.lit(10.0)).alias("latitude"),
        (F.lit(-55.0) + (u * 29 % 103) / F.lit(10.0)).alias("longitude"),
        u.cast("double").alias("elevation"),
        F.struct(
            series(lambda e: e["d"]).alias("time"),
            warm.alias("temperature_2m_max"),
            # Deliberately one entry short.
            F.slice(warm, 1, F.greatest(F.size("a") - 1, F.lit(0))).alias("temperature_2m_min"),
            series(lambda e: F.concat(e["d"], F.lit("T06:30"))).alias("sunrise"),
            series(lambda e: e["n"].cast("string")).alias("precipitation_sum"),
        ).alias("daily"),
    )
    # A response or list holds the cells of a stretch of 100 numbers, as a service answers it.
    cell = F.struct("latitude", "longitude", "elevation", "daily")
    kind, stretch = F.col("elevation") % 4, F.floor(F.col("elevation") / 100).alias("g")
    folder = scratch_path(spark, "weather")
    payload.filter(kind == 0).write.json(f"{folder}/single")
    many = payload.filter(kind % 2 == 1).groupBy(stretch).agg(F.collect_list(cell).alias("responses"))
    many.select("responses").write.json(f"{folder}/batched")
    # One file per list and per indented object: neither can be read line by line.
    listed = payload.filter(kind == 2).groupBy(stretch).agg(F.to_json(F.collect_list(cell)).alias("value"))
    spread = listed.select(F.regexp_replace("value", r"\},\{", "},\n{").alias("value"), "g")
    spread.repartitionByRange(listed.count() or 1, "g").select("value").write.option("maxRecordsPerFile", 1).text(f"{folder}/list")
    by_line = R.read_weather_json(spark, [f"{folder}/single", f"{folder}/batched"], multiline=False)
    return by_line.unionByName(R.read_weather_json(spark, f"{folder}/list", multiline=True))


CELL_DAYS = """
e AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS warm, count(*) AS n FROM events GROUP BY 1, 2),
i AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day) - 1 AS day_index, count(*) OVER (PARTITION BY user_id) AS days FROM e)"""


@query(
    "explode_daily_arrays",
    f"""WITH {CELL_DAYS} SELECT CAST(user_id AS DOUBLE) AS elevation, day_index, CAST(day AS VARCHAR) AS weather_date, round(warm, 6) AS warm,
        CASE WHEN day_index < days - 1 THEN round(warm, 6) END AS cold, CAST(day AS VARCHAR) || 'T06:30' AS sunrise, CAST(n AS DOUBLE) AS rain, NULL::DOUBLE AS wind FROM i""",
)
def explode_daily_arrays(spark, sf):
    """Parallel daily arrays to rows; short or absent arrays give null."""
    days = R.unnest_daily(weather_files(spark, sf))
    return days.select(
        "elevation",
        "day_index",
        "weather_date",
        F.col("temperature_2m_max").cast("double").alias("warm"),
        F.col("temperature_2m_min").cast("double").alias("cold"),
        "sunrise",
        F.col("precipitation_sum").cast("double").alias("rain"),
        F.col("wind_speed_10m_max").cast("double").alias("wind"),
    )


@query(
    "weather_table",
    f"""WITH {CELL_DAYS},
        c AS (SELECT *, -30.0::DOUBLE + (user_id * 13 % 101) / 10.0::DOUBLE AS cy, -55.0::DOUBLE + (user_id * 29 % 103) / 10.0::DOUBLE AS cx FROM i),
        m AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, -30.0::DOUBLE + (n_nationkey // 5) * 2 + 1.07::DOUBLE AS py, -55.0::DOUBLE + n_nationkey % 5 * 2 + 1.03::DOUBLE AS px FROM nation),
        j AS (SELECT code, c.*, sqrt((py - cy) * (py - cy) + (px - cx) * (px - cx)) AS dist FROM m, c),
        r AS (SELECT *, row_number() OVER (PARTITION BY code, day ORDER BY dist, cy, cx) AS r FROM j WHERE dist <= 0.2)
        SELECT code AS codigo_municipio, CAST(day AS VARCHAR) AS weather_date, year(day) AS year, round(cy, 6) AS openmeteo_latitude, round(cx, 6) AS openmeteo_longitude,
          round(warm, 6) AS temperature_2m_max, CAST(day AS VARCHAR) || ' 06:30:00' AS sunrise, round(dist, 6) AS coordinate_match_distance_degrees, 'local_json' AS source_kind FROM r WHERE r = 1""",
)
def weather(spark, sf):
    """Weather files joined to request points within 0.2 degrees, nearest cell per day."""
    k = F.col("n_nationkey")
    points = table(spark, sf, "nation").select(
        F.lpad(k.cast("string"), 2, "0").alias("codigo_municipio"),
        (F.lit(-30.0) + F.floor(k / 5) * 2 + 1.07).alias("latitude"),
        (F.lit(-55.0) + k % 5 * 2 + 1.03).alias("longitude"),
        F.lit("matched_centroid_superposition").alias("municipio_match_status"),
    )
    made = weather_table(points, R.unnest_daily(weather_files(spark, sf)), "local_json", F.current_timestamp())
    return made.select(
        "codigo_municipio",
        "weather_date",
        "year",
        "openmeteo_latitude",
        "openmeteo_longitude",
        "temperature_2m_max",
        "sunrise",
        "coordinate_match_distance_degrees",
        "source_kind",
    )


@query(
    "schema_align",
    """SELECT o_orderkey AS id, CAST(year(o_orderdate) AS VARCHAR) AS br, CAST(month(o_orderdate) AS DOUBLE) AS month, round(o_totalprice, 6) AS price, NULL::VARCHAR AS note FROM orders""",
)
def schema_align(spark, sf):
    wanted = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("br", T.StringType()),
            T.StructField("month", T.DoubleType()),
            T.StructField("price", T.DoubleType()),
            T.StructField("note", T.StringType()),
        ]
    )
    return W.align_to(order_rows(spark, sf), wanted)


@query(
    "manifest_row",
    f"""WITH {INC} SELECT count(*) AS n_rows, count(DISTINCT codigo_municipio) AS n_entities, CAST(min(d) AS VARCHAR) AS forecast_min_date,
        CAST(max(d) AS VARCHAR) AS source_panel_max_date, 30 AS horizon_days, 'incident_day' AS model_variant FROM inc""",
)
def manifest_row(spark, sf):
    """Run facts written as JSON and read back."""
    day = F.col("accident_date")
    row = W.manifest(
        incidents(spark, sf, victims=False),
        {
            "n_rows": F.count("*"),
            "n_entities": F.count_distinct("codigo_municipio"),
            "forecast_min_date": F.min(day).cast("string"),
            "source_panel_max_date": F.max(day).cast("string"),
        },
        horizon_days=30,
        model_variant="incident_day",
    )
    return spark.read.json(W.write_manifest(row, scratch_path(spark, "manifest")))


@query(
    "ingest_territories",
    f"""WITH {POLYGONS} SELECT code AS codigo, n_name AS nome, state AS sg_uf, 'municipio' AS tipo_territorial, true AS stamped
        FROM sq JOIN nation ON lpad(CAST(n_nationkey AS VARCHAR), 2, '0') = code""",
)
def ingest_territories(spark, sf):
    source = nation_polygons(spark, sf).withColumnsRenamed({"codigo_municipio": "CD_MUN", "nome_municipio": "Nm_Mun"})
    made = R.ingest_territories(source, {"cd_mun": "codigo", "NM_MUN": "nome", "SG_UF": "sg_uf"}, "municipio")
    return made.withColumn("stamped", F.col("data_ingestion").isNotNull()).drop("data_ingestion")


@query(
    "ingest_road_snapshot",
    "SELECT s_suppkey // 10 AS road_number, 2021 AS snapshot_year, '101' AS br_canonical FROM supplier GROUP BY 1 HAVING count(*) > 1 AND (s_suppkey // 10) % 2 = 0",
)
def ingest_road_snapshot(spark, sf):
    roads = supplier_roads(spark, sf).select(
        F.when(F.col("road_id") % 2 == 0, "0101").otherwise("BR-116").alias("VL_BR"),
        F.lit("SC").alias("sg_uf"),
        F.col("road_id").cast("string").alias("versao_snv"),
        "geometry",
    )
    made = R.ingest_road_snapshot(roads, 2021, "101")
    return made.select(F.col("versao_snv").cast("bigint").alias("road_number"), "snapshot_year", "br_canonical")


@query(
    "static_features",
    """SELECT CAST(s_nationkey AS VARCHAR) AS rgi_id, n_name AS rgi_name, 'R' || n_regionkey AS uf, round(sum(s_acctbal), 2) AS length_m
       FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2, 3""",
)
def static(spark, sf):
    """Road length per region from its sections, codes normalised."""
    nation = table(spark, sf, "nation")
    sections = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lpad(F.col("n_nationkey").cast("string"), 4, "0"), F.lit(".0")).alias("codigo_rgi"),
        F.col("n_name").alias("nome_rgi"),
        F.concat(F.lit(" r"), F.col("n_regionkey").cast("string")).alias("sg_uf"),
        F.col("n_regionkey").cast("string").alias("cd_rgint"),
        F.col("n_regionkey").cast("string").alias("nm_rgint"),
        F.col("s_acctbal").alias("road_length_m"),
    )
    made = R.static_features(sections)
    return made.select("rgi_id", "rgi_name", "uf", F.round("br101_length_m_in_rgi", 2).alias("length_m"))


@query(
    "published_order",
    f"""WITH {INC} SELECT year, count(*) AS rows, 0 AS out_of_order FROM inc GROUP BY 1""",
)
def published_order(spark, sf):
    """Events published by year: inside every file they lie by territory, time and id."""
    events = incidents(spark, sf, victims=False).select("id", "codigo_municipio", "timestamp", "year")
    order = ["codigo_municipio", "timestamp", "id"]
    path = W.write_table(events, scratch_path(spark, "published"), ["year"], order=order)
    back = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    key = F.struct(*order)
    # A file is bounded by the writer's task.
    before = F.lag(key).over(Window.partitionBy("file").orderBy("place"))
    return back.select("year", (before > key).alias("wrong")).groupBy("year").agg(
        F.count("*").alias("rows"), F.count_if("wrong").alias("out_of_order")
    )


@query(
    "dataset_paths",
    f"""WITH {INC} SELECT uf, 's3a://lake/gold/panel/uf=' || uf AS path, count(*) AS rows FROM inc GROUP BY 1""",
)
def dataset_paths(spark, sf):
    """A logical dataset below a root: one partition per state resolved and read; the same name below an object store."""
    events = incidents(spark, sf, victims=False).select("id", "uf")
    root = scratch_path(spark, "lake")
    W.write_table(events, R.dataset_uri(root, "/gold/panel/"), ["uf"])
    # One row per state: a short list.
    states = [r[0] for r in events.select("uf").distinct().orderBy("uf").collect()]
    parts = [
        spark.read.parquet(R.dataset_uri(root, "gold/panel", f"uf={uf}")).agg(F.count("*").alias("rows")).select(
            F.lit(uf).alias("uf"), F.lit(R.dataset_uri("s3://lake/", "/gold/panel/", f"uf={uf}")).alias("path"), "rows"
        )
        for uf in states
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
