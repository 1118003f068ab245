"""Readers: delimited event files, partitioned tables, weather JSON, forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentpanel.functions.clean import code_text, resolve_column, road_code

# The daily weather variables.
WEATHER_VARIABLES = [
    "temperature_2m_max",
    "temperature_2m_min",
    "wind_speed_10m_max",
    "sunrise",
    "sunset",
    "precipitation_sum",
    "precipitation_hours",
]

_DAILY = ", ".join(["time: array<string>", *[f"{v}: array<string>" for v in WEATHER_VARIABLES]])
_CELL = f"latitude: double, longitude: double, elevation: double, daily: struct<{_DAILY}>"
WEATHER_SCHEMA = (
    f"latitude double, longitude double, elevation double, daily struct<{_DAILY}>, "
    f"responses array<struct<{_CELL}>>, error boolean, reason string"
)


def dataset_uri(root: str, name: str, *partitions: str) -> str:
    """Path of a logical dataset below a local or object-store root."""
    base = root.replace("s3://", "s3a://", 1) if root.startswith("s3://") else root
    return "/".join([base.rstrip("/"), name.strip("/"), *partitions])


def read_delimited(
    spark: SparkSession, paths: Sequence[str], sep: str = ";", encoding: str = "ISO-8859-1"
) -> DataFrame:
    """Yearly text files as strings, one scan, each row tagged with its file's year."""
    # The year stands in the file name or in the name of its folder.
    tail = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*/[^/]*)$", 1)
    year = F.regexp_extract(tail, r"((?:19|20)\d{2})", 1)
    frame = spark.read.options(header=True, sep=sep, encoding=encoding).csv(list(paths))
    return frame.withColumn("source_year_file", year.try_cast("int"))


def read_table(spark: SparkSession, path: str, base: str | None = None) -> DataFrame | None:
    """Parquet with its partition columns; None when the path does not exist."""
    reader = spark.read.option("basePath", base) if base else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}:
            return None
        raise


def read_road_partition(spark: SparkSession, path: str, road: int) -> DataFrame:
    """One road only; the filter prunes the other partitions."""
    return spark.read.option("basePath", path).parquet(path).filter(F.col("br") == road)


def read_forecast(spark: SparkSession, path: str) -> DataFrame | None:
    """Forecast table by suffix; a folder without suffix is Parquet."""
    name = path.rstrip("/").rsplit("/", 1)[-1].lower()
    suffix = name.rsplit(".", 1)[-1] if "." in name else "parquet"
    if suffix in ("parquet", "pq"):
        return spark.read.parquet(path)
    if suffix == "csv":
        return spark.read.options(header=True, inferSchema=True).csv(path)
    if suffix == "json":
        return spark.read.json(path)
    return None


def read_weather_json(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Weather cells from JSON: a list, an object with ``responses`` or one object.

    One row per cell with the source path; a file that carries an error payload
    stops the job with its reason.
    """
    raw = spark.read.schema(WEATHER_SCHEMA).option("multiLine", multiline).json(path)
    return weather_cells(raw)


def weather_cells(raw: DataFrame, *kept: str) -> DataFrame:
    """Cells of payloads read with ``WEATHER_SCHEMA``, from files or a file stream, with further columns kept."""
    tagged = raw.withColumn("source_json_path", F.col("_metadata.file_path"))
    checked = tagged.filter(
        F.when(
            F.coalesce("error", F.lit(False)),
            F.raise_error(F.concat(F.lit("weather payload error: "), F.coalesce("reason", F.lit("?")))).cast("boolean"),
        ).otherwise(F.lit(True))
    )
    own = F.array(F.struct("latitude", "longitude", "elevation", "daily"))
    return (
        checked.withColumn("__r", F.coalesce("responses", own))
        .select(F.explode("__r").alias("r"), "source_json_path", *kept)
        .select("r.*", "source_json_path", *kept)
        .filter(F.col("daily").isNotNull())
    )


def unnest_daily(cells: DataFrame, variables: Sequence[str] = WEATHER_VARIABLES) -> DataFrame:
    """One row per cell and day; variables with short arrays give null."""
    kept = [c for c in cells.columns if c != "daily"]
    days = cells.select(*kept, "daily", F.posexplode("daily.time").alias("day_index", "raw_day"))
    return days.select(
        *kept,
        "day_index",
        F.substring("raw_day", 1, 10).try_cast("date").alias("weather_date"),
        *[F.get(F.col(f"daily.{v}"), F.col("day_index")).alias(v) for v in variables],
    ).filter(F.col("weather_date").isNotNull())


def ingest_territories(table: DataFrame, columns: dict[str, str], kind: str) -> DataFrame:
    """Territorial table: pick columns whatever their case, rename, tag, stamp."""
    picked = [F.col(resolve_column(table, source)).alias(target) for source, target in columns.items()]
    return table.select(*picked).withColumns(
        {"tipo_territorial": F.lit(kind), "data_ingestion": F.current_timestamp()}
    )


def ingest_road_snapshot(table: DataFrame, snapshot_year: int, road: str) -> DataFrame:
    """Road segments of one snapshot, restricted to one canonical road."""
    wanted = {"vl_br": "vl_br", "sg_uf": "sg_uf", "versao_snv": "versao_snv", "geometry": "geometry"}
    picked = table.select(*[F.col(resolve_column(table, s)).alias(t) for s, t in wanted.items()])
    return (
        picked.withColumns({"br_canonical": road_code("vl_br"), "snapshot_year": F.lit(snapshot_year)})
        .filter(F.col("br_canonical") == road)
    )


def static_features(sections: DataFrame) -> DataFrame:
    """Road length per region from its sections."""
    keys = {
        "rgi_id": code_text("codigo_rgi"),
        "rgi_name": F.col("nome_rgi"),
        "uf": F.upper(F.trim("sg_uf")),
        "rgint_id": code_text("cd_rgint"),
        "rgint_name": F.col("nm_rgint"),
    }
    grouped = sections.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(
        F.sum("road_length_m").alias("br101_length_m_in_rgi")
    )
    return grouped.withColumn("br101_length_km_in_rgi", F.col("br101_length_m_in_rgi") / 1000.0)
