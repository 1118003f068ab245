"""From raw events, roads and territories to published panels.

``standardise_*`` clean one source each; ``municipality_panel`` and
``region_panel`` fuse them.  Nothing is collected: corridor and territory tests
are grid joins, panels are generated spines joined with aggregated counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentpanel.functions import clean as C
from incidentpanel.functions import geometry as G
from incidentpanel.functions import labels as L
from incidentpanel.functions import temporal as T
from incidentpanel.functions.crs import project, unproject
from incidentpanel.operators import spatial as S
from incidentpanel.operators.panel import count_events, day_panel, territory_metadata, week_panel, with_victims
from incidentpanel.session import checkpointed

# Integer-like text columns of the event files.
COUNT_COLUMNS = [
    "id",
    "pessoas",
    "mortos",
    "feridos_leves",
    "feridos_graves",
    "ilesos",
    "ignorados",
    "feridos",
    "veiculos",
]

# Column names of the published tables.
TERRITORY_TEXT = [
    "cd_uf",
    "nm_uf",
    "cd_rgi",
    "nm_rgi",
    "cd_rgint",
    "nm_rgint",
    "cd_regia",
    "nm_regia",
    "cd_concu",
    "nm_concu",
    "tipo_territorial",
]

EVENT_COLUMNS = [
    "id",
    "timestamp",
    "data_inversa",
    "horario",
    "year",
    "month",
    "quarter",
    "week_start",
    "uf",
    "municipio",
    "br",
    "br_canonical",
    "km",
    "latitude",
    "longitude",
    "dia_semana",
    "fase_dia",
    "condicao_metereologica",
    "tipo_acidente",
    "classificacao_acidente",
    "pessoas",
    "mortos",
    "fatal_victims_occ",
    "has_fatality_occ",
]

GEODETIC = "EPSG:4674"


@dataclass(frozen=True)
class CorridorSettings:
    """Road code, corridor radius and grid cell size in metres."""

    road: str = "101"
    buffer_m: float = 500.0
    cell_m: float = 5_000.0
    merge_block_m: float = 10_000.0


def standardise_events(raw: DataFrame, road: str = "101") -> DataFrame:
    """Clean raw event rows and keep those declared on the road."""
    columns: dict[str, Column] = {}
    for name in raw.columns:
        if name == "uf":
            columns[name] = F.upper(F.trim(name))
        elif name == "municipio":
            columns[name] = F.trim(name)
        elif name == "id":
            # Whole numbers beyond 2^53 do not survive a double.
            columns[name] = F.coalesce(F.trim(name).try_cast("bigint"), C.numeric_text(name).try_cast("bigint"))
        elif name in {"km", "latitude", "longitude"} or name in COUNT_COLUMNS:
            columns[name] = C.numeric_text(name)
    base = raw.withColumns(columns)
    moment = C.parse_moment("data_inversa", "horario")
    code = C.road_code("br")
    # The declared-road filter comes first, so nothing else is computed for other roads.
    kept = base.filter(code == road).withColumns(
        {
            "br_canonical": code,
            "is_br101_declared": code == road,
            "timestamp": moment,
            "has_valid_coords": C.coords_valid("latitude", "longitude"),
        }
    )
    return kept.withColumns(
        {
            **T.calendar_fields("timestamp"),
            "fatal_victims_occ": C.count_or_zero("mortos"),
            "has_valid_timestamp": F.col("timestamp").isNotNull(),
            "latitude": F.when(F.col("has_valid_coords"), F.col("latitude")),
            "longitude": F.when(F.col("has_valid_coords"), F.col("longitude")),
        }
    )


def standardise_territories(table: DataFrame, code: str, name: str, level: str, road_states_only: bool = True) -> DataFrame:
    """Clean labels, measure polygons, flag states crossed by the road."""
    kept = [c for c in TERRITORY_TEXT if c in table.columns]
    stamp = ["data_ingestion"] if "data_ingestion" in table.columns else []
    cleaned = table.select(
        C.clean_text(code).alias(code),
        C.clean_text(name).alias(name),
        C.clean_text("sg_uf", upper=True).alias("sg_uf"),
        *[C.clean_text(c).alias(c) for c in kept],
        *([C.clean_text("sigla_rg", upper=True).alias("sigla_rg")] if "sigla_rg" in table.columns else []),
        C.numeric_text("area_km2").alias("area_km2_ibge"),
        C.in_scope(C.clean_text("sg_uf", upper=True)).alias("is_br101_uf_candidate"),
        F.lit(level).alias("territorial_level"),
        F.lit(GEODETIC).alias("geometry_crs"),
        "geometry",
        *stamp,
    )
    if road_states_only:
        cleaned = cleaned.filter("is_br101_uf_candidate")
    return S.polygon_measures(cleaned, projected=True).drop("centroid")


def road_snapshots(segments: DataFrame, settings: CorridorSettings = CorridorSettings()) -> DataFrame:
    """Distinct projected segments per snapshot of the road, with the first version tag."""
    own = segments.filter(F.col("br_canonical") == settings.road).select(
        F.col("snapshot_year").cast("int").alias("snapshot_year"), "versao_snv", "geometry"
    )
    return S.dissolve_segments(S.segments_from_wkt(own, projected=True), ["snapshot_year"], "versao_snv")


def snapshot_summary(snapshots: DataFrame) -> DataFrame:
    """Centerline length and version per snapshot."""
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    return snapshots.groupBy("snapshot_year").agg(
        F.min("versao_snv").alias("versao_snv"), F.count("*").alias("segments"), F.sum(length).alias("road_length_m")
    )


def road_union(snapshots: DataFrame, settings: CorridorSettings = CorridorSettings()) -> DataFrame:
    """One centerline over all snapshots; overlapping alignments count once."""
    return S.merge_collinear(snapshots, settings.merge_block_m, digits=3)


def territories_in_scope(territories: DataFrame, code: str, snapshots: DataFrame, settings: CorridorSettings) -> DataFrame:
    edges = S.polygon_edges(territories.select(code, "geometry"), projected=True)
    return S.polygons_near_corridor(territories, edges, snapshots, code, settings.buffer_m, settings.cell_m)


def road_sections(scope: DataFrame, code: str, union: DataFrame, prefix: str, settings: CorridorSettings) -> tuple[DataFrame, DataFrame]:
    """One section per territory the road enters, and its pieces.

    The section geometry is the list of its pieces, bounded by the road's own
    vertices inside one territory.
    """
    edges = S.polygon_edges(scope.select(code, "geometry"), projected=True)
    keyed = union.withColumn("segment_id", F.xxhash64(*S.SEGMENT))
    pieces = S.clip_segments(keyed, edges, "segment_id", code, settings.cell_m)

    def corner(x: str, y: str) -> Column:
        back = unproject(F.col(x), F.col(y))
        return F.struct(back["lon"].alias("x"), back["lat"].alias("y"))

    part = F.struct(F.lit(True).alias("outer"), F.array(corner("x1", "y1"), corner("x2", "y2")).alias("pts"))
    grouped = pieces.withColumn("__part", part).groupBy(code).agg(
        F.sum("length").alias("road_length_m"),
        G.to_wkt_line(F.array_sort(F.collect_list("__part"))).alias("geometry"),
    )
    labels = ["sg_uf", "cd_uf", "nm_uf", "cd_rgi", "nm_rgi", "cd_rgint", "nm_rgint", "polygon_area_km2"]
    names = [c for c in scope.columns if c.startswith("nome_")]
    kept = scope.select(code, *names, *[c for c in labels if c in scope.columns])
    sections = kept.join(grouped, code).withColumns(
        {
            "section_id": F.concat(F.lit(f"{prefix}_"), F.col(code)),
            "geometry_type": G.geometry_type("geometry"),
            "geometry_crs": F.lit(GEODETIC),
        }
    )
    return sections, pieces


def canonical_events(events: DataFrame, snapshots: DataFrame, settings: CorridorSettings) -> DataFrame:
    """Declared events inside the corridor, located, keyed and checkpointed.

    The event id is not trusted to be unique; a checkpoint pins a row key so
    that every later join sees the same one, also after a lost executor.
    """
    usable = events.filter(F.coalesce("has_valid_coords", F.lit(False)) & F.coalesce("is_br101_declared", F.lit(False)))
    x, y = project(F.col("longitude"), F.col("latitude"))
    located = usable.withColumns({"x": x, "y": y, "row_key": F.monotonically_increasing_id()})
    inside = S.within_corridor(located, snapshots, settings.buffer_m, "row_key")
    shaped = with_victims(inside).withColumns(
        {
            "id": F.col("id").cast("bigint"),
            "uf": C.clean_text("uf", upper=True),
            "has_fatality_occ": F.col("has_fatality"),
            "fatal_victims_occ": F.col("fatal_victims_occ").cast("double"),
            **{
                c: C.clean_text(c)
                for c in EVENT_COLUMNS
                if c in events.columns and dict(events.dtypes)[c] == "string" and c != "uf"
            },
        }
    )
    return checkpointed(events.sparkSession, shaped)


def _located_in(
    events: DataFrame, scope: DataFrame, code: str, settings: CorridorSettings, order: list[str], prefer: tuple[str, str] | None = None
) -> DataFrame:
    edges = S.polygon_edges(scope.select(code, "sg_uf", "geometry"), projected=True)
    index = S.polygon_index(edges, code, settings.cell_m, ["sg_uf"])
    return S.assign_polygon(events, index, settings.cell_m, order, "row_key", prefer=prefer).drop("sg_uf")


def _bounds(events: DataFrame, day: str) -> tuple[Column, Column]:
    row = events.agg(F.min(day), F.max(day)).first()
    if row[0] is None:
        raise ValueError("no valid timestamps to span the panel")
    return F.lit(row[0]), F.lit(row[1])


def municipality_panel(
    events: DataFrame,
    municipalities: DataFrame,
    snapshots: DataFrame,
    state: str,
    settings: CorridorSettings = CorridorSettings(),
) -> dict[str, DataFrame]:
    """Municipalities of one state: scope, sections, events, day and week panels.

    Panels span all cleaned events of the state and keep every municipality the
    corridor touches; events without a municipality stay in the event table only.
    """
    code, name = "codigo_municipio", "nome_municipio"
    own = municipalities.filter(F.col("sg_uf") == state)
    scope = checkpointed(events.sparkSession, territories_in_scope(own, code, snapshots, settings))
    sections, _ = road_sections(scope, code, road_union(snapshots, settings), "municipio", settings)
    in_state = events.filter(F.col("uf") == state)
    canonical = canonical_events(in_state, snapshots, settings)
    placed = _located_in(canonical, scope, code, settings, [code]).join(scope.select(code, name), code, "left")
    placed = checkpointed(events.sparkSession, placed.withColumn("accident_date", F.to_date("timestamp")))
    dated = in_state.filter(F.col("timestamp").isNotNull() & F.col("week_start").isNotNull())
    first, last = _bounds(dated.select(F.to_date("timestamp").alias("d")), "d")
    labels = scope.select(code, name, "sg_uf", "cd_rgint", "nm_rgint")
    days = day_panel(labels, count_events(placed, [code, "accident_date"]), code, "accident_date", first, last)
    weeks = week_panel(
        labels, count_events(placed, [code, "week_start"]), code, T.week_start(first), T.week_start(last)
    ).drop("level_observed")
    kept = [c for c in EVENT_COLUMNS if c in placed.columns and c not in ("br_canonical", "km", "latitude", "longitude")]
    return {
        "municipios_in_scope": scope,
        "road_sections_by_municipio": sections,
        "canonical_accidents": placed.select(*kept, code, name, F.lit(False).alias("depends_on_tolerant_geometry")),
        "day_panel": days,
        "week_panel": weeks,
    }


def region_panel(
    events: DataFrame, regions: DataFrame, snapshots: DataFrame, settings: CorridorSettings = CorridorSettings()
) -> dict[str, DataFrame]:
    """Regions over all states: scope, sections, events, unmatched rows, section and region weeks."""
    spark = events.sparkSession
    code, name = "codigo_rgi", "nome_rgi"
    scope = checkpointed(spark, territories_in_scope(regions, code, snapshots, settings))
    sections, pieces = road_sections(scope, code, road_union(snapshots, settings), "rgi", settings)
    sections = checkpointed(spark, sections)
    canonical = canonical_events(events, snapshots, settings)
    placed = _located_in(canonical, scope, code, settings, ["sg_uf", code], prefer=("uf", "sg_uf"))
    segments = pieces.select(code, *S.SEGMENT).join(sections.select(code, "section_id", "road_length_m"), code)
    matched = S.nearest_section(placed, segments, code, settings.buffer_m * 2, "row_key")
    matched = matched.join(scope.select(code, name, "cd_rgint", "nm_rgint"), code, "left").withColumns(
        {
            "inside_canonical_corridor": F.lit(True),
            "accident_class": F.lit(L.DECLARED_INSIDE),
            "canonical_policy": F.lit(L.CANONICAL_POLICY),
            "rgi_match_status": F.when(F.col(code).isNotNull(), "matched_exact_polygon").otherwise("unmatched_exact_polygon"),
            "assignment_rule": F.lit("official_polygon_exact_then_nearest_section_within_rgi"),
            "depends_on_tolerant_geometry": F.lit(False),
        }
    )
    tail = [
        "inside_canonical_corridor",
        "accident_class",
        "canonical_policy",
        code,
        name,
        "cd_rgint",
        "nm_rgint",
        "rgi_match_status",
        "section_id",
        "section_match_status",
        "assignment_rule",
        "depends_on_tolerant_geometry",
    ]
    table = checkpointed(spark, matched.select(*[c for c in EVENT_COLUMNS if c in matched.columns], *tail))
    first, last = _bounds(events.filter(F.col("week_start").isNotNull()), "week_start")
    usable = table.filter(F.col("section_id").isNotNull() & F.col("week_start").isNotNull())
    labels = [code, name, "sg_uf", "cd_rgint", "nm_rgint"]
    by_section = week_panel(
        sections.select("section_id", *labels, "road_length_m"),
        count_events(usable, ["section_id", "week_start"]),
        "section_id",
        first,
        last,
    )
    owners = territory_metadata(sections, code, labels[1:])
    by_region = week_panel(owners, count_events(usable, [code, "week_start"]), code, first, last)
    policy = F.lit(L.CANONICAL_POLICY)
    missed = (F.col("rgi_match_status") != "matched_exact_polygon") | (
        F.col("section_match_status") != "matched_nearest_section"
    )
    return {
        "rgis_in_scope": scope,
        "road_sections_by_rgi": sections,
        "canonical_accidents_by_rgi_section": table,
        "unmatched_assignments": table.filter(missed),
        "section_week_panel": by_section.withColumn("canonical_policy", policy),
        "rgi_week_panel": by_region.withColumn("canonical_policy", policy),
    }
