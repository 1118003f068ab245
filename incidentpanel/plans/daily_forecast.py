"""Daily territory forecast: enriched panel, kernels, ridges, evaluation, recursion."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentpanel.functions.labels import split_by_year
from incidentpanel.functions.temporal import calendar_cycles
from incidentpanel.models import minirocket, ridge
from incidentpanel.operators import evaluate as E
from incidentpanel.operators.calendar_tables import date_features, future_rows
from incidentpanel.operators.keys import require_unique
from incidentpanel.operators.samples import EXOGENOUS, WEATHER_CHANNELS, daily_blocks, train_zscores, weather_coverage
from incidentpanel.operators.windows import keep_rows
from incidentpanel.session import checkpointed
from incidentpanel.sources.writers import manifest

TOWN, DAY = "codigo_municipio", "accident_date"
LABELS = ["nome_municipio", "sg_uf", "cd_rgint", "nm_rgint"]


@dataclass(frozen=True)
class DailySettings:
    years: dict[str, tuple[int, int]] = field(
        default_factory=lambda: {"train": (2017, 2023), "validation": (2024, 2024), "test": (2025, 2026)}
    )
    lookback: int = 90
    n_kernels: int = 10_000
    # Training windows that give the bias quantiles (no labels are used): bounds what the driver reads.
    kernel_windows: int = 256
    seed: int = 101
    alphas: Sequence[float] = ridge.ALPHAS
    selection_split: str = "validation"
    holiday_lookahead: int = 30
    horizon: int = 30
    weather: bool = True

    @property
    def variant(self) -> str:
        return "municipio_day_with_weather" if self.weather else "municipio_day_without_weather"


def enrich(
    panel: DataFrame, settings: DailySettings, weather: DataFrame | None = None, state_holidays: DataFrame | None = None
) -> DataFrame:
    """Day panel with off-day features, optional weather channels and split labels."""
    row = panel.agg(F.min(DAY), F.max(DAY)).first()
    lo, hi = F.lit(row[0]), F.lit(row[1])
    features = date_features(panel.select("sg_uf"), lo, hi, state_holidays, "sg_uf", longest=settings.holiday_lookahead)
    made = panel.join(features.withColumnRenamed("date", DAY), ["sg_uf", DAY], "left")
    if settings.weather:
        if weather is None:
            raise ValueError("weather features are enabled but no weather table was given")
        made = made.join(require_unique(weather, [TOWN, DAY], "weather"), [TOWN, DAY], "left")
    kept = [TOWN, *[c for c in LABELS if c in made.columns], DAY, "year", "month", "day", "accident_count"]
    extra = WEATHER_CHANNELS if settings.weather else []
    return made.withColumn("split", split_by_year("year", settings.years)).select(*kept, "split", *EXOGENOUS, *extra)


def registry(enriched: DataFrame, settings: DailySettings) -> DataFrame:
    """One row that describes the feature table."""
    facts = {
        "n_municipios": F.count_distinct(TOWN),
        "n_rows": F.count("*"),
        "first_date": F.min(DAY),
        "last_date": F.max(DAY),
        **{f"n_{s}": F.count_if(F.col("split") == s) for s in settings.years},
    }
    row = manifest(
        enriched,
        facts,
        n_sequence_channels=17 if settings.weather else 10,
        lookback_days=settings.lookback,
        model_variant=settings.variant,
        target_column="accident_count",
        holiday_max_lookahead=settings.holiday_lookahead,
    )
    if settings.weather:
        row = row.withColumn("weather_complete_row_share", weather_coverage(enriched).scalar())
    return row


def train(enriched: DataFrame, settings: DailySettings) -> dict[str, object]:
    """Kernels fitted on a bounded sample, one ridge per territory, errors per split."""
    spark = enriched.sparkSession
    enriched = checkpointed(spark, enriched)
    samples = checkpointed(spark, daily_blocks(enriched, TOWN, DAY, settings.lookback, weather=settings.weather))
    rocket = minirocket.fit_on(samples, settings.n_kernels, settings.seed, settings.kernel_windows)
    models = checkpointed(spark, ridge.train_per_entity(samples, TOWN, settings.alphas, settings.selection_split, rocket))
    dated = keep_rows(samples, lambda r: r["split"].isin(list(settings.years)))
    scored = ridge.score_samples(dated, models, TOWN, rocket)
    overall, per_town = E.evaluate_entities(scored.withColumn("actual", F.col("y_raw")), TOWN)
    return {"rocket": rocket, "models": models, "metrics": overall, "metrics_by_municipio": per_town}


def forecast(
    enriched: DataFrame,
    trained: dict[str, object],
    settings: DailySettings,
    model_uri: str,
    state_holidays: DataFrame | None = None,
    generated_at: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Recursive forecast of the next ``horizon`` days and its manifest."""
    cutoff = enriched.agg(F.max(DAY)).first()[0]
    first, last = F.date_add(F.lit(cutoff), 1), F.date_add(F.lit(cutoff), settings.horizon)
    ahead = date_features(
        enriched.select("sg_uf"), first, last, state_holidays, "sg_uf", longest=settings.holiday_lookahead
    )
    labels = [c for c in LABELS if c in enriched.columns]
    extended = future_rows(enriched, labels, TOWN, DAY, settings.horizon, "accident_count", ahead, "sg_uf")
    channels = [*calendar_cycles(DAY), *EXOGENOUS]
    extended = extended.withColumns(calendar_cycles(DAY))
    if settings.weather:
        # Unknown future weather counts as the train mean, as in training.
        extended = train_zscores(extended, TOWN, WEATHER_CHANNELS)
        channels += [f"{c}_z" for c in WEATHER_CHANNELS]
    made = ridge.recursive_forecast(
        extended, trained["models"], trained["rocket"], TOWN, DAY, channels, settings.lookback
    )
    towns = enriched.groupBy(TOWN).agg(*[F.max_by(c, DAY).alias(c) for c in labels])
    stamp = generated_at or datetime.now(timezone.utc).isoformat()
    table = made.join(towns, TOWN, "left").select(
        TOWN,
        *labels,
        DAY,
        "predicted_accident_count",
        "prediction_raw",
        "prediction_scaled",
        "forecast_horizon_day",
        F.lit(settings.variant).alias("model_variant"),
        F.lit(model_uri).alias("model_uri"),
        F.lit(cutoff).alias("source_panel_max_date"),
        F.lit(stamp).alias("generated_at"),
        F.lit("previsão").alias("fonte"),
    )
    table = checkpointed(enriched.sparkSession, table)
    row = manifest(
        table,
        {
            "n_rows": F.count("*"),
            "forecast_min_date": F.min(DAY).cast("string"),
            "forecast_max_date": F.max(DAY).cast("string"),
        },
        generated_at=stamp,
        model_uri=model_uri,
        model_variant=settings.variant,
        source_panel_max_date=str(cutoff),
        horizon_days=settings.horizon,
    )
    return table, row
