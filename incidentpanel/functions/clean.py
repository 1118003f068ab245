"""Column cleaning.  Every cast is lenient: bad text becomes null, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Degrees that bound the country.
COUNTRY_BOUNDS = {"lat_min": -35.0, "lat_max": 6.0, "lon_min": -75.0, "lon_max": -28.0}

# The states crossed by the road.
ROAD_STATES = ["AL", "BA", "ES", "PB", "PE", "PR", "RJ", "RN", "RS", "SC", "SE", "SP"]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_text(c: Column | str) -> Column:
    """Decimal-comma text to double; blank and spelled-out nulls give null."""
    text = F.regexp_replace(F.trim(col(c).cast("string")), ",", ".")
    return F.when(~F.lower(text).isin("", "nan", "none", "null"), text.try_cast("double"))


def clean_text(c: Column | str, upper: bool = False) -> Column:
    text = F.nullif(F.trim(col(c).cast("string")), F.lit(""))
    return F.upper(text) if upper else text


def road_code(c: Column | str) -> Column:
    """First run of digits without leading zeros, null when nothing is left."""
    digits = F.regexp_extract(col(c).cast("string"), r"(\d+)", 1)
    return F.nullif(F.regexp_replace(digits, "^0+", ""), F.lit(""))


def code_text(c: Column | str) -> Column:
    """Numeric code as plain integer text."""
    return col(c).cast("string").try_cast("double").try_cast("bigint").cast("string")


def parse_moment(day: Column | str, clock: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    d, t = clean_text(day), clean_text(clock)
    return F.try_to_timestamp(F.concat(d, F.lit(" "), t), F.lit(pattern))


def coords_valid(lat: Column | str, lon: Column | str, bounds: dict[str, float] = COUNTRY_BOUNDS) -> Column:
    """Three-valued: null coordinates give a null flag."""
    return col(lat).between(bounds["lat_min"], bounds["lat_max"]) & col(lon).between(
        bounds["lon_min"], bounds["lon_max"]
    )


def count_or_zero(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("double"), F.lit(0.0)).try_cast("int")


def in_scope(state: Column | str, states: Sequence[str] = ROAD_STATES) -> Column:
    return F.coalesce(col(state).isin(list(states)), F.lit(False))


def repair_mojibake(c: Column | str) -> Column:
    """UTF-8 bytes that were read as ISO-8859-1."""
    return F.decode(F.encode(col(c), "iso-8859-1"), "utf-8")


def seconds_of_day(c: Column | str) -> Column:
    ts = col(c)
    return (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("double")


def lenient_timestamp(c: Column | str) -> Column:
    """Epoch seconds, ISO text or ISO text with a zone, as a UTC timestamp."""
    text = F.trim(col(c).cast("string"))
    epoch = text.try_cast("double")
    return F.when(epoch.isNotNull(), F.timestamp_seconds(epoch)).otherwise(
        F.coalesce(text.try_cast("timestamp"), F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm")))
    )


def finite_double(c: Column | str) -> Column:
    value = col(c).cast("string").try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def round_coord(c: Column | str, digits: int = 6) -> Column:
    return F.round(col(c).cast("double"), digits)


def or_unknown(c: Column | str, label: str = "unknown") -> Column:
    return F.coalesce(clean_text(c), F.lit(label))


def first_available(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """Name of the first candidate column the frame has."""
    return next((name for name in candidates if name in df.columns), None)


def prediction_to_count(scaled: Column | str, scale: Column | str | float = 1.0) -> Column:
    """Rescale, clip at zero, round half to even."""
    factor = F.lit(scale) if isinstance(scale, (int, float)) else col(scale)
    return F.rint(F.greatest(col(scaled) * factor, F.lit(0.0)))


def resolve_column(df: DataFrame, wanted: str) -> str:
    """Column name matched without regard to case; a listing error otherwise."""
    by_fold = {name.casefold(): name for name in df.columns}
    if wanted.casefold() not in by_fold:
        raise ValueError(f"column '{wanted}' not found; available: {', '.join(df.columns)}")
    return by_fold[wanted.casefold()]
