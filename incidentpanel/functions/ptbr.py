"""Numbers, dates and periods as Brazilian Portuguese text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from incidentpanel.functions.clean import col


def number_text(c: Column | str, decimals: int = 0) -> Column:
    return F.coalesce(F.translate(F.format_number(col(c).cast("double"), decimals), ",.", ".,"), F.lit("-"))


def date_text(c: Column | str) -> Column:
    return F.coalesce(F.date_format(col(c), "dd/MM/yyyy"), F.lit("-"))


def period_text(start: Column | str, end: Column | str | None = None) -> Column:
    if end is None:
        return date_text(start)
    span = F.concat(date_text(start), F.lit(" a "), date_text(end))
    return F.when(col(end).isNull(), date_text(start)).otherwise(span)
