"""Calendar arithmetic as column expressions (weeks start on Monday)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from incidentpanel.functions.clean import col
from incidentpanel.functions.geometry import let


def week_start(c: Column | str) -> Column:
    return F.to_date(F.date_trunc("week", col(c)))


def calendar_fields(c: Column | str) -> dict[str, Column]:
    ts = col(c)
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "quarter": F.quarter(ts),
        "week_start": week_start(ts),
    }


def iso_year(c: Column | str) -> Column:
    # The Thursday of a week lies in the week's ISO year.
    return F.year(F.date_add(week_start(c), 3))


def iso_week_label(c: Column | str) -> Column:
    return F.concat(iso_year(c).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(col(c)).cast("string"), 2, "0"))


def iso_week_monday(year: Column | str | int, week: Column | str | int) -> Column:
    y = F.lit(year) if isinstance(year, int) else col(year)
    w = F.lit(week) if isinstance(week, int) else col(week)
    fourth = F.make_date(y, F.lit(1), F.lit(4))
    return F.date_add(week_start(fourth), ((w - 1) * 7).cast("int"))


def cyclical(value: Column, period: float, prefix: str) -> dict[str, Column]:
    angle = value * F.lit(2.0 * math.pi) / F.lit(period)
    return {f"{prefix}_sin": F.sin(angle), f"{prefix}_cos": F.cos(angle)}


def calendar_cycles(day: Column | str) -> dict[str, Column]:
    """Sine and cosine of weekday / 7, day of month / 31 and day of year / 365.25."""
    d = col(day)
    return {
        **cyclical(F.weekday(d), 7.0, "dow"),
        **cyclical(F.dayofmonth(d), 31.0, "dom"),
        **cyclical(F.dayofyear(d), 365.25, "doy"),
    }


def easter(year: Column | str) -> Column:
    """Gregorian Easter Sunday in integer arithmetic."""

    def epact(y: Column) -> Column:
        century = F.floor(y / 100)
        shift = F.floor((century - F.floor((century + 8) / 25) + 1) / 3)
        return F.named_struct(
            F.lit("golden"),
            y % 19,
            F.lit("moon"),
            ((y % 19) * 19 + century - F.floor(century / 4) - shift + 15) % 30,
            F.lit("sundays"),
            (century % 4) * 2 + F.floor(y % 100 / 4) * 2 - y % 100 % 4 + 32,
        )

    def serial(k: Column) -> Column:
        weekday = (k["sundays"] - k["moon"]) % 7
        late = F.floor((k["golden"] + k["moon"] * 11 + weekday * 22) / 451)
        return (k["moon"] + weekday - late * 7 + 114).cast("int")

    y = col(year).cast("int")
    return let(
        let(epact(y), serial), lambda s: F.make_date(y, F.floor(s / 31).cast("int"), s % 31 + 1)
    )
