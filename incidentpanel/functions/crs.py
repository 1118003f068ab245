"""American Polyconic projection on GRS80 (forward and inverse) as expressions.

Formulas: J. P. Snyder, Map Projections - A Working Manual (1987), chapter 18.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from incidentpanel.functions.geometry import let

# GRS80 ellipsoid and the Brazilian polyconic grid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
CENTRAL_MERIDIAN = -54.0
FALSE_EASTING = 5_000_000.0
FALSE_NORTHING = 10_000_000.0

E2 = FLATTENING * (2 - FLATTENING)
# Coefficients of the meridian arc series.
M0 = 1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256
M2 = 3 * E2 / 8 + 3 * E2**2 / 32 + 45 * E2**3 / 1024
M4 = 15 * E2**2 / 256 + 45 * E2**3 / 1024
M6 = 35 * E2**3 / 3072

NEWTON_STEPS = 8


def _arc(phi: Column) -> Column:
    """Meridian arc from the equator divided by the semi-major axis."""
    return phi * M0 - F.sin(phi * 2) * M2 + F.sin(phi * 4) * M4 - F.sin(phi * 6) * M6


def _arc_slope(phi: Column) -> Column:
    return F.lit(M0) - F.cos(phi * 2) * (2 * M2) + F.cos(phi * 4) * (4 * M4) - F.cos(phi * 6) * (6 * M6)


def project(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to metres."""
    phi = lat * (math.pi / 180)
    delta = (lon - CENTRAL_MERIDIAN) * (math.pi / 180)
    turn = delta * F.sin(phi)
    radius = F.lit(SEMI_MAJOR) / F.sqrt(F.lit(1.0) - F.sin(phi) * F.sin(phi) * E2) / F.tan(phi)
    on_equator = phi == 0
    x = F.when(on_equator, delta * SEMI_MAJOR).otherwise(radius * F.sin(turn))
    y = F.when(on_equator, F.lit(0.0)).otherwise(_arc(phi) * SEMI_MAJOR + radius * (F.lit(1.0) - F.cos(turn)))
    return x + FALSE_EASTING, y + FALSE_NORTHING


def unproject(x: Column, y: Column) -> Column:
    """Metres to degrees, as struct(lon, lat); Newton steps on the latitude."""
    east = (x - FALSE_EASTING) / SEMI_MAJOR
    north = (y - FALSE_NORTHING) / SEMI_MAJOR

    def solve(k: Column) -> Column:
        square = k["e"] * k["e"] + k["n"] * k["n"]

        def step(phi: Column, _: Column) -> Column:
            c = F.sqrt(F.lit(1.0) - F.sin(phi) * F.sin(phi) * E2) * F.tan(phi)
            m, slope = _arc(phi), _arc_slope(phi)
            top = k["n"] * (c * m + 1) - m - (m * m + square) * c / 2
            bottom = (
                F.sin(phi * 2) * E2 * (m * m + square - k["n"] * m * 2) / (c * 4)
                + (k["n"] - m) * (c * slope - F.lit(2.0) / F.sin(phi * 2))
                - slope
            )
            return phi - top / bottom

        steps = F.sequence(F.lit(1), F.lit(NEWTON_STEPS))
        latitude = F.aggregate(steps, k["n"], step)

        def longitude(phi: Column) -> Column:
            c = F.sqrt(F.lit(1.0) - F.sin(phi) * F.sin(phi) * E2) * F.tan(phi)
            return F.struct(
                (F.asin(k["e"] * c) / F.sin(phi) * (180 / math.pi) + CENTRAL_MERIDIAN).alias("lon"),
                (phi * (180 / math.pi)).alias("lat"),
            )

        flat = F.struct(
            (k["e"] * (180 / math.pi) + CENTRAL_MERIDIAN).alias("lon"), F.lit(0.0).alias("lat")
        )
        return F.when(k["n"] == 0, flat).otherwise(let(latitude, longitude))

    return let(F.struct(east.alias("e"), north.alias("n")), solve)
