"""Named queries over the shared test tables, each with its SQL twin."""

from incidentpanel.catalog import (  # noqa: F401  (importing registers the queries)
    boards,
    calendars,
    cleaning,
    fits,
    forecasts,
    panels,
    places,
    profiles,
    storage,
    streams,
)
from incidentpanel.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
