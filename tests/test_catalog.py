"""Named queries against their SQL twins on the smallest shared tables.

The headline queries run by default; ``CATALOG=all`` runs every query (as
``tools/compare.py`` does on a larger scale).
"""

from __future__ import annotations

import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from bench import HEADLINE  # noqa: E402
from tools.compare import TABLES, rows  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="shared tables are not here")
# These fit models for a while; test_models.py checks the same code on small data.
SLOW = {"minirocket_features", "grid_selection", "seasonal_forecasts", "group_models", "ridge_per_entity", "model_scores", "recursive_forecast"}


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    for t in TABLES:
        made.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return made


NAMES = list(entry.queries()) if os.environ.get("CATALOG") == "all" else [*HEADLINE, "poisson_glm"]


@pytest.mark.parametrize("name", [n for n in NAMES if n not in SLOW])
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    ran = con.execute(sql)
    columns = [d[0] for d in ran.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows(columns, ran.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
