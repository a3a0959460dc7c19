"""Every registered query against its DuckDB oracle (sf0.001), and the
rows-only keys for a non-empty, stable schema."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_check import compare, duck
from tripspark.plans.catalog import QUERIES, ROWS_ONLY

ORACLE = E.oracle_sql()
KEYS = sorted(QUERIES)  # the entry may hold more, with tests of their own


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    info = compare(spark, con, key, E.queries()[key], ORACLE.get(key), SF_SMALL)
    if key in ORACLE:
        assert info["ok"], info
    else:
        assert info["rows"] > 0


def test_every_query_has_oracle_or_is_rows_only():
    assert set(KEYS) <= set(E.queries())
    assert set(KEYS) == (set(ORACLE) & set(KEYS)) | ROWS_ONLY
    assert not (set(ORACLE) & ROWS_ONLY)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["hour", "trips", "avg_distance", "avg_total"]
    assert df.count() == 24
