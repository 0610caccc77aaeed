"""Every query with checking SQL gives the same columns, types and values."""

from __future__ import annotations

import math

import pytest

import __spark_entry__ as contract
from tests.conftest import TESTDATA

QUERIES = contract.queries()
ORACLES = contract.oracle_sql()
# Fan-out of shared postcodes only shows from this scale on.
FAN_OUT = [
    "dim_locations", "dim_locations_unique", "fct_property_aggregations", "v_regional_performance",
    "v_retrofit_priority", "postcode_band_counts", "treemap_levels", "ml_split", "sample_before_filter",
]


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _canonical(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(repr(_plain(row[i])) for i in order) for row in rows)


def _compare(spark, con, name, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert _canonical(df.columns, [tuple(r) for r in df.collect()]) == _canonical(columns, expected)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_small_scale(spark, duck, sf_dir, name):
    _compare(spark, duck(sf_dir), name, sf_dir)


@pytest.mark.parametrize("name", FAN_OUT)
def test_with_fan_out(spark, duck, name):
    sf_dir = f"{TESTDATA}/sf0.01"
    _compare(spark, duck(sf_dir), name, sf_dir)


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
