"""Quantiles and running maxima without a task that holds a group."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from joulemart.operators import quantiles, ranking
from joulemart.operators.distribution import box_summary, value_counts

INF = float("inf")


def _values():
    pick = random.Random(2)
    groups = {
        "normal": [pick.gauss(0, 1) for _ in range(3000)],
        "steep": [10.0 ** pick.uniform(-30, 30) * pick.choice([-1, 1]) for _ in range(2500)],
        "ties": [float(pick.randrange(3)) for _ in range(2500)],
        "one": [7.5],
        "same": [2.0] * 900,
        "few": [1.0, 4.0],
        None: [pick.random() for _ in range(1500)],
        "ends": [-INF] * 5 + [INF] * 900 + [pick.random() for _ in range(900)],
        "wide": [-1.7e308, 1.7e308, *[float(i) for i in range(700)]],
    }
    return groups


@pytest.mark.parametrize("send", [True, False])
def test_quantiles_equal_numpy(spark, monkeypatch, send):
    if not send:
        monkeypatch.setattr(quantiles, "BROADCAST_SLICES", 0)
    groups = _values()
    rows = [(g, v, "x") for g, values in groups.items() for v in values] + [("normal", None, "x"), ("normal", float("nan"), "x"), ("none", None, "x")]
    df = spark.createDataFrame(rows, "k string, n double, g string").repartition(6)
    wanted = (0.0, 0.1, 0.25, 0.5, 1.0)
    found = {r.k: r for r in quantiles.exact_quantiles(df, "k", "n", wanted, rank_rows=150).collect()}
    assert set(found) == set(groups)
    for group, values in groups.items():
        row, ordered = found[group], sorted(values)
        assert (row.n_rows, row.min_value, row.max_value) == (len(values), ordered[0], ordered[-1])
        for p, got in zip(wanted, row.quantiles):
            at = p * (len(values) - 1)
            low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
            assert got == low if low == high else got == pytest.approx((math.ceil(at) - at) * low + (at - math.floor(at)) * high, rel=1e-12)
    assert np.quantile(groups["normal"], 0.25) == pytest.approx(found["normal"].quantiles[2])
    assert quantiles.exact_quantiles(df.limit(0), "k", "n", wanted).count() == 0


def test_box_of_values_equals_box_of_counts(spark):
    df = spark.range(5000).select((F.col("id") % 3).cast("string").alias("k"), F.round(F.exp(F.randn(4)), 3).alias("v"))
    df = df.union(spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 50.0)], "k string, v double"))
    by_counts = sorted(map(str, box_summary(value_counts(df, "k", "v"), "k", "v").collect()))
    assert sorted(map(str, quantiles.box_of_values(df, "k", "v", rank_rows=100).collect())) == by_counts


@pytest.mark.parametrize("kind", ["double", "decimal(12,2)", "date"])
def test_running_max_by_ranges(spark, kind):
    value = {"double": "rand(3) * id", "decimal(12,2)": "cast(rand(3) * id as decimal(12,2))", "date": "date_add(date '2000-01-01', cast(rand(3) * id as int))"}[kind]
    rows = spark.range(3000).selectExpr("id div 2 as o", f"case when id % 5 > 0 and id > 20 then {value} end as v")
    rows = rows.union(rows.limit(3).selectExpr("cast(null as bigint)", "v")).cache()
    whole = sorted(map(tuple, ranking.running_max(rows, "o", "v", "best").collect()), key=str)
    ranged = ranking.running_max(rows, "o", "v", "best", pass_rows=100)
    assert sorted(map(tuple, ranged.collect()), key=str) == whole and len(whole) == 1501
    assert "SinglePartition" not in ranged._jdf.queryExecution().executedPlan().toString()
    assert ranking.running_max(rows.limit(0), "o", "v", "best", pass_rows=0).count() == 0
