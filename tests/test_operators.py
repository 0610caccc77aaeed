from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from joulemart import constants as K
from joulemart.operators import distribution, metrics, quality, ranking, sampling, shares
from joulemart.operators.latest import latest_per_key
from joulemart.operators.reshape import pivot_fill
from joulemart.operators.sampling import sample_exact, stratified_exact
from joulemart.plans.examples import example_first, example_second


def test_latest_matches_brute_force(spark):
    rng = random.Random(1)
    rows = [
        (rng.choice([None, "a", "b", "c"]), rng.choice([None, 1, 2]), rng.choice([None, 1, 2]), i, f"v{i}")
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "k string, d1 int, d2 int, id int, v string")
    got = {r.k: r.v for r in latest_per_key(df, "k", ["d1", "d2", "id"], ["v"]).collect()}
    low = lambda x: -1 if x is None else x
    expected = {}
    for key in ("a", "b", "c"):
        best = max((r for r in rows if r[0] == key), key=lambda r: (low(r[1]), low(r[2]), r[3]))
        expected[key] = best[4]
    assert got == expected


def test_exact_sample(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    first = {r.key for r in sampling.sample_exact(df, "key", 700, 42).collect()}
    again = {r.key for r in sampling.sample_exact(df.repartition(13), "key", 700, 42).collect()}
    other = {r.key for r in sampling.sample_exact(df, "key", 700, 99).collect()}
    assert len(first) == 700 and first == again and first != other
    assert sampling.sample_exact(df, "key", 9000, 42).count() == 5000
    assert sampling.sample_exact(df, "key", 5000, 42).count() == 5000


def test_exact_sample_is_unbiased(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 10).alias("g"))
    counts = {r.g: r.n for r in sampling.sample_exact(df, "key", 4000, 7).groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert all(300 < n < 500 for n in counts.values())


@pytest.fixture(scope="module")
def labelled(spark):
    # One label holds most rows, one is missing, one is rare.
    label = F.when(F.col("id") % 100 < 80, "D").when(F.col("id") % 100 < 99, "C").otherwise(F.lit(None))
    return spark.range(3000).select(F.col("id").cast("string").alias("key"), label.alias("label"))


def test_stratified_split(labelled):
    split = sampling.stratified_split(labelled, "label", "key", 0.2, 42)
    got = {(r.label, r.is_test): r.n for r in split.groupBy("label", "is_test").agg(F.count("*").alias("n")).collect()}
    assert got == {
        ("D", True): 480, ("D", False): 1920, ("C", True): 114, ("C", False): 456, (None, True): 6, (None, False): 24,
    }


def test_stratified_folds(labelled):
    folds = sampling.stratified_folds(labelled, "label", "key", 3, 42)
    rows = folds.collect()
    assert len(rows) == 3000 and len({r.key for r in rows}) == 3000
    sizes = Counter((r.label, r.fold) for r in rows)
    for label, whole in (("D", 2400), ("C", 570), (None, 30)):
        per_fold = [sizes[(label, fold)] for fold in range(3)]
        assert sum(per_fold) == whole and max(per_fold) - min(per_fold) <= 1


def test_box_summary_matches_numpy(spark):
    rng = random.Random(3)
    values = {g: [round(rng.gauss(5, 2), 1) for _ in range(301)] + [40.0] for g in "xy"}
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs], "g string, v double")
    for row in distribution.box_summary(distribution.value_counts(df, "g", "v"), "g", "v").collect():
        q1, median, q3 = np.percentile(values[row.g], [25, 50, 75])
        assert (row.q1, row.median, row.q3) == pytest.approx((q1, median, q3))
        inside = [v for v in values[row.g] if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
        assert (row.lower_whisker, row.upper_whisker) == (min(inside), max(inside))
        assert row.max_value == 40.0 and row.n_rows == 302
        assert row.notch_high - row.median == pytest.approx(1.57 * (q3 - q1) / 302**0.5, abs=1e-4)


def test_head_and_tail(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(30)] + [(99, None)], "id int, v double")
    rows = ranking.head_and_tail(df, ["v", "id"], 3, ("low", "high")).collect()
    by_side = {s: [r.id for r in sorted(rows, key=lambda r: r.position) if r.side == s] for s in ("low", "high")}
    assert by_side == {"low": [0, 7, 14], "high": [20, 27, 99]}


def test_running_max(spark):
    trials = [0.3, 0.1, 0.5, 0.4, 0.6]
    df = spark.createDataFrame(list(enumerate(trials)), "trial int, value double")
    rows = ranking.running_max(df, "trial", "value", "best").orderBy("trial").collect()
    assert [r.best for r in rows] == [0.3, 0.3, 0.5, 0.5, 0.6]


def test_shares(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("b", "x", 0)], "g string, c string, n bigint")
    got = {(r.g, r.c): r.p for r in df.withColumn("p", shares.share_of_group(F.col("n"), "g")).collect()}
    assert got == {("a", "x"): 25.0, ("a", "y"): 75.0, ("b", "x"): 0.0}
    whole = shares.with_total(df, F.sum("n"), "whole").collect()
    assert len(whole) == 3 and {r.whole for r in whole} == {4}


def test_pivot_keeps_absent_labels(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "g string, c string, n int")
    got = pivot_fill(df, "g", "c", {"n_": "n"}, ("x", "y", "Never Seen")).orderBy("g")
    assert got.columns == ["g", "n_x", "n_y", "n_never_seen"]
    assert [tuple(r) for r in got.collect()] == [("a", 1, 0, 0), ("b", 0, 2, 0)]


def test_pivot_refuses_other_labels(spark):
    for other in ("c", None):
        rows = spark.createDataFrame([(1, "a", 2), (1, other, 3)], "k int, label string, n int")
        with pytest.raises(Exception, match="none of the pivoted labels"):
            pivot_fill(rows, "k", "label", {"n_": "n"}, ("a", "b")).collect()


def test_pivoted_events_are_all_events(spark, sf_dir):
    wide = contract.queries()["pivot_fill"](spark, sf_dir)
    cells = sum(sum(r[c] for c in wide.columns if c != "day") for r in wide.collect())
    assert cells == spark.read.parquet(f"{sf_dir}/events.parquet").count()


@pytest.mark.parametrize("n", [1, 7, 100, 333, 5000])
def test_stratified_exact(spark, n):
    labels = ["a"] * 700 + ["b"] * 201 + ["c"] * 98 + [None]
    rows = spark.createDataFrame([(i, label) for i, label in enumerate(labels)], "id long, label string").repartition(3)
    got = Counter(r.label for r in stratified_exact(rows, "label", "id", n, 3).collect())
    assert sum(got.values()) == min(n, 1000)
    for label, size in Counter(labels).items():
        assert abs(got[label] - min(n, 1000) * size / 1000) < 1


def test_exact_sample_keeps_partitions(spark):
    rows = spark.range(0, 40_000, 1, 8)
    sample = sample_exact(rows, "id", 10_000, 5)
    assert sample.count() == 10_000 and sample.rdd.getNumPartitions() > 4
    assert "TakeOrdered" not in sample._jdf.queryExecution().executedPlan().toString()


def test_examples_and_checks(spark):
    first, second = example_first(spark), example_second(spark)
    assert sorted(r.id or 0 for r in first.collect()) == [0, 1]
    assert [r.id for r in second.collect()] == [1]
    declared = [quality.unique("id"), quality.not_null("id")]
    got = {r.check: (r.n_failed, r.passed) for r in quality.run_checks(first, declared).collect()}
    assert got == {"unique": (0, True), "not_null": (1, False)}
    assert all(r.passed for r in quality.run_checks(second, declared).collect())


def test_checks_find_failures(spark):
    df = spark.createDataFrame(
        [(1, "A", "2024-01-01"), (1, "Z", "2024-02-01"), (2, None, "2024-03-01"), (None, "B", None)],
        "id int, band string, day string",
    ).withColumn("day", F.col("day").cast("date"))
    got = {
        (r.check, r.column): (r.n_failed, r.n_rows, r.passed)
        for r in quality.run_checks(
            df,
            [
                quality.unique("id"),
                quality.unique("id", "band"),
                quality.accepted_values("band", K.BANDS),
                quality.accepted_range("id", 1, 1),
                quality.not_null_proportion("id", 0.75),
                quality.not_null_proportion("band", 0.8),
                quality.recency("day", "2024-03-31", 30),
                quality.recency("day", "2025-03-31", 30),
                quality.row_predicate("future", "day", F.col("day") > "2024-02-15"),
            ],
        ).collect()
    }
    assert got[("unique", "id")] == (1, 3, False)
    assert got[("unique_combination", "id,band")] == (0, 2, True)
    assert got[("accepted_values", "band")] == (1, 4, False)
    assert got[("accepted_range", "id")] == (1, 4, False)
    assert got[("not_null_proportion", "id")] == (1, 4, True)
    assert got[("not_null_proportion", "band")] == (1, 4, False)
    assert got[("future", "day")] == (1, 4, False)
    assert got[("recency", "day")] == (1, 4, False)


PAIRS = [("A", "A"), ("A", "B"), ("B", "B"), ("B", "B"), ("C", "B"), ("C", "D")]


def test_class_report(spark):
    df = spark.createDataFrame(PAIRS, "actual string, guess string")
    pairs = metrics.pair_counts(df, "actual", "guess")
    got = {r.band: (r.precision, r.recall, r.f1, r.support) for r in metrics.class_report(pairs).collect()}
    assert got["A"] == pytest.approx((1.0, 0.5, 2 / 3, 2))
    assert got["B"] == pytest.approx((0.5, 1.0, 2 / 3, 2))
    # Never predicted right, and predicted without any actual: 0, not undefined.
    assert got["C"] == (0.0, 0.0, 0.0, 2) and got["D"] == (0.0, 0.0, 0.0, 0)
    assert got["macro avg"][2] == pytest.approx((2 / 3 + 2 / 3) / 4)
    assert got["weighted avg"][2] == pytest.approx((2 / 3 * 2 + 2 / 3 * 2) / 6)
    assert got["accuracy"][0] == 0.5
    assert [r.band for r in metrics.labels_present(pairs, K.BANDS).collect()] == ["A", "B", "C", "D"]


def test_confusion(spark):
    df = spark.createDataFrame(PAIRS, "actual string, guess string")
    pairs = metrics.pair_counts(df, "actual", "guess")
    counts = {r.actual: (r.pred_a, r.pred_b, r.pred_d) for r in metrics.confusion_matrix(pairs, K.BANDS).collect()}
    assert counts == {"A": (1, 1, 0), "B": (0, 2, 0), "C": (0, 1, 1)}
    shares_ = {r.actual: (r.pct_a, r.pct_b, r.pct_d) for r in metrics.confusion_shares(pairs, K.BANDS).collect()}
    assert shares_ == {"A": (50.0, 50.0, 0.0), "B": (0.0, 100.0, 0.0), "C": (0.0, 50.0, 50.0)}


def test_naive_baselines(spark):
    df = spark.createDataFrame([("D",)] * 3 + [("C",)], "target string")
    row = metrics.naive_baselines(df, "target", 7).first()
    assert (row.majority_class, row.majority_accuracy) == ("D", 0.75)
    assert row.uniform_accuracy == pytest.approx(1 / 7)
