"""Exact quantiles of continuous columns, whatever the number of distinct values or of rows in a group.

A wanted quantile is a value at a rank. A histogram between a group's least and greatest value tells which
bins hold wanted ranks; only those bins are cut up again, between their own least and greatest values,
until a bin has one value or few enough rows to be ranked by one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from joulemart.functions.numbers import rounded
from joulemart.operators.distribution import NOTCH, WHISKER
from joulemart.session import sent_if_few, written

#: Rows of a slice that one task puts in order.
RANK_ROWS = 100_000
#: Bins that a slice is cut into.
BINS = 4096
#: Up to so many slices or groups are sent to every task.
BROADCAST_SLICES = 100_000


def _numbers(df: DataFrame, group: str, value: str) -> DataFrame:
    number = F.col(value).cast("double")
    return df.select(F.col(group).alias("g"), number.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))


def _in_slices(rows: DataFrame, slices: DataFrame) -> DataFrame:
    """Rows that lie in a slice, with what is known of it."""
    known = sent_if_few(slices.withColumnRenamed("g", "of"), BROADCAST_SLICES)
    return rows.join(known, F.col("g").eqNullSafe(F.col("of")) & F.col("v").between(F.col("lo"), F.col("hi")))


def _cut(rows: DataFrame, slices: DataFrame) -> DataFrame:
    """The bins of slices that hold wanted ranks, as slices."""
    # Halves, as the width itself may be too large for a double; between infinities there are three bins.
    part = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * BINS
    ends = F.when(F.col("v") == F.col("lo"), 0).when(F.col("v") == F.col("hi"), BINS - 1)
    bin_ = F.coalesce(ends, F.when(F.isnan(part) | (F.abs("lo") == float("inf")) | (F.abs("hi") == float("inf")), 1), F.least(F.floor(part), F.lit(BINS - 1)))
    counts = _in_slices(rows, slices).groupBy("g", "lo", "first", "ranks", bin_.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("hi")
    )
    before = Window.partitionBy("g", "lo").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("first") + F.coalesce(F.sum("n").over(before), F.lit(0))
    placed = counts.withColumn("first", start)
    ranks = F.filter("ranks", lambda r: (r >= F.col("first")) & (r < F.col("first") + F.col("n")))
    return placed.select("g", F.col("least").alias("lo"), "hi", "first", "n", ranks.alias("ranks")).filter(F.size("ranks") > 0)


def exact_quantiles(df: DataFrame, group: str, value: str, probabilities: Sequence[float], rank_rows: int = RANK_ROWS) -> DataFrame:
    """(group, n_rows, min_value, max_value, quantiles): linear interpolation between the two nearest ranks.

    Nulls and NaN do not count; groups with nothing else have no row. A null group is a group. Each round
    reads the rows once and shuffles counts only, at most BINS a slice; there are at most two slices a
    probability and group. What is ranked at the end are at most rank_rows rows a slice.
    """
    rows = _numbers(df, group, value)
    position = lambda p: F.lit(float(p)) * (F.col("n") - 1)
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(position(p)), F.ceil(position(p))) for p in probabilities])))
    stats = written(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")), "quantile-groups")
    slices = stats.select("g", "lo", "hi", F.lit(0).cast("long").alias("first"), "n", ranks.alias("ranks"))
    large = (F.col("n") > rank_rows) & (F.col("lo") < F.col("hi"))
    while slices.filter(large).limit(1).count():
        slices = written(slices.filter(~large).unionByName(_cut(rows, slices.filter(large))), "quantile-slices")

    single = slices.filter("lo = hi").select("g", F.explode("ranks").alias("rank"), F.col("lo").alias("v"))
    place = F.row_number().over(Window.partitionBy("g", "lo").orderBy("v")) - 1 + F.col("first")
    ranked = _in_slices(rows, slices.filter("lo < hi")).withColumn("rank", place).filter(F.array_contains("ranks", F.col("rank")))
    found = single.unionByName(ranked.select("g", "rank", "v")).groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))

    def quantile(p: float):
        low, high = F.floor(position(p)), F.ceil(position(p))
        between = (high - position(p)) * F.element_at("at", low) + (position(p) - low) * F.element_at("at", high)
        return F.when(low == high, F.element_at("at", low)).otherwise(between)

    known = stats.withColumnRenamed("g", "of").join(found, F.col("of").eqNullSafe(F.col("g")))
    return known.select(
        F.col("of").alias(group), F.col("n").alias("n_rows"), F.col("lo").alias("min_value"), F.col("hi").alias("max_value"),
        F.array(*[quantile(p) for p in probabilities]).alias("quantiles"),
    )


def box_of_values(df: DataFrame, group: str, value: str, rank_rows: int = RANK_ROWS) -> DataFrame:
    """Quartiles, whiskers and median notch per group, as ``distribution.box_summary``, of any numbers."""
    box = exact_quantiles(df, group, value, (0.25, 0.5, 0.75), rank_rows)
    box = box.select(F.col(group).alias("of"), "n_rows", "min_value", "max_value", *[F.col("quantiles")[i].alias(c) for i, c in enumerate(("q1", "median", "q3"))])
    box = written(box, "boxes")
    reach = (F.col("q3") - F.col("q1")) * WHISKER
    is_inside = F.col("v").between(F.col("q1") - reach, F.col("q3") + reach)
    rows = _numbers(df, group, value).join(sent_if_few(box, BROADCAST_SLICES), F.col("g").eqNullSafe(F.col("of")))
    ends = rows.filter(is_inside).groupBy("g").agg(F.min("v").alias("lower_whisker"), F.max("v").alias("upper_whisker"))
    notch = (F.col("q3") - F.col("q1")) * NOTCH / F.sqrt(F.col("n_rows").cast("double"))
    return box.join(ends, F.col("of").eqNullSafe(F.col("g"))).select(
        F.col("of").alias(group), "n_rows", "min_value", "lower_whisker", "q1", "median", "q3", "upper_whisker", "max_value",
        rounded(F.col("median") - notch, 4).alias("notch_low"), rounded(F.col("median") + notch, 4).alias("notch_high"),
    )
