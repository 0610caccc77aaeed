"""Box-plot summaries and binned densities.

Both start from counts per (group, value) or per bin. The number of those is
bounded by the value grid, not by the rows, so no group is ever gathered whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joulemart.functions.numbers import rounded

WHISKER = 1.5  # inter-quartile ranges a whisker may span
NOTCH = 1.57  # width factor of the median's confidence interval


def value_counts(df: DataFrame, group: str, value: str, weight: str | None = None) -> DataFrame:
    """Rows ``(group, value, n)``; ``weight`` sums counts instead of rows."""
    n = F.count("*") if weight is None else F.sum(weight)
    return df.groupBy(group, value).agg(n.alias("n"))


def box_summary(counts: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, whiskers and median notch per group, from ``value_counts``.

    ``value`` must come from a bounded grid (two-decimal tonnes, whole
    points): a group is held as one counter per distinct value.
    """
    number = F.col(value).cast("double")
    quartiles = F.percentile(number, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n"))
    box = counts.groupBy(group).agg(quartiles.alias("q"), F.sum("n").alias("n_rows"))
    box = box.select(F.col(group).alias("_group"), "n_rows", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    reach = (F.col("q3") - F.col("q1")) * WHISKER
    inside = F.when((number >= F.col("q1") - reach) & (number <= F.col("q3") + reach), number)
    # The counters meet their group's quartiles again: no group's values are gathered.
    box = (
        counts.join(box, F.col(group).eqNullSafe(F.col("_group")))
        .groupBy(group, "n_rows", "q1", "median", "q3")
        .agg(
            F.min(number).alias("min_value"), F.min(inside).alias("lower_whisker"),
            F.max(inside).alias("upper_whisker"), F.max(number).alias("max_value"),
        )
    )
    notch = (F.col("q3") - F.col("q1")) * NOTCH / F.sqrt(F.col("n_rows").cast("double"))
    return box.select(
        group, "n_rows", "min_value", "lower_whisker", "q1", "median", "q3", "upper_whisker", "max_value",
        rounded(F.col("median") - notch, 4).alias("notch_low"),
        rounded(F.col("median") + notch, 4).alias("notch_high"),
    )


def bin_of(value: Column, low: float, width: float) -> Column:
    """0-based bin number of an equal-width grid."""
    return F.floor((value.cast("double") - F.lit(low)) / F.lit(width)).cast("int")


def histogram_2d(df: DataFrame, group: str, x_bin: Column, y_bin: Column, weight: str | None = None) -> DataFrame:
    n = F.count("*") if weight is None else F.sum(weight)
    return df.groupBy(group, x_bin.alias("x_bin"), y_bin.alias("y_bin")).agg(n.alias("n"))


def marginals(density: DataFrame, group: str) -> DataFrame:
    """Both one-axis histograms of a ``histogram_2d`` result."""
    axes = [
        density.groupBy(group, F.col(f"{axis}_bin").alias("bin")).agg(F.sum("n").alias("n"))
        .withColumn("axis", F.lit(axis))
        for axis in ("x", "y")
    ]
    return axes[0].unionByName(axes[1])
