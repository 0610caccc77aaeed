"""Shares of totals over already aggregated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from joulemart.functions.numbers import ratio, rounded


def share_of_total(value: Column, digits: int | None = None) -> Column:
    """Percent of the whole frame's total.

    The window has one partition: apply it to a frame with a handful of rows,
    such as counts per rating band.
    """
    share = value.cast("double") * 100 / F.sum(value).over(Window.partitionBy())
    return share if digits is None else rounded(share, digits)


def share_of_group(value: Column, group: str, digits: int | None = None) -> Column:
    """Percent of the group's total; 0 for a group that sums to nothing."""
    total = F.sum(value).over(Window.partitionBy(group))
    share = F.coalesce(ratio(value, total) * 100, F.lit(0.0))
    return share if digits is None else rounded(share, digits)


def with_total(df: DataFrame, total: Column, name: str) -> DataFrame:
    """Attach one global aggregate to every row, as a scalar subquery.

    Unlike a window without partitions this keeps the rows distributed, and
    unlike a cross join it cannot multiply them.
    """
    return df.withColumn(name, df.agg(total.alias(name)).scalar())
