"""Top-k reports and prefix maxima."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from joulemart.functions.numbers import rounded
from joulemart.session import written


def head_and_tail(df: DataFrame, order: list[str], k: int, names: tuple[str, str]) -> DataFrame:
    """First and last ``k`` rows of an ascending order, NULLs last.

    Both ends carry ``side`` (one of ``names``) and a 1-based ``position`` in
    ascending order. Only 2k rows reach the position window.
    """
    up = [F.asc_nulls_last(c) for c in order]
    down = [F.desc_nulls_first(c) for c in order]
    head = df.orderBy(*up).limit(k).withColumn("side", F.lit(names[0]))
    tail = df.orderBy(*down).limit(k).withColumn("side", F.lit(names[1]))
    position = F.row_number().over(Window.partitionBy("side").orderBy(*up))
    return head.unionByName(tail).withColumn("position", position)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of an order: per-partition heaps, one small merge."""
    return df.orderBy(*order).limit(k)


def first_last_delta(value: str, key: str, digits: int) -> Column:
    """Aggregate: value at the greatest key minus value at the least key."""
    return rounded(F.max_by(value, key) - F.min_by(value, key), digits)


#: Up to so many order values, a running maximum is one sorted pass.
PASS_ROWS = 100_000
#: Up to so many ranges, what came before each is sent to every task.
BROADCAST_RANGES = 100_000


def running_max(df: DataFrame, order: str, value: str, out: str, pass_rows: int = PASS_ROWS) -> DataFrame:
    """Greatest value so far along an order, one row per order value (null first).

    Rows are first reduced to one maximum per order value, with map-side combining. Up to pass_rows of
    those are one window. More are dealt out by ranges of the order: every range has its own running
    maximum, and what came before it is the greatest maximum of the ranges before, one number a range.
    """
    peaks = written(df.groupBy(order).agg(F.max(value).alias(value)), "peaks")
    so_far = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if peaks.limit(pass_rows + 1).count() <= pass_rows:
        return peaks.withColumn(out, F.max(value).over(so_far))
    dealt = written(peaks.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "ranges")
    tops = sorted((r["_range"], r["top"]) for r in dealt.groupBy("_range").agg(F.max(value).alias("top")).collect())  # one row a task
    before, rows = None, []
    for number, top in tops:
        rows.append((number, before))
        before = top if before is None or (top is not None and top > before) else before
    kind = dict(dealt.dtypes)[value]
    earlier = df.sparkSession.createDataFrame(rows, f"_range int, _before {kind}")
    within = F.max(value).over(Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = dealt.withColumn("_within", within).join(F.broadcast(earlier) if len(rows) <= BROADCAST_RANGES else earlier, "_range")
    return joined.select(order, value, F.greatest("_within", "_before").alias(out))
