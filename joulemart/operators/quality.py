"""Declarative data checks that run as Spark aggregates.

Result: one row per check, ``(check, column, n_failed, n_rows, passed)``. All
row-level checks of a frame share one pass; only uniqueness needs a grouping.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RowCheck:
    """A check that one aggregate decides: failures, and whether they matter."""

    name: str
    column: str
    n_failed: Column
    passed: Column | None = None  # no failures at all, unless stated


@dataclass(frozen=True)
class UniqueCheck:
    """Every combination of the columns occurs once; NULL keys are ignored."""

    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return "unique" if len(self.columns) == 1 else "unique_combination"


def not_null(column: str) -> RowCheck:
    return RowCheck("not_null", column, F.count_if(F.col(column).isNull()))


def accepted_values(column: str, values: tuple[str, ...]) -> RowCheck:
    """NULL is not a value, so it does not fail."""
    return RowCheck("accepted_values", column, F.count_if(~F.col(column).isin(*values)))


def accepted_range(column: str, low: float, high: float) -> RowCheck:
    return RowCheck("accepted_range", column, F.count_if(~F.col(column).between(low, high)))


def row_predicate(name: str, column: str, violates: Column) -> RowCheck:
    """Rows for which ``violates`` holds are failures."""
    return RowCheck(name, column, F.count_if(violates))


def not_null_proportion(column: str, at_least: float) -> RowCheck:
    missing = F.count_if(F.col(column).isNull())
    enough = F.count(column) >= F.count(F.lit(1)) * F.lit(at_least)
    return RowCheck("not_null_proportion", column, missing, enough)


def recency(column: str, as_of: str, days: int) -> RowCheck:
    """The newest date lies within ``days`` before a stated day."""
    fresh = F.coalesce(F.max(column) >= F.date_sub(F.lit(as_of).cast("date"), days), F.lit(False))
    return RowCheck("recency", column, F.when(fresh, 0).otherwise(1).cast("bigint"), fresh)


def unique(*columns: str) -> UniqueCheck:
    return UniqueCheck(columns)


def run_checks(df: DataFrame, checks: list[RowCheck | UniqueCheck]) -> DataFrame:
    """Run the checks; nothing is computed before the result is read."""
    results = []
    row_checks = [c for c in checks if isinstance(c, RowCheck)]
    if row_checks:
        structs = [
            F.struct(
                F.lit(c.name).alias("check"),
                F.lit(c.column).alias("column"),
                c.n_failed.cast("bigint").alias("n_failed"),
                F.count(F.lit(1)).alias("n_rows"),
                (c.n_failed == 0 if c.passed is None else c.passed).alias("passed"),
            )
            for c in row_checks
        ]
        results.append(df.agg(F.array(*structs).alias("checks")).select(F.inline("checks")))
    for check in checks:
        if isinstance(check, UniqueCheck):
            results.append(_check_unique(df, check))
    return reduce(DataFrame.unionByName, results)


def _check_unique(df: DataFrame, check: UniqueCheck) -> DataFrame:
    """Failures are keys that occur more than once."""
    keyed = df.na.drop(subset=list(check.columns))
    counts = keyed.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count_if(F.col("n") > 1).alias("n_failed"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
    ).select(
        F.lit(check.name).alias("check"),
        F.lit(",".join(check.columns)).alias("column"),
        "n_failed",
        "n_rows",
        (F.col("n_failed") == 0).alias("passed"),
    )
