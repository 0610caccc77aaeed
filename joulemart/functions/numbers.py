"""Exact sums, safe ratios and surrogate keys.

Averages are built from integer or decimal sums and one final division, so a
result does not depend on how rows were partitioned or in which order partial
aggregates were merged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from joulemart import constants as K


def surrogate_key(*columns: Column) -> Column:
    """md5 hex of the columns' text; NULLs hash as a fixed text."""
    parts = [F.coalesce(c.cast("string"), F.lit(K.NULL_KEY_TEXT)) for c in columns]
    return F.md5(parts[0] if len(parts) == 1 else F.concat_ws("-", *parts))


def mean_of(total: Column, count: Column) -> Column:
    """``total / count`` in double; NULL when nothing was counted."""
    return total.cast("double") / F.nullif(count, F.lit(0)).cast("double")


def exact_mean(value: Column) -> Column:
    """Average of an integer or decimal column as double."""
    return mean_of(F.sum(value), F.count(value))


def exact_mean_of_rounded(value: Column, digits: int) -> Column:
    """Average of doubles that carry at most ``digits`` decimals."""
    return exact_mean(value.cast(f"decimal(20,{digits})"))


def rounded(value: Column, digits: int) -> Column:
    """Round a double half away from zero, judging ties on its decimal value.

    A quotient such as 164.1 / 6 is 27.35 on paper but a hair below it in
    binary; it rounds up here.
    """
    return F.round(value.cast("decimal(28,10)"), digits).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """Double division; NULL instead of an error on zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def clamp_unit(value: Column, low: float, high: float) -> Column:
    """Position of a value on a scale, clamped to 0..1."""
    position = (value - F.lit(low)) / F.lit(high - low)
    # least() and greatest() skip NULLs, so a missing value is kept missing here.
    return F.when(value.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), position)))
