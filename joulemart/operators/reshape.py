"""Long to wide with a fixed column list."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_name(label: str) -> str:
    """``"Pre-1900"`` -> ``"pre_1900"``."""
    return re.sub(r"[^a-z0-9]+", "_", label.lower()).strip("_")


def pivot_fill(df: DataFrame, index: str, on: str, values: dict[str, str], labels: tuple[str, ...]) -> DataFrame:
    """One row per ``index``, one column per value and label, 0 where there is no row.

    ``values`` maps a column-name prefix to a value column; several are
    pivoted in one pass. The labels are given, so the result's columns do not
    depend on the data and no extra pass looks for them. A row whose ``on`` is none of the labels fails
    the query: no value is left out of the result in silence. Filter first where that is wanted.
    """
    listed = F.coalesce(F.col(on).isin(*labels), F.lit(False))
    told = F.concat(F.lit(f"{on} is none of the pivoted labels: "), F.coalesce(F.col(on).cast("string"), F.lit("NULL")))
    df = df.withColumn(on, F.when(listed, F.col(on)).otherwise(F.raise_error(told)))
    firsts = [F.first(column).alias(column) for column in values.values()]
    wide = df.groupBy(index).pivot(on, list(labels)).agg(*firsts)
    # Spark names a pivoted column by its label, plus the value if there are several.
    source = "{label}" if len(values) == 1 else "{label}_{column}"
    names = {
        source.format(label=label, column=column): prefix + column_name(label)
        for prefix, column in values.items()
        for label in labels
    }
    filled = wide.na.fill(0, list(names))
    return filled.select(index, *[F.col(f"`{old}`").alias(new) for old, new in names.items()])
