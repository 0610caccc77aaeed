"""Places of rows in the order of their group, whatever the size of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from joulemart.llm.components import written


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows with place (long, from 0, by order in their group) and total (long, rows of the group).

    Rows are dealt out by ranges of group and order, sorted, and written with their number in the task; a
    group that goes over several tasks starts in each where it ended in the one before. So no task holds
    a whole group. Nulls come first; rows equal in group and order follow in any order, and may be dealt to
    several tasks. Written once, so that a lost executor changes no number.
    """
    salted = rows.withColumn("__row", F.monotonically_increasing_id())
    keys = [group, *order, "__row"]
    dealt = salted.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__row")
    table = written(dealt.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    table = table.withColumn("__part", F.shiftright("__at", 33))
    pieces = table.groupBy(F.col(group).alias("__group"), F.col("__part").alias("__piece")).agg(
        F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    # As many rows a group as tasks that have some of it.
    whole = Window.partitionBy("__group")
    before = F.sum("__n").over(whole.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select("__group", "__piece", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"), F.sum("__n").over(whole).alias("total"))
    placed = table.join(pieces, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__part") == F.col("__piece")))
    return placed.select(*rows.columns, (F.col("__at") + F.col("__shift")).alias("place"), "total")
