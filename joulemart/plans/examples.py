"""The two starter models: literal rows, and a filter on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def example_first(spark: SparkSession) -> DataFrame:
    """The id 1 and a missing id, as a bag union of two literal rows."""
    one = spark.range(1).select(F.lit(1).alias("id"))
    missing = spark.range(1).select(F.lit(None).cast("int").alias("id"))
    return one.unionAll(missing)


def example_second(spark: SparkSession) -> DataFrame:
    return example_first(spark).filter(F.col("id") == 1)
