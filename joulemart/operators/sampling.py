"""Exact-size samples and stratified splits, reproducible by key.

A row's place in the sample order is the md5 of a seed and its key. The order
does not depend on partitioning, so a retried task draws the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(key: str, seed: int) -> Column:
    """Uniform sample order of a row: hex digits of a seeded hash."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def sample_exact(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` rows (all of them, if there are fewer), each equally likely.

    Rows are counted per leading hash digits (at most 65,536 counters), and the digits at which the
    first ``n`` rows end are found. Rows before them stay where they are; only the rows of that one
    counter are ordered, so that the result keeps the input's partitions.
    """
    digits = 4
    drawn = df.withColumn("_draw", draw(key, seed))
    lead = F.substring("_draw", 1, digits)
    counts = drawn.groupBy(lead.alias("lead")).agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.orderBy("lead"))
    ends = counts.withColumn("upto", upto).filter(F.col("upto") >= n)
    # NULL when the whole frame holds fewer than n rows: then all of them are before the cut.
    last = ends.agg(F.min(F.struct("lead", (F.lit(n) - F.col("upto") + F.col("c")).alias("take"))).alias("last"))
    cut, take = last.select("last.lead").scalar(), last.select("last.take").scalar()
    before = drawn.filter(lead < F.coalesce(cut, F.lit("g")))
    place = F.row_number().over(Window.partitionBy(lead).orderBy("_draw", key))
    edge = drawn.filter(lead == cut).withColumn("_place", place).filter(F.col("_place") <= take).drop("_place")
    return before.union(edge).drop("_draw")


def rank_in_stratum(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    """Add ``stratum_rank`` (0-based) and ``stratum_size``, without a window.

    A window per label would sort a third of all rows in one task if one band
    is that common. Labels are instead cut into hash slices: rows are ranked
    within (label, slice), and the slice's offset is the running count of the
    slices before it.
    """
    ranked = df.withColumn("_draw", draw(key, seed)).withColumn("_slice", F.substring("_draw", 1, 3))
    slices = ranked.groupBy(label, "_slice").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(label).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        F.col(label).alias("_label"),
        F.col("_slice").alias("_offset_slice"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(label)).alias("stratum_size"),
    )
    within = F.row_number().over(Window.partitionBy(label, "_slice").orderBy("_draw", key)) - 1
    same = F.col(label).eqNullSafe(F.col("_label")) & (F.col("_slice") == F.col("_offset_slice"))
    return (
        ranked.withColumn("_within", within)
        .join(offsets, same)
        .withColumn("stratum_rank", (F.col("_offset") + F.col("_within")).cast("bigint"))
        .drop("_draw", "_slice", "_n", "_within", "_label", "_offset_slice", "_offset")
    )


def stratified_split(df: DataFrame, label: str, key: str, test_share: float, seed: int) -> DataFrame:
    """Add ``is_test``: the same share of every label, to within one row."""
    ranked = rank_in_stratum(df, label, key, seed)
    n_test = F.round(F.col("stratum_size") * F.lit(test_share), 0)
    return ranked.withColumn("is_test", F.col("stratum_rank") < n_test).drop("stratum_rank", "stratum_size")


def stratified_subset(df: DataFrame, label: str, key: str, share: float, seed: int) -> DataFrame:
    """The same share of every label."""
    return stratified_split(df, label, key, share, seed).filter("is_test").drop("is_test")


def stratified_exact(df: DataFrame, label: str, key: str, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer), shared out over the labels in proportion.

    A label gets the whole part of its share; what is then left goes to the labels with the largest
    fractions, one row each, ties to the smaller label. Quotas are one row per label and meet the rows as
    one map value, so that no label's rows are gathered.
    """
    counts = df.groupBy(label).agg(F.count("*").alias("size"))
    rows = counts.agg(F.sum("size")).scalar()
    shares = counts.withColumn("all", rows).withColumn("n", F.least(F.lit(n), F.col("all")))
    shares = shares.select(label, F.expr("size * n div all").alias("base"), (F.col("size") * F.col("n") % F.col("all")).alias("rest"), "n")
    place = F.row_number().over(Window.orderBy(F.desc("rest"), label))
    left = F.col("n") - F.sum("base").over(Window.partitionBy("n"))
    quotas = shares.select(label, (F.col("base") + (place <= left).cast("bigint")).alias("quota"))
    by_label = quotas.agg(F.map_from_entries(F.collect_list(F.struct(F.coalesce(F.col(label).cast("string"), F.lit("")), "quota")))).scalar()
    ranked = rank_in_stratum(df, label, key, seed).withColumn("_quota", F.element_at(by_label, F.coalesce(F.col(label).cast("string"), F.lit(""))))
    return ranked.filter(F.col("stratum_rank") < F.col("_quota")).drop("_quota", "stratum_rank", "stratum_size")


def stratified_folds(df: DataFrame, label: str, key: str, k: int, seed: int) -> DataFrame:
    """Add ``fold`` (0..k-1), balanced within every label."""
    ranked = rank_in_stratum(df, label, key, seed)
    return ranked.withColumn("fold", (F.col("stratum_rank") % k).cast("int")).drop("stratum_rank", "stratum_size")
