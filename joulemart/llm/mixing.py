"""Mix sources to target weights by Poisson replication, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A Poisson rate is split into parts of at most this size, so that exp(-rate) never underflows.
PART_RATE = 256.0
#: Up to so many sources the table of rates is sent to every task; with more, it is joined by salted keys.
BROADCAST_SOURCES = 10_000
SALTS = 64
_HEX_DIGITS = 13  # 52 bits, exact in a double


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the given values alone."""
    digits = F.substring(F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])), 1, _HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << (4 * _HEX_DIGITS)))


def poisson_cdf(rate: Column) -> Column:
    """Distribution function of a Poisson variable at 0, 1, 2, ... up to far in its tail."""
    last = F.ceil(rate + 10 * F.sqrt(rate) + 20).cast("int")
    first = F.exp(-rate)
    return F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(first.alias("p"), F.array(first).alias("cdf")),
        lambda acc, j: F.struct(
            (acc["p"] * rate / j).alias("p"),
            F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + acc["p"] * rate / j)).alias("cdf"),
        ),
        lambda acc: acc["cdf"],
    )


def source_rates(
    docs: DataFrame, source: str, weights: dict[str | None, float] | None, total: int | None, exponent: float
) -> DataFrame:
    """Mean number of copies of a document of each source, as (source, parts, cdf of a part)."""
    counts = docs.groupBy(F.col(source).alias("__source")).agg(F.count(F.lit(1)).cast("double").alias("__n"))
    if weights is None:
        weighted = counts.withColumn("__w", F.pow("__n", F.lit(exponent)))
    else:
        given = docs.sparkSession.createDataFrame(
            [(k, float(w)) for k, w in weights.items()], "__name string, __w double"
        )
        weighted = counts.join(F.broadcast(given), F.col("__source").cast("string").eqNullSafe(F.col("__name")), "left")
        weighted = weighted.select("__source", "__n", F.coalesce("__w", F.lit(0.0)).alias("__w"))
    sums = weighted.agg(F.sum("__n").alias("n"), F.sum("__w").alias("w"))
    whole = F.lit(float(total)) if total is not None else sums.select("n").scalar()
    rate = F.when(F.col("__w") > 0, F.col("__w") / sums.select("w").scalar() * whole / F.col("__n")).otherwise(0.0)
    parts = F.greatest(F.lit(1), F.ceil(rate / PART_RATE).cast("int"))
    return (
        weighted.select("__source", rate.alias("__rate"), parts.alias("__parts"))
        .select("__source", "__rate", "__parts", poisson_cdf(F.col("__rate") / F.col("__parts")).alias("__cdf"))
    )


def poisson_mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    total: int | None = None,
    exponent: float = 0.5,
    seed: int = 42,
    source: str = "source",
    key: str = "doc_id",
) -> DataFrame:
    """Repeat documents so that sources get their share of the output, and shuffle the copies.

    A source's share is its weight over the sum of weights of the sources present; without weights, a
    source of n documents weighs n ** exponent. A document of a source is repeated on average
    share * total / n times; the number itself inverts the Poisson distribution of that mean at a hash
    of seed and key, so that a run can be repeated anywhere. `total` is the number of rows of docs
    unless given.

    Adds copy_no (long, from 1) and shuffle_key (string); columns of docs with these names are replaced.
    Rows are dealt out by shuffle_key and sorted by it within a partition. A null source is a source
    like any other (weights may hold None); a source without weight has none. Rows with equal keys,
    null keys among them, have the same number of copies. An empty table stays empty.
    """
    rates = source_rates(docs, source, weights, total, exponent)
    rates = rates.filter("__rate > 0")
    same_source = F.col(source).eqNullSafe(F.col("__source"))
    if rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rated = docs.join(F.broadcast(rates), same_source)
    else:
        salted = rates.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rated = docs.withColumn("__row_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")).join(
            salted, same_source & (F.col("__row_salt") == F.col("__salt"))
        )
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col("__parts")),
        F.lit(0),
        lambda n, part: n + F.size(F.filter("__cdf", lambda c: c <= uniform(F.lit(seed), part, F.col(key)))),
    )
    kept = [c for c in docs.columns if c not in ("copy_no", "shuffle_key")]
    copies = (
        rated.withColumn("__copies", drawn)
        .filter("__copies > 0")
        .select(*kept, F.explode(F.sequence(F.lit(1), F.col("__copies")).cast("array<bigint>")).alias("copy_no"))
    )
    order = F.md5(F.concat_ws(":", F.lit(f"{seed}s"), F.coalesce(F.col(key).cast("string"), F.lit("null")), "copy_no"))
    return copies.withColumn("shuffle_key", order).repartition("shuffle_key").sortWithinPartitions("shuffle_key")
