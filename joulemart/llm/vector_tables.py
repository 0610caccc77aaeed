"""Vectors as distinct classes dealt to shards, for the graph operators."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joulemart.llm.components import written

#: Distinct vectors that one graph holds, and the least number of graphs.
SHARD_VECTORS = 100_000
LEAST_SHARDS = 8
#: Queries that meet one graph in one task.
SLICE_QUERIES = 50_000


def is_usable(vector: str) -> Column:
    """Whether a vector is not null or zero and has only finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_classes(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Distinct usable vectors, written once: cid, vec (array<float>), size, least (smallest key), shard."""
    good = vectors.filter(is_usable(vector)).select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<float>").alias("vec"))
    classes = good.groupBy("vec").agg(F.count("vec").alias("size"), F.min("key").alias("least"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("cid"), "vec", "size", "least"), "vector-classes")
    check_lengths(classes, "vec")
    return classes


def check_lengths(vectors: DataFrame, vector: str, length: int | None = None) -> int | None:
    """The length of all vectors, or of those given before; an error if they differ."""
    short, long = vectors.agg(F.min(F.size(vector)), F.max(F.size(vector))).first()
    if short != long or (length is not None and short is not None and short != length):
        raise ValueError(f"vectors of {short} to {long} components" + (f", others of {length}" if length is not None else ""))
    return short if length is None else length


def shard_count(classes: DataFrame) -> int:
    return max(LEAST_SHARDS, math.ceil(classes.count() / SHARD_VECTORS))


def with_shard(classes: DataFrame, shards: int) -> DataFrame:
    return classes.withColumn("shard", F.pmod(F.xxhash64("cid"), F.lit(shards)).cast("int"))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long float lists as rows of a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float32).reshape(len(column), -1)


def met_by_all(graphs: DataFrame, queries: DataFrame, shards: int, n_queries: int) -> tuple[DataFrame, DataFrame]:
    """Both sides keyed by (shard, slice), so that every slice of queries meets every graph."""
    slices = max(1, math.ceil(n_queries / SLICE_QUERIES))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = graphs.withColumn("slice", numbers(slices))
    right = queries.withColumn("slice", F.pmod(F.xxhash64("qid"), F.lit(slices)).cast("int")).withColumn("shard", numbers(shards))
    return left, right
