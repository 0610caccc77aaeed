"""Connected components of links between numbered nodes, by repeated contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joulemart.session import new_work_dir


#: So many links one task resolves; with more, rounds of joins come first.
FINISH_LINKS = 2_000_000


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, from a table in the shared work folder: computed once, whatever is lost later."""
    folder = new_work_dir(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All nodes of the links of one task with the smallest node each is connected with."""
    parts = [np.stack([np.asarray(b.column(0), np.int64), np.asarray(b.column(1), np.int64)]) for b in batches if b.num_rows]
    if not parts:
        return
    nodes, ends = np.unique(np.concatenate(parts, 1), return_inverse=True)
    a, b = ends.reshape(2, -1)
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            break
        # What a node's label pointed at moves with it.
        np.minimum.at(label, np.concatenate([label[a], label[b]]), np.concatenate([low, low]))
        np.minimum.at(label, np.concatenate([a, b]), np.concatenate([low, low]))
        label = label[label]
    yield pa.RecordBatch.from_pydict({"node": nodes, "component": nodes[label]})


def connected_components(links: DataFrame, a: str = "a", b: str = "b", finish_links: int = FINISH_LINKS) -> DataFrame:
    """(node, component): the smallest node reachable from each node that has a link to another one.

    While more than finish_links links are left, a round points each node at its smallest neighbour, follows
    the pointers twice, and goes on with the links between what they point at; at least half of the nodes
    that have links are gone after a round. The last links, of which the number is bounded, are resolved
    by one task. Null ends, loops and repeated links count for nothing; without links there are no rows.
    """
    ends = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).filter("a <> b")
    edges = written(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    labels = None
    while edges.count() > finish_links:
        both = edges.union(edges.select("b", "a"))
        parents = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("n"), F.least("a", "b").alias("p"))
        parents = written(parents, "parents")
        for _ in range(2):
            above = parents.select(F.col("n").alias("p"), F.col("p").alias("pp"))
            parents = parents.join(above, "p").select("n", F.col("pp").alias("p"))
        parents = written(parents, "parents")
        if labels is None:
            labels = parents.select(F.col("n").alias("node"), F.col("p").alias("component"))
        else:
            labels = written(_moved(labels, parents.withColumnsRenamed({"n": "node", "p": "to"})), "labels")
        of_a = parents.select(F.col("n").alias("a"), F.col("p").alias("pa"))
        of_b = parents.select(F.col("n").alias("b"), F.col("p").alias("pb"))
        between = edges.join(of_a, "a").join(of_b, "b").filter("pa <> pb")
        edges = written(between.select(F.greatest("pa", "pb").alias("a"), F.least("pa", "pb").alias("b")).distinct(), "edges")
    last = written(edges.coalesce(1).mapInArrow(_labels, "node bigint, component bigint"), "last-components")
    return last if labels is None else written(_moved(labels, last.withColumnRenamed("component", "to")), "labels")


def _moved(labels: DataFrame, to: DataFrame) -> DataFrame:
    """Labels after what they name has moved, where it has, by (node, to) rows."""
    to = to.select(F.col("node").alias("component"), "to")
    return labels.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
