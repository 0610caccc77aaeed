"""Approximate nearest neighbours by robust-pruned directed graphs, one a shard.

Greedy searches from fixed start nodes propose neighbours for every node; relaxed distance pruning keeps
diverse ones. A query's beam runs over the graph of every shard, and what it ends with is ranked by cosine
in double precision. In every shard, sampled queries of each slice are held against a scan: the beam widens
until it finds enough of their neighbours.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from joulemart.llm import graphs as g
from joulemart.llm.components import written
from joulemart.llm.vector_tables import check_lengths, is_usable, matrix, met_by_all, shard_count, vector_classes, with_shard

DEGREE = 36
BUILD_WIDTH = 64
SEARCH_WIDTH = 96
SLACK = 1.2
STARTS = 8
#: Queries of a slice that a shard's beam is audited with, the share of their neighbours it must find, and the
#: widest beam; where that finds less, the shard is scanned.
AUDIT_QUERIES = 128
LEAST_RECALL = 0.98
WIDEST = 1024
#: Similarities that a scan holds at a time.
SCAN_CELLS = 1 << 24


def build_graph(vectors: np.ndarray, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Edges (nodes x DEGREE, -1 for none) and start nodes of a graph over unit vectors."""
    n = len(vectors)
    edges = np.full((n, DEGREE), -1, np.int64)
    if not n:
        return edges, np.zeros(0, np.int64)
    order = np.random.default_rng(seed).permutation(n)
    # The node nearest the mean comes first, then the others at random.
    middle = int((vectors @ vectors.mean(0)).argmax())
    order = np.concatenate([[middle], order[order != middle]])
    starts = order[: min(STARTS, n)]
    for before, batch in g.insertion_batches(order):
        known = g.batch_candidates(vectors, batch, DEGREE)
        if len(before):
            entry = np.broadcast_to(starts[: min(len(starts), len(before))], (len(batch), min(len(starts), len(before))))
            found, _ = g.beam_search(vectors, edges, vectors[batch], entry, BUILD_WIDTH)
            known = np.concatenate([found, known], 1)
        g.link(vectors, edges, batch, known, SLACK)
    return edges, starts


def search_graph(vectors: np.ndarray, edges: np.ndarray, starts: np.ndarray, queries: np.ndarray, width: int = SEARCH_WIDTH) -> tuple[np.ndarray, np.ndarray]:
    entry = np.broadcast_to(starts, (len(queries), len(starts)))
    return g.beam_search(vectors, edges, queries, entry, width)


def scan(vectors: np.ndarray, queries: np.ndarray, k: int) -> list[np.ndarray]:
    """The k nodes most similar to each query, and all as similar as the last of them up to rounding."""
    out, step = [], max(1, SCAN_CELLS // max(1, len(vectors)))
    for low in range(0, len(queries), step):
        sims = queries[low : low + step] @ vectors.T
        least = np.partition(sims, -k, 1)[:, -k] if k < len(vectors) else np.full(len(sims), -np.inf)
        out += [np.flatnonzero(row >= edge - 1e-6) for row, edge in zip(sims, least)]
    return out


def audited_width(vectors: np.ndarray, edges: np.ndarray, starts: np.ndarray, queries: np.ndarray, k: int, width: int) -> int:
    """The smallest beam, from `width` on by doubling, that finds enough of what a scan finds for sampled queries;
    the number of nodes, which stands for a scan, if none does."""
    sample = queries[np.unique(np.linspace(0, len(queries) - 1, AUDIT_QUERIES).astype(int))]
    near = scan(vectors, sample, k)
    while width <= WIDEST and width < len(vectors):
        nodes, _ = search_graph(vectors, edges, starts, sample, width)
        found = sum(min(k, np.isin(known, row).sum()) for known, row in zip(near, nodes))
        if found >= LEAST_RECALL * min(k, len(vectors)) * len(sample):
            return width
        width *= 2
    return len(vectors)


def find(vectors: np.ndarray, edges: np.ndarray, starts: np.ndarray, queries: np.ndarray, k: int, width: int) -> list[np.ndarray]:
    """Nodes near each query: those of an audited beam, or of a scan where no beam passes the audit."""
    if not len(queries):
        return []
    width = audited_width(vectors, edges, starts, queries, k, width)
    if width >= len(vectors):
        return scan(vectors, queries, k)
    nodes, _ = search_graph(vectors, edges, starts, queries, width)
    return [row[row >= 0] for row in nodes]


def _build(group: pa.Table) -> pa.Table:
    raw = matrix(group.column("vec"))
    edges, starts = build_graph(g.unit_rows(raw))
    return pa.table({
        "shard": group.column("shard").slice(0, 1),
        "ids": [np.asarray(group.column("cid"), np.int64).tobytes()],
        "vectors": [raw.tobytes()],
        "edges": [edges.astype(np.int32).tobytes()],
        "starts": [starts.astype(np.int32).tobytes()],
    })


def _search(k: int, width: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        qids, cids, scores = [], [], []
        if len(left) and len(right):
            row = left.slice(0, 1).to_pylist()[0]
            ids = np.frombuffer(row["ids"], np.int64)
            raw = np.frombuffer(row["vectors"], np.float32).reshape(len(ids), -1)
            edges = np.frombuffer(row["edges"], np.int32).reshape(len(ids), -1).astype(np.int64)
            vectors = matrix(right.column("vec"))
            nodes = find(g.unit_rows(raw), edges, np.frombuffer(row["starts"], np.int32), g.unit_rows(vectors), k, max(width, 2 * k))
            wide, queries = raw.astype(np.float64), vectors.astype(np.float64)
            lengths = np.sqrt((wide * wide).sum(1))
            for i, qid in enumerate(np.asarray(right.column("qid"), np.int64)):
                found = nodes[i]
                exact = (wide[found] @ queries[i]) / (lengths[found] * np.sqrt(queries[i] @ queries[i]))
                # Ties at the last place all go on; keys decide between them later.
                if len(found) > k:
                    inside = exact >= np.partition(exact, -k)[-k]
                    found, exact = found[inside], exact[inside]
                qids.append(np.full(len(found), qid))
                cids.append(ids[found])
                scores.append(exact)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pa.table({"qid": join(qids, np.int64), "cid": join(cids, np.int64), "score": join(scores, np.float64)})

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, width: int = SEARCH_WIDTH, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k rows of `vectors` most similar to each query row, but for rows with the query's own key.

    Gives query_id, rank (int, from 1), key and score (cosine in double precision of the original vectors),
    ties to the smaller key; all rows found, if fewer than k. Vectors that are null, zero or hold null or
    non-finite components take no part, on either side, nor do null keys. Equal vectors are one node of a
    graph, and the k + 1 smallest keys of each stand for it. Rows that repeat a query's key ask once. All
    usable vectors must have the same length (ValueError). Empty tables give no rows.
    """
    vectors, queries = vectors.filter(F.col(key).isNotNull()), queries.filter(F.col(key).isNotNull())
    classes = vector_classes(vectors, key, vector)
    shards = shard_count(classes)
    built = with_shard(classes.select("cid", "vec"), shards).groupBy("shard").applyInArrow(
        _build, "shard int, ids binary, vectors binary, edges binary, starts binary"
    )
    asked = queries.filter(is_usable(vector)).select(F.col(key).cast("long").alias("qid"), F.col(vector).cast("array<float>").alias("vec"))
    asked = written(asked.dropDuplicates(["qid"]), "queries")
    check_lengths(asked, "vec", check_lengths(classes, "vec"))
    left, right = met_by_all(written(built, "graphs"), asked, shards, asked.count())
    found = left.groupBy("shard", "slice").cogroup(right.groupBy("shard", "slice")).applyInArrow(
        _search(k + 1, width), "qid bigint, cid bigint, score double"
    )
    members = vectors.filter(is_usable(vector)).select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<float>").alias("vec"))
    members = members.join(classes.select("cid", "vec"), "vec").select("cid", "key").distinct()
    members = members.withColumn("place", F.row_number().over(Window.partitionBy("cid").orderBy("key"))).filter(F.col("place") <= k + 1)
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "key")
    ranked = found.join(members.select("cid", "key"), "cid").filter("key <> qid").withColumn("rank", F.row_number().over(best))
    return ranked.filter(F.col("rank") <= k).select(F.col("qid").alias("query_id"), "rank", F.col("key").alias(key), "score")
