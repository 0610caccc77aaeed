"""Near-duplicate vectors by hierarchical navigable small-world graphs, one a shard.

Every vector searches the graph of every shard. Where a slice of vectors meets a graph, the beam is widened
until an audit against brute force passes, query by query; a query's beam is widened as long as it is full of
near vectors. Where the widest beam does not do, and for nodes that no links lead to, the shard is scanned.
Pairs are verified in double precision.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joulemart.llm import graphs as g
from joulemart.llm.components import connected_components, written
from joulemart.llm.vector_tables import is_usable, matrix, met_by_all, shard_count, vector_classes, with_shard

DEGREE = 16
BUILD_WIDTH = 48
FIRST_WIDTH = 32
#: Beams that would be wider are scans of the shard.
WIDEST = 512
#: Queries of each kind in an audit, and those looked through for some that have partners.
AUDIT_QUERIES = 128
AUDIT_POOL = 1_024
#: Mean over the queries, and over those with few partners.
AUDIT_RECALL = 0.999
FEW_PARTNERS = 16
#: Similarities that a scan has at a time, and queries whose finds are held at a time.
SCAN_CELLS = 1 << 24
HELD_QUERIES = 512


class LayeredGraph:
    """A hierarchy of graphs over unit vectors; each layer has a sixteenth of the nodes of the one below."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray], top: int):
        self.vectors, self.layers, self.top = vectors, layers, top

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 5) -> LayeredGraph:
        random = np.random.default_rng(seed)
        n = len(vectors)
        level = np.minimum(-np.log(1 - random.random(n)) / np.log(DEGREE), 4).astype(int)
        layers = [np.full((n, DEGREE * (2 if i == 0 else 1)), -1, np.int64) for i in range(int(level.max(initial=0)) + 1)]
        graph = cls(vectors, layers, -1)
        # The nodes of the highest layer come first, so that every later one has a way down.
        order = np.argsort(-level, kind="stable")
        graph.top = int(order[0]) if n else -1
        for before, batch in g.insertion_batches(order):
            entry = np.full((len(batch), 1), graph.top)
            for i in range(len(layers) - 1, -1, -1):
                member = level[batch] >= i
                if len(before):
                    width = BUILD_WIDTH if member.any() else 1
                    found, _ = g.beam_search(vectors, layers[i], vectors[batch], entry, width)
                    entry = found[:, :4]
                else:
                    found = np.full((len(batch), 1), -1)
                if member.any():
                    points = batch[member]
                    fellows = g.batch_candidates(vectors, points, DEGREE)
                    known = np.concatenate([found[member], fellows], 1)
                    g.link(vectors, layers[i], points, known, 1.0, fill=True)
        return graph

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        entry = np.full((len(queries), 1), self.top)
        for edges in self.layers[:0:-1]:
            entry, _ = g.beam_search(self.vectors, edges, queries, entry, 4)
        return g.beam_search(self.vectors, self.layers[0], queries, entry, width)

    @functools.cached_property
    def strays(self) -> np.ndarray:
        """Nodes that no path over links of the lowest layer reaches from the top node."""
        seen = np.zeros(len(self.vectors), bool)
        front = np.array([self.top] if self.top >= 0 else [], np.int64)
        while len(front):
            seen[front] = True
            ahead = np.unique(self.layers[0][front])
            front = ahead[(ahead >= 0) & ~seen[ahead]]
        return np.flatnonzero(~seen)

    def scan(self, queries: np.ndarray, cosine: float, among: np.ndarray | None = None) -> list[np.ndarray]:
        """All nodes, or all of some, within a similarity of each query."""
        vectors = self.vectors if among is None else self.vectors[among]
        out: list[np.ndarray] = []
        step = max(1, SCAN_CELLS // max(1, len(vectors)))
        for low in range(0, len(queries), step):
            rows, nodes = np.nonzero(queries[low : low + step] @ vectors.T >= cosine)
            nodes = nodes if among is None else among[nodes]
            out.extend(np.split(nodes, np.searchsorted(rows, np.arange(1, min(step, len(queries) - low)))))
        return out

    def near(self, queries: np.ndarray, cosine: float, width: int) -> list[np.ndarray]:
        """Nodes found within a similarity of each query; a beam that is full of them is doubled, and a scan
        takes the place of beams wider than WIDEST or as wide as the shard."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
        left = np.arange(len(queries))
        while len(left) and width <= WIDEST and width < len(self.vectors):
            nodes, sims = self.search(queries[left], width)
            inside = (sims >= cosine) & (nodes >= 0)
            full = inside.sum(1) * 2 > width
            for row in np.flatnonzero(~full):
                out[left[row]] = nodes[row, inside[row]]
            left, width = left[full], width * 2
        done = np.setdiff1d(np.arange(len(queries)), left)
        for row, nodes in zip(left, self.scan(queries[left], cosine)):
            out[row] = nodes
        if len(done) and len(self.strays):
            for row, nodes in zip(done, self.scan(queries[done], cosine, self.strays)):
                out[row] = np.union1d(out[row], nodes)
        return out

    def audited_width(self, cosine: float, queries: np.ndarray | None = None, own: np.ndarray | None = None, seed: int = 11) -> int:
        """The smallest tried beam by which each kind of sampled query finds what brute force finds, or the
        number of nodes, which stands for a scan.

        `own` is the node that a query is itself, -1 for none; it counts as no partner. Queries with partners
        are sampled from those that a scan of a pool finds and from those that have the fewest; as there may be
        none, nodes moved away by less than the similarity are queries, too.
        """
        n, random = len(self.vectors), np.random.default_rng(seed)
        if queries is None:
            queries, own = self.vectors, np.arange(n)
        if n <= FIRST_WIDTH or not len(queries):
            return n
        pool = random.permutation(len(queries))[:AUDIT_POOL]
        near = self.scan(queries[pool], cosine)
        partners = np.array([len(nodes) - (own[q] in nodes) for q, nodes in zip(pool, near)])
        has = np.flatnonzero(partners)
        picked = np.union1d(has[:AUDIT_QUERIES], has[np.argsort(partners[has], kind="stable")[:AUDIT_QUERIES]])
        moved = self.vectors[random.permutation(n)[:AUDIT_QUERIES]]
        aside = random.normal(size=moved.shape).astype(np.float32)
        aside -= (aside * moved).sum(1, keepdims=True) * moved
        # In one dimension there is nowhere to move to.
        aside /= np.maximum(np.sqrt((aside * aside).sum(1, keepdims=True)), 1e-6)
        to = np.minimum(1, cosine + (1 - cosine) * random.uniform(0.05, 1, (len(moved), 1)))
        moved = g.unit_rows(to * moved + np.sqrt(1 - to * to) * aside)
        sample, selves = np.concatenate([queries[pool[picked]], moved]), np.concatenate([own[pool[picked]], np.full(len(moved), -1)])
        truth = [near[i] for i in picked] + self.scan(moved, cosine)
        truth = [nodes[nodes != self_] for nodes, self_ in zip(truth, selves)]
        many = np.array([len(nodes) for nodes in truth])
        kind = np.arange(len(sample)) < len(picked)
        kinds = [many > 0, (many > 0) & kind, (many > 0) & (many <= FEW_PARTNERS), (many > 0) & (many <= FEW_PARTNERS) & kind]
        width = FIRST_WIDTH
        while width < n and width <= WIDEST:
            found = self.near(sample, cosine, width)
            recall = np.array([np.isin(t, f).mean() if len(t) else 1.0 for t, f in zip(truth, found)])
            if all(recall[k].mean() >= AUDIT_RECALL for k in kinds if k.any()):
                return width
            width *= 2
        return n


def _pack(array: np.ndarray) -> bytes:
    return array.astype(np.int32).tobytes()


def _build(group: pa.Table) -> pa.Table:
    raw = matrix(group.column("vec"))
    graph = LayeredGraph.build(g.unit_rows(raw))
    return pa.table({
        "shard": group.column("shard").slice(0, 1),
        "ids": [np.asarray(group.column("cid"), np.int64).tobytes()],
        "sizes": [np.asarray(group.column("size"), np.int64).tobytes()],
        "vectors": [raw.tobytes()],
        "layers": pa.array([[_pack(layer) for layer in graph.layers]], pa.list_(pa.binary())),
        "top": pa.array([graph.top], pa.int64()),
    })


def _search(cosine: float):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        counts, links, qids = [], [], np.zeros(0, np.int64)
        if len(left) and len(right):
            row = left.slice(0, 1).to_pylist()[0]
            ids, sizes = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["sizes"], np.int64)
            raw = np.frombuffer(row["vectors"], np.float32).reshape(len(ids), -1)
            layers = [np.frombuffer(layer, np.int32).reshape(len(ids), -1).astype(np.int64) for layer in row["layers"]]
            graph = LayeredGraph(g.unit_rows(raw), layers, row["top"])
            qids, vectors = np.asarray(right.column("qid"), np.int64), matrix(right.column("vec"))
            units = g.unit_rows(vectors)
            order = np.argsort(ids)
            at = order[np.minimum(np.searchsorted(ids, qids, sorter=order), len(ids) - 1)]
            # Slightly less than asked for, as graphs hold single precision.
            least = cosine - 1e-4
            width = graph.audited_width(least, units, np.where(ids[at] == qids, at, -1))
            found = (nodes for low in range(0, len(units), HELD_QUERIES) for nodes in graph.near(units[low : low + HELD_QUERIES], least, width))
            parent: dict[int, int] = {}

            def root(x: int) -> int:
                while parent.setdefault(x, x) != x:
                    parent[x] = x = parent[parent[x]]
                return x

            wide, wide_queries = raw.astype(np.float64), vectors.astype(np.float64)
            lengths = np.sqrt((wide * wide).sum(1))
            for i, nodes in enumerate(found):
                query = wide_queries[i]
                exact = (wide[nodes] @ query) / (lengths[nodes] * np.sqrt(query @ query))
                nodes = nodes[(exact >= cosine) & (ids[nodes] != qids[i])]
                counts.append(int(sizes[nodes].sum()))
                kept = []
                # Of this task's links those are enough that connect what was not connected.
                for other in ids[nodes].tolist():
                    a, b = root(int(qids[i])), root(other)
                    if a != b:
                        parent[a] = b
                        kept.append(other)
                links.append(kept)
        return pa.table({"qid": pa.array(qids, pa.int64()), "n_found": pa.array(counts, pa.int64()), "links": pa.array(links, pa.list_(pa.int64()))})

    return run


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per row: key, n_links (other rows whose vector is at least this similar), component_id (smallest key
    reachable by links) and kept (key = component_id).

    Null and zero vectors, and those with null or non-finite components, link with nothing: n_links 0,
    component_id their own key, kept. Equal vectors are one node of a graph and linked with each other. All
    usable vectors must have the same length. Null keys are linked but name no component; an empty table
    gives no rows.
    """
    classes = vector_classes(vectors, key, vector)
    n, shards = classes.count(), shard_count(classes)
    built = with_shard(classes.select("cid", "vec", "size"), shards).groupBy("shard").applyInArrow(
        _build, "shard int, ids binary, sizes binary, vectors binary, layers array<binary>, top bigint"
    )
    left, right = met_by_all(written(built, "graphs"), classes.select(F.col("cid").alias("qid"), "vec"), shards, n)
    found = left.groupBy("shard", "slice").cogroup(right.groupBy("shard", "slice")).applyInArrow(
        _search(cosine), "qid bigint, n_found bigint, links array<bigint>"
    )
    found = written(found, "near-vectors")
    counts = found.groupBy(F.col("qid").alias("cid")).agg(F.sum("n_found").alias("n_found"))
    labels = connected_components(found.select(F.col("qid").alias("a"), F.explode("links").alias("b")))
    labelled = classes.join(counts, "cid", "left").join(labels.withColumnRenamed("node", "cid"), "cid", "left")
    labelled = labelled.select("vec", "size", "least", "n_found", F.coalesce("component", "cid").alias("component"))
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = labelled.join(least, "component").select("vec", (F.col("size") - 1 + F.coalesce("n_found", F.lit(0))).alias("n_links"), "component_id")
    own = F.col(key).cast("long")
    rows = vectors.select(own.alias(key), F.col(vector).cast("array<float>").alias("vec"))
    good = rows.filter(is_usable("vec")).join(named, "vec").select(key, "n_links", "component_id")
    bad = rows.filter(~is_usable("vec")).select(key, F.lit(0).cast("bigint").alias("n_links"), F.col(key).alias("component_id"))
    return good.union(bad).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
