"""Neighbour graphs of unit vectors in numpy: beam search for many queries at once, and edge pruning."""

from __future__ import annotations

import numpy as np

#: Cells of the table of visited nodes; bounds how many queries are searched at once.
VISITED_CELLS = 1 << 25
_EXPAND = 4


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    return (wide / np.sqrt((wide * wide).sum(1, keepdims=True))).astype(np.float32)


def beam_search(vectors: np.ndarray, edges: np.ndarray, queries: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The best nodes met by each query, (nodes, similarities) with the most similar first.

    `entries` has one row of start nodes a query; -1 stands for none, in edges and in the result.
    """
    step = max(1, min(256, VISITED_CELLS // max(1, len(vectors))))
    nodes = np.full((len(queries), width), -1, np.int64)
    sims = np.full((len(queries), width), -np.inf, np.float32)
    for low in range(0, len(queries), step):
        part = slice(low, low + step)
        nodes[part], sims[part] = _beam(vectors, edges, queries[part], entries[part], width)
    return nodes, sims


def _merge(nodes, sims, done, new_nodes, new_sims, width):
    nodes, sims = np.concatenate([nodes, new_nodes], 1), np.concatenate([sims, new_sims], 1)
    done = np.concatenate([done, np.zeros(new_nodes.shape, bool)], 1)
    order = np.argsort(-sims, axis=1, kind="stable")[:, :width]
    return np.take_along_axis(nodes, order, 1), np.take_along_axis(sims, order, 1), np.take_along_axis(done, order, 1)


def _beam(vectors, edges, queries, entries, width):
    count = len(queries)
    # One more column takes the marks of missing nodes.
    visited = np.zeros((count, len(vectors) + 1), bool)

    def look(rows, found):
        """Similarities of nodes not seen before; all others get the lowest."""
        found = np.sort(found, 1)
        fresh = (found >= 0) & ~visited[rows[:, None], found]
        fresh[:, 1:] &= found[:, 1:] != found[:, :-1]
        visited[rows[:, None], found] = True
        near = np.einsum("qcd,qd->qc", vectors[found], queries[rows])
        return np.where(fresh, found, -1), np.where(fresh, near, -np.inf).astype(np.float32)

    everyone = np.arange(count)
    nodes, sims = look(everyone, entries)
    nodes, sims, done = _merge(np.full((count, width), -1), np.full((count, width), -np.inf, np.float32), np.zeros((count, width), bool), nodes, sims, width)
    while True:
        open_sims = np.where(done | (nodes < 0), -np.inf, sims)
        rows = np.flatnonzero(open_sims.max(1) > -np.inf)
        if not len(rows):
            return nodes, sims
        picks = min(_EXPAND, width)
        best = np.argpartition(-open_sims[rows], picks - 1, 1)[:, :picks] if picks < width else np.argsort(-open_sims[rows], 1)
        real = np.take_along_axis(open_sims[rows], best, 1) > -np.inf
        chosen = np.where(real, nodes[rows[:, None], best], -1)
        done[rows[:, None], best] = True
        found = np.where((chosen >= 0)[:, :, None], edges[chosen], -1).reshape(len(rows), -1)
        new_nodes, new_sims = look(rows, found)
        nodes[rows], sims[rows], done[rows] = _merge(nodes[rows], sims[rows], done[rows], new_nodes, new_sims, width)


def diverse(vectors: np.ndarray, points: np.ndarray, found: np.ndarray, degree: int, slack: float, fill: bool = False) -> np.ndarray:
    """Up to `degree` of each point's candidates: near ones, but none that is `slack` times nearer to a
    chosen one than to the point. With `fill`, the nearest of those left out take the places that remain.
    Missing candidates are -1; a point is never its own."""
    if not found.shape[1]:
        return np.full((len(points), degree), -1, np.int64)
    found = np.sort(found, 1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    found = np.where(found == points[:, None], -1, found)
    sims = np.einsum("pcd,pd->pc", vectors[found], vectors[points])
    sims[found < 0] = -np.inf
    order = np.argsort(-sims, 1, kind="stable")
    found, sims = np.take_along_axis(found, order, 1), np.take_along_axis(sims, order, 1)
    held = vectors[found]
    among = held @ held.transpose(0, 2, 1)
    alive = found >= 0
    taken = np.zeros(found.shape, bool)
    out = np.full((len(points), degree), -1, np.int64)
    everyone = np.arange(len(points))
    for place in range(degree):
        first = alive.argmax(1)
        real = alive[everyone, first]
        if not real.any():
            break
        out[real, place] = found[real, first[real]]
        taken[everyone[real], first[real]] = True
        # Squared distances of unit vectors are twice one minus the similarity.
        covered = slack**2 * (1 - among[everyone, first]) <= 1 - sims
        alive &= ~(covered & real[:, None])
        alive[everyone, first] = False
    if fill:
        rest = np.argsort(taken | (found < 0), axis=1, kind="stable")[:, :degree]
        left_out = np.where(np.take_along_axis(taken, rest, 1), -1, np.take_along_axis(found, rest, 1))
        both = np.concatenate([out, left_out], 1)
        out = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable")[:, :degree], 1)
    return out


def link(vectors: np.ndarray, edges: np.ndarray, points: np.ndarray, found: np.ndarray, slack: float, fill: bool = False) -> None:
    """Give `points` edges to their diverse candidates, and edges back from those.

    Two thirds of the places of a node are filled at first, so that edges back find room; a node without
    room is pruned to two thirds again.
    """
    room = edges.shape[1]
    keep = max(1, room * 2 // 3)
    edges[points] = -1
    edges[points, :keep] = diverse(vectors, points, found, keep, slack, fill)
    source = np.repeat(points, keep)
    target = edges[points, :keep].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, count = np.unique(target, return_index=True, return_counts=True)
    has = (edges[nodes] >= 0).sum(1)
    fits = has + count <= room
    at = np.repeat(fits, count)
    place = np.arange(len(target)) - np.repeat(first, count) + np.repeat(has, count)
    edges[target[at], place[at]] = source[at]
    nodes, first, count = nodes[~fits], first[~fits], count[~fits]
    # A crowded node takes up to `room` new edges at a time; the rest come round again.
    for turn in range(0, int(count.max(initial=0)), room):
        some = count > turn
        place = first[some][:, None] + turn + np.arange(min(room, int(count.max()) - turn))
        inside = place < (first + count)[some][:, None]
        extra = np.where(inside, source[np.minimum(place, len(source) - 1)], -1)
        known = np.concatenate([edges[nodes[some]], extra], 1)
        edges[nodes[some]] = -1
        edges[nodes[some], :keep] = diverse(vectors, nodes[some], known, keep, slack, fill)


def insertion_batches(order: np.ndarray, largest: int = 256):
    """Runs of nodes to insert together, none larger than what is there before."""
    at = 0
    while at < len(order):
        size = max(1, min(largest, at))
        yield order[:at], order[at : at + size]
        at += size


def batch_candidates(vectors: np.ndarray, batch: np.ndarray, keep: int) -> np.ndarray:
    """Each batch member's nearest fellow members, which no search can find yet."""
    sims = vectors[batch] @ vectors[batch].T
    np.fill_diagonal(sims, -np.inf)
    keep = min(keep, len(batch) - 1)
    return batch[np.argsort(-sims, 1)[:, :keep]] if keep else np.zeros((len(batch), 0), np.int64)
