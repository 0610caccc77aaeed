"""Boosted trees for several classes at once, over binned rows.

Spark bins the rows and counts them per cell (a combination of bins), fold and class: a table whose
size depends on the bins alone, however many rows there are. A fit sees nothing else. Fits of several
parameter sets and folds are tasks side by side, one model each. A fitted ensemble becomes two tables:
its nodes, and the class shares of every cell, by which rows are then scored with a join.
"""

from __future__ import annotations

import heapq
import io
import json
import math
from collections.abc import Generator, Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from joulemart import constants as K
from joulemart.session import new_work_dir

AREA, AGE, FUEL, WALL = "total_floor_area_sqm", "construction_age_band", "main_fuel", "wall_type"
#: Bins of floor area, and the grid their edges lie on: quarters of a square metre, the last one open.
AREA_BINS = 255
_GRID, _GRID_CELLS = 4, 1 << 16
#: Bounds of what a fit may see; beyond them it is refused.
MAX_CELLS = 2_000_000
MAX_CATEGORIES = 200
#: Up to so many cells, their class shares are sent to every task.
BROADCAST_CELLS = 500_000
#: Added to a category's weight when categories are put in order of their gradient.
CATEGORY_SMOOTH = 10.0
_LEAST_WEIGHT = 1e-3


@dataclass(frozen=True)
class BoostParams:
    """Parameters of a fit; 0 of depth or resample means no limit and no resampling of rows.

    Held-out rows stop a fit `patience` rounds after its best one, which is then its last; with a patience
    of 0 every round is made and kept.
    """

    rounds: int = 200
    leaves: int = 63
    depth: int = 0
    min_leaf: int = 20
    step: float = 0.1
    feature_share: float = 1.0
    row_share: float = 1.0
    resample: int = 0
    l1: float = 0.0
    l2: float = 0.0
    min_gain: float = 0.0
    patience: int = 20


@dataclass(frozen=True)
class Bins:
    """How rows become cells. The last bin of a feature takes what is missing or was never seen."""

    edges: tuple[float, ...]
    categories: tuple[tuple[str, ...], ...]
    classes: tuple[str, ...]

    @property
    def sizes(self) -> list[int]:
        return [len(self.edges) + 2, *(len(c) + 1 for c in self.categories)]

    @property
    def cells(self) -> int:
        return int(np.prod(self.sizes, dtype=object))

    def cell(self, rows: DataFrame, name: str) -> DataFrame:
        """The rows with the number of their cell."""
        splits = [-np.inf, *self.edges, np.inf]
        binned = Bucketizer(splits=splits, inputCol="__area", outputCol="__bin", handleInvalid="keep")
        rows = binned.transform(rows.withColumn("__area", F.coalesce(F.col(AREA).cast("double"), F.lit(float("nan")))))
        number = F.col("__bin").cast("long")
        for column, known in zip((AGE, FUEL, WALL), self.categories):
            place = F.coalesce(F.array_position(F.array(*map(F.lit, known)), F.col(column)), F.lit(0)) if known else F.lit(0)
            number = number * (len(known) + 1) + F.when(place > 0, place - 1).otherwise(len(known))
        return rows.withColumn(name, number.cast("long")).drop("__area", "__bin")

    def of_cells(self, cells: np.ndarray) -> np.ndarray:
        """The bins of cells, one column a feature."""
        return np.stack(np.unravel_index(cells, self.sizes), 1)


def learn_bins(train: DataFrame) -> Bins:
    """Bins from training rows: floor area in equal shares, ages in their fixed order, fuels and walls by name."""
    grid = F.least(F.floor(F.col(AREA).cast("double") * _GRID), F.lit(_GRID_CELLS - 1)).alias("g")
    counts = train.filter(F.col(AREA).cast("double") > 0).groupBy(grid).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1))
    share = F.floor(F.coalesce(upto, F.lit(0)) * AREA_BINS / F.sum("n").over(Window.partitionBy()))
    starts = counts.select("g", share.alias("bin")).groupBy("bin").agg(F.min("g").alias("g"))
    edges = sorted(r.g / _GRID for r in starts.collect())[1:]

    def values(column: str) -> tuple[str, ...]:
        found = train.filter(F.col(column).isNotNull()).select(column).distinct().limit(MAX_CATEGORIES + 1).collect()
        if len(found) > MAX_CATEGORIES:
            raise ValueError(f"{column} has more than {MAX_CATEGORIES} values")
        return tuple(sorted(r[0] for r in found))

    bins = Bins(tuple(edges), (tuple(K.AGE_LABELS), values(FUEL), values(WALL)), values("target"))
    if bins.cells > MAX_CELLS:
        raise ValueError(f"{bins.cells} cells, more than {MAX_CELLS}")
    return bins


def count_cells(rows: DataFrame, bins: Bins, fold: Column) -> DataFrame:
    """(cell, fold, n): rows of every class, written; at most one row a cell and fold."""
    hits = [F.sum((F.col("target") == c).cast("long")) for c in bins.classes]
    counted = bins.cell(rows, "cell").groupBy("cell", fold.cast("int").alias("fold")).agg(F.array(*hits).alias("n"))
    folder = new_work_dir(rows.sparkSession, "cells")
    counted.write.parquet(folder)
    return rows.sparkSession.read.parquet(folder)


@dataclass
class Tree:
    """Nodes of a tree, the root first. `goes_left` has a column a bin of any feature."""

    feature: list[int] = field(default_factory=list)
    goes_left: list[np.ndarray] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    n: list[int] = field(default_factory=list)

    def add(self, value: float, n: float, width: int) -> int:
        for column, x in zip(vars(self).values(), (-1, np.zeros(width, bool), -1, -1, value, 0.0, int(n))):
            column.append(x)
        return len(self.feature) - 1


class _Layout:
    """Where the bins of each feature stand in one row of all bins."""

    def __init__(self, sizes: Sequence[int]):
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
        self.width = int(self.starts[-1])
        self.sizes = np.asarray(sizes)
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        self.categories = [slice(a, b) for a, b in zip(self.starts[1:], self.starts[2:])]  # all but the first feature


def _less(gradient: np.ndarray, l1: float) -> np.ndarray:
    if not l1:
        return gradient
    return np.sign(gradient) * np.maximum(np.abs(gradient) - l1, 0)


def best_splits(sums: np.ndarray, layout: _Layout, allowed: np.ndarray, params: BoostParams) -> list[tuple[float, int, np.ndarray]]:
    """Gain, feature and left bins of the best split of each leaf; `sums` are gradient, weight and rows of every bin, leaf by leaf.

    Floor area splits at a bin; categories in the order of gradient over weight, so that any set of
    them can go left. Empty bins go right. `allowed` has the features of each leaf.
    """
    order = np.tile(np.arange(layout.width), (len(sums), 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        for part in layout.categories:
            slope = sums[:, 0, part] / (sums[:, 1, part] + CATEGORY_SMOOTH)
            slope[sums[:, 2, part] == 0] = np.inf
            order[:, part] = part.start + np.argsort(slope, 1, kind="stable")
        upto = np.take_along_axis(sums, order[:, None], 2).cumsum(2)
        total = upto[:, :, layout.starts[1] - 1, None]
        left = upto.copy()
        for part in layout.categories:
            left[:, :, part] -= upto[:, :, part.start - 1, None]
        g, weight, rows = left[:, 0], left[:, 1], left[:, 2]
        least = max(params.min_leaf, 1)
        good = (rows >= least) & (rows <= total[:, 2] - least) & (weight >= _LEAST_WEIGHT) & (weight <= total[:, 1] - _LEAST_WEIGHT) & allowed[:, layout.owner]
        score = lambda g, h: _less(g, params.l1) ** 2 / (h + params.l2)
        gain = score(g, weight) + score(total[:, 0] - g, total[:, 1] - weight) - score(total[:, 0], total[:, 1])
    gain[~good] = -np.inf
    best = gain.argmax(1)
    found = []
    for i, at in enumerate(best):
        feature = int(layout.owner[at])
        found.append((float(gain[i, at]), feature, order[i, layout.starts[feature] : at + 1]))
    return found


def best_split(sums: np.ndarray, layout: _Layout, allowed: np.ndarray, params: BoostParams) -> tuple[float, int, np.ndarray]:
    """The best split of one leaf."""
    return best_splits(sums[None], layout, allowed[None], params)[0]


def _growing(flat: np.ndarray, sums: Sequence[np.ndarray], layout: _Layout, params: BoostParams) -> Generator[list, list, tuple[Tree, np.ndarray]]:
    """Grows a tree leaf by leaf, the largest gain first; yields the sums of new leaves, and is sent their best splits."""
    tree, value = Tree(), np.zeros(len(flat))
    heap, members, new = [], {}, []

    def histogram(rows: np.ndarray) -> np.ndarray:
        places, held = flat[rows].ravel(), np.empty((len(sums), layout.width))
        for to, s in zip(held, sums):
            to[:] = np.bincount(places, s[rows].repeat(flat.shape[1]), layout.width)
        return held

    def leaf(rows: np.ndarray, histogram: np.ndarray, depth: int) -> None:
        g, h, n = histogram[:, : layout.starts[1]].sum(1).tolist()
        less = math.copysign(max(abs(g) - params.l1, 0.0), g)
        at = tree.add(-less / (h + params.l2) * params.step if h + params.l2 > 0 else 0.0, n, layout.width)
        members[at] = rows
        if n >= 2 * params.min_leaf and (not params.depth or depth < params.depth):
            new.append((at, histogram, depth))

    everything = np.arange(len(flat))
    leaf(everything, histogram(everything), 0)
    leaves = 1
    while leaves < params.leaves:
        if new:
            for (at, whole, depth), (gain, feature, bins) in zip(new, (yield [h for _, h, _ in new])):
                if gain > max(params.min_gain, 1e-12):
                    heapq.heappush(heap, (-gain, at, feature, bins, whole, depth))
            new.clear()
        if not heap:
            break
        gain, at, feature, bins, whole, depth = heapq.heappop(heap)
        rows = members.pop(at)
        tree.feature[at], tree.gain[at] = feature, -gain
        tree.goes_left[at][bins] = True
        goes_left = tree.goes_left[at][flat[rows, feature]]
        parts = rows[goes_left], rows[~goes_left]
        small = histogram(min(parts, key=len))
        sides = (small, whole - small) if len(parts[0]) <= len(parts[1]) else (whole - small, small)
        tree.left[at] = len(tree.feature)
        leaf(parts[0], sides[0], depth + 1)
        tree.right[at] = len(tree.feature)
        leaf(parts[1], sides[1], depth + 1)
        leaves += 1
    for at, rows in members.items():
        value[rows] = tree.value[at]
    return tree, value


def grow_all(flat: np.ndarray, sums: Sequence, layout: _Layout, allowed: Sequence[np.ndarray], params: BoostParams) -> list[tuple[Tree, np.ndarray]]:
    """A tree, and the value of each cell, for each of `sums`; the trees grow side by side, their new leaves are split in one go.

    `flat` has the places of a cell's bins, each of `sums` its gradient, weight and rows.
    """
    growing = [_growing(flat, s, layout, params) for s in sums]
    grown, sent = [None] * len(sums), dict.fromkeys(range(len(sums)))
    while sent:
        asked = {}
        for i, splits in sent.items():
            try:
                asked[i] = growing[i].send(splits)
            except StopIteration as end:
                grown[i] = end.value
        sent = {}
        if asked:
            features = np.stack([allowed[i] for i, leaves in asked.items() for _ in leaves])
            found = iter(best_splits(np.stack([h for leaves in asked.values() for h in leaves]), layout, features, params))
            sent = {i: [next(found) for _ in leaves] for i, leaves in asked.items()}
    return grown


def grow(flat: np.ndarray, sums: np.ndarray, layout: _Layout, allowed: np.ndarray, params: BoostParams) -> tuple[Tree, np.ndarray]:
    """One tree, and the value of each cell."""
    return grow_all(flat, [sums], layout, [allowed], params)[0]


@dataclass
class Fit:
    """An ensemble: trees by round and class, the held-out loss after each round, and the rounds kept."""

    trees: list[list[Tree]]
    losses: list[float]
    kept: int
    confusion: np.ndarray


def _shares(scores: np.ndarray) -> np.ndarray:
    up = np.exp(scores - scores.max(1, keepdims=True))
    return up / up.sum(1, keepdims=True)


def boost(places: np.ndarray, sizes: Sequence[int], counts: np.ndarray, held_out: np.ndarray, params: BoostParams, seed: int) -> Fit:
    """Rounds of one tree a class on the softmax loss of binned counts, classes weighted to equal shares.

    `places` are the bins of the cells; `counts` and `held_out` their rows of each class. With held-out
    rows, the rounds before the smallest held-out loss are kept, and boosting stops when that is
    `patience` rounds ago.
    """
    layout = _Layout(sizes)
    flat = places + layout.starts[:-1]
    rows = counts.sum(0)
    weight = rows.sum() / (max((rows > 0).sum(), 1) * np.maximum(rows, 1.0))
    classes = counts.shape[1]
    known = held_out * weight
    scores, best = np.zeros(counts.shape), np.zeros(counts.shape)
    fit, least, bag = Fit([], [], 0, np.zeros((classes, classes))), np.inf, counts
    curve = classes / (classes - 1) if classes > 1 else 1.0
    for number in range(params.rounds):
        random = np.random.default_rng([seed, number])
        if params.resample and params.row_share < 1 and number % params.resample == 0:
            bag = random.binomial(counts.astype(np.int64), params.row_share)
        shares, n, weighted = _shares(scores), bag.sum(1), bag * weight
        whole = weighted.sum(1)
        allowed = np.zeros((classes, len(sizes)), bool)
        for features in allowed:
            features[random.permutation(len(sizes))[: max(1, round(params.feature_share * len(sizes)))]] = True
        sums = [(whole * p - w, curve * whole * p * (1 - p), n) for p, w in zip(shares.T, weighted.T)]
        trees = []
        for c, (tree, change) in enumerate(grow_all(flat, sums, layout, allowed, params)):
            trees.append(tree)
            scores[:, c] += change
        fit.trees.append(trees)
        if known.any():
            fit.losses.append(float(-(known * np.log(np.maximum(_shares(scores), 1e-15))).sum() / known.sum()))
        if not fit.losses or not params.patience or fit.losses[-1] < least:
            least, fit.kept, best = min([least, *fit.losses[-1:]]), number + 1, scores.copy()
        elif number + 1 - fit.kept >= params.patience:
            break
    fit.trees = fit.trees[: fit.kept]
    guessed = best.argmax(1)
    for c in range(classes):
        fit.confusion[:, c] = held_out[guessed == c].sum(0)
    return fit


_COLUMNS = ("feature", "left", "right", "value", "gain", "n")


def _packed(fit: Fit) -> bytes:
    trees = [t for trees in fit.trees for t in trees]
    arrays = {c: np.array([x for t in trees for x in getattr(t, c)]) for c in _COLUMNS}
    masks = np.array([m for t in trees for m in t.goes_left], bool)
    out = io.BytesIO()
    np.savez_compressed(out, sizes=[len(t.n) for t in trees], masks=np.packbits(masks, 1) if len(masks) else masks, **arrays)
    return out.getvalue()


def _unpacked(data: bytes, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(feature, goes_left, left, right, value, gain, n) of every tree, round by round and class by class."""
    held = dict(np.load(io.BytesIO(data)))
    masks = np.unpackbits(held["masks"], 1, width).astype(bool) if len(held["masks"]) else held["masks"]
    low = 0
    for size in held["sizes"]:
        part = slice(low, low + size)
        yield held["feature"][part], masks[part], *(held[c][part] for c in _COLUMNS[1:])
        low += size


def _packed_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row a batch of cells: their numbers, folds and rows of every class, as compressed arrays."""
    for rows in batches:
        if len(rows):
            out = io.BytesIO()
            np.savez_compressed(out, cell=rows["cell"], fold=rows["fold"], n=np.stack(rows["n"].to_numpy()).astype(float))
            yield pd.DataFrame({"data": [out.getvalue()]})


def _unpacked_cells(data: bytes) -> tuple[np.ndarray, ...]:
    held = np.load(io.BytesIO(data))
    return held["cell"], held["fold"], held["n"]


@dataclass(frozen=True)
class Job:
    """One fit: its parameters and the fold that is held out, if any."""

    params: BoostParams
    held_out: int | None = None
    seed: int = 42


_FITTED = "model int, kept int, rounds int, losses array<double>, confusion array<long>, trees binary"


def fit_jobs(cells: DataFrame, bins: Bins, jobs: Sequence[Job]) -> DataFrame:
    """One row a job (model is its number), each fitted in a task of its own, written.

    A task holds the cells once, of which the bins limit the number; they are dealt to each job packed.
    `rounds` are those tried, `kept` those in `trees`; `confusion` counts held-out rows by class and
    predicted class.
    """
    classes, sizes = len(bins.classes), bins.sizes

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        params, held_out, seed = jobs[int(key[0])].params, jobs[int(key[0])].held_out, jobs[int(key[0])].seed
        number, folds, n = (np.concatenate(parts) for parts in zip(*map(_unpacked_cells, rows["data"])))
        cell, at = np.unique(number, return_inverse=True)
        is_held = folds == held_out if held_out is not None else np.zeros(len(folds), bool)
        counts, known = np.zeros((len(cell), classes)), np.zeros((len(cell), classes))
        np.add.at(counts, at[~is_held], n[~is_held])
        np.add.at(known, at[is_held], n[is_held])
        places = np.stack(np.unravel_index(cell, sizes), 1)
        found = boost(places, sizes, counts, known, params, seed)
        return pd.DataFrame({
            "model": [int(key[0])], "kept": [found.kept], "rounds": [max(len(found.losses), found.kept)], "losses": [found.losses],
            "confusion": [found.confusion.astype(np.int64).ravel().tolist()], "trees": [_packed(found)],
        })

    packed = cells.select("cell", "fold", "n").mapInPandas(_packed_cells, "data binary")
    numbers = F.explode(F.array(*map(F.lit, range(len(jobs))))).alias("model")
    # By range, with a number of its own: every model gets a task, and adaptive execution merges none.
    dealt = packed.select(numbers, "data").repartitionByRange(len(jobs), "model")
    fitted = dealt.groupBy("model").applyInPandas(fit, _FITTED)
    folder = new_work_dir(cells.sparkSession, "fits")
    fitted.write.parquet(folder)
    return cells.sparkSession.read.parquet(folder)


@dataclass(frozen=True)
class BoostedModel:
    """A fitted ensemble: nodes as rows, and the class shares of every cell."""

    bins: Bins
    nodes: DataFrame
    shares: DataFrame
    about: dict

    def save(self, path: str) -> None:
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        self.shares.write.mode("overwrite").parquet(f"{path}/shares")
        text = json.dumps({"bins": asdict(self.bins), "about": self.about})
        spark = self.nodes.sparkSession
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/boosted")


def load_boosted(spark: SparkSession, path: str) -> BoostedModel:
    held = json.loads(spark.read.text(f"{path}/boosted").first().value)
    bins = Bins(tuple(held["bins"]["edges"]), tuple(map(tuple, held["bins"]["categories"])), tuple(held["bins"]["classes"]))
    return BoostedModel(bins, spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/shares"), held["about"])


_NODES = (
    "round int, class string, node int, feature int, left_bins array<int>, left int, right int, value double, gain double, n long"
)


def boosted_model(fitted: DataFrame, bins: Bins, number: int, about: dict | None = None) -> BoostedModel:
    """The model of one row of fit_jobs, as tables in the work folder. Its trees are bounded by rounds and leaves."""
    spark = fitted.sparkSession
    row = fitted.filter(F.col("model") == number).first()
    data, layout, classes = bytes(row.trees), _Layout(bins.sizes), bins.classes
    sent = spark.sparkContext.broadcast(data)

    def node_rows(_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for i, (feature, masks, left, right, value, gain, n) in enumerate(_unpacked(sent.value, layout.width)):
            inner = [(np.flatnonzero(m) - layout.starts[f]).tolist() if f >= 0 else [] for f, m in zip(feature, masks)]
            yield pd.DataFrame({
                "round": i // len(classes), "class": classes[i % len(classes)], "node": np.arange(len(n)), "feature": feature,
                "left_bins": inner, "left": left, "right": right, "value": value, "gain": gain, "n": n,
            })

    def cell_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = list(_unpacked(sent.value, layout.width))
        for batch in batches:
            flat = np.stack(np.unravel_index(batch["id"].to_numpy(), bins.sizes), 1) + layout.starts[:-1]
            scores, at = np.zeros((len(flat), len(classes))), np.arange(len(flat))
            for i, (feature, masks, left, right, value, _, _) in enumerate(trees):
                node = np.zeros(len(flat), int)
                while (inner := feature[node] >= 0).any():
                    some, here = at[inner], node[inner]
                    goes_left = masks[here, flat[some, feature[here]]]
                    node[some] = np.where(goes_left, left[here], right[here])
                scores[:, i % len(classes)] += value[node]
            yield pd.DataFrame({"cell": batch["id"], "probabilities": list(_shares(scores))})

    folder = new_work_dir(spark, "boosted")
    spark.range(0, 1, 1, 1).mapInPandas(node_rows, _NODES).write.parquet(f"{folder}/nodes")
    tasks = max(1, min(bins.cells // 10_000, 64))
    spark.range(0, bins.cells, 1, tasks).mapInPandas(cell_rows, "cell long, probabilities array<double>").write.parquet(f"{folder}/shares")
    about = {"rounds_tried": row.rounds, "rounds_kept": row.kept, "losses": list(row.losses), **(about or {})}
    return BoostedModel(bins, spark.read.parquet(f"{folder}/nodes"), spark.read.parquet(f"{folder}/shares"), about)


def fit_boosted(train: DataFrame, params: BoostParams = BoostParams(), validation: str | None = None, seed: int = 42) -> BoostedModel:
    """An ensemble over labelled rows; where the boolean ``validation`` holds, rows only decide when to stop."""
    bins = learn_bins(train if validation is None else train.filter(~F.col(validation)))
    fold = F.lit(0) if validation is None else F.when(F.col(validation), 1).otherwise(0)
    cells = count_cells(train.filter(F.col("target").isin(*bins.classes)), bins, fold)
    fitted = fit_jobs(cells, bins, [Job(params, None if validation is None else 1, seed)])
    return boosted_model(fitted, bins, 0, {"parameters": asdict(params)})


def score_boosted(model: BoostedModel, rows: DataFrame) -> DataFrame:
    """Add ``predicted`` and ``probabilities`` (by class, in the order of the model's classes).

    The most probable class wins, the better band among equals. Values that training never saw have a bin
    of their own. Rows meet the shares of their cell, which are sent to every task if there are few cells.
    """
    shares = model.shares.withColumnsRenamed({"cell": "__of", "probabilities": "__shares"})
    shares = F.broadcast(shares) if model.bins.cells <= BROADCAST_CELLS else shares
    joined = model.bins.cell(rows, "__cell").join(shares, F.col("__cell") == F.col("__of"))
    names = F.array(*map(F.lit, model.bins.classes))
    best = F.element_at(names, F.array_position("__shares", F.array_max("__shares")).cast("int"))
    kept = [c for c in rows.columns if c not in ("predicted", "probabilities")]
    return joined.select(*kept, best.alias("predicted"), F.col("__shares").alias("probabilities"))


def node_importance(model: BoostedModel) -> DataFrame:
    """(feature, splits, gain): how often each feature splits, and the gain of its splits, from the stored nodes."""
    names = F.array(*map(F.lit, ("floor_area_sqm", AGE, FUEL, WALL)))
    every = model.nodes.sparkSession.range(4).select(F.element_at(names, (F.col("id") + 1).cast("int")).alias("feature"), F.col("id").cast("int").alias("__id"))
    found = model.nodes.filter("feature >= 0").groupBy(F.col("feature").alias("__id")).agg(F.count(F.lit(1)).alias("splits"), F.sum("gain").alias("gain"))
    return every.join(found, "__id", "left").select("feature", F.coalesce("splits", F.lit(0)).alias("splits"), F.coalesce("gain", F.lit(0.0)).alias("gain"))

