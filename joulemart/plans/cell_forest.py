"""Spark's random forest classifier, fitted on counts of binned rows.

Spark's own fit reads every row for every tree at every level and sends the statistics of all nodes from every
partition. Here Spark bins the rows and counts them per cell (a combination of bins), class and weight: a table whose
size depends on the bins alone. A tree's bootstrap takes a row Poisson-often, so it takes n equal rows as often as a
Poisson draw of n says: cells are drawn instead of rows, with the same law. Trees are grown in tasks side by side, by
the rules of Spark's: the best Gini gain among features drawn a node, least rows a child, equal leaves beside each
other merged. Their nodes become a saved model, which Spark loads, and which scores, explains and saves as ever.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import classification
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joulemart.session import new_work_dir

#: Groups of trees a core: each group is a task that holds all cells.
GROUPS_A_CORE = 3
#: Rows to make an empty form of the model from, which keeps its parameters, classes and features.
_FORM_ROWS = 64


@dataclass(frozen=True)
class TreeParams:
    depth: int
    min_leaf: int
    features: int
    subsample: float = 1.0


def binary_features(rows: DataFrame, features: str) -> set[int]:
    """Places of the features that are 0 or 1, by the vector's metadata; others are numbers."""
    attributes = rows.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    return {a["idx"] for a in attributes.get("binary", [])}


def learn_thresholds(rows: DataFrame, columns: Sequence[str], max_bins: int) -> list[list[float]]:
    """Per column, the midpoints of its values if they are at most ``max_bins``, else quantiles of its rows."""
    shares = [i / max_bins for i in range(1, max_bins)]
    quantiles = rows.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in columns]).first()
    found = []
    for c in columns:
        values = sorted(r[0] for r in rows.select(c).distinct().limit(max_bins + 1).collect())
        few = len(values) <= max_bins
        found.append([(a + b) / 2 for a, b in zip(values, values[1:])] if few else sorted(set(quantiles[c])))
    return found


def grow_tree(bins: np.ndarray, sizes: Sequence[int], label: np.ndarray, weight: np.ndarray, n: np.ndarray, classes: int, params: TreeParams, random: np.random.Generator) -> dict[str, np.ndarray]:
    """Nodes of one tree, the root first and children behind their parents; feature -1 for leaves.

    ``bins`` has a row an entry and a column a feature; ``n`` rows of that class and weight are in it. A split sends bins up to ``upto`` left.
    """
    drawn = random.poisson(n * params.subsample)
    some = np.flatnonzero(drawn)
    bins, label, drawn = bins[some], label[some], drawn[some].astype(float)
    weighted = drawn * weight[some]
    slot, parts, first = np.zeros(len(some), int), [], 0
    for depth in range(params.depth + 1):
        open_nodes = int(slot.max()) + 1 if len(slot) else 1
        stats = np.bincount(slot * classes + label, weighted, open_nodes * classes).reshape(open_nodes, classes)
        count = np.bincount(slot, drawn, open_nodes)
        whole = stats.sum(1)
        purity = (stats**2).sum(1) / np.maximum(whole, 1e-300)
        part = {
            "stats": stats, "count": count.astype(np.int64), "impurity": np.where(whole > 0, 1 - purity / np.maximum(whole, 1e-300), 0.0),
            "gain": np.full(open_nodes, -1.0), "feature": np.full(open_nodes, -1), "upto": np.full(open_nodes, -1), "left": np.full(open_nodes, -1),
        }
        parts.append(part)
        if depth == params.depth:
            break
        asked = np.zeros((open_nodes, len(sizes)), bool)
        np.put_along_axis(asked, random.random(asked.shape).argsort(1)[:, : params.features], True, 1)
        asked &= ((stats > 0).sum(1) > 1)[:, None] & (np.asarray(sizes) > 1)
        best = np.zeros(open_nodes)
        for feature, size in enumerate(sizes):
            nodes = np.flatnonzero(asked[:, feature])
            if not len(nodes):
                continue
            rows = np.flatnonzero(asked[slot, feature])
            place = (np.cumsum(asked[:, feature]) - 1)[slot[rows]] * size + bins[rows, feature]
            left = np.bincount(place * classes + label[rows], weighted[rows], len(nodes) * size * classes)
            left = left.reshape(len(nodes), size, classes).cumsum(1)[:, :-1]
            taken = np.bincount(place, drawn[rows], len(nodes) * size).reshape(len(nodes), size).cumsum(1)[:, :-1]
            right = np.maximum(stats[nodes, None] - left, 0)
            good = (taken >= params.min_leaf) & (count[nodes, None] - taken >= params.min_leaf)
            kept = (left**2).sum(2) / np.maximum(left.sum(2), 1e-300) + (right**2).sum(2) / np.maximum(right.sum(2), 1e-300)
            gain = np.where(good, (kept - purity[nodes, None]) / whole[nodes, None], -1.0)
            upto = gain.argmax(1)
            gain = gain[np.arange(len(nodes)), upto]
            better = gain > best[nodes]
            chosen = nodes[better]
            best[chosen], part["feature"][chosen], part["upto"][chosen] = gain[better], feature, upto[better]
        split = part["feature"] >= 0
        if not split.any():
            break
        part["gain"][split] = best[split]
        child = 2 * (np.cumsum(split) - 1)
        part["left"][split] = first + open_nodes + child[split]
        first += open_nodes
        stay = np.flatnonzero(split[slot])
        bins, label, drawn, weighted, slot = bins[stay], label[stay], drawn[stay], weighted[stay], slot[stay]
        goes_right = bins[np.arange(len(stay)), part["feature"][slot]] > part["upto"][slot]
        slot = child[slot] + goes_right
    return {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}


def merged(tree: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The tree without leaves that predict what the leaf beside them does, numbered as it is read: node, left, right."""
    feature, left, predicted = tree["feature"].copy(), tree["left"], tree["stats"].argmax(1)
    for at in range(len(feature) - 1, -1, -1):
        a = left[at]
        if feature[at] >= 0 and feature[a] < 0 and feature[a + 1] < 0 and predicted[a] == predicted[a + 1]:
            feature[at] = -1
    order, waiting = [], [0]
    while waiting:
        at = waiting.pop()
        order.append(at)
        if feature[at] >= 0:
            waiting += [left[at] + 1, left[at]]
    order = np.array(order)
    number = np.full(len(feature) + 1, -1)
    number[order] = np.arange(len(order))
    inner = feature[order] >= 0
    kept = {name: column[order] for name, column in tree.items()}
    return kept | {
        "node": np.arange(len(order)), "feature": feature[order], "gain": np.where(inner, kept["gain"], -1.0), "predicted": predicted[order].astype(float),
        "left": np.where(inner, number[left[order]], -1), "right": np.where(inner, number[left[order] + 1], -1),
    }


_NODES = (
    "treeID int, id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double,"
    " leftChild int, rightChild int, featureIndex int, upto int"
)


class RandomForestClassifier(classification.RandomForestClassifier):
    """A forest of Gini trees over number and 0/1 features, with ceil(sqrt) of them drawn a node."""

    def _fit(self, dataset: DataFrame) -> classification.RandomForestClassificationModel:
        if (self.getFeatureSubsetStrategy(), self.getImpurity(), self.getBootstrap()) != ("sqrt", "gini", True):
            raise ValueError("only bootstrapped Gini trees over sqrt of the features")
        form = super()._fit(dataset.limit(_FORM_ROWS))
        folder = new_work_dir(dataset.sparkSession, "trees")
        form.write().save(folder)
        self._nodes(dataset, form.numFeatures, form.numClasses).write.mode("overwrite").parquet(f"{folder}/data")
        return self._copyValues(classification.RandomForestClassificationModel.load(folder))

    def _counted(self, dataset: DataFrame, features: int) -> tuple[DataFrame, list[list[float]], set[int]]:
        """(bins, label, weight, n), written, with the thresholds of each feature and which of them are 0 or 1."""
        values = vector_to_array(self.getFeaturesCol())
        binary = binary_features(dataset, self.getFeaturesCol())
        numbers = [i for i in range(features) if i not in binary]
        weight = F.col(self.getWeightCol()) if self.isDefined("weightCol") else F.lit(1.0)
        rows = dataset.select(
            F.col(self.getLabelCol()).cast("int").alias("label"), weight.cast("double").alias("weight"),
            *[values[i].alias(f"x{i}") for i in numbers], F.array(*[(values[i] != 0).cast("int") for i in sorted(binary)]).alias("flags"),
        )
        learned = dict(zip(numbers, learn_thresholds(rows, [f"x{i}" for i in numbers], self.getMaxBins()) if numbers else []))
        for i in numbers:
            # Up to a threshold means left, and a bucket starts at its lower end.
            ends = [-math.inf, *[math.nextafter(t, math.inf) for t in learned[i]], math.inf]
            rows = Bucketizer(splits=ends, inputCol=f"x{i}", outputCol=f"b{i}").transform(rows) if learned[i] else rows.withColumn(f"b{i}", F.lit(0))
        places = [F.col(f"b{i}").cast("int") if i in learned else F.col("flags")[sorted(binary).index(i)] for i in range(features)]
        counted = rows.groupBy(F.array(*places).alias("bins"), "label", "weight").agg(F.count(F.lit(1)).alias("n"))
        folder = new_work_dir(dataset.sparkSession, "forest-cells")
        counted.write.parquet(folder)
        thresholds = [learned.get(i, [0.0]) for i in range(features)]
        return dataset.sparkSession.read.parquet(folder), thresholds, binary

    def _nodes(self, dataset: DataFrame, features: int, classes: int) -> DataFrame:
        """The nodes of all trees, in the columns of a saved forest."""
        cells, thresholds, binary = self._counted(dataset, features)
        sizes = [len(t) + 1 for t in thresholds]
        params = TreeParams(self.getMaxDepth(), self.getMinInstancesPerNode(), math.ceil(math.sqrt(features)), self.getSubsamplingRate())
        trees, seed = self.getNumTrees(), self.getSeed() % (1 << 64)
        groups = min(trees, GROUPS_A_CORE * dataset.sparkSession.sparkContext.defaultParallelism)

        def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            bins = np.stack(rows["bins"].to_numpy()).astype(np.int64)
            label, weight, n = (rows[c].to_numpy() for c in ("label", "weight", "n"))
            order = np.lexsort([weight, label, *bins.T])  # the same trees however the rows lie
            bins, label, weight, n = bins[order], label[order].astype(np.int64), weight[order], n[order]
            found = []
            for number in range(int(key[0]), trees, groups):
                tree = merged(grow_tree(bins, sizes, label, weight, n, classes, params, np.random.default_rng([seed, number])))
                found.append(pd.DataFrame({
                    "treeID": number, "id": tree["node"], "prediction": tree["predicted"], "impurity": tree["impurity"], "impurityStats": list(tree["stats"]),
                    "rawCount": tree["count"], "gain": tree["gain"], "leftChild": tree["left"], "rightChild": tree["right"],
                    "featureIndex": tree["feature"], "upto": tree["upto"],
                }))
            return pd.concat(found)

        numbers = F.explode(F.array(*map(F.lit, range(groups)))).alias("group")
        dealt = cells.select(numbers, "*").repartitionByRange(groups, "group")
        grown = dealt.groupBy("group").applyInPandas(grow, _NODES)
        known = F.array(*[F.array(*map(F.lit, t)) if t else F.array().cast("array<double>") for t in thresholds])
        is_inner, is_binary = F.col("featureIndex") >= 0, F.col("featureIndex").isin(*sorted(binary))
        threshold = F.when(is_inner, F.array(known[F.col("featureIndex")][F.col("upto")])).otherwise(F.array().cast("array<double>"))
        split = F.struct("featureIndex", threshold.alias("leftCategoriesOrThreshold"), F.when(is_inner & is_binary, 2).otherwise(-1).alias("numCategories"))
        node = F.struct("id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", split.alias("split"))
        return grown.select("treeID", node.alias("nodeData"))
