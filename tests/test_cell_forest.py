"""Forests grown over counts of binned rows, held against Spark's own and a search of all splits."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import classification
from pyspark.sql import functions as F

from joulemart import constants as K
from joulemart.plans import band_models as models
from joulemart.plans import cell_forest as cells
from joulemart.session import new_work_dir


@pytest.fixture(scope="module")
def train(spark):
    """Bands by age, area and wall, with noise."""
    age, area = (F.col("id") * 7) % 8, 40 + F.col("id") * 31 % 997 / 10
    band = F.when(F.col("id") * 13 % 17 == 0, "G").when((age < 3) & (area > 80), "E").when(age < 6, "D").otherwise("C")
    frame = spark.range(2000).select(
        F.concat(F.lit("c"), F.col("id")).alias("certificate_id"), band.alias("target"), area.cast("double").alias("total_floor_area_sqm"),
        F.element_at(F.array(*map(F.lit, K.AGE_LABELS)), (age + 1).cast("int")).alias("construction_age_band"),
        F.when(F.col("id") % 3 == 0, "LPG").otherwise("Mains Gas").alias("main_fuel"),
        F.when(F.col("id") % 2 == 0, "Timber Frame").otherwise("System Build").alias("wall_type"),
    )
    path = new_work_dir(spark, "forest-rows")
    frame.write.parquet(path)
    return spark.read.parquet(path)


def _trees(model):
    return [tree.toDebugString.splitlines()[1:] for tree in model.stages[-2].trees]


def test_forest_depends_on_the_rows_alone(spark, train, monkeypatch):
    params = models.ForestParams(trees=30, depth=5, min_leaf=5)
    counted = []
    count = cells.RandomForestClassifier._counted
    monkeypatch.setattr(cells.RandomForestClassifier, "_counted", lambda *a: counted.append(count(*a)) or counted[-1])
    model = models.fit_forest(train, params)
    assert _trees(models.fit_forest(train.repartition(7), params)) == _trees(model)
    models.fit_forest(train.crossJoin(spark.range(5)).drop("id"), params)
    sums = [found[0].agg(F.count("*"), F.sum("n")).first() for found in counted]
    assert sums[2][0] == sums[0][0] <= 32 * 8 * 2 * 2 * 4 and sums[2][1] == 5 * sums[0][1] == 5 * 2000

    monkeypatch.setattr(models, "RandomForestClassifier", classification.RandomForestClassifier)
    plain = models.fit_forest(train, params)
    ours, theirs = model.stages[-2], plain.stages[-2]
    assert (ours.getNumTrees, ours.numFeatures, ours.numClasses, ours.getMaxDepth()) == (30, theirs.numFeatures, theirs.numClasses, 5)
    assert np.abs(ours.featureImportances.toArray() - theirs.featureImportances.toArray()).max() < 0.06
    by_id = lambda m: {r.certificate_id: r for r in models.score_forest(m, train).collect()}
    a, b = by_id(model), by_id(plain)
    assert sum(a[k].predicted == b[k].predicted for k in a) > 0.93 * len(a)
    assert np.mean([np.abs(np.subtract(a[k].probabilities, b[k].probabilities)).max() for k in a]) < 0.05


@pytest.mark.parametrize("seed", range(4))
def test_tree_splits_as_a_search_of_all_splits(seed):
    random = np.random.default_rng(seed)
    sizes, classes, least = [6, 3, 2], 3, 4
    bins = np.stack([random.integers(0, s, 80) for s in sizes], 1)
    label, n = random.integers(0, classes, 80), random.integers(1, 9, 80)
    weight = np.array([1.0, 0.5, 2.0])[label]
    tree = cells.grow_tree(bins, sizes, label, weight, n, classes, cells.TreeParams(3, least, 3), np.random.default_rng(seed))
    drawn = np.random.default_rng(seed).poisson(n)

    def check(at, rows):
        stats = np.bincount(label[rows], (drawn * weight)[rows], classes)
        assert np.allclose(stats, tree["stats"][at]) and tree["count"][at] == drawn[rows].sum() >= least
        gini = lambda s: s.sum() * (1 - ((s / max(s.sum(), 1e-9)) ** 2).sum())
        gains = {}
        for f, size in enumerate(sizes):
            for upto in range(size - 1):
                left = rows[bins[rows, f] <= upto]
                part = np.bincount(label[left], (drawn * weight)[left], classes)
                if min(drawn[left].sum(), drawn[rows].sum() - drawn[left].sum()) >= least:
                    gains[f, upto] = (gini(stats) - gini(part) - gini(stats - part)) / stats.sum()
        f, upto = tree["feature"][at], tree["upto"][at]
        if f < 0:
            return 0
        assert gains[f, upto] == pytest.approx(max(gains.values())) == pytest.approx(tree["gain"][at])
        left = bins[rows, f] <= upto
        return 1 + max(check(tree["left"][at], rows[left]), check(tree["left"][at] + 1, rows[~left]))

    assert check(0, np.arange(80)) == 3
    small = cells.merged(tree)
    inner = np.flatnonzero(small["feature"] >= 0)
    both = [(small["left"][i], small["right"][i]) for i in inner]
    assert all(small["predicted"][a] != small["predicted"][b] for a, b in both if small["feature"][a] < 0 and small["feature"][b] < 0)
    assert small["node"].tolist() == sorted({0, *(i for pair in both for i in pair)})
