from __future__ import annotations

import itertools
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from joulemart import __main__ as jobs
from joulemart import constants as K
from joulemart import queries_models
from joulemart.operators import metrics
from joulemart.operators.ranking import running_max
from joulemart.plans import band_features as features
from joulemart.plans import band_models as models
from joulemart.plans import softmax_boost as boosting
from joulemart.session import new_work_dir

FUELS = [label for label, _ in K.FUEL_TEXT]


@pytest.fixture(scope="module")
def rows(spark):
    """Bands that the age decides, with some noise from the fuel."""
    age = (F.col("id") * 7) % 8
    band = F.when(age < 3, "E").when(age < 6, "D").otherwise("C")
    noisy = F.when(F.col("id") % 11 == 0, F.lit("B")).otherwise(band)
    frame = spark.range(1500).select(
        F.concat(F.lit("c"), F.col("id")).alias("certificate_id"),
        noisy.alias("target"),
        (40 + F.col("id") % 90).cast("double").alias("total_floor_area_sqm"),
        F.element_at(F.array(*[F.lit(a) for a in K.AGE_LABELS]), (age + 1).cast("int")).alias("construction_age_band"),
        F.element_at(F.array(*[F.lit(f) for f in FUELS]), (F.col("id") % len(FUELS) + 1).cast("int")).alias("main_fuel"),
        F.when(F.col("id") % 2 == 0, "Timber Frame").otherwise("System Build").alias("wall_type"),
    )
    path = new_work_dir(spark, "model-rows")
    features.split_features(frame).write.parquet(path)
    return spark.read.parquet(path)


def _unseen(spark):
    schema = "total_floor_area_sqm double, construction_age_band string, main_fuel string, wall_type string"
    return spark.createDataFrame(
        [(95.0, "1976-1990", "Mains Gas", "Timber Frame"), (95.0, "Stone Age", "Peat", "Straw")], schema
    )


def test_forest(spark, rows):
    train, test = rows.filter(~F.col("is_test")), rows.filter("is_test")
    model = models.fit_forest(train, models.ForestParams(trees=10, depth=6, min_leaf=5))
    path = new_work_dir(spark, "forest")
    models.save_model(model, path)
    loaded = models.load_model(path)

    scored = models.score_forest(model, test)
    again = models.score_forest(loaded, test)
    by_id = lambda df: {r.certificate_id: r.predicted for r in df.collect()}
    assert by_id(scored) == by_id(again)

    accuracy, macro_f1 = models.scores_of(scored)
    majority = metrics.naive_baselines(test, "target", 7).first().majority_accuracy
    assert accuracy > majority and 0 < macro_f1 <= 1

    for row in models.score_forest(loaded, _unseen(spark)).collect():
        assert row.predicted in K.BANDS and sum(row.probabilities) == pytest.approx(1)

    importance = models.importance(spark, model).collect()
    assert importance[0].feature == "construction_age_band"
    assert sum(r.importance for r in importance) == pytest.approx(1)
    assert {r.feature for r in importance} >= {"floor_area_sqm", "Fuel: LPG", "Wall: Timber Frame"}
    splits = {r.feature: (r.splits, r.pct) for r in models.split_counts(spark, model, path).collect()}
    said = [line.split()[2] for tree in model.stages[-2].trees for line in tree.toDebugString.splitlines() if line.strip().startswith("If (feature ")]
    assert sum(n for n, _ in splits.values()) == len(said)
    assert splits["floor_area_sqm"][0] == said.count("0") and splits["construction_age_band"][0] == said.count("1") > 0
    assert models.split_counts(spark, model).count() == len(splits)


def test_boosted_with_early_stopping(spark, rows):
    train, test = rows.filter(~F.col("is_test")), rows.filter("is_test")
    marked = features.fold_features(train).withColumn("held_out", F.col("fold") == 0)
    model = models.fit_boosted(marked, models.BoostParams(rounds=30, depth=3, min_leaf=5, patience=4), validation="held_out")
    assert model.bins.classes == ("B", "C", "D", "E")
    losses, kept = model.about["losses"], model.about["rounds_kept"]
    assert kept == np.argmin(losses) + 1 and len(losses) == model.about["rounds_tried"] == min(30, kept + 4)
    assert model.nodes.agg(F.max("round") + 1).first()[0] == kept and model.shares.count() == model.bins.cells
    path = new_work_dir(spark, "boosted")
    models.save_model(model, path)
    loaded = models.load_model(path)
    assert loaded.about == model.about and loaded.bins == model.bins
    scored = models.score(loaded, test.withColumn("predicted", F.lit("old")))
    assert sorted(scored.columns) == sorted([*test.columns, "predicted", "probabilities"]) and scored.count() == test.count()
    accuracy, _ = models.scores_of(scored)
    assert accuracy > metrics.naive_baselines(test, "target", 7).first().majority_accuracy
    for row in models.score(model, _unseen(spark)).collect():
        assert row.predicted in "BCDE" and sum(row.probabilities) == pytest.approx(1)
    nothing = _unseen(spark).select(*[F.lit(None).cast(t).alias(c) for c, t in _unseen(spark).dtypes])
    assert models.score(model, nothing).filter("predicted is not null").count() == 2
    importance = models.importance(spark, model).collect()
    assert importance[0].feature == "construction_age_band" and sum(r.importance for r in importance) == pytest.approx(1)
    splits = {r.feature: r.splits for r in models.split_counts(spark, model).collect()}
    assert len(splits) == 4 and sum(splits.values()) == model.nodes.filter("feature >= 0").count()
    gains = model.nodes.filter("feature >= 0").select(F.min("gain"), F.min("n")).first()
    assert gains[0] > 0 and gains[1] >= 10


SIZES = [7, 3, 4, 2]


def _cells(seed, n=60, classes=3):
    random = np.random.default_rng(seed)
    cells = np.unique(random.integers(0, np.prod(SIZES), n))
    places = np.stack(np.unravel_index(cells, SIZES), 1)
    lean = (places[:, 0] > 3).astype(int) + (places[:, 2] == 1)
    counts = random.integers(0, 4, (len(cells), classes)).astype(float)
    counts[np.arange(len(cells)), lean % classes] += 6
    return places, counts


def _splits(places, rows):
    """Every split of rows (places): by floor area at a bin, by any set of categories."""
    for bin_ in range(SIZES[0]):
        yield 0, frozenset(range(bin_ + 1))
    for feature in (1, 2, 3):
        present = sorted(set(places[rows, feature]))
        for size in range(1, len(present)):
            for some in itertools.combinations(present, size):
                yield feature, frozenset(some)


def _best_by_hand(places, sums, rows, params):
    score = lambda s: np.sign(s[0]) ** 2 * max(abs(s[0]) - params.l1, 0) ** 2 / (s[1] + params.l2)
    best = (-np.inf, None, None)
    for feature, some in _splits(places, rows):
        left = np.isin(places[rows, feature], list(some))
        a, b = sums[:, rows[left]].sum(1), sums[:, rows[~left]].sum(1)
        if min(a[2], b[2]) >= params.min_leaf and min(a[1], b[1]) >= 1e-3:
            gain = score(a) + score(b) - score(a + b)
            if gain > best[0] + 1e-9:
                best = (gain, feature, left)
    return best


@pytest.mark.parametrize("seed", range(8))
def test_trees_split_as_a_search_of_all_splits(monkeypatch, seed):
    monkeypatch.setattr(boosting, "CATEGORY_SMOOTH", 0.0)
    places, counts = _cells(seed)
    random = np.random.default_rng(seed)
    n = counts.sum(1)
    # Weights in proportion to rows: then the order by gradient over weight holds the best set also with l2.
    sums = np.stack([random.normal(size=len(n)) * n, n * 0.3, n])
    params = models.BoostParams(leaves=5, depth=3, min_leaf=9, step=1.0, l2=0.0, min_gain=0.05)
    layout = boosting._Layout(SIZES)
    tree, value = boosting.grow(places + layout.starts[:-1], sums, layout, np.ones(4, bool), params)

    open_, leaves, gains = [(np.arange(len(n)), 0)], [], []
    while True:  # the leaf with the largest gain first
        found = [(*_best_by_hand(places, sums, rows, params), i) for i, (rows, depth) in enumerate(open_) if depth < 3 and n[rows].sum() >= 18]
        found = [f for f in found if f[0] > 0.05]
        if not found or len(open_) == 5:
            break
        gain, _, left, i = max(found, key=lambda f: f[0])
        rows, depth = open_.pop(i)
        gains.append(gain)
        open_ += [(rows[left], depth + 1), (rows[~left], depth + 1)]
    expected = np.empty(len(n))
    for rows, _ in open_:
        expected[rows] = -sums[0, rows].sum() / sums[1, rows].sum()
    assert np.allclose(value, expected)
    assert np.allclose([g for g in tree.gain if g], gains, atol=1e-8) or np.allclose(sorted(g for g in tree.gain if g), sorted(gains), atol=1e-8)
    inner = [i for i, f in enumerate(tree.feature) if f >= 0]
    assert all(tree.n[i] == tree.n[tree.left[i]] + tree.n[tree.right[i]] for i in inner)


def test_trees_side_by_side_are_those_grown_alone():
    places, counts = _cells(4, 100)
    random, layout, n = np.random.default_rng(4), boosting._Layout(SIZES), counts.sum(1)
    sums = [np.stack([random.normal(size=len(n)) * n * (i < 3), n * 0.3, n]) for i in range(4)]  # the last has nothing to split
    allowed = [np.array(a, bool) for a in ((1, 1, 1, 1), (1, 0, 0, 1), (0, 1, 1, 0), (1, 1, 1, 1))]
    for params in (models.BoostParams(leaves=9, min_leaf=5, l1=0.1), models.BoostParams(depth=2, min_leaf=5), models.BoostParams(leaves=1)):
        flat = places + layout.starts[:-1]
        together = boosting.grow_all(flat, sums, layout, allowed, params)
        assert (len(together[3][0].n) == 1) and (params.leaves == 1 or len({len(tree.n) for tree, _ in together}) > 1)
        for (tree, value), s, a in zip(together, sums, allowed):
            alone, expected = boosting.grow(flat, s, layout, a, params)
            assert (tree.feature, tree.left, tree.right, tree.value, tree.gain) == (alone.feature, alone.left, alone.right, alone.value, alone.gain)
            assert np.array_equal(tree.goes_left, alone.goes_left) and np.array_equal(value, expected)
            used = {f for f in tree.feature if f >= 0}
            assert used <= set(np.flatnonzero(a)) and tree.feature.count(-1) <= params.leaves


def test_split_keeps_its_limits():
    places, counts = _cells(3)
    layout = boosting._Layout(SIZES)
    sums = np.stack([counts[:, 0] - 3, counts.sum(1) * 0.2, counts.sum(1)])
    hist = np.stack([np.bincount((places + layout.starts[:-1]).ravel(), np.repeat(s, 4), layout.width) for s in sums])
    everything = np.ones(4, bool)
    free = boosting.best_split(hist, layout, everything, models.BoostParams(min_leaf=1))
    assert free[0] > boosting.best_split(hist, layout, everything, models.BoostParams(min_leaf=1, l1=2.0))[0]
    assert free[0] > boosting.best_split(hist, layout, everything, models.BoostParams(min_leaf=1, l2=50.0))[0]
    only = boosting.best_split(hist, layout, np.array([False, False, False, True]), models.BoostParams(min_leaf=1))
    assert only[1] == 3 and only[0] <= free[0]
    assert boosting.best_split(hist, layout, everything, models.BoostParams(min_leaf=10**6))[0] == -np.inf


def _loss_of_prefixes(fit, places, held_out, weight):
    """Held-out losses of the first 1, 2, ... rounds, by walking the trees cell by cell."""
    layout, scores, out = boosting._Layout(SIZES), np.zeros(held_out.shape), []
    for trees in fit.trees:
        for c, tree in enumerate(trees):
            for i, place in enumerate(places + layout.starts[:-1]):
                node = 0
                while tree.feature[node] >= 0:
                    node = tree.left[node] if tree.goes_left[node][place[tree.feature[node]]] else tree.right[node]
                scores[i, c] += tree.value[node]
        p = np.exp(scores) / np.exp(scores).sum(1, keepdims=True)
        out.append(-(held_out * weight * np.log(p)).sum() / (held_out * weight).sum())
    return out


def test_patience_goes_past_plateaus_and_keeps_the_best_prefix():
    places, counts = _cells(1, 140)
    held_out = np.random.default_rng(2).binomial(counts.astype(int), 0.4).astype(float)
    train = counts - held_out
    # A tree sees one feature, so that rounds without the telling ones bring nothing or harm.
    params = models.BoostParams(rounds=120, leaves=6, min_leaf=3, step=0.4, feature_share=0.25, patience=0)
    whole = boosting.boost(places, SIZES, train, held_out, params, 7)
    assert whole.kept == len(whole.losses) == 120
    weight = train.sum() / (3 * train.sum(0))
    assert np.allclose(whole.losses, _loss_of_prefixes(whole, places, held_out, weight))
    kept = {}
    for patience in (1, 3, 8, 20):
        fit = boosting.boost(places, SIZES, train, held_out, models.BoostParams(**{**vars(params), "patience": patience}), 7)
        best, since, expected = np.inf, 0, 0
        for number, loss in enumerate(whole.losses, 1):
            best, since, expected = (loss, 0, number) if loss < best else (best, since + 1, expected)
            if since == patience:
                break
        assert (fit.kept, len(fit.trees), len(fit.losses)) == (expected, expected, number)
        assert fit.losses == whole.losses[:number] and fit.kept == np.argmin(fit.losses) + 1
        kept[patience] = fit.kept
    assert kept[1] < kept[20]  # there was a plateau, and it was passed


def test_resampling_and_seeds():
    places, counts = _cells(5, 100)
    nothing = np.zeros_like(counts)
    params = models.BoostParams(rounds=6, min_leaf=2, row_share=0.5, resample=2, feature_share=0.5)
    values = lambda seed, p=params: [t.value for trees in boosting.boost(places, SIZES, counts, nothing, p, seed).trees for t in trees]
    assert values(1) == values(1) != values(2)
    assert values(1, models.BoostParams(rounds=6, min_leaf=2)) == values(2, models.BoostParams(rounds=6, min_leaf=2))
    longer = values(1, models.BoostParams(**{**vars(params), "rounds": 9}))
    assert longer[: 6 * 3] == values(1)
    one = boosting.boost(places, SIZES, counts * [1, 0, 0], nothing, params, 1)
    assert one.kept == 6


def test_bins(spark):
    schema = "total_floor_area_sqm double, construction_age_band string, main_fuel string, wall_type string, target string"
    areas = [None, float("nan"), -1.0, 0.1, *[float(i) for i in range(1, 2000)], 1e9]
    table = spark.createDataFrame([(a, K.AGE_LABELS[0], "Gas", None, "D") for a in areas] + [(5.0, "Stone Age", None, "x", "C")], schema)
    bins = boosting.learn_bins(table)
    assert bins.classes == ("C", "D") and bins.categories[1:] == (("Gas",), ("x",)) and len(bins.edges) == 254
    cells = bins.cell(table, "c").select("total_floor_area_sqm", "c").collect()
    by_area = {}
    for area, cell in cells:
        by_area.setdefault(int(bins.of_cells(np.array([cell]))[0][0]), []).append(area)
    assert set(by_area[255]) == {None} | {a for a in by_area[255] if a is not None and np.isnan(a)} and len(by_area[255]) == 2
    assert max(map(len, by_area.values())) <= 10
    shares = bins.cell(table, "c").filter("construction_age_band = 'Stone Age'").first().c
    assert bins.of_cells(np.array([shares]))[0].tolist()[1:] == [len(K.AGE_LABELS), 1, 0]
    counted = boosting.count_cells(table, bins, F.lit(0))
    assert counted.select(F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] == table.count()
    many = spark.range(300).select(*[F.lit(None).cast("string").alias(c) for c in ("construction_age_band", "main_fuel")], F.lit(1.0).alias("total_floor_area_sqm"), F.concat(F.lit("w"), "id").alias("wall_type"), F.lit("D").alias("target"))
    with pytest.raises(ValueError, match="wall_type"):
        boosting.learn_bins(many)


def test_comparison_and_search(spark, rows):
    folded = features.fold_features(rows, k=2)
    result = models.cross_validate("forest", models.forest_trainer(models.ForestParams(3, 4, 5)), folded, k=2)
    assert 0 < result.macro_f1 <= 1 and result.seconds > 0
    worse = models.CrossValidation("none", 0.1, 0.0, 0.2, 1.0)
    assert [r.model for r in models.comparison(spark, [worse, result]).collect()] == ["forest", "none"]

    assert models.draw_boost_params(3) == models.draw_boost_params(3)
    drawn = models.draw_boost_params(50)
    assert all(3 <= p.depth <= 12 and 0.005 <= p.step <= 0.301 and 15 <= p.leaves <= 300 and 0 <= p.min_gain <= 0.5 for p in drawn)
    assert all(0.4 <= p.feature_share <= 1 and 1 <= p.resample <= 10 and 1e-8 <= p.l1 <= 10 and 1e-8 <= p.l2 <= 10 for p in drawn)
    trials = [models.Trial(i, models.BoostParams(), f, pruned=f == 0.6) for i, f in enumerate((0.2, 0.6, 0.5, 0.4))]
    assert models.best_trial(trials).number == 2
    table = models.trial_table(spark, trials)
    history = running_max(table, "trial", "finished_f1", "best").orderBy("trial")
    assert [r.best for r in history.collect()] == [0.2, 0.2, 0.5, 0.5] and len(table.columns) == 5 + 11


def test_scores_of_confusion(spark):
    pairs = [("A", "A", 5), ("A", "B", 2), ("B", "B", 1), ("C", "A", 4)]
    table = spark.createDataFrame(pairs, "actual string, predicted string, n long")
    expected = metrics.accuracy_macro_f1(table).first()
    matrix = [5, 2, 0, 0, 0, 1, 0, 0, 4, 0, 0, 0, 0, 0, 0, 0]  # D does not occur
    assert models.scores_of_confusion(matrix) == (pytest.approx(expected.accuracy), pytest.approx(expected.macro_f1))


def test_search_prunes_and_finishes_as_without_rungs(spark, rows, monkeypatch):
    monkeypatch.setattr(models, "LEAST_TRIALS", 3)
    folded = features.fold_features(rows.filter(~F.col("is_test")), k=2)
    good = [models.BoostParams(rounds=r, leaves=8, min_leaf=4, step=0.3, patience=3) for r in (8, 6, 2)]
    hopeless = models.BoostParams(rounds=9, leaves=2, min_leaf=300, step=1e-4)
    found = models.search(folded, [hopeless, *good], k=2, rungs=(2, 4))
    assert [t.number for t in found] == [0, 1, 2, 3] and found[0].pruned and found[0].macro_f1 < min(t.macro_f1 for t in found[1:])
    assert not any(t.pruned for t in found[1:]) and found[3].rounds <= 2
    plain = models.search(folded, good, k=2, rungs=())
    assert [(t.macro_f1, t.rounds) for t in found[1:]] == [(t.macro_f1, t.rounds) for t in plain]
    monkeypatch.setattr(models, "LEAST_TRIALS", 10)
    assert not any(t.pruned for t in models.search(folded, [hopeless, *good], k=2, rungs=(2,)))
    result = models.cross_validate_boosted("b", models.BoostParams(rounds=3, min_leaf=4), folded, k=2)
    assert 0.5 < result.accuracy <= 1 and 0 < result.macro_f1 <= 1


def test_search_takes_every_training_row(spark, rows, monkeypatch):
    train = rows.filter(~F.col("is_test"))
    tried = [models.BoostParams(rounds=r, leaves=8, min_leaf=4, step=0.3) for r in (3, 5)]
    counted, count_cells = [], models.count_cells
    monkeypatch.setattr(models, "count_cells", lambda folded, *how: counted.append(folded) or count_cells(folded, *how))
    monkeypatch.setattr(models, "draw_boost_params", lambda trials: tried)
    monkeypatch.setattr(queries_models, "_split", lambda *_: (train, rows.filter("is_test")))
    monkeypatch.setattr(queries_models, "_searches", {})
    monkeypatch.setattr(features, "TUNE_ROWS", 200)
    got = queries_models.QUERIES["hyperparameter_search"][0](spark, "every row").orderBy("trial").collect()
    whole = features.fold_features(train)
    assert sorted(counted[0].select("certificate_id", "fold").collect()) == sorted(whole.select("certificate_id", "fold").collect())
    assert [(r.macro_f1, r.rounds_kept) for r in got] == [(t.macro_f1, t.rounds) for t in models.search(whole, tried)]


@pytest.mark.parametrize("batch", [3, 10_000])
def test_fits_see_the_cells_of_all_partitions_and_batches(spark, rows, batch):
    folded = features.fold_features(rows)
    bins = boosting.learn_bins(folded)
    cells = boosting.count_cells(folded, bins, F.col("fold"))
    params = [models.BoostParams(rounds=3, leaves=5, min_leaf=4, row_share=0.7, resample=1), models.BoostParams(rounds=2)]
    wanted = [boosting.Job(p, held_out) for p in params for held_out in (None, 0, 2)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        fitted = boosting.fit_jobs(cells.repartition(7), bins, wanted).orderBy("model").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [r.model for r in fitted] == list(range(len(wanted)))
    numbers = sorted({r.cell for r in cells.collect()})
    for row, job in zip(fitted, wanted):
        counts = np.zeros((2, len(numbers), len(bins.classes)))
        for r in cells.collect():
            counts[int(r.fold == job.held_out), numbers.index(r.cell)] += r.n
        alone = boosting.boost(bins.of_cells(np.array(numbers)), bins.sizes, *counts, job.params, job.seed)
        assert (row.kept, row.losses, row.confusion) == (alone.kept, alone.losses, alone.confusion.ravel().tolist())
        assert bytes(row.trees) == boosting._packed(alone)


def test_class_weights(spark):
    frame = spark.createDataFrame([("D",)] * 6 + [("A",)] * 2, "target string")
    got = {r.target: r.weight for r in features.class_weights(frame).collect()}
    assert got == {"D": pytest.approx(8 / (2 * 6)), "A": pytest.approx(8 / (2 * 2))}


def test_more_categories_than_bins(spark, rows):
    many = rows.withColumn("wall_type", F.concat(F.lit("wall "), (F.hash("certificate_id") % 60).cast("string")))
    model = models.fit_boosted(many, models.BoostParams(rounds=2, depth=2))
    assert models.score_boosted(model, many).count() == many.count()


def test_tune_then_score(spark, rows, tmp_path):
    path = new_work_dir(spark, "tuned")
    about = models.tune(rows, path, subset=400, trials=2, max_rounds=3, k=2, sizes=(4, 2))
    assert about["tuned_rows"] == 400 and len(about["compared"]) == 3 and len(about["trials"]) == 2
    best = next(t for t in about["trials"] if t["step"] == about["parameters"]["step"])
    assert best["macro_f1"] == max(t["macro_f1"] for t in about["trials"]) and about["rounds_kept"] == best["rounds_kept"]
    saved = json.loads(spark.read.text(f"{path}-about").first().value)
    assert saved == json.loads(json.dumps(about)) and saved["bands"] == list(K.BANDS)
    model = models.load_model(path)
    assert model.nodes.agg(F.max("round") + 1).first()[0] == max(about["rounds_kept"], 1)
    test, out = str(tmp_path / "test"), str(tmp_path / "out")
    rows.filter("is_test").write.parquet(test)
    assert jobs.main(["score", path, test, out]) == 0
    assert models.scores_of(spark.read.parquet(out))[0] == pytest.approx(about["accuracy"])
    with pytest.raises(Exception):
        models.load_model(str(tmp_path / "nothing"))


class _Asked(Exception):
    pass


def test_registered_models_have_full_sizes(spark, rows, monkeypatch):
    split = rows.withColumn("is_test", F.col("certificate_id").endswith("7"))
    monkeypatch.setattr(queries_models, "_split", lambda *_: (split.filter("not is_test"), split.filter("is_test")))
    run = lambda name: queries_models.QUERIES[name][0](spark, "")
    asked = []

    def forest(self, *_):
        asked.append((self.getNumTrees(), self.getMaxDepth(), self.getMinInstancesPerNode()))
        raise _Asked

    def fit_jobs(cells, bins, wanted):
        asked.extend((j.params.rounds, j.params.patience, j.held_out) for j in wanted)
        raise _Asked

    monkeypatch.setattr(models.RandomForestClassifier, "_fit", forest)
    monkeypatch.setattr(boosting, "fit_jobs", fit_jobs)
    for name in ("random_forest", "ml_importance", "split_importance", "model_save_load", "boosted_trees"):
        with pytest.raises(_Asked):
            run(name)
    assert asked == [(300, 12, 20)] * 4 + [(200, 20, 1)]

    asked.clear()

    def cross_validate(name, train, folded, k=features.FOLDS):
        asked.append((name, k, sorted(r.fold for r in folded.select("fold").distinct().collect())))
        return models.CrossValidation(name, 0.5, 0.0, 0.5, 1.0)

    monkeypatch.setattr(models, "cross_validate", cross_validate)
    boosted = lambda name, params, folded, k=features.FOLDS: cross_validate((name, params.rounds), None, folded, k)
    monkeypatch.setattr(models, "cross_validate_boosted", boosted)
    monkeypatch.setattr(models, "comparison", lambda spark, results: spark.createDataFrame([(0.0,)] * len(results), "cv_seconds double"))
    assert run("kfold_cv").count() == 3
    assert sorted(asked, key=str) == sorted([(name, 3, [0, 1, 2]) for name in ("random forest", ("boosted trees", 200), ("leaf-wise boosted trees", 200))], key=str)
    seen = []
    monkeypatch.setattr(models, "search", lambda folded, tried, k=features.FOLDS: seen.append((k, tried)) or [models.Trial(i, p, 0.1) for i, p in enumerate(tried)])
    assert run("hyperparameter_search").count() == 30
    assert seen[0][0] == 3 and max(p.rounds for p in seen[0][1]) > 200
