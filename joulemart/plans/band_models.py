"""Training, tuning and scoring of band predictors with ``pyspark.ml``."""

from __future__ import annotations

import json
import random
import statistics
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import IndexToString, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joulemart import constants as K
from joulemart.functions.labels import feature_text
from joulemart.operators.metrics import accuracy_macro_f1, pair_counts
from joulemart.operators.ranking import top_k
from joulemart.operators.sampling import stratified_exact
from joulemart.operators.shares import share_of_total
from joulemart.plans.band_features import FOLDS, SEED, fold_features, with_class_weight
from joulemart.plans.cell_forest import RandomForestClassifier
from joulemart.plans.softmax_boost import (
    BoostedModel, BoostParams, Job, count_cells, fit_boosted, fit_jobs, learn_bins, load_boosted, node_importance, score_boosted,
)
from joulemart.session import new_work_dir

CATEGORIES = ("main_fuel", "wall_type")
# Bins of a feature in a forest.
MAX_BINS = 32


def _age_stage() -> SQLTransformer:
    """Age as its fixed ordinal, 8 when unknown (not by frequency)."""
    ages = ", ".join(f"'{a}'" for a in K.AGE_LABELS)
    unknown = len(K.AGE_LABELS) + 1
    position = f"coalesce(nullif(array_position(array({ages}), construction_age_band), 0), {unknown})"
    return SQLTransformer(statement=f"SELECT *, cast({position} - 1 AS double) AS age_order FROM __THIS__")


def _category_stages() -> list[StringIndexer]:
    """Alphabetical codes; an unseen category gets a code of its own."""
    return [
        StringIndexer(inputCol=c, outputCol=f"{c}_code", handleInvalid="keep", stringOrderType="alphabetAsc")
        for c in CATEGORIES
    ]


def one_hot_stages() -> list:
    """Floor area, age ordinal, one-hot fuel and wall; unseen values are all 0."""
    hot = OneHotEncoder(
        inputCols=[f"{c}_code" for c in CATEGORIES], outputCols=[f"{c}_hot" for c in CATEGORIES], dropLast=True
    )
    columns = ["total_floor_area_sqm", "age_order", *[f"{c}_hot" for c in CATEGORIES]]
    return [_age_stage(), *_category_stages(), hot, VectorAssembler(inputCols=columns, outputCol="features")]


def label_stage() -> StringIndexer:
    return StringIndexer(inputCol="target", outputCol="label", stringOrderType="alphabetAsc")


@dataclass(frozen=True)
class ForestParams:
    trees: int = 300
    depth: int = 12
    min_leaf: int = 20
    subsample: float = 1.0


def fit_forest(train: DataFrame, params: ForestParams = ForestParams(), seed: int = SEED) -> PipelineModel:
    """Encoding and a class-balanced random forest as one model.

    Scoring needs the feature columns only: the label is indexed beforehand
    and its names are kept in the last stage. Trees are grown over counts of
    binned rows (see cell_forest).
    """
    labels = label_stage().fit(train)
    forest = RandomForestClassifier(
        numTrees=params.trees,
        maxDepth=params.depth,
        minInstancesPerNode=params.min_leaf,
        subsamplingRate=params.subsample,
        featureSubsetStrategy="sqrt",
        weightCol="weight",
        maxBins=MAX_BINS,
        seed=seed,
    )
    name = IndexToString(inputCol="prediction", outputCol="predicted", labels=labels.labels)
    rows = labels.transform(with_class_weight(train))
    return Pipeline(stages=[*one_hot_stages(), forest, name]).fit(rows)


def score_forest(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add ``predicted`` and ``probabilities``; unseen categories are tolerated."""
    scored = model.transform(rows).withColumn("probabilities", vector_to_array("probability"))
    return scored.select(*rows.columns, "predicted", "probabilities")


Model = PipelineModel | BoostedModel


def score(model: Model, rows: DataFrame) -> DataFrame:
    """Add ``predicted`` and ``probabilities``, whichever kind of model it is."""
    return score_boosted(model, rows) if isinstance(model, BoostedModel) else score_forest(model, rows)


def save_model(model: Model, path: str, about: dict | None = None) -> None:
    """Save a model and, beside it in ``path``-about, what was chosen and measured, as one JSON row."""
    if isinstance(model, BoostedModel):
        model.save(path)
    else:
        model.write().overwrite().save(path)
    if about is not None:
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(about, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}-about")


def load_model(path: str) -> Model:
    """A saved model of either kind; ensembles of boosted trees say so in a folder of that name."""
    try:
        return load_boosted(SparkSession.getActiveSession(), path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return PipelineModel.load(path)


def scores_of(predictions: DataFrame) -> tuple[float, float]:
    """Accuracy and macro F1 of predictions, as numbers."""
    row = accuracy_macro_f1(pair_counts(predictions, "target", "predicted")).first()
    return row.accuracy, row.macro_f1


Trainer = Callable[[DataFrame], Callable[[DataFrame], DataFrame]]


def forest_trainer(params: ForestParams = ForestParams(100, 10, 1)) -> Trainer:
    def train(rows: DataFrame) -> Callable[[DataFrame], DataFrame]:
        model = fit_forest(rows, params)
        return lambda test: score_forest(model, test)

    return train


@dataclass(frozen=True)
class CrossValidation:
    model: str
    macro_f1: float
    f1_std: float
    accuracy: float
    seconds: float


def cross_validate(name: str, train: Trainer, folded: DataFrame, k: int = FOLDS) -> CrossValidation:
    """Mean scores over ``k`` folds of rows that carry a ``fold`` column.

    The driver loops over folds; fitting and scoring run on the cluster.
    """
    started = time.time()
    results = []
    for fold in range(k):
        predict = train(folded.filter(F.col("fold") != fold))
        results.append(scores_of(predict(folded.filter(F.col("fold") == fold))))
    accuracies, f1s = zip(*results)
    return CrossValidation(
        name, statistics.fmean(f1s), statistics.pstdev(f1s), statistics.fmean(accuracies), time.time() - started
    )


def scores_of_confusion(counts: Sequence[int]) -> tuple[float, float]:
    """Accuracy and macro F1 of a square matrix of counts, row by row, over the classes that occur."""
    matrix = np.array(counts, float).reshape(2 * [round(len(counts) ** 0.5)])
    hits, both = np.diag(matrix), matrix.sum(0) + matrix.sum(1)
    return float(hits.sum() / max(matrix.sum(), 1.0)), float((2 * hits[both > 0] / both[both > 0]).mean()) if both.any() else 0.0


def cross_validate_boosted(name: str, params: BoostParams, folded: DataFrame, k: int = FOLDS) -> CrossValidation:
    """Mean scores of boosted trees with all their rounds; the folds are fitted side by side."""
    started = time.time()
    bins = learn_bins(folded)
    jobs = [Job(replace(params, patience=0), fold) for fold in range(k)]
    fitted = fit_jobs(count_cells(folded, bins, F.col("fold")), bins, jobs).select("confusion").collect()
    accuracies, f1s = zip(*(scores_of_confusion(r.confusion) for r in fitted))
    return CrossValidation(
        name, statistics.fmean(f1s), statistics.pstdev(f1s), statistics.fmean(accuracies), time.time() - started
    )


def comparison(spark: SparkSession, results: Sequence[CrossValidation]) -> DataFrame:
    """Candidates by macro F1, best first; one row per candidate."""
    rows = [
        (r.model, round(r.macro_f1, 4), round(r.f1_std, 4), round(r.accuracy, 4), round(r.seconds, 1))
        for r in results
    ]
    schema = "model string, macro_f1 double, f1_std double, accuracy double, cv_seconds double"
    return spark.createDataFrame(rows, schema).orderBy(F.desc("macro_f1"), "model")


def draw_boost_params(trials: int, seed: int = SEED, max_rounds: int = 400) -> list[BoostParams]:
    """Seeded random draws of eleven parameters; scale-free values log-uniformly."""
    rng = random.Random(seed)
    return [
        BoostParams(
            leaves=rng.randint(15, 300),
            depth=rng.randint(3, 12),
            min_leaf=rng.randint(10, 200),
            rounds=rng.randint(min(100, max_rounds), max_rounds),
            step=10 ** rng.uniform(-2.3, -0.523),
            feature_share=rng.uniform(0.4, 1.0),
            row_share=rng.uniform(0.4, 1.0),
            resample=rng.randint(1, 10),
            l1=10 ** rng.uniform(-8, 1),
            l2=10 ** rng.uniform(-8, 1),
            min_gain=rng.uniform(0.0, 0.5),
        )
        for _ in range(trials)
    ]


@dataclass(frozen=True)
class Trial:
    """A tried parameter set: its mean macro F1 over folds, and the mean number of rounds its fits kept.

    A pruned trial was given up; its score is that of the rounds it had, and no result.
    """

    number: int
    params: BoostParams
    macro_f1: float
    rounds: int = 0
    pruned: bool = False


#: Rounds after which trials are compared, and the fewest trials among which one is pruned.
RUNGS = (10, 40)
LEAST_TRIALS = 10


def search(folded: DataFrame, candidates: Sequence[BoostParams], k: int = FOLDS, rungs: Sequence[int] = RUNGS) -> list[Trial]:
    """Cross-validated macro F1 of each candidate, with early stopping and median pruning.

    All folds of all candidates are fitted side by side, up to the first rung of rounds, then to the next,
    at last to their own number of rounds. At a rung, candidates that score below the median of those
    that came there are pruned, if those are LEAST_TRIALS or more. A fit whose held-out fold has
    stopped it is done and not repeated; others start anew, as the same seed gives them the same rounds.
    """
    bins = learn_bins(folded)
    cells = count_cells(folded, bins, F.col("fold"))
    done: dict[int, Trial] = {}
    alive = list(range(len(candidates)))
    for rung in (*rungs, None):
        limits = {n: candidates[n].rounds if rung is None else min(rung, candidates[n].rounds) for n in alive}
        jobs = [(n, Job(replace(candidates[n], rounds=limits[n]), fold)) for n in alive for fold in range(k)]
        if not jobs:
            break
        fitted = fit_jobs(cells, bins, [job for _, job in jobs]).select("model", "kept", "rounds", "confusion").collect()
        reports: dict[int, list] = {n: [] for n in alive}
        for row in fitted:
            reports[jobs[row.model][0]].append(row)
        tried = {
            n: Trial(n, candidates[n], statistics.fmean(scores_of_confusion(r.confusion)[1] for r in rows), round(statistics.fmean(r.kept for r in rows)))
            for n, rows in reports.items()
        }
        median = statistics.median(t.macro_f1 for t in tried.values())
        for n, trial in tried.items():
            if limits[n] == candidates[n].rounds or all(r.rounds < limits[n] for r in reports[n]):
                done[n] = trial
            elif len(tried) >= LEAST_TRIALS and trial.macro_f1 < median:
                done[n] = replace(trial, pruned=True)
        alive = [n for n in alive if n not in done]
    return [done[n] for n in sorted(done)]


def best_trial(trials: Sequence[Trial]) -> Trial:
    """The best of the trials that were not pruned, the first among equals."""
    return max((t for t in trials if not t.pruned), key=lambda t: t.macro_f1)


def tuning_folds(train: DataFrame, subset: int, k: int = FOLDS) -> DataFrame:
    """An exact stratified subset of the training rows with their folds, written."""
    folder = new_work_dir(train.sparkSession, "tuning")
    fold_features(stratified_exact(train, "target", "certificate_id", subset, SEED), k).write.parquet(folder)
    return train.sparkSession.read.parquet(folder)


def compare(folded: DataFrame, k: int = FOLDS, sizes: tuple[int, int] = (100, 200)) -> list[CrossValidation]:
    """The three candidates, side by side; ``sizes`` are the trees of the forest and the rounds of both boosters."""
    trees, rounds = sizes
    candidates = [
        lambda: cross_validate("random forest", forest_trainer(ForestParams(trees, 10, 1)), folded, k),
        lambda: cross_validate_boosted("boosted trees", BoostParams(rounds, leaves=31, depth=8), folded, k),
        lambda: cross_validate_boosted("leaf-wise boosted trees", BoostParams(rounds, leaves=63), folded, k),
    ]
    with ThreadPoolExecutor(len(candidates)) as pool:
        running = [pool.submit(run) for run in candidates]
    return [r.result() for r in running]


def tune(split: DataFrame, path: str, subset: int, trials: int, max_rounds: int = 400, k: int = FOLDS, sizes: tuple[int, int] = (100, 200)) -> dict:
    """Compare candidates and search parameters on an exact stratified subset, refit on all, evaluate, save.

    ``split`` has ``is_test`` and must be a written table. ``subset`` bounds the labelled rows that are tried
    many times; the best parameters are fitted on every training row, with the rounds that the search kept. ``sizes`` are the trees of the forest and the rounds of
    both boosters that are compared. The result is also saved beside the model.
    """
    train = split.filter(~F.col("is_test"))
    folded = tuning_folds(train, subset, k)
    compared = compare(folded, k, sizes)
    tried = search(folded, draw_boost_params(trials, max_rounds=max_rounds), k)
    best = best_trial(tried)
    model = fit_boosted(train, replace(best.params, rounds=max(best.rounds, 1)))
    accuracy, macro_f1 = scores_of(score(model, split.filter("is_test")))
    about = {
        "accuracy": accuracy, "macro_f1": macro_f1, "bands": list(K.BANDS), "features": feature_names(model),
        "compared": [asdict(c) for c in compared], "parameters": asdict(best.params), "tuned_rows": folded.count(),
        "rounds_kept": best.rounds,
        "trials": [{"number": t.number, "macro_f1": t.macro_f1, "pruned": t.pruned, "rounds_kept": t.rounds, **asdict(t.params)} for t in tried],
    }
    save_model(model, path, about)
    return about


def trial_table(spark: SparkSession, trials: Sequence[Trial]) -> DataFrame:
    """One row per trial with its parameters; ``finished_f1`` is null for pruned ones.

    Feed it to ``ranking.running_max`` for best-so-far.
    """
    names = [n for n in asdict(BoostParams()) if n != "patience"]
    rows = [(t.number, t.pruned, t.rounds, t.macro_f1, None if t.pruned else t.macro_f1, *[asdict(t.params)[n] for n in names]) for t in trials]
    kinds = ", ".join(f"{n} {'double' if isinstance(v, float) else 'int'}" for n, v in asdict(BoostParams()).items() if n in names)
    return spark.createDataFrame(rows, f"trial int, pruned boolean, rounds_kept int, macro_f1 double, finished_f1 double, {kinds}")


def feature_names(model: Model) -> list[str]:
    """Names of the features, one-hot positions of a forest by their category."""
    if isinstance(model, BoostedModel):
        return ["floor_area_sqm", "construction_age_band", *CATEGORIES]
    indexers = {s.getInputCol(): s.labels for s in model.stages if hasattr(s, "labels") and s.hasParam("stringOrderType")}
    hot = [f"{c}_{value}" for c in CATEGORIES for value in indexers[c]]
    return ["floor_area_sqm", "construction_age_band", *hot]


def _forest_stage(model: PipelineModel) -> tuple[int, RandomForestClassificationModel]:
    return next((i, s) for i, s in enumerate(model.stages) if isinstance(s, RandomForestClassificationModel))


def importance(spark: SparkSession, model: Model, k: int = 20) -> DataFrame:
    """The ``k`` features with the largest gain, and their share; one row per feature of the model."""
    if isinstance(model, BoostedModel):
        gains = node_importance(model)
        whole = gains.agg(F.sum("gain")).scalar()
        table = gains.select("feature", F.coalesce(F.col("gain") / F.nullif(whole, F.lit(0.0)), F.lit(0.0)).alias("importance"))
    else:
        gains = _forest_stage(model)[1].featureImportances
        table = spark.createDataFrame([(name, float(gains[i])) for i, name in enumerate(feature_names(model))], "feature string, importance double")
    shares = table.withColumn("pct", share_of_total(F.col("importance"), 1))
    cleaned = shares.withColumn("feature", feature_text(F.col("feature")))
    return top_k(cleaned, k, F.desc("importance"), F.asc("feature"))


def saved_nodes(spark: SparkSession, model: PipelineModel, path: str) -> DataFrame:
    """(tree, node, feature, gain): the nodes of a saved forest as rows, feature null for leaves."""
    place, stage = _forest_stage(model)
    places = f"{place:0{len(str(len(model.stages)))}d}"
    data = spark.read.parquet(f"{path}/stages/{places}_{stage.uid}/data")
    feature = F.when(F.col("nodeData.split.featureIndex") >= 0, F.col("nodeData.split.featureIndex"))
    return data.select(F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"), feature.alias("feature"), F.col("nodeData.gain").alias("gain"))


def split_counts(spark: SparkSession, model: Model, path: str | None = None) -> DataFrame:
    """How often each feature is a decision point, and its share, from the model's node table.

    A forest's nodes are those saved at ``path``; without one, it is saved to the work folder first.
    """
    if isinstance(model, BoostedModel):
        table = node_importance(model).select("feature", "splits")
    else:
        if path is None:
            path = new_work_dir(spark, "forest")
            save_model(model, path)
        names = spark.createDataFrame(list(enumerate(feature_names(model))), "place int, feature string")
        counts = saved_nodes(spark, model, path).filter("feature is not null").groupBy(F.col("feature").alias("place")).agg(F.count("*").alias("splits"))
        table = names.join(counts, "place", "left").select("feature", F.coalesce("splits", F.lit(0)).alias("splits"))
    return table.withColumn("pct", share_of_total(F.col("splits"), 1)).withColumn(
        "feature", feature_text(F.col("feature"))
    )
