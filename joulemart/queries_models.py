"""Registered queries of the band prediction work.

Model fits have full sizes, the defaults of the parameter classes. The search runs
on all training rows, with the folds and trials of the ``tune`` job; the comparison
on the stratified subset of them that the job takes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joulemart import constants as K
from joulemart.operators import metrics
from joulemart.operators.ranking import running_max
from joulemart.operators.sampling import sample_exact, stratified_exact, stratified_subset
from joulemart.oracle import query, rnd
from joulemart.plans import band_features as features
from joulemart.plans import band_models as models
from joulemart.queries_core import raw, star, written_star
from joulemart.session import new_work_dir

#: Trials of the parameter search, as of the ``tune`` job.
TRIALS = 30


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_rows(star(spark, sf_dir, (features.WALLS,)).staged)


def _written(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Training reads its input many times, so it reads a written table."""
    path = new_work_dir(spark, "training")
    rows.write.parquet(path)
    return spark.read.parquet(path)


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = _written(spark, features.split_features(_rows(spark, sf_dir)))
    return rows.filter(~F.col("is_test")), rows.filter("is_test")


def _rule_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current bands against a rule: the band the certificate says is reachable."""
    staged = star(spark, sf_dir).staged.filter(F.col("energy_rating_current").isNotNull())
    return metrics.pair_counts(staged, "energy_rating_current", "energy_rating_potential")


def rule_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.class_report(_rule_pairs(spark, sf_dir))
    return report.withColumns({m: F.round(m, 6) for m in ("precision", "recall", "f1")})


def rule_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = metrics.accuracy_macro_f1(_rule_pairs(spark, sf_dir))
    return scores.select(F.round("accuracy", 6).alias("accuracy"), F.round("macro_f1", 6).alias("macro_f1"))


_forests: dict[tuple[str, str], str] = {}


def _forest(spark: SparkSession, sf_dir: str) -> tuple[models.Model, DataFrame, str]:
    """The forest of a folder of tables, its test rows, and where it is saved; fitted once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _forests:
        train, test = _split(spark, sf_dir)
        path = new_work_dir(spark, "forest")
        test.write.parquet(f"{path}-test")
        models.save_model(models.fit_forest(train), path)
        _forests[key] = path
    path = _forests[key]
    return models.load_model(path), spark.read.parquet(f"{path}-test"), path


def forest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test, _ = _forest(spark, sf_dir)
    return metrics.class_report(metrics.pair_counts(models.score(model, test), "target", "predicted"))


def forest_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.importance(spark, _forest(spark, sf_dir)[0])


def forest_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _, path = _forest(spark, sf_dir)
    return models.split_counts(spark, model, path)


def saved_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion shares of a forest that was saved and loaded before scoring."""
    model, test, _ = _forest(spark, sf_dir)
    return metrics.confusion_shares(metrics.pair_counts(models.score(model, test), "target", "predicted"), K.BANDS)


_ensembles: dict[tuple[str, str], tuple[models.Model, DataFrame]] = {}


def _boosted(spark: SparkSession, sf_dir: str) -> tuple[models.Model, DataFrame]:
    """The boosted ensemble of a folder of tables, stopped by fold 0, and its test rows; fitted once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ensembles:
        train, test = _split(spark, sf_dir)
        marked = features.fold_features(train).withColumn("held_out", F.col("fold") == 0)
        _ensembles[key] = models.fit_boosted(_written(spark, marked), validation="held_out"), test
    return _ensembles[key]


def _supports(scored: DataFrame) -> DataFrame:
    """Scored rows per band, and whether each got a band and probabilities that sum to one."""
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x)
    good = F.col("predicted").isin(*K.BANDS) & (F.abs(total - 1) < 1e-9)
    return scored.groupBy(F.col("target").alias("band")).agg(F.count("*").alias("support"), F.every(good).alias("all_scored"))


def forest_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the saved and loaded forest scored."""
    model, test, _ = _forest(spark, sf_dir)
    return _supports(models.score(model, test))


def forest_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the forest, from its node table and its importances, which are shares of one."""
    model, _, path = _forest(spark, sf_dir)
    gains = models.importance(spark, model, 1000)
    whole = gains.agg(F.abs(F.sum("importance") - 1) < 1e-9).scalar()
    splits = models.split_counts(spark, model, path).select("feature", (F.col("splits") >= 0).alias("counted"))
    return gains.join(splits, "feature").select("feature", (F.col("counted") & whole).alias("known"))


def boosted_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What early-stopped boosting scored, and whether the rounds it kept are the best of those it tried."""
    model, test = _boosted(spark, sf_dir)
    losses, kept = model.about["losses"], model.about["rounds_kept"]
    is_best = losses[kept - 1] == min(losses) and (len(losses) == 200 or len(losses) == kept + 20)
    return _supports(models.score(model, test)).withColumn("best_prefix", F.lit(is_best))


def boosted_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early-stopped boosting: fold 0 of the training rows decides when to stop; with the rounds tried and kept."""
    model, test = _boosted(spark, sf_dir)
    report = metrics.class_report(metrics.pair_counts(models.score(model, test), "target", "predicted"))
    return report.withColumns({n: F.lit(model.about[n]) for n in ("rounds_tried", "rounds_kept")})


def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _split(spark, sf_dir)
    results = models.compare(models.tuning_folds(train, features.TUNE_ROWS))
    return models.comparison(spark, results).drop("cv_seconds")


_searches: dict[tuple[str, str], list[models.Trial]] = {}


def _searched(spark: SparkSession, sf_dir: str) -> list[models.Trial]:
    """All random trials, over every training row, made once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _searches:
        train, _ = _split(spark, sf_dir)
        _searches[key] = models.search(_written(spark, features.fold_features(train)), models.draw_boost_params(TRIALS))
    return _searches[key]


def search_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All random trials, pruned ones marked, and the best finished score so far."""
    table = models.trial_table(spark, _searched(spark, sf_dir))
    return table.join(running_max(table, "trial", "finished_f1", "best_so_far").drop("finished_f1"), "trial")


def search_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each trial's parameters are in their ranges, and what it reports fits its end."""
    ranges = {
        "leaves": (15, 300), "depth": (3, 12), "min_leaf": (10, 200), "rounds": (100, 400), "step": (0.005, 0.3), "feature_share": (0.4, 1.0),
        "row_share": (0.4, 1.0), "resample": (1, 10), "l1": (1e-8, 10.0), "l2": (1e-8, 10.0), "min_gain": (0.0, 0.5),
    }
    table = search_history(spark, sf_dir)
    fits = (F.col("pruned") == F.col("finished_f1").isNull()) & F.col("macro_f1").between(0, 1) & (F.col("rounds_kept") <= F.col("rounds"))
    ahead = F.coalesce(F.col("finished_f1") <= F.col("best_so_far"), F.lit(True))
    in_ranges = F.forall(F.array(*[F.col(name).between(low, high) for name, (low, high) in ranges.items()]), lambda x: x)
    return table.select("trial", in_ranges.alias("in_ranges"), (fits & ahead).alias("consistent"))


_RULE = """
with pairs as (select energy_rating_current as actual, energy_rating_potential as predicted from stg
  where energy_rating_current is not null),
bands as (select unnest(['A', 'B', 'C', 'D', 'E', 'F', 'G']) as band),
tally as (select band,
    (select count(*) from pairs where actual = band and predicted = band) as hits,
    (select count(*) from pairs where actual = band) as support,
    (select count(*) from pairs where predicted = band) as guessed
  from bands),
scores as (select band, support, hits,
    coalesce(cast(hits as double) / nullif(guessed, 0), 0) as p,
    coalesce(cast(hits as double) / nullif(support, 0), 0) as r,
    coalesce(cast(2 * hits as double) / nullif(guessed + support, 0), 0) as f
  from tally where support + guessed > 0)
"""


def _rank_sql(keep: str) -> str:
    return f"""
select {keep} from (
  select certificate_id, target,
    row_number() over (partition by target order by md5('42:' || certificate_id), certificate_id) - 1 as place,
    count(*) over (partition by target) as whole
  from features) r
"""


# name -> (DataFrame query, SQL to check it against)
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "ml_features": (_rows, query("select * from features", "features")),
    "staging_raw_join": (
        lambda spark, d: features.feature_rows_by_join(star(spark, d).staged, raw(spark, d)),
        query("select * from features", "features"),
    ),
    "reservoir_exact_n": (
        lambda spark, d: sample_exact(written_star(spark, d).facts.select("certificate_id"), "certificate_id", 500, 42),
        query("select certificate_id from facts order by md5('42:' || certificate_id), certificate_id limit 500", "facts"),
    ),
    "subquery_then_sample": (
        lambda spark, d: features.sampled_features(written_star(spark, d, (features.WALLS,)).staged, 1000, 99),
        query(
            "select * from features order by md5('99:' || certificate_id), certificate_id limit 1000", "features"
        ),
    ),
    "ml_split": (
        lambda spark, d: features.split_features(_rows(spark, d)).select("certificate_id", "target", "is_test"),
        query(_rank_sql("certificate_id, target, place < round(whole * 0.2) as is_test"), "features"),
    ),
    "stratified_subset": (
        lambda spark, d: stratified_subset(_rows(spark, d), "target", "certificate_id", 0.15, 42).select("certificate_id"),
        query(_rank_sql("certificate_id") + " where place < round(whole * cast(0.15 as double))", "features"),
    ),
    "stratified_exact_subset": (
        lambda spark, d: stratified_exact(
            features.feature_rows(written_star(spark, d, (features.WALLS,)).staged), "target", "certificate_id", 601, 42
        ).select("certificate_id", "target"),
        query(
            f"""with ranked as ({_rank_sql("certificate_id, target, place, whole")}),
sizes as (select target, count(*) as size, sum(count(*)) over () as rows from features group by 1),
shares as (select target, size * least(601, rows) // rows as base, size * least(601, rows) % rows as rest, least(601, rows) as n from sizes),
quotas as (select target, base + case when row_number() over (order by rest desc, target) <= n - sum(base) over () then 1 else 0 end as quota from shares)
select certificate_id, target from ranked join quotas using (target) where place < quota""",
            "features",
        ),
    ),
    "stratified_kfold": (
        lambda spark, d: features.fold_features(_rows(spark, d)).select("certificate_id", "target", "fold"),
        query(_rank_sql("certificate_id, target, cast(place % 3 as integer) as fold"), "features"),
    ),
    "class_weights": (
        lambda spark, d: features.class_weights(_rows(spark, d)),
        query(
            "select target, cast(count(*) as bigint) as n, cast((select count(*) from features) as double)"
            " / ((select count(distinct target) from features) * count(*)) as weight from features group by 1",
            "features",
        ),
    ),
    "value_counts_sorted": (
        lambda spark, d: _rows(spark, d).groupBy("target").agg(F.count("*").alias("n")).orderBy("target"),
        query("select target, cast(count(*) as bigint) as n from features group by 1", "features"),
    ),
    "ordinal_encode": (
        lambda spark, d: features.encode_ordinal(
            star(spark, d).staged.select("certificate_id", "construction_age_band")
        ),
        query(
            """select certificate_id, construction_age_band, cast(coalesce(list_position(
  ['Pre-1900', '1900-1929', '1930-1949', '1950-1975', '1976-1990', '1991-2002', '2003-2011', '2012-Present'],
  construction_age_band) - 1, 8) as integer) as age_order from stg""",
            "stg",
        ),
    ),
    "ml_report": (
        rule_report,
        query(
            _RULE + """
select band, round(p, 6) as precision, round(r, 6) as recall, round(f, 6) as f1, cast(support as bigint) as support from scores
union all select 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), cast(sum(support) as bigint) from scores
union all select 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f * support) / sum(support), 6), cast(sum(support) as bigint) from scores
union all select 'accuracy', round(cast(sum(hits) as double) / sum(support), 6), round(cast(sum(hits) as double) / sum(support), 6),
  round(cast(sum(hits) as double) / sum(support), 6), cast(sum(support) as bigint) from scores
""",
            "stg",
        ),
    ),
    "accuracy_macro_f1": (
        rule_accuracy,
        query(
            _RULE + "select round(cast(sum(hits) as double) / sum(support), 6) as accuracy, round(avg(f), 6) as macro_f1 from scores",
            "stg",
        ),
    ),
    "ml_confusion": (
        lambda spark, d: metrics.confusion_matrix(_rule_pairs(spark, d), K.BANDS),
        query(
            "select energy_rating_current as actual, "
            + ", ".join(
                f"cast(count(*) filter (where energy_rating_potential = '{b}') as bigint) as pred_{b.lower()}" for b in K.BANDS
            )
            + " from stg where energy_rating_current is not null group by 1",
            "stg",
        ),
    ),
    "row_normalise": (
        lambda spark, d: metrics.confusion_shares(_rule_pairs(spark, d), K.BANDS, 4),
        query(
            "select energy_rating_current as actual, "
            + ", ".join(
                rnd(f"cast(count(*) filter (where energy_rating_potential = '{b}') as double) / count(*) * 100", 4)
                + f" as pct_{b.lower()}"
                for b in K.BANDS
            )
            + " from stg where energy_rating_current is not null group by 1",
            "stg",
        ),
    ),
    "set_union_labels": (
        lambda spark, d: metrics.labels_present(_rule_pairs(spark, d), K.BANDS),
        query(
            """select band, cast(strpos('ABCDEFG', band) as integer) as position from (
  select energy_rating_current as band from stg where energy_rating_current is not null
  union select energy_rating_potential from stg where energy_rating_current is not null) b""",
            "stg",
        ),
    ),
    "naive_baselines": (
        lambda spark, d: metrics.naive_baselines(_rows(spark, d), "target", len(K.BANDS)),
        query(
            """with c as (select target, count(*) as n from features group by 1)
select (select target from c order by n desc, target desc limit 1) as majority_class,
  cast(max(n) as double) / sum(n) as majority_accuracy, cast(1 as double) / 7 as uniform_accuracy from c""",
            "features",
        ),
    ),
    "forest_support": (
        forest_support,
        query(
            f"""select target as band, cast(count(*) as bigint) as support, true as all_scored
from ({_rank_sql("target, place < round(whole * 0.2) as is_test")}) t where is_test group by 1""",
            "features",
        ),
    ),
    "forest_features": (
        forest_features,
        query(
            f"""with train as (select f.* from features f join ({_rank_sql("certificate_id, place < round(whole * 0.2) as is_test")}) t
  on f.certificate_id = t.certificate_id where not is_test)
select feature, true as known from (select 'floor_area_sqm' as feature union all select 'construction_age_band'
  union select concat('Fuel: ', main_fuel) from train union select concat('Wall: ', wall_type) from train) f""",
            "features",
        ),
    ),
    "boosted_support": (
        boosted_support,
        query(
            f"""select target as band, cast(count(*) as bigint) as support, true as all_scored, true as best_prefix
from ({_rank_sql("target, place < round(whole * 0.2) as is_test")}) t where is_test group by 1""",
            "features",
        ),
    ),
    "search_checks": (
        search_checks,
        "select cast(trial as integer) as trial, true as in_ranges, true as consistent from (select unnest(range(30)) as trial) t",
    ),
    "random_forest": (forest_report, None),
    "ml_importance": (forest_importance, None),
    "split_importance": (forest_split_counts, None),
    "model_save_load": (saved_forest, None),
    "boosted_trees": (boosted_report, None),
    "kfold_cv": (model_comparison, None),
    "hyperparameter_search": (search_history, None),
}
