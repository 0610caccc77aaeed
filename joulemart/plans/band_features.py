"""Rows and encodings for band prediction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joulemart import constants as K
from joulemart.functions.labels import ordinal, wall_label
from joulemart.operators.sampling import sample_exact, stratified_folds, stratified_split
from joulemart.plans.staging import lower_case_columns

WALLS = "walls_description"
FEATURES = ["total_floor_area_sqm", "construction_age_band", "main_fuel", "wall_type"]
SAMPLE_ROWS = 500_000
TUNE_ROWS = 60_000
TEST_SHARE = 0.2
FOLDS = 3
SEED = 42


def usable(staged: DataFrame) -> DataFrame:
    """Certificates with a rating, a floor area and known age and fuel."""
    return staged.filter(
        F.col("energy_rating_current").isNotNull()
        & (F.col("total_floor_area_sqm") > 0)
        & (F.col("construction_age_band") != K.UNKNOWN_AGE)
        & (F.col("main_fuel") != K.UNKNOWN_FUEL)
    )


def _project(rows: DataFrame) -> DataFrame:
    lowered = rows.withColumn("walls_lower", F.lower(WALLS))
    return lowered.select(
        "certificate_id",
        F.col("energy_rating_current").alias("target"),
        F.col("total_floor_area_sqm").cast("double").alias("total_floor_area_sqm"),
        "construction_age_band",
        "main_fuel",
        wall_label("walls_lower").alias("wall_type"),
    )


def feature_rows(staged: DataFrame) -> DataFrame:
    """Features of staged rows that carry the wall text along: no join."""
    return _project(usable(staged))


def feature_rows_by_join(staged: DataFrame, raw: DataFrame) -> DataFrame:
    """The same where the wall text is only in the raw table.

    A certificate id that occurs twice in the raw table repeats its row.
    """
    walls = lower_case_columns(raw).select(F.col("lmk_key").alias("certificate_id"), WALLS)
    return _project(usable(staged).drop(WALLS).join(walls, "certificate_id"))


def sampled_features(staged: DataFrame, n: int = SAMPLE_ROWS, seed: int = SEED) -> DataFrame:
    """Exactly ``n`` usable rows: the sample is drawn after the filter."""
    return sample_exact(feature_rows(staged), "certificate_id", n, seed)


def split_features(features: DataFrame, seed: int = SEED) -> DataFrame:
    return stratified_split(features, "target", "certificate_id", TEST_SHARE, seed)


def fold_features(features: DataFrame, k: int = FOLDS, seed: int = SEED) -> DataFrame:
    return stratified_folds(features, "target", "certificate_id", k, seed)


def class_weights(features: DataFrame) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = features.groupBy("target").agg(F.count("*").alias("n"))
    both = counts.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("classes"))).scalar()
    with_total = counts.withColumn("whole", both)
    weight = F.col("whole.rows").cast("double") / (F.col("whole.classes") * F.col("n")).cast("double")
    return with_total.select("target", "n", weight.alias("weight"))


def with_class_weight(features: DataFrame) -> DataFrame:
    """Features plus ``weight``; the weights are one row per class and come as one map value, without a join."""
    entries = F.collect_list(F.struct("target", "weight"))
    by_class = class_weights(features).agg(F.map_from_entries(entries)).scalar()
    return features.withColumn("weight", F.element_at(by_class, F.col("target")))


def encode_ordinal(features: DataFrame) -> DataFrame:
    """Age as 0 (oldest) to 7 (newest), 8 for anything else."""
    return features.withColumn("age_order", ordinal(F.col("construction_age_band"), K.AGE_LABELS))
