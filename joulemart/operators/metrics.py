"""Classification metrics as aggregates over (label, prediction) rows.

Everything is computed from counts per (label, prediction) pair. With seven
bands that is at most 49 rows, however many predictions were counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joulemart.operators.reshape import pivot_fill
from joulemart.operators.shares import share_of_group


def pair_counts(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    return predictions.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def _part(part: Column, whole: Column) -> Column:
    """Ratio that is 0, not undefined, when nothing was counted."""
    return F.coalesce(part.cast("double") / F.nullif(whole, F.lit(0)).cast("double"), F.lit(0.0))


def class_scores(pairs: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every actual or predicted class."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    as_actual = F.struct(F.col("actual").alias("band"), F.col("n").alias("a"), zero.alias("p"), hit.alias("h"))
    as_predicted = F.struct(F.col("predicted").alias("band"), zero.alias("a"), F.col("n").alias("p"), zero.alias("h"))
    sums = pairs.select(F.inline(F.array(as_actual, as_predicted))).groupBy("band").agg(
        F.sum("a").alias("support"), F.sum("p").alias("n_predicted"), F.sum("h").alias("hits")
    )
    precision = _part(F.col("hits"), F.col("n_predicted"))
    recall = _part(F.col("hits"), F.col("support"))
    f1 = _part(2 * F.col("hits"), F.col("n_predicted") + F.col("support"))
    return sums.select(
        "band", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support", "hits"
    )


def class_report(pairs: DataFrame) -> DataFrame:
    """Class scores plus macro and weighted averages and the accuracy.

    The macro average weighs classes equally; it is not the weighted F1 that
    Spark's evaluator calls ``f1``.
    """
    scores = class_scores(pairs)
    measures = ("precision", "recall", "f1")
    support = F.sum("support")
    macro = scores.agg(*[F.avg(m).alias(m) for m in measures], support.alias("support"))
    weighted = scores.agg(
        *[_part(F.sum(F.col(m) * F.col("support")), support).alias(m) for m in measures],
        support.alias("support"),
    )
    right = _part(F.sum("hits"), support)
    accuracy = scores.agg(*[right.alias(m) for m in measures], support.alias("support"))
    rows = scores.drop("hits")
    for name, summary in (("macro avg", macro), ("weighted avg", weighted), ("accuracy", accuracy)):
        rows = rows.unionByName(summary.withColumn("band", F.lit(name)))
    return rows


def accuracy_macro_f1(pairs: DataFrame) -> DataFrame:
    scores = class_scores(pairs)
    return scores.agg(
        _part(F.sum("hits"), F.sum("support")).alias("accuracy"), F.avg("f1").alias("macro_f1")
    )


def labels_present(pairs: DataFrame, ordered: tuple[str, ...]) -> DataFrame:
    """Classes that occur as label or prediction, in their fixed order."""
    both = pairs.select(F.col("actual").alias("band")).union(pairs.select("predicted")).distinct()
    position = F.array_position(F.array(*[F.lit(b) for b in ordered]), F.col("band"))
    return both.withColumn("position", position.cast("int")).orderBy("position")


def confusion_matrix(pairs: DataFrame, ordered: tuple[str, ...]) -> DataFrame:
    """Counts: one row per actual class, one column per predicted class."""
    return pivot_fill(pairs, "actual", "predicted", {"pred_": "n"}, ordered)


def confusion_shares(pairs: DataFrame, ordered: tuple[str, ...], digits: int = 1) -> DataFrame:
    """The matrix as percent of each actual class."""
    shares = pairs.withColumn("pct", share_of_group(F.col("n"), "actual", digits))
    return pivot_fill(shares, "actual", "predicted", {"pct_": "pct"}, ordered)


def naive_baselines(rows: DataFrame, label: str, n_classes: int) -> DataFrame:
    """Accuracy of always guessing the most common class, and of guessing uniformly."""
    counts = rows.groupBy(label).agg(F.count("*").alias("n"))
    return counts.agg(
        F.max_by(label, F.struct("n", label)).alias("majority_class"),
        _part(F.max("n"), F.sum("n")).alias("majority_accuracy"),
        F.lit(1.0 / n_classes).alias("uniform_accuracy"),
    )
