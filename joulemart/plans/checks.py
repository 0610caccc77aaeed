"""The checks certificates have to pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joulemart import constants as K
from joulemart.operators import quality as Q
from joulemart.plans.marts import Star


def source_checks(raw: DataFrame) -> DataFrame:
    return Q.run_checks(raw, [Q.unique("lmk_key"), Q.not_null("lmk_key")])


def staging_checks(staged: DataFrame) -> DataFrame:
    """A garbage rating stages as NULL, so its not-null check can fail by design."""
    return Q.run_checks(
        staged,
        [
            Q.unique("certificate_key"),
            Q.not_null("certificate_key"),
            Q.not_null("uprn"),
            Q.not_null("energy_rating_current"),
            Q.accepted_values("energy_rating_current", K.BANDS),
            Q.not_null("inspection_at"),
            Q.not_null("postcode"),
        ],
    )


def extended_checks(staged: DataFrame, as_of: str) -> DataFrame:
    """Checks against a stated day, of proportions, ranges and combinations."""
    return Q.run_checks(
        staged,
        [
            Q.row_predicate("no_future_date", "inspection_at", F.col("inspection_at") > F.lit(as_of).cast("date")),
            Q.unique("uprn", "inspection_at"),
            Q.not_null_proportion("postcode", 0.9),
            Q.recency("inspection_at", as_of, 365),
            Q.accepted_range("energy_efficiency_current", 1, 100),
        ],
    )


def quality_report(raw: DataFrame, star: Star, as_of: str) -> DataFrame:
    parts = {
        "raw": source_checks(raw),
        "stg_certificates": staging_checks(star.staged),
        "stg_certificates extended": extended_checks(star.staged, as_of),
    }
    tagged = [report.withColumn("dataset", F.lit(name)) for name, report in parts.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
