"""Analytics datasets over the star schema.

Every average here is a sum over a count, and both add up over any grouping.
So facts are first summed per property or per postcode, and only those sums
are joined to a dimension: the join sees one row per key, and no key is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joulemart import constants as K
from joulemart.functions.numbers import exact_mean, mean_of, ratio, rounded, surrogate_key
from joulemart.plans.marts import Star, with_location, with_property


def sums_per(facts: DataFrame, keys: list[str], measures: dict[str, Column]) -> DataFrame:
    """Row count ``n`` plus ``<name>_sum`` and ``<name>_n`` of each measure."""
    aggregates = [F.count("*").alias("n")]
    for name, value in measures.items():
        aggregates += [F.sum(value).alias(f"{name}_sum"), F.count(value).alias(f"{name}_n")]
    return facts.groupBy(*keys).agg(*aggregates)


def total_n() -> Column:
    return F.sum("n")


def mean(name: str) -> Column:
    """Average of a measure out of ``sums_per`` rows."""
    return mean_of(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))


def facts_by_property(star: Star, facts: DataFrame, measures: dict[str, Column], columns: list[str]) -> DataFrame:
    """Fact sums per property, with columns of the property attached.

    Sums are one row a property and lie by its number already, so they are joined by that and stay where they are.
    """
    sums = sums_per(facts.filter(F.col("uprn").isNotNull()), ["uprn"], measures)
    return sums.join(star.properties.select("uprn", *columns), "uprn")


def construction_age(star: Star) -> DataFrame:
    """Certificates and mean efficiency, consumption and carbon per age and type."""
    measures = {
        "efficiency": F.col("energy_efficiency_current"),
        "consumption": F.col("energy_consumption_current"),
        "co2": F.col("co2_emissions_current_tonnes_per_year"),
    }
    rows = facts_by_property(star, star.facts, measures, ["construction_age_band", "property_type"])
    return (
        rows.filter(F.col("construction_age_band").isNotNull())
        .groupBy("construction_age_band", "property_type")
        .agg(
            total_n().alias("total_certificates"),
            mean("efficiency").alias("avg_efficiency"),
            mean("consumption").alias("avg_consumption"),
            mean("co2").alias("avg_co2"),
        )
        .orderBy(F.desc_nulls_last("construction_age_band"), F.asc_nulls_last("property_type"))
    )


def regional_means(star: Star) -> DataFrame:
    """Certificates and mean efficiency and carbon per county, authority, town."""
    current, potential = F.col("energy_efficiency_current"), F.col("energy_efficiency_potential")
    measures = {
        "current": current,
        "potential": potential,
        "co2_current": F.col("co2_emissions_current_tonnes_per_year"),
        "co2_potential": F.col("co2_emissions_potential_tonnes_per_year"),
        "gap": potential - current,
    }
    sums = sums_per(star.facts.filter(F.col("postcode").isNotNull()), ["postcode"], measures)
    # One row a postcode, joined by it: the sums are not shuffled again.
    places = star.locations.select("postcode", "county", "local_authority", "post_town")
    return (
        sums.join(places, "postcode")
        .groupBy("county", "local_authority", "post_town")
        .agg(
            total_n().alias("total_certificates"),
            mean("current").alias("avg_current_efficiency"),
            mean("potential").alias("avg_potential_efficiency"),
            mean("co2_current").alias("avg_co2_current"),
            mean("co2_potential").alias("avg_co2_potential"),
            mean("gap").alias("avg_efficiency_gap"),
        )
    )


def regional_performance(star: Star) -> DataFrame:
    return regional_means(star).orderBy(F.desc_nulls_last("avg_current_efficiency"), "county", "local_authority", "post_town")


def efficiency_gaps(star: Star, min_gap: int = 30) -> DataFrame:
    """Certificates whose achievable gain exceeds ``min_gap`` points."""
    gap = F.col("energy_efficiency_potential") - F.col("energy_efficiency_current")
    co2 = F.col("co2_emissions_current_tonnes_per_year") - F.col("co2_emissions_potential_tonnes_per_year")
    rows = star.facts.filter(gap > min_gap).select(
        "certificate_id",
        "property_id",
        "energy_efficiency_current",
        "energy_efficiency_potential",
        gap.alias("efficiency_gap"),
        co2.alias("co2_reduction_potential_tonnes"),
    )
    return (
        with_property(rows, star, ["uprn", "property_type", "built_form"])
        .select(
            "certificate_id", "uprn", "property_type", "built_form",
            "energy_efficiency_current", "energy_efficiency_potential",
            "efficiency_gap", "co2_reduction_potential_tonnes",
        )
        # Gaps are few; the key lets the sort spread over more tasks than there are gaps.
        .orderBy(F.desc_nulls_last("efficiency_gap"), "certificate_id")
    )


def _score_parts() -> dict[str, Column]:
    """The three quantities a retrofit score weighs, in weight order."""
    return {
        "inefficiency": 100 - F.col("energy_efficiency_current"),
        "gap": F.col("energy_efficiency_potential") - F.col("energy_efficiency_current"),
        "co2_saving": F.col("co2_emissions_current_tonnes_per_year")
        - F.col("co2_emissions_potential_tonnes_per_year"),
    }


def improvable(star: Star) -> DataFrame:
    """Certificates with room to improve, with their property's kind.

    Columns: the keys of a kind, ``postcode``, the two efficiencies, current
    carbon and the three score parts.
    """
    rows = star.facts.filter(
        (F.col("energy_efficiency_current") > 0)
        & (F.col("energy_efficiency_potential") > F.col("energy_efficiency_current"))
        & F.col("co2_emissions_current_tonnes_per_year").isNotNull()
        & F.col("postcode").isNotNull()
    ).select(
        "property_id",
        "postcode",
        "energy_efficiency_current",
        "energy_efficiency_potential",
        F.col("co2_emissions_current_tonnes_per_year").alias("co2_current"),
        *[part.alias(name) for name, part in _score_parts().items()],
    )
    kinds = with_property(rows, star, ["property_type", "construction_age_band", "tenure"])
    return kinds.filter(F.col("property_type").isNotNull() & F.col("construction_age_band").isNotNull())


def score_scale(star: Star, base: DataFrame) -> DataFrame:
    """One row: the greatest value of each score part over ``improvable`` rows.

    A maximum ignores repeats, so the location test is a semi join of the
    per-postcode maxima instead of the fan-out join.
    """
    peaks = base.groupBy("postcode").agg(*[F.max(p).alias(p) for p in _score_parts()])
    placed = star.locations.filter(F.col("local_authority").isNotNull()).select("location_id")
    return (
        peaks.withColumn("location_id", surrogate_key(F.col("postcode")))
        .join(placed, "location_id", "left_semi")
        .agg(*[F.max(p).alias(f"max_{p}") for p in _score_parts()])
    )


def scored(star: Star, base: DataFrame) -> DataFrame:
    """``improvable`` rows with their 0-100 retrofit score.

    The scale comes in as a scalar subquery: one row, evaluated once.
    """
    scale = score_scale(star, base)
    peak = scale.select(F.struct(*[F.col(c) for c in scale.columns])).scalar()
    rows = base.withColumn("peak", peak)
    weighted = [
        F.lit(weight) * ratio(F.col(part), F.col("peak").getField(f"max_{part}"))
        for weight, part in zip(K.SCORE_WEIGHTS, _score_parts())
    ]
    score = rounded((weighted[0] + weighted[1] + weighted[2]) * 100, 1)
    # A one-decimal score is exact as decimal, and so are sums of it.
    return rows.withColumn("score", score.cast("decimal(9,1)")).drop("peak")


def retrofit_priority(star: Star, base: DataFrame | None = None) -> DataFrame:
    """Scores and savings per property kind, tenure, county and authority.

    The scale and the scores both read ``improvable`` rows. Pass them as
    ``base`` when they have been written, and they are joined only once.
    """
    base = improvable(star) if base is None else base
    kind = ["property_type", "construction_age_band", "tenure"]
    measures = {
        "current": F.col("energy_efficiency_current"),
        "potential": F.col("energy_efficiency_potential"),
        "gap": F.col("gap"),
        "co2_current": F.col("co2_current"),
        "co2_saving": F.col("co2_saving"),
        "score": F.col("score"),
    }
    partial = scored(star, base).groupBy(*kind, "postcode").agg(
        F.count("*").alias("n"),
        F.max("score").alias("score_max"),
        *[F.sum(v).alias(f"{k}_sum") for k, v in measures.items()],
        *[F.count(v).alias(f"{k}_n") for k, v in measures.items()],
    )
    return (
        with_location(partial, star, ["county", "local_authority"])
        .filter(F.col("local_authority").isNotNull())
        .groupBy(*kind, "county", "local_authority")
        .agg(
            total_n().alias("property_count"),
            rounded(mean("current"), 1).alias("avg_efficiency_current"),
            rounded(mean("potential"), 1).alias("avg_efficiency_potential"),
            rounded(mean("gap"), 1).alias("avg_efficiency_gap"),
            rounded(mean("co2_current"), 3).alias("avg_co2_current_tonnes"),
            rounded(mean("co2_saving"), 3).alias("avg_co2_saving_per_property_tonnes"),
            F.round(F.sum("co2_saving_sum"), 1).cast("decimal(38,1)").alias("total_co2_saving_potential_tonnes"),
            rounded(mean("score"), 1).alias("avg_retrofit_priority_score"),
            F.max("score_max").cast("double").alias("max_retrofit_priority_score"),
        )
    )


def mean_efficiency_by(rows: DataFrame, key: str) -> DataFrame:
    """Row count and one-decimal mean efficiencies per key."""
    return rows.groupBy(key).agg(
        F.count("*").alias("n"),
        rounded(exact_mean(F.col("energy_efficiency_current")), 1).alias("avg_current"),
        rounded(exact_mean(F.col("energy_efficiency_potential")), 1).alias("avg_potential"),
    )
