"""Star schema: property and location dimensions, facts, yearly aggregate.

Joins between these tables go over the surrogate keys. A dimension that was
just aggregated by its natural key is then still exchanged for the join, and
with an exchange on both sides adaptive execution can split a hot key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joulemart.functions.numbers import mean_of, rounded, surrogate_key
from joulemart.operators.latest import latest_per_key

PROPERTY_STATE = [
    "property_type", "built_form", "construction_age_band", "tenure", "total_floor_area_sqm",
    "count_habitable_rooms", "count_heated_rooms", "count_extensions",
]
LOCATION = ["postcode", "post_town", "local_authority", "constituency", "county"]
MEASURES = [
    "energy_rating_current", "energy_rating_potential",
    "energy_efficiency_current", "energy_efficiency_potential",
    "env_impact_current", "env_impact_potential",
    "energy_consumption_current", "energy_consumption_potential",
    "co2_emissions_current_tonnes_per_year", "co2_emissions_potential_tonnes_per_year",
    "lighting_cost_current", "heating_cost_current", "hot_water_cost_current",
    "inspection_at", "lodgement_at", "source_file",
]
FACT = ["certificate_key", "certificate_id", "property_id", "location_id", *MEASURES]


def dim_properties(staged: DataFrame) -> DataFrame:
    """One row per property: its state at the latest assessment."""
    latest = latest_per_key(
        staged, "uprn", ["inspection_at", "lodgement_at", "certificate_id"], PROPERTY_STATE
    )
    return latest.select(surrogate_key(F.col("uprn")).alias("property_id"), "uprn", *PROPERTY_STATE)


def dim_locations(staged: DataFrame) -> DataFrame:
    """Distinct location tuples. The key covers the postcode alone, so a
    postcode recorded under two towns has two rows with one key."""
    distinct = staged.filter(F.col("postcode").isNotNull()).select(*LOCATION).distinct()
    return distinct.select(surrogate_key(F.col("postcode")).alias("location_id"), *LOCATION)


def dim_locations_unique(staged: DataFrame) -> DataFrame:
    """One row per postcode: its most frequently recorded location tuple."""
    rest = [c for c in LOCATION if c != "postcode"]
    counted = staged.filter(F.col("postcode").isNotNull()).groupBy(*LOCATION).agg(F.count("*").alias("n"))
    # Ties go to the alphabetically last tuple, for a definite result.
    chosen = latest_per_key(counted, "postcode", ["n", *rest], rest)
    return chosen.select(surrogate_key(F.col("postcode")).alias("location_id"), *LOCATION)


def certificate_facts(staged: DataFrame) -> DataFrame:
    """The fact table plus the natural keys its surrogate keys derive from.

    Aggregations group by the short natural keys and derive the surrogate
    key afterwards, on the few remaining rows.
    """
    return staged.filter(F.col("certificate_id").isNotNull()).select(
        surrogate_key(F.col("certificate_id")).alias("certificate_key"),
        "certificate_id",
        surrogate_key(F.col("uprn")).alias("property_id"),
        surrogate_key(F.col("postcode")).alias("location_id"),
        *MEASURES,
        "uprn",
        "postcode",
    )


def fct_certificates(facts: DataFrame) -> DataFrame:
    return facts.select(*FACT)


def fct_energy_performance(staged: DataFrame) -> DataFrame:
    """Certificate rows with the achievable gain and the yearly cost."""
    gain = F.col("energy_efficiency_potential") - F.col("energy_efficiency_current")
    cost = (
        F.col("heating_cost_current") + F.col("hot_water_cost_current") + F.col("lighting_cost_current")
    )
    return staged.select(
        "certificate_id", "uprn", "address1", "postcode",
        "energy_rating_current", "energy_rating_potential",
        "energy_efficiency_current", "energy_efficiency_potential",
        gain.alias("efficiency_gain_potential"),
        "total_floor_area_sqm", "inspection_at", "lodgement_at", "property_type", "built_form",
        "heating_cost_current", "hot_water_cost_current", "lighting_cost_current",
        cost.alias("total_estimated_annual_cost_current"),
    )


def year_start(date: Column) -> Column:
    """First day of the date's year as a zone-free timestamp."""
    return F.make_date(F.year(date), F.lit(1), F.lit(1)).cast("timestamp_ntz")


@dataclass(frozen=True)
class Star:
    """The tables the analytics read. ``facts`` carries the natural keys."""

    staged: DataFrame
    facts: DataFrame
    properties: DataFrame
    locations: DataFrame

    @classmethod
    def from_staged(cls, staged: DataFrame) -> Star:
        """All tables as one lazy plan over the staged rows."""
        return cls(staged, certificate_facts(staged), dim_properties(staged), dim_locations(staged))


def with_property(rows: DataFrame, star: Star, columns: list[str], how: str = "inner") -> DataFrame:
    """Attach property columns to rows that carry ``property_id``."""
    return rows.join(star.properties.select("property_id", *columns), "property_id", how)


def with_location(rows: DataFrame, star: Star, columns: list[str], how: str = "inner") -> DataFrame:
    """Attach location columns; repeats a row per tuple of its postcode."""
    # Rows without a postcode share one key text that no location has.
    if how == "inner":
        rows = rows.filter(F.col("postcode").isNotNull())
    return rows.drop("location_id").withColumn(
        "location_id", surrogate_key(F.col("postcode"))
    ).join(star.locations.select("location_id", *columns), "location_id", how)


def fct_property_aggregations(star: Star) -> DataFrame:
    """Certificates, mean rating and carbon per county, property kind and year.

    Facts are summed up per property kind, postcode and year before locations
    fan them out, so the join moves sums instead of certificates.
    """
    kind = ["property_type", "tenure", "construction_age_band"]
    rows = star.facts.select(
        "property_id",
        "postcode",
        year_start(F.col("inspection_at")).alias("inspection_year"),
        "energy_efficiency_current",
        F.col("co2_emissions_current_tonnes_per_year").alias("co2"),
    )
    partial = (
        with_property(rows, star, kind, "left")
        .groupBy(*kind, "postcode", "inspection_year")
        .agg(
            F.count("*").alias("n"),
            F.sum("energy_efficiency_current").alias("rating_sum"),
            F.count("energy_efficiency_current").alias("rating_n"),
            F.sum("co2").alias("co2_sum"),
        )
    )
    return (
        with_location(partial, star, ["county"], "left")
        .groupBy("county", *kind, "inspection_year")
        .agg(
            F.sum("n").alias("certificate_count"),
            rounded(mean_of(F.sum("rating_sum"), F.sum("rating_n")), 2).alias("avg_energy_efficiency"),
            F.sum("co2_sum").cast("decimal(38,2)").alias("total_co2_emissions"),
        )
    )
