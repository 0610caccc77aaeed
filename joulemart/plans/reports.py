"""Reporting datasets: the tables behind the charts, ready to draw."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joulemart import constants as K
from joulemart.functions.labels import ordinal, percent_text, score_text
from joulemart.functions.numbers import clamp_unit, exact_mean, exact_mean_of_rounded, rounded, surrogate_key
from joulemart.operators.distribution import bin_of, box_summary, histogram_2d, value_counts
from joulemart.operators.ranking import first_last_delta, head_and_tail, top_k
from joulemart.operators.reshape import pivot_fill
from joulemart.operators.sampling import sample_exact
from joulemart.operators.shares import share_of_group, share_of_total
from joulemart.plans.analytics import (
    facts_by_property, mean, mean_efficiency_by, regional_means, sums_per,
)
from joulemart.plans.marts import Star, with_property
from joulemart.sources.geojson import main_outline, match_districts

BOX_SAMPLE = 200_000
DENSITY_SAMPLE = 150_000
SAMPLE_SEED = 42


def rating_distribution(star: Star) -> DataFrame:
    """Certificates per band with their share among banded certificates."""
    counts = (
        star.facts.filter(F.col("energy_rating_current").isin(*K.BANDS))
        .groupBy(F.col("energy_rating_current").alias("rating"))
        .agg(F.count("*").alias("n"))
    )
    shares = counts.withColumn("pct", share_of_total(F.col("n"), 1))
    return shares.withColumn("label", percent_text(F.col("pct"))).orderBy("rating")


def below_c_share(star: Star) -> DataFrame:
    """Summed displayed shares of bands D to G, as the chart annotates it."""
    return rating_distribution(star).filter(F.col("rating").isin(*K.BELOW_C)).agg(
        rounded(F.sum(F.col("pct").cast("decimal(6,1)")).cast("double"), 1).alias("pct_below_c")
    )


def county_best_worst(star: Star, k: int = 20) -> DataFrame:
    """The k least and the k most efficient (county, authority, town) rows."""
    rows = regional_means(star).filter(F.col("county").isNotNull()).select(
        "county", "local_authority", "post_town", "avg_current_efficiency", "total_certificates"
    )
    order = ["avg_current_efficiency", "county", "local_authority", "post_town"]
    ends = head_and_tail(rows, order, k, ("worst", "best"))
    return ends.withColumn("colour", clamp_unit(F.col("avg_current_efficiency"), *K.COUNTY_SCALE))


def efficiency_by_age(star: Star) -> DataFrame:
    """Mean current and potential efficiency per construction age, oldest first."""
    measures = {
        "current": F.col("energy_efficiency_current"),
        "potential": F.col("energy_efficiency_potential"),
    }
    rows = facts_by_property(star, star.facts, measures, ["construction_age_band"])
    age = F.col("construction_age_band")
    return (
        rows.filter(age.isNotNull())
        .groupBy("construction_age_band")
        .agg(rounded(mean("current"), 1).alias("avg_current"), rounded(mean("potential"), 1).alias("avg_potential"))
        .withColumn("age_order", ordinal(age, (*K.AGE_LABELS, K.UNKNOWN_AGE)))
        .orderBy("age_order")
    )


def _sampled_kinds(star: Star, n: int, columns: list[str]) -> DataFrame:
    """``n`` sampled certificates with their property type.

    The sample is of the joined rows, before any filter. Each certificate
    joins exactly one property, so sampling first and joining the sample
    gives the same rows without joining the rest.
    """
    facts = star.facts.filter(F.col("uprn").isNotNull()).select("certificate_id", "property_id", *columns)
    return with_property(sample_exact(facts, "certificate_id", n, SAMPLE_SEED), star, ["property_type"])


def co2_box_by_type(star: Star, n: int = BOX_SAMPLE) -> DataFrame:
    """Box-plot numbers of carbon per property type, from an n-row sample."""
    co2 = F.col("co2_emissions_current_tonnes_per_year")
    rows = _sampled_kinds(star, n, ["co2_emissions_current_tonnes_per_year"]).filter(
        co2.between(F.lit(0.1).cast("decimal(10,2)"), F.lit(20).cast("decimal(10,2)"))
        & F.col("property_type").isNotNull()
    )
    return box_summary(value_counts(rows.withColumn("co2", co2), "property_type", "co2"), "property_type", "co2")


def efficiency_density(star: Star, n: int = DENSITY_SAMPLE) -> DataFrame:
    """Counts per property type on an efficiency x carbon grid, from a sample.

    Grid: 5 points by half a tonne, from the lower limits of the filters.
    """
    efficiency = F.col("energy_efficiency_current")
    co2 = F.col("co2_emissions_current_tonnes_per_year")
    rows = _sampled_kinds(star, n, ["energy_efficiency_current", "co2_emissions_current_tonnes_per_year"]).filter(
        efficiency.between(1, 100)
        & co2.between(F.lit(0.1).cast("decimal(10,2)"), F.lit(15).cast("decimal(10,2)"))
        & F.col("property_type").isNotNull()
    )
    return histogram_2d(rows, "property_type", bin_of(efficiency, 1, 5), bin_of(co2, 0.1, 0.5))


def retrofit_cells(retrofit: DataFrame) -> DataFrame:
    """Mean score and property count per property type and known age."""
    return (
        retrofit.filter(
            (F.col("construction_age_band") != K.UNKNOWN_AGE) & F.col("property_type").isNotNull()
        )
        .groupBy("property_type", "construction_age_band")
        .agg(
            rounded(exact_mean_of_rounded(F.col("avg_retrofit_priority_score"), 1), 1).alias("score"),
            F.sum("property_count").alias("total_props"),
        )
        .withColumn("label", score_text(F.col("score"), F.col("total_props")))
    )


def retrofit_matrix(retrofit: DataFrame) -> DataFrame:
    """Wide form: one score and one count column per construction age."""
    values = {"score_": "score", "props_": "total_props"}
    return pivot_fill(retrofit_cells(retrofit), "property_type", "construction_age_band", values, K.AGE_LABELS)


def la_treemap(retrofit: DataFrame, min_count: int = 500) -> DataFrame:
    """Efficiency and saving per county and authority with enough properties."""
    return (
        retrofit.filter(F.col("county").isNotNull() & F.col("local_authority").isNotNull())
        .groupBy("county", "local_authority")
        .agg(
            rounded(exact_mean_of_rounded(F.col("avg_efficiency_current"), 1), 1).alias("avg_efficiency"),
            F.round(F.sum("total_co2_saving_potential_tonnes"), 0).cast("double").alias("total_co2_saving"),
            F.sum("property_count").alias("property_count"),
        )
        .filter(F.col("property_count") > min_count)
        .orderBy(F.asc_nulls_last("avg_efficiency"))
    )


def treemap_levels(leaves: DataFrame) -> DataFrame:
    """Box sizes and size-weighted colours at every level of the treemap.

    ``level`` is 0 for the whole country, 1 for a county, 2 for an authority.
    """
    size = F.col("total_co2_saving").cast("decimal(20,0)")
    weighted = F.col("avg_efficiency").cast("decimal(6,1)") * size
    level = F.lit(2) - F.grouping("local_authority") - F.grouping("county")
    return leaves.rollup("county", "local_authority").agg(
        level.cast("int").alias("level"),
        F.sum(size).cast("double").alias("total_co2_saving"),
        rounded(
            F.sum(weighted).cast("double") / F.nullif(F.sum(size).cast("double"), F.lit(0.0)), 4
        ).alias("weighted_efficiency"),
    )


def postcode_band_counts(star: Star) -> DataFrame:
    """Certificates per postcode area and band, once per location tuple.

    Only the number of tuples of a postcode matters here, so the fan-out is a
    multiplication instead of repeated rows.
    """
    facts = star.facts.filter(
        F.col("energy_rating_current").isin(*K.BANDS) & F.col("postcode").isNotNull()
    )
    counts = sums_per(facts, ["postcode", "energy_rating_current"], {}).withColumn(
        "location_id", surrogate_key(F.col("postcode"))
    )
    tuples = star.locations.groupBy("location_id").agg(F.count("*").alias("tuples"))
    area = F.regexp_extract("postcode", "^([A-Z]{1,2})", 1)
    return (
        counts.join(tuples, "location_id")
        .groupBy(area.alias("postcode_area"), F.col("energy_rating_current").alias("rating"))
        .agg(F.sum(F.col("n") * F.col("tuples")).alias("cnt"))
    )


def postcode_band_shares(star: Star) -> DataFrame:
    return postcode_band_counts(star).withColumn("pct", share_of_group(F.col("cnt"), "postcode_area", 1))


def postcode_band_matrix(star: Star) -> DataFrame:
    """Share of each band per postcode area, most G-rated areas first."""
    wide = pivot_fill(postcode_band_shares(star), "postcode_area", "rating", {"band_": "pct"}, K.BANDS)
    return wide.orderBy(F.desc_nulls_last("band_g"), F.asc_nulls_last("postcode_area"))


def fuel_impact(star: Star) -> DataFrame:
    """Mean efficiencies per known main fuel."""
    rows = star.staged.filter(
        (F.col("main_fuel") != K.UNKNOWN_FUEL) & (F.col("energy_efficiency_current") > 0)
    )
    return (
        mean_efficiency_by(rows, "main_fuel")
        .select(F.col("main_fuel").alias("fuel"), "avg_current", "avg_potential", "n")
        .orderBy(F.desc_nulls_last("avg_current"), "fuel")
    )


def fuel_gap(star: Star) -> DataFrame:
    """Points between the most and the least efficient fuel."""
    return fuel_impact(star).agg(first_last_delta("avg_current", "avg_current", 1).alias("gap"))


def annual_trend(star: Star, first_year: int = 2008, last_year: int = 2024) -> DataFrame:
    """Mean efficiency and certificates per inspection year.

    The year limits are stated as date limits, so a Parquet scan can use them.
    """
    date = F.col("inspection_at")
    rows = star.facts.filter(
        (date >= F.make_date(F.lit(first_year), F.lit(1), F.lit(1)))
        & (date < F.make_date(F.lit(last_year + 1), F.lit(1), F.lit(1)))
    )
    return (
        rows.groupBy(F.year(date).alias("yr"))
        .agg(
            rounded(exact_mean(F.col("energy_efficiency_current")), 1).alias("avg_sap"),
            F.count("*").alias("certs"),
        )
        .orderBy("yr")
    )


def trend_gain(star: Star) -> DataFrame:
    """Mean efficiency of the last year minus that of the first."""
    return annual_trend(star).agg(
        F.min("yr").alias("first_year"),
        F.max("yr").alias("last_year"),
        first_last_delta("avg_sap", "yr", 1).alias("improvement"),
    )


def cost_breakdown(star: Star) -> DataFrame:
    """Mean yearly heating, hot water and lighting cost per property type."""
    heating = F.col("heating_cost_current")
    measures = {
        "heating": heating,
        "hot_water": F.col("hot_water_cost_current"),
        "lighting": F.col("lighting_cost_current"),
    }
    facts = star.facts.filter((heating > 0) & (heating < 10000))
    rows = facts_by_property(star, facts, measures, ["property_type"])
    return (
        rows.filter(F.col("property_type").isNotNull())
        .groupBy("property_type")
        .agg(*[rounded(mean(m), 0).alias(m) for m in measures])
        .orderBy(
            F.desc_nulls_last(F.col("heating") + F.col("hot_water") + F.col("lighting")), "property_type"
        )
    )


def national_summary(star: Star) -> DataFrame:
    """One row of headline numbers, from one pass over the facts."""
    current = F.col("co2_emissions_current_tonnes_per_year")
    saving = current - F.col("co2_emissions_potential_tonnes_per_year")
    sums = star.facts.agg(
        F.count("*").alias("total"),
        F.sum(current).alias("co2_current"),
        F.sum(saving).alias("co2_saving"),
        exact_mean(F.col("energy_efficiency_current")).alias("eff_current"),
        exact_mean(F.col("energy_efficiency_potential")).alias("eff_potential"),
        F.count_if(F.col("energy_rating_current").isin(*K.BELOW_C)).alias("below_c"),
    )
    co2_current, co2_saving = F.col("co2_current").cast("double"), F.col("co2_saving").cast("double")
    return sums.select(
        "total",
        co2_current.alias("co2_current"),
        co2_saving.alias("co2_saving"),
        rounded(F.try_divide(co2_saving, co2_current) * 100, 1).alias("pct_saving"),
        rounded(F.col("eff_current"), 1).alias("avg_eff_current"),
        rounded(F.col("eff_potential"), 1).alias("avg_eff_potential"),
        rounded(F.try_divide(F.col("below_c").cast("double"), F.col("total").cast("double")) * 100, 1).alias(
            "pct_below_c"
        ),
    )


def emissions_equivalence(star: Star, digits: int = 1) -> DataFrame:
    """The carbon saving in million tonnes, and in millions of cars."""
    megatonnes = rounded(F.col("co2_saving") / 1e6, digits)
    return national_summary(star).select(
        megatonnes.alias("co2_saving_mt"),
        rounded(megatonnes / K.CAR_TONNES_PER_YEAR, digits).alias("cars_million"),
    )


def profile(star: Star, column: str, k: int = 30) -> DataFrame:
    """The most frequent values of a staged column."""
    counts = star.staged.groupBy(column).agg(F.count("*").alias("n"))
    return top_k(counts, k, F.desc("n"), F.asc_nulls_last(column))


def rating_profile(star: Star) -> DataFrame:
    return star.staged.groupBy("energy_rating_current").agg(F.count("*").alias("n")).orderBy(
        F.asc_nulls_last("energy_rating_current")
    )


def regional_unique(star: Star, locations: DataFrame) -> DataFrame:
    """Regional means over one location per postcode, without the fan-out."""
    return regional_means(Star(star.staged, star.facts, star.properties, locations))


def weighted_retrofit_cells(retrofit: DataFrame) -> DataFrame:
    """Retrofit cells whose mean is weighted by properties, not by groups."""
    known = retrofit.filter((F.col("construction_age_band") != K.UNKNOWN_AGE) & F.col("property_type").isNotNull())
    weighted = F.col("avg_retrofit_priority_score").cast("decimal(6,1)") * F.col("property_count")
    # Groups whose score is missing weigh nothing.
    weight = F.when(F.col("avg_retrofit_priority_score").isNotNull(), F.col("property_count"))
    return known.groupBy("property_type", "construction_age_band").agg(
        rounded(F.sum(weighted).cast("double") / F.nullif(F.sum(weight), F.lit(0)).cast("double"), 1).alias("score"),
        F.sum("property_count").alias("total_props"),
    )




def map_figures(retrofit: DataFrame, min_count: int = 100) -> DataFrame:
    """The numbers a district map shows, per authority and county."""
    return (
        retrofit.filter(F.col("local_authority").isNotNull())
        .groupBy("local_authority", "county")
        .agg(
            rounded(exact_mean_of_rounded(F.col("avg_efficiency_current"), 1), 1).alias("avg_efficiency"),
            rounded(exact_mean_of_rounded(F.col("avg_retrofit_priority_score"), 1), 1).alias("avg_retrofit_score"),
            F.sum("property_count").alias("property_count"),
            rounded(F.sum("total_co2_saving_potential_tonnes").cast("double") / 1e3, 1).alias("co2_saving_kt"),
        )
        .filter(F.col("property_count") > min_count)
    )


def la_map(retrofit: DataFrame, features: DataFrame, min_count: int = 100) -> DataFrame:
    """Map figures with colour position and simplified outline.

    Authorities without a boundary, and boundaries without a usable shape,
    are left out; ``geojson.unmatched_districts`` lists the former.
    """
    figures = match_districts(map_figures(retrofit, min_count), features)
    return (
        figures.na.drop(subset=["lad_code"])
        .join(main_outline(features), "lad_code")
        .withColumn("colour", clamp_unit(F.col("avg_efficiency"), *K.DISTRICT_SCALE))
    )
