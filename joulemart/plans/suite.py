"""All reports by name, and a run that writes each of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joulemart.plans import analytics, reports
from joulemart.plans.marts import Star

# Name -> dataset of the star schema and the retrofit table.
REPORTS: dict[str, Callable[[Star, DataFrame], DataFrame]] = {
    "national_summary": lambda star, _: reports.national_summary(star),
    "rating_distribution": lambda star, _: reports.rating_distribution(star),
    "county_best_worst": lambda star, _: reports.county_best_worst(star),
    "efficiency_by_age": lambda star, _: reports.efficiency_by_age(star),
    "co2_box_by_type": lambda star, _: reports.co2_box_by_type(star),
    "efficiency_density": lambda star, _: reports.efficiency_density(star),
    "retrofit_matrix": lambda _, retrofit: reports.retrofit_matrix(retrofit),
    "la_treemap": lambda _, retrofit: reports.la_treemap(retrofit),
    "postcode_band_matrix": lambda star, _: reports.postcode_band_matrix(star),
    "map_figures": lambda _, retrofit: reports.map_figures(retrofit),
    "fuel_impact": lambda star, _: reports.fuel_impact(star),
    "annual_trend": lambda star, _: reports.annual_trend(star),
    "cost_breakdown": lambda star, _: reports.cost_breakdown(star),
    "v_retrofit_priority": lambda _, retrofit: retrofit,
    "v_construction_age": lambda star, _: analytics.construction_age(star),
    "v_regional_performance": lambda star, _: analytics.regional_performance(star),
    "v_efficiency_gaps": lambda star, _: analytics.efficiency_gaps(star),
}


def write_reports(
    star: Star, retrofit: DataFrame, out: str, names: list[str] | None = None, features: DataFrame | None = None
) -> DataFrame:
    """Write each report as Parquet below ``out``; one failing does not stop the rest.

    With boundary ``features`` the district map is one of them. Returns one row per report: ``(report, path, error)``.
    """
    outcomes = []
    known = dict(REPORTS)
    if features is not None:
        known["la_map"] = lambda _, cells: reports.la_map(cells, features)
    for name in names or list(known):
        path, error = f"{out}/{name}", None
        try:
            known[name](star, retrofit).write.mode("overwrite").parquet(path)
        except Exception as problem:  # noqa: BLE001 - reported per report
            error = f"{type(problem).__name__}: {problem}".splitlines()[0]
        outcomes.append((name, path, error))
    spark = star.facts.sparkSession
    return spark.createDataFrame(outcomes, "report string, path string, error string").orderBy(F.col("report"))
