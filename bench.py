"""Time the certificate workload and print one JSON line.

First the whole build, from raw rows to the written star schema, then every
report over those tables. A report's time is the better of two runs, so that
it does not include compiling code for the first time.

BENCH_SF_DIR   input tables (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
BENCH_COPIES   repeat the raw rows under distinct keys (default 1)
BENCH_MEMORY   driver memory (default 12g)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from joulemart import registry  # noqa: E402
from joulemart.operators.sampling import sample_exact  # noqa: E402
from joulemart.plans import analytics, band_features, checks, marts, reports  # noqa: E402
from joulemart.plans.staging import lower_case_columns  # noqa: E402
from joulemart.session import build_session, new_work_dir  # noqa: E402
from joulemart.sources.certificate_rows import raw_certificates  # noqa: E402
from joulemart.sources.tables import Warehouse  # noqa: E402


#: Landing, replacing, streams, checks, the map and model fits.
WHOLE_QUERIES = (
    "csv_glob_scan", "append_stream", "incremental_latest", "ctas_overwrite", "five_number_continuous", "dq_report", "la_map",
    "random_forest", "boosted_trees", "hyperparameter_search",
)


def report_queries(star, retrofit):
    """Name -> DataFrame, for every report over the written tables."""
    return {
        "v_construction_age": analytics.construction_age(star),
        "v_regional_performance": analytics.regional_performance(star),
        "v_efficiency_gaps": analytics.efficiency_gaps(star),
        "rating_distribution": reports.rating_distribution(star),
        "county_best_worst": reports.county_best_worst(star),
        "efficiency_by_age": reports.efficiency_by_age(star),
        "co2_box_by_type": reports.co2_box_by_type(star),
        "efficiency_density": reports.efficiency_density(star),
        "retrofit_matrix": reports.retrofit_matrix(retrofit),
        "la_treemap": reports.la_treemap(retrofit),
        "treemap_levels": reports.treemap_levels(reports.la_treemap(retrofit)),
        "postcode_band_matrix": reports.postcode_band_matrix(star),
        "map_figures": reports.map_figures(retrofit),
        "fuel_impact": reports.fuel_impact(star),
        "annual_trend": reports.annual_trend(star),
        "cost_breakdown": reports.cost_breakdown(star),
        "national_summary": reports.national_summary(star),
        "profile_age": reports.profile(star, "construction_age_band"),
        "profile_fuel": reports.profile(star, "main_fuel"),
        "profile_rating": reports.rating_profile(star),
        "dq_staging": checks.staging_checks(star.staged),
        "ml_features": band_features.feature_rows(star.staged),
        "ml_split": band_features.split_features(band_features.feature_rows(star.staged)),
        "sample_exact": sample_exact(star.facts.select("certificate_id"), "certificate_id", 20_000, 99),
    }


def run(df) -> float:
    """Seconds to compute every row and column of a result."""
    started = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    copies = int(os.environ.get("BENCH_COPIES", "1"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(int(cpus) * (1 if copies < 10 else 4)),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="joulemart-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("OFF")

    raw = raw_certificates(spark, sf_dir, copies)
    rows = raw.count()
    # The raw rows land as a table of many files first, as certificate files would.
    landed = new_work_dir(spark, "landed")
    (raw if copies > 1 else raw.repartition(int(cpus))).write.parquet(landed)
    warehouse = Warehouse(spark, new_work_dir(spark, "warehouse"))
    started = time.perf_counter()
    warehouse.build(lower_case_columns(spark.read.parquet(landed)))
    build_seconds = time.perf_counter() - started

    star = warehouse.star()
    queries = {"build_star_schema": round(build_seconds, 3)}
    for name, df in report_queries(star, warehouse.table("v_retrofit_priority")).items():
        queries[name] = round(min(run(df), run(df)), 3)
    # The two aggregate tables are part of the build; timed alone as well.
    queries["v_retrofit_priority"] = round(run(analytics.retrofit_priority(star, warehouse.table("improvable"))), 3)
    queries["fct_property_aggregations"] = round(run(marts.fct_property_aggregations(star)), 3)

    # Queries that write and read intermediate tables: the whole call counts, once.
    registered = registry.all_queries()
    for name in WHOLE_QUERIES:
        started = time.perf_counter()
        run(registered[name](spark, sf_dir))
        queries[name] = round(time.perf_counter() - started, 3)

    folder = os.path.basename(os.path.normpath(sf_dir))
    result = {
        "metric": "certificate_workload_seconds",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": float(folder.removeprefix("sf")) if folder.startswith("sf") else folder,
        "raw_rows": rows,
        "build_rows_per_sec": round(rows / build_seconds),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
