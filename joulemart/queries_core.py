"""Registered queries over the certificate tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joulemart.functions.labels import compact_count
from joulemart.functions.numbers import rounded
from joulemart.oracle import mean, query, rnd
from joulemart.operators.shares import with_total
from joulemart.plans import analytics, marts, reports, staging
from joulemart.plans.marts import Star
from joulemart.session import new_work_dir, settle
from joulemart.sources.certificate_rows import raw_certificates


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    return raw_certificates(spark, sf_dir)


def star(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> Star:
    return Star.from_staged(staging.stage_certificates(raw(spark, sf_dir), extra))


def written(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Rows that are read more than once, from a table in the shared work folder."""
    path = new_work_dir(spark, name)
    rows.write.parquet(path)
    return spark.read.parquet(path)


def written_star(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> Star:
    """The star over certificates that are staged once, for what reads them several times."""
    return Star.from_staged(written(spark, star(spark, sf_dir, extra).staged, "staged"))


def retrofit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retrofit priorities, the joined rows behind scale and scores written once too."""
    once = written_star(spark, sf_dir)
    return analytics.retrofit_priority(once, written(spark, analytics.improvable(once), "improvable"))


def _on_written(build: Callable[[Star], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(written_star(spark, sf_dir))


def _on_star(build: Callable[[Star], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(star(spark, sf_dir))


def _on_retrofit(build: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(retrofit(spark, sf_dir))


def _select_all(relation: str, columns: str = "*") -> str:
    return query(f"select {columns} from {relation}", relation)


_AGES = (
    "Pre-1900", "1900-1929", "1930-1949", "1950-1975",
    "1976-1990", "1991-2002", "2003-2011", "2012-Present",
)
_AGE_COLUMNS = (
    "pre_1900", "1900_1929", "1930_1949", "1950_1975",
    "1976_1990", "1991_2002", "2003_2011", "2012_present",
)
_CELLS = f"""
select property_type, construction_age_band,
  {rnd(mean("cast(avg_retrofit_priority_score as decimal(20, 1))"), 1)} as score,
  cast(sum(property_count) as bigint) as total_props
from retrofit where construction_age_band <> 'Unknown' and property_type is not null group by 1, 2
"""
_LEAVES = f"""
select county, local_authority,
  {rnd(mean("cast(avg_efficiency_current as decimal(20, 1))"), 1)} as avg_efficiency,
  cast(round(sum(total_co2_saving_potential_tonnes), 0) as double) as total_co2_saving,
  cast(sum(property_count) as bigint) as property_count
from retrofit where county is not null and local_authority is not null
group by 1, 2 having sum(property_count) > 100
"""
_RATINGS = f"""
select energy_rating_current as rating, cast(count(*) as bigint) as n,
  {rnd("count(*) * cast(100 as double) / (select count(*) from facts where energy_rating_current is not null)", 1)} as pct
from facts where energy_rating_current is not null group by 1
"""
_AREAS = """
select regexp_extract(l.postcode, '^([A-Z]{1,2})', 1) as postcode_area, f.energy_rating_current as rating,
  cast(count(*) as bigint) as cnt
from facts f join locs l using (location_id) where f.energy_rating_current is not null group by 1, 2
"""
_AREA_SHARES = f"""
select a.*, {rnd("cnt * cast(100 as double) / sum(cnt) over (partition by postcode_area)", 1)} as pct from ({_AREAS}) a
"""
_TREND = f"""
select cast(year(inspection_at) as integer) as yr, {rnd(mean("energy_efficiency_current"), 1)} as avg_sap,
  cast(count(*) as bigint) as certs
from facts where year(inspection_at) between 2008 and 2024 group by 1
"""
_FUELS = f"""
select main_fuel as fuel, {rnd(mean("energy_efficiency_current"), 1)} as avg_current,
  {rnd(mean("energy_efficiency_potential"), 1)} as avg_potential, cast(count(*) as bigint) as n
from stg where main_fuel <> 'Other/Unknown' and energy_efficiency_current > 0 group by 1
"""
SUMMARY_SQL = f"""
select cast(count(*) as bigint) as total,
  cast(sum(co2_emissions_current_tonnes_per_year) as double) as co2_current,
  cast(sum(co2_emissions_current_tonnes_per_year - co2_emissions_potential_tonnes_per_year) as double) as co2_saving,
  {rnd("cast(sum(co2_emissions_current_tonnes_per_year - co2_emissions_potential_tonnes_per_year) as double) / cast(sum(co2_emissions_current_tonnes_per_year) as double) * 100", 1)} as pct_saving,
  {rnd(mean("energy_efficiency_current"), 1)} as avg_eff_current,
  {rnd(mean("energy_efficiency_potential"), 1)} as avg_eff_potential,
  {rnd("cast(count(*) filter (where energy_rating_current >= 'D') as double) / count(*) * 100", 1)} as pct_below_c
from facts
"""
# Sample order: md5 of seed and key, as the sampler documents.
_SAMPLE = "order by md5('{seed}:' || certificate_id), certificate_id limit {n}"


def _box_sql(n: int) -> str:
    sample = _SAMPLE.format(seed=42, n=n)
    return f"""
with drawn as (select * from facts {sample}),
rows as (
  select p.property_type, cast(d.co2_emissions_current_tonnes_per_year as double) as co2
  from drawn d join props p using (property_id)
  where d.co2_emissions_current_tonnes_per_year between 0.1 and 20 and p.property_type is not null),
box as (
  select property_type, cast(count(*) as bigint) as n_rows, min(co2) as min_value, max(co2) as max_value,
    quantile_cont(co2, 0.25) as q1, quantile_cont(co2, 0.5) as median, quantile_cont(co2, 0.75) as q3
  from rows group by 1),
ends as (
  select r.property_type, min(r.co2) as lower_whisker, max(r.co2) as upper_whisker
  from rows r join box b using (property_type)
  where r.co2 between b.q1 - 1.5 * (b.q3 - b.q1) and b.q3 + 1.5 * (b.q3 - b.q1) group by 1)
select property_type, n_rows, min_value, lower_whisker, round(q1, 4) as q1, round(median, 4) as median,
  round(q3, 4) as q3, upper_whisker, max_value,
  round(median - 1.57 * (q3 - q1) / sqrt(n_rows), 4) as notch_low,
  round(median + 1.57 * (q3 - q1) / sqrt(n_rows), 4) as notch_high
from box join ends using (property_type)
"""


def _density_sql(n: int) -> str:
    sample = _SAMPLE.format(seed=42, n=n)
    return f"""
with drawn as (select * from facts {sample})
select p.property_type,
  cast(floor((cast(d.energy_efficiency_current as double) - 1) / 5) as integer) as x_bin,
  cast(floor((cast(d.co2_emissions_current_tonnes_per_year as double) - cast(0.1 as double)) / cast(0.5 as double)) as integer) as y_bin,
  cast(count(*) as bigint) as n
from drawn d join props p using (property_id)
where d.energy_efficiency_current between 1 and 100
  and d.co2_emissions_current_tonnes_per_year between 0.1 and 15 and p.property_type is not null
group by 1, 2, 3
"""


def _profile_sql(column: str, limit: bool = True) -> str:
    tail = f"order by n desc, {column} limit 30" if limit else ""
    return query(f"select {column}, cast(count(*) as bigint) as n from stg group by 1 {tail}", "stg")


def _rounded_box(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


def _failures_sql() -> str:
    integers = list(staging.INTEGER.values())
    decimals = list(staging.DECIMAL.values())
    dates = list(staging.DATE.values())
    parts = []
    for names, kind in ((integers, "integer"), (decimals, "decimal(10, 2)"), (dates, "date")):
        for c in names:
            parts.append(
                f"select '{c}' as raw_column, cast(count(*) filter (where trim({c}) <> '') as bigint) as n_text,"
                f" cast(count(*) filter (where trim({c}) <> '' and try_cast({c} as {kind}) is null) as bigint) as n_failed"
                " from epc_raw"
            )
    return query(" union all ".join(parts), "epc_raw")


def _share_of_national_carbon(s: Star) -> DataFrame:
    """Carbon per rating and its share of the national total."""
    co2 = F.col("co2_emissions_current_tonnes_per_year")
    banded = s.facts.groupBy("energy_rating_current").agg(F.sum(co2).alias("co2"), F.count("*").alias("n"))
    with_sum = with_total(banded, F.sum("co2"), "co2_total")
    return with_sum.select(
        "energy_rating_current",
        F.col("co2").cast("decimal(38,2)").alias("co2"),
        rounded(F.col("co2").cast("double") / F.col("co2_total").cast("double") * 100, 2).alias("pct"),
        compact_count(F.col("n").cast("bigint")).alias("n_text"),
    )


AGGREGATE_SQL = query(
    f"""
select county, property_type, tenure, construction_age_band,
  cast(date_trunc('year', f.inspection_at) as timestamp) as inspection_year,
  cast(count(*) as bigint) as certificate_count,
  {rnd(mean("f.energy_efficiency_current"), 2)} as avg_energy_efficiency,
  cast(sum(f.co2_emissions_current_tonnes_per_year) as decimal(38, 2)) as total_co2_emissions
from facts f left join props p on f.property_id = p.property_id
  left join locs l on f.location_id = l.location_id
group by 1, 2, 3, 4, 5
""",
    "facts", "props", "locs",
)


# name -> (DataFrame query, SQL to check it against)
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    # staging
    "lowercase_columns": (
        lambda spark, d: staging.lower_case_columns(raw(spark, d)).select("lmk_key", "uprn", "main_fuel"),
        query("select lmk_key as lmk_key, uprn as uprn, main_fuel as main_fuel from epc_raw", "epc_raw"),
    ),
    "validity_filter": (
        lambda spark, d: staging.valid_rows(raw(spark, d)).select(F.col("LMK_KEY").alias("lmk_key")),
        query(
            "select lmk_key as lmk_key from epc_raw where current_energy_rating <> 'INVALID!'"
            " and uprn is not null and inspection_date is not null",
            "epc_raw",
        ),
    ),
    "stg_certificates": (
        lambda spark, d: staging.stage_certificates(raw(spark, d)),
        _select_all("stg", "* exclude (walls_description)"),
    ),
    "parse_failures": (lambda spark, d: staging.parse_failures(raw(spark, d)), _failures_sql()),
    "row_count_check": (
        lambda spark, d: raw(spark, d).agg(F.count(F.lit(1)).alias("n_rows")),
        query("select cast(count(*) as bigint) as n_rows from epc_raw", "epc_raw"),
    ),
    # star schema
    "dim_properties": (_on_star(lambda s: s.properties), _select_all("props")),
    "dim_locations": (_on_star(lambda s: s.locations), _select_all("locs")),
    "dim_locations_unique": (
        _on_star(lambda s: marts.dim_locations_unique(s.staged)),
        query(
            """
with tuples as (select postcode, post_town, local_authority, constituency, county, count(*) as n
  from stg where postcode is not null group by all)
select distinct on (postcode) md5(postcode) as location_id, postcode, post_town, local_authority, constituency, county
from tuples order by postcode, n desc, post_town desc nulls last, local_authority desc nulls last,
  constituency desc nulls last, county desc nulls last
""",
            "stg",
        ),
    ),
    "fct_certificates": (_on_star(lambda s: marts.fct_certificates(s.facts)), _select_all("facts")),
    "fct_energy_performance": (
        _on_star(lambda s: marts.fct_energy_performance(s.staged)),
        query(
            """
select certificate_id, uprn, address1, postcode, energy_rating_current, energy_rating_potential,
  energy_efficiency_current, energy_efficiency_potential,
  energy_efficiency_potential - energy_efficiency_current as efficiency_gain_potential,
  total_floor_area_sqm, inspection_at, lodgement_at, property_type, built_form,
  heating_cost_current, hot_water_cost_current, lighting_cost_current,
  cast(heating_cost_current + hot_water_cost_current + lighting_cost_current as decimal(12, 2))
    as total_estimated_annual_cost_current
from stg
""",
            "stg",
        ),
    ),
    "fct_property_aggregations": (_on_written(marts.fct_property_aggregations), AGGREGATE_SQL),
    # analytics
    "v_construction_age": (
        _on_star(analytics.construction_age),
        query(
            f"""
select construction_age_band, property_type, cast(count(*) as bigint) as total_certificates,
  {mean("energy_efficiency_current")} as avg_efficiency,
  {mean("energy_consumption_current")} as avg_consumption,
  {mean("co2_emissions_current_tonnes_per_year")} as avg_co2
from facts join props using (property_id) where construction_age_band is not null group by 1, 2
""",
            "facts", "props",
        ),
    ),
    "v_regional_performance": (_on_star(analytics.regional_performance), _select_all("regional")),
    "v_regional_performance_unique": (
        _on_star(lambda s: reports.regional_unique(s, marts.dim_locations_unique(s.staged))),
        query(
            f"""
with tuples as (select postcode, post_town, local_authority, constituency, county, count(*) as n
  from stg where postcode is not null group by all),
one as (select distinct on (postcode) md5(postcode) as location_id, county, local_authority, post_town
  from tuples order by postcode, n desc, post_town desc nulls last, local_authority desc nulls last,
    constituency desc nulls last, county desc nulls last)
select county, local_authority, post_town, cast(count(*) as bigint) as total_certificates,
  {mean("energy_efficiency_current")} as avg_current_efficiency,
  {mean("energy_efficiency_potential")} as avg_potential_efficiency,
  {mean("co2_emissions_current_tonnes_per_year")} as avg_co2_current,
  {mean("co2_emissions_potential_tonnes_per_year")} as avg_co2_potential,
  {mean("energy_efficiency_potential - energy_efficiency_current")} as avg_efficiency_gap
from facts join one using (location_id) group by 1, 2, 3
""",
            "stg", "facts",
        ),
    ),
    "v_efficiency_gaps": (
        _on_star(analytics.efficiency_gaps),
        query(
            """
select certificate_id, uprn, property_type, built_form, energy_efficiency_current, energy_efficiency_potential,
  energy_efficiency_potential - energy_efficiency_current as efficiency_gap,
  cast(co2_emissions_current_tonnes_per_year - co2_emissions_potential_tonnes_per_year as decimal(11, 2))
    as co2_reduction_potential_tonnes
from facts join props using (property_id)
where energy_efficiency_potential - energy_efficiency_current > 30
""",
            "facts", "props",
        ),
    ),
    "v_retrofit_priority": (retrofit, _select_all("retrofit")),
    "global_max": (
        _on_star(lambda s: analytics.score_scale(s, analytics.improvable(s))),
        query(
            "select max(100 - sap_now) as max_inefficiency, max(gain) as max_gap,"
            " cast(max(saved) as decimal(11, 2)) as max_co2_saving from base",
            "base",
        ),
    ),
    # reports
    "rating_distribution": (
        _on_star(reports.rating_distribution),
        query(f"select *, concat(pct, '%') as label from ({_RATINGS}) r", "facts"),
    ),
    "rating_below_c": (
        _on_star(reports.below_c_share),
        query(
            f"select cast(sum(cast(pct as decimal(6, 1))) as double) as pct_below_c from ({_RATINGS}) r where rating >= 'D'",
            "facts",
        ),
    ),
    "county_best_worst": (
        _on_written(reports.county_best_worst),
        query(
            """
with placed as (select *, row_number() over (order by avg_current_efficiency nulls last, county, local_authority, post_town) as up,
    count(*) over () as rows_all from regional where county is not null),
ends as (
  select 'worst' as side, * from placed where up <= 20
  union all select 'best', * from placed where up > rows_all - 20)
select side, county, local_authority, post_town, avg_current_efficiency, total_certificates,
  cast(row_number() over (partition by side order by up) as integer) as position,
  greatest(cast(0 as double), least(cast(1 as double), (avg_current_efficiency - 48) / 28)) as colour
from ends
""",
            "regional",
        ),
    ),
    "efficiency_by_age": (
        _on_star(reports.efficiency_by_age),
        query(
            f"""
select construction_age_band, {rnd(mean("energy_efficiency_current"), 1)} as avg_current,
  {rnd(mean("energy_efficiency_potential"), 1)} as avg_potential,
  cast(list_position([{", ".join(f"'{a}'" for a in (*_AGES, "Unknown"))}], construction_age_band) - 1 as integer) as age_order
from facts join props using (property_id) where construction_age_band is not null group by 1
""",
            "facts", "props",
        ),
    ),
    "co2_box_by_type": (
        lambda spark, d: _rounded_box(reports.co2_box_by_type(written_star(spark, d))),
        query(_box_sql(200_000), "facts", "props"),
    ),
    "efficiency_density": (
        _on_written(reports.efficiency_density),
        query(_density_sql(150_000), "facts", "props"),
    ),
    "sample_before_filter": (
        _on_written(lambda s: reports.efficiency_density(s, 2_000)),
        query(_density_sql(2_000), "facts", "props"),
    ),
    "retrofit_cells": (
        _on_retrofit(reports.retrofit_cells),
        query(
            f"""select *, concat(cast(cast(round_even(score, 0) as bigint) as varchar), ' (', format('{{:,}}', total_props), ')') as label
from ({_CELLS}) c""",
            "retrofit",
        ),
    ),
    "retrofit_matrix": (
        _on_retrofit(reports.retrofit_matrix),
        query(
            "select property_type, "
            + ", ".join(
                f"coalesce(max(score) filter (where construction_age_band = '{a}'), 0) as score_{c},"
                f" coalesce(max(total_props) filter (where construction_age_band = '{a}'), 0) as props_{c}"
                for a, c in zip(_AGES, _AGE_COLUMNS)
            )
            + f" from ({_CELLS}) c group by 1",
            "retrofit",
        ),
    ),
    "retrofit_cells_weighted": (
        _on_retrofit(reports.weighted_retrofit_cells),
        query(
            f"""
select property_type, construction_age_band,
  {rnd("cast(sum(cast(avg_retrofit_priority_score as decimal(6, 1)) * property_count) as double)"
       " / nullif(sum(property_count) filter (where avg_retrofit_priority_score is not null), 0)", 1)} as score,
  cast(sum(property_count) as bigint) as total_props
from retrofit where construction_age_band <> 'Unknown' and property_type is not null group by 1, 2
""",
            "retrofit",
        ),
    ),
    "la_treemap": (_on_retrofit(lambda r: reports.la_treemap(r, 100)), query(_LEAVES, "retrofit")),
    "treemap_levels": (
        _on_retrofit(lambda r: reports.treemap_levels(reports.la_treemap(r, 100))),
        query(
            f"""
with leaves as ({_LEAVES}),
boxes as (
  select 2 as level, county, local_authority, avg_efficiency, total_co2_saving from leaves
  union all select 1, county, null, avg_efficiency, total_co2_saving from leaves
  union all select 0, null, null, avg_efficiency, total_co2_saving from leaves)
select cast(level as integer) as level, county, local_authority, sum(total_co2_saving) as total_co2_saving,
  {rnd("cast(sum(cast(avg_efficiency as decimal(6, 1)) * cast(total_co2_saving as decimal(18, 0))) as double) / sum(total_co2_saving)", 4)} as weighted_efficiency
from boxes group by 1, 2, 3
""",
            "retrofit",
        ),
    ),
    "postcode_band_counts": (_on_star(reports.postcode_band_counts), query(_AREAS, "facts", "locs")),
    "postcode_band_shares": (_on_star(reports.postcode_band_shares), query(_AREA_SHARES, "facts", "locs")),
    "postcode_band_matrix": (
        _on_star(reports.postcode_band_matrix),
        query(
            "select postcode_area, "
            + ", ".join(f"coalesce(max(pct) filter (where rating = '{b}'), 0) as band_{b.lower()}" for b in "ABCDEFG")
            + f" from ({_AREA_SHARES}) s group by 1",
            "facts", "locs",
        ),
    ),
    "fuel_impact": (_on_star(reports.fuel_impact), query(_FUELS, "stg")),
    "fuel_gap": (
        _on_star(reports.fuel_gap),
        query(f"select {rnd('max(avg_current) - min(avg_current)', 1)} as gap from ({_FUELS}) f", "stg"),
    ),
    "annual_trend": (_on_star(reports.annual_trend), query(_TREND, "facts")),
    "trend_gain": (
        _on_star(reports.trend_gain),
        query(
            f"""
with trend as ({_TREND})
select min(yr) as first_year, max(yr) as last_year,
  {rnd("(select avg_sap from trend order by yr desc limit 1) - (select avg_sap from trend order by yr limit 1)", 1)} as improvement
from trend
""",
            "facts",
        ),
    ),
    "cost_breakdown": (
        _on_star(reports.cost_breakdown),
        query(
            f"""
select property_type, {rnd(mean("heating_cost_current"), 0)} as heating,
  {rnd(mean("hot_water_cost_current"), 0)} as hot_water, {rnd(mean("lighting_cost_current"), 0)} as lighting
from facts join props using (property_id)
where heating_cost_current > 0 and heating_cost_current < 10000 and property_type is not null group by 1
""",
            "facts", "props",
        ),
    ),
    "national_summary": (_on_star(reports.national_summary), query(SUMMARY_SQL, "facts")),
    "emissions_equivalence": (
        _on_star(lambda s: reports.emissions_equivalence(s, 4)),
        query(
            f"""
with mt as (select {rnd("co2_saving / 1000000", 4)} as co2_saving_mt from ({SUMMARY_SQL}) s)
select co2_saving_mt, {rnd("co2_saving_mt / cast(2.1 as double)", 4)} as cars_million from mt
""",
            "facts",
        ),
    ),
    "carbon_by_rating": (
        _on_star(_share_of_national_carbon),
        query(
            f"""
select energy_rating_current, cast(sum(co2_emissions_current_tonnes_per_year) as decimal(38, 2)) as co2,
  {rnd("cast(sum(co2_emissions_current_tonnes_per_year) as double) / (select cast(sum(co2_emissions_current_tonnes_per_year) as double) from facts) * 100", 2)} as pct,
  format('{{:,}}', count(*)) as n_text
from facts group by 1
""",
            "facts",
        ),
    ),
    "profile_age": (_on_star(lambda s: reports.profile(s, "construction_age_band")), _profile_sql("construction_age_band")),
    "profile_fuel": (_on_star(lambda s: reports.profile(s, "main_fuel")), _profile_sql("main_fuel")),
    "profile_rating": (_on_star(reports.rating_profile), _profile_sql("energy_rating_current", limit=False)),
}
