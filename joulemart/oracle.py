"""Independent SQL for checking results on another engine.

The texts share no code with the DataFrame plans beyond the raw-row SQL: they
join row by row where the plans pre-aggregate, pick latest rows with DISTINCT
ON where the plans use an aggregate, and match labels with regular expressions.
"""

from __future__ import annotations

from joulemart.sources.certificate_rows import RAW_SQL

_NULL_KEY = "'_dbt_utils_surrogate_key_null_'"


def mean(x: str) -> str:
    """Exact sum over count, in double."""
    return f"(cast(sum({x}) as double) / nullif(count({x}), 0))"


def rnd(x: str, digits: int) -> str:
    """Half away from zero, decided on the decimal value."""
    return f"cast(round(cast({x} as decimal(28, 10)), {digits}) as double)"


_STG = f"""
select md5(coalesce(lmk_key, {_NULL_KEY})) as certificate_key, lmk_key as certificate_id, uprn as uprn,
  building_reference_number as building_ref, address1 as address1,
  cast(null as varchar) as address2, cast(null as varchar) as address3,
  postcode as postcode, posttown as post_town, local_authority_label as local_authority,
  constituency_label as constituency, county as county,
  nullif(regexp_extract(current_energy_rating, '^[A-G]$'), '') as energy_rating_current,
  nullif(regexp_extract(potential_energy_rating, '^[A-G]$'), '') as energy_rating_potential,
  cast(current_energy_efficiency as integer) as energy_efficiency_current,
  cast(potential_energy_efficiency as integer) as energy_efficiency_potential,
  property_type as property_type, built_form as built_form, cast(total_floor_area as decimal(10, 2)) as total_floor_area_sqm,
  case
    when construction_age_band is null then 'Unknown'
    when regexp_matches(construction_age_band, 'before 1900') then 'Pre-1900'
    when regexp_matches(construction_age_band, '1900-1929') then '1900-1929'
    when regexp_matches(construction_age_band, '1930-1949') then '1930-1949'
    when regexp_matches(construction_age_band, '1950-1966|1967-1975') then '1950-1975'
    when regexp_matches(construction_age_band, '1976-1982|1983-1990') then '1976-1990'
    when regexp_matches(construction_age_band, '1991-1995|1996-2002') then '1991-2002'
    when regexp_matches(construction_age_band, '2003-2006|2007') then '2003-2011'
    when regexp_matches(construction_age_band, '2012|onwards') then '2012-Present'
    when not regexp_full_match(construction_age_band, '[0-9][0-9][0-9][0-9]') then 'Unknown'
    when construction_age_band > '2011' then '2012-Present'
    when construction_age_band > '2002' then '2003-2011'
    when construction_age_band > '1990' then '1991-2002'
    when construction_age_band > '1975' then '1976-1990'
    when construction_age_band > '1949' then '1950-1975'
    when construction_age_band > '1929' then '1930-1949'
    when construction_age_band > '1899' then '1900-1929'
    else 'Pre-1900'
  end as construction_age_band,
  tenure as tenure, transaction_type as transaction_type,
  cast(inspection_date as date) as inspection_at, cast(lodgement_date as date) as lodgement_at,
  cast(environment_impact_current as integer) as env_impact_current,
  cast(environment_impact_potential as integer) as env_impact_potential,
  cast(energy_consumption_current as integer) as energy_consumption_current,
  cast(energy_consumption_potential as integer) as energy_consumption_potential,
  cast(co2_emissions_current as decimal(10, 2)) as co2_emissions_current_tonnes_per_year,
  cast(co2_emissions_potential as decimal(10, 2)) as co2_emissions_potential_tonnes_per_year,
  cast(lighting_cost_current as decimal(10, 2)) as lighting_cost_current,
  cast(heating_cost_current as decimal(10, 2)) as heating_cost_current,
  cast(hot_water_cost_current as decimal(10, 2)) as hot_water_cost_current,
  case
    when main_fuel is null then 'Other/Unknown'
    when regexp_matches(main_fuel, 'gas', 'i') then 'Mains Gas'
    when regexp_matches(main_fuel, 'electricity', 'i') then 'Electricity'
    when regexp_matches(main_fuel, 'oil', 'i') then 'Heating Oil'
    when regexp_matches(main_fuel, 'lpg', 'i') then 'LPG'
    when regexp_matches(main_fuel, 'coal|anthracite', 'i') then 'Solid Fuel'
    when regexp_matches(main_fuel, 'wood|biomass', 'i') then 'Biomass'
    else 'Other/Unknown'
  end as main_fuel,
  floor_level as floor_level, cast(number_habitable_rooms as integer) as count_habitable_rooms,
  cast(number_heated_rooms as integer) as count_heated_rooms,
  cast(extension_count as integer) as count_extensions, filename as source_file,
  walls_description as walls_description
from epc_raw
where current_energy_rating <> 'INVALID!' and uprn is not null and inspection_date is not null
"""

_PROPS = """
select distinct on (uprn) md5(uprn) as property_id, uprn, property_type, built_form,
  construction_age_band, tenure, total_floor_area_sqm,
  count_habitable_rooms, count_heated_rooms, count_extensions
from stg where uprn is not null
order by uprn, inspection_at desc nulls last, lodgement_at desc nulls last, certificate_id desc
"""

_LOCS = """
select md5(postcode) as location_id, postcode, post_town, local_authority, constituency, county
from stg where postcode is not null group by all
"""

_FACTS = f"""
select md5(certificate_id) as certificate_key, certificate_id,
  md5(coalesce(uprn, {_NULL_KEY})) as property_id, md5(coalesce(postcode, {_NULL_KEY})) as location_id,
  energy_rating_current, energy_rating_potential,
  energy_efficiency_current, energy_efficiency_potential,
  env_impact_current, env_impact_potential,
  energy_consumption_current, energy_consumption_potential,
  co2_emissions_current_tonnes_per_year, co2_emissions_potential_tonnes_per_year,
  lighting_cost_current, heating_cost_current, hot_water_cost_current,
  inspection_at, lodgement_at, source_file
from stg where certificate_id is not null
"""

# Row-level join of everything, with location fan-out.
_WIDE = """
select f.*, p.uprn, p.property_type, p.built_form, p.construction_age_band, p.tenure,
  l.postcode, l.county, l.local_authority, l.post_town,
  f.co2_emissions_current_tonnes_per_year as co2_now,
  f.co2_emissions_potential_tonnes_per_year as co2_later,
  f.energy_efficiency_current as sap_now, f.energy_efficiency_potential as sap_later
from facts f join props p using (property_id) join locs l using (location_id)
"""

_BASE = """
select property_type, construction_age_band, tenure, county, local_authority,
  sap_now, sap_later, sap_later - sap_now as gain, co2_now, co2_now - co2_later as saved
from wide
where sap_now > 0 and sap_later > sap_now and co2_now is not null
  and property_type is not null and construction_age_band is not null and local_authority is not null
"""

_SCORED = """
select *, round(cast((
    cast(0.35 as double) * (cast(100 - sap_now as double) / nullif((select max(100 - sap_now) from base), 0))
  + cast(0.40 as double) * (cast(gain as double) / nullif((select max(gain) from base), 0))
  + cast(0.25 as double) * (cast(saved as double) / nullif(cast((select max(saved) from base) as double), 0))
  ) * 100 as decimal(28, 10)), 1) as points
from base
"""

_RETROFIT = f"""
select property_type, construction_age_band, tenure, county, local_authority,
  cast(count(*) as bigint) as property_count,
  {rnd(mean("sap_now"), 1)} as avg_efficiency_current,
  {rnd(mean("sap_later"), 1)} as avg_efficiency_potential,
  {rnd(mean("gain"), 1)} as avg_efficiency_gap,
  {rnd(mean("co2_now"), 3)} as avg_co2_current_tonnes,
  {rnd(mean("saved"), 3)} as avg_co2_saving_per_property_tonnes,
  cast(round(sum(saved), 1) as decimal(38, 1)) as total_co2_saving_potential_tonnes,
  {rnd(mean("points"), 1)} as avg_retrofit_priority_score,
  cast(max(points) as double) as max_retrofit_priority_score
from scored group by 1, 2, 3, 4, 5
"""

_REGIONAL = f"""
select county, local_authority, post_town, cast(count(*) as bigint) as total_certificates,
  {mean("energy_efficiency_current")} as avg_current_efficiency,
  {mean("energy_efficiency_potential")} as avg_potential_efficiency,
  {mean("co2_emissions_current_tonnes_per_year")} as avg_co2_current,
  {mean("co2_emissions_potential_tonnes_per_year")} as avg_co2_potential,
  {mean("energy_efficiency_potential - energy_efficiency_current")} as avg_efficiency_gap
from facts join locs using (location_id)
group by 1, 2, 3
"""

_FEATURES = """
select certificate_id, energy_rating_current as target,
  cast(total_floor_area_sqm as double) as total_floor_area_sqm,
  construction_age_band, main_fuel,
  case
    when regexp_matches(walls_description, 'cavity', 'i') and regexp_matches(walls_description, 'no insulation|uninsulated', 'i') then 'Cavity - Uninsulated'
    when regexp_matches(walls_description, 'cavity', 'i') and regexp_matches(walls_description, 'insulation', 'i') then 'Cavity - Insulated'
    when regexp_matches(walls_description, 'solid', 'i') and regexp_matches(walls_description, 'no insulation|uninsulated', 'i') then 'Solid - Uninsulated'
    when regexp_matches(walls_description, 'solid', 'i') and regexp_matches(walls_description, 'insulation', 'i') then 'Solid - Insulated'
    when regexp_matches(walls_description, 'timber', 'i') then 'Timber Frame'
    when regexp_matches(walls_description, 'system', 'i') then 'System Build'
    else 'Other/Unknown'
  end as wall_type
from stg
where energy_rating_current is not null and total_floor_area_sqm > 0
  and construction_age_band <> 'Unknown' and main_fuel <> 'Other/Unknown'
"""

# Definition and direct inputs of each named relation.
_RELATIONS = {
    "epc_raw": (RAW_SQL.format(orders="orders", customer="customer", nation="nation", region="region"), ()),
    "stg": (_STG, ("epc_raw",)),
    "props": (_PROPS, ("stg",)),
    "locs": (_LOCS, ("stg",)),
    "facts": (_FACTS, ("stg",)),
    "wide": (_WIDE, ("facts", "props", "locs")),
    "base": (_BASE, ("wide",)),
    "scored": (_SCORED, ("base",)),
    "retrofit": (_RETROFIT, ("scored",)),
    "regional": (_REGIONAL, ("facts", "locs")),
    "features": (_FEATURES, ("stg",)),
}


def query(body: str, *relations: str) -> str:
    """``body`` with the CTEs of the relations it names, inputs first."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for inner in _RELATIONS[name][1]:
            need(inner)
        if name not in ordered:
            ordered.append(name)

    for name in relations:
        need(name)
    ctes = ",\n".join(f"{name} as materialized ({_RELATIONS[name][0].strip()})" for name in ordered)
    body = body.strip()
    if body.startswith("with "):
        body = ", " + body.removeprefix("with ")
    return f"with {ctes}\n{body}"
