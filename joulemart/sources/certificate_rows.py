"""Certificate-shaped raw rows derived from the sales test tables.

One all-text row per order, with the defects real certificate files have: bad
and missing ratings, missing keys, several certificates per property, date
ties, postcodes that span two towns. The text runs unchanged on other SQL
engines, so checks can start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

RAW_SQL = """
select
 'L' || cast(o_orderkey as string) as LMK_KEY,
 case when o_orderkey % 97 = 0 then null else cast(100000 + o_custkey as string) end as UPRN,
 cast(o_custkey * 7 as string) as BUILDING_REFERENCE_NUMBER,
 c_name as ADDRESS1,
 case when o_orderkey % 101 = 0 then null else chr(65 + n_nationkey) || case when c_custkey % 2 = 0 then chr(cast(65 + c_custkey % 5 as int)) else '' end || cast(1 + c_custkey % 20 as string) || ' ' || cast(c_custkey % 9 as string) || 'AA' end as POSTCODE,
 'TOWN_' || cast(c_custkey % 40 as string) as POSTTOWN,
 'LA_' || cast(n_nationkey as string) || '_' || cast(c_custkey % 4 as string) as LOCAL_AUTHORITY_LABEL,
 'CON_' || cast(n_nationkey as string) as CONSTITUENCY_LABEL,
 case when n_nationkey % 6 = 5 then null else r_name end as COUNTY,
 case when o_orderkey % 223 = 0 then null when o_orderkey % 211 = 0 then 'INVALID!' when o_orderkey % 227 = 0 then 'X'
  when sap >= 92 then 'A' when sap >= 81 then 'B' when sap >= 69 then 'C' when sap >= 55 then 'D' when sap >= 39 then 'E' when sap >= 21 then 'F' else 'G' end as CURRENT_ENERGY_RATING,
 case when pot >= 92 then 'A' when pot >= 81 then 'B' when pot >= 69 then 'C' when pot >= 55 then 'D' when pot >= 39 then 'E' when pot >= 21 then 'F' else 'G' end as POTENTIAL_ENERGY_RATING,
 cast(sap as string) as CURRENT_ENERGY_EFFICIENCY, cast(pot as string) as POTENTIAL_ENERGY_EFFICIENCY,
 case c_custkey % 5 when 0 then 'House' when 1 then 'Flat' when 2 then 'Bungalow' when 3 then 'Maisonette' else null end as PROPERTY_TYPE,
 case c_custkey % 3 when 0 then 'Detached' when 1 then 'Semi-Detached' else 'Mid-Terrace' end as BUILT_FORM,
 cast(20 + o_orderkey % 280 as string) || '.' || cast(10 + o_orderkey % 90 as string) as TOTAL_FLOOR_AREA,
 case o_orderkey % 12 when 0 then 'England and Wales: before 1900' when 1 then 'England and Wales: 1900-1929' when 2 then 'England and Wales: 1950-1966' when 3 then 'England and Wales: 1967-1975' when 4 then 'England and Wales: 1983-1990' when 5 then 'England and Wales: 2003-2006' when 6 then 'England and Wales: 2007 onwards' when 7 then 'England and Wales: 2012 onwards' when 8 then '1985' when 9 then '2015' when 10 then 'NO DATA!' else null end as CONSTRUCTION_AGE_BAND,
 case o_orderkey % 4 when 0 then 'owner-occupied' when 1 then 'rental (private)' when 2 then 'rental (social)' else null end as TENURE,
 o_orderpriority as TRANSACTION_TYPE,
 cast(year(o_orderdate) + 12 as string) || substr(cast(cast(o_orderdate as date) as string), 5) as INSPECTION_DATE, cast(year(o_orderdate) + 12 as string) || substr(cast(cast(o_orderdate as date) as string), 5) as LODGEMENT_DATE,
 cast(sap as string) as ENVIRONMENT_IMPACT_CURRENT, cast(pot as string) as ENVIRONMENT_IMPACT_POTENTIAL,
 cast(500 - 4 * sap as string) as ENERGY_CONSUMPTION_CURRENT, cast(500 - 4 * pot as string) as ENERGY_CONSUMPTION_POTENTIAL,
 case when o_orderkey % 89 = 0 then null else cast((101 - sap) % 20 as string) || '.' || cast(o_orderkey % 10 as string) end as CO2_EMISSIONS_CURRENT,
 cast((101 - pot) % 20 as string) || '.' || cast(o_orderkey % 10 as string) as CO2_EMISSIONS_POTENTIAL,
 cast(30 + o_orderkey % 120 as string) as LIGHTING_COST_CURRENT, cast((o_orderkey * 13) % 12000 as string) as HEATING_COST_CURRENT, cast(60 + o_orderkey % 400 as string) as HOT_WATER_COST_CURRENT,
 case o_orderkey % 9 when 0 then 'mains gas (not community)' when 1 then 'Electricity: unspecified tariff' when 2 then 'oil (not community)' when 3 then 'LPG (not community)' when 4 then 'house coal (not community)' when 5 then 'wood logs' when 6 then 'biogas (community)' when 7 then null else 'To be used only when there is no heating' end as MAIN_FUEL,
 case o_orderkey % 8 when 0 then 'Cavity wall, as built, no insulation (assumed)' when 1 then 'Cavity wall, filled cavity' when 2 then 'Cavity wall, with external insulation' when 3 then 'Solid brick, as built, no insulation (assumed)' when 4 then 'Solid brick, with internal insulation' when 5 then 'Timber frame, as built, insulated (assumed)' when 6 then 'System built, as built, no insulation (assumed)' else null end as WALLS_DESCRIPTION,
 cast(o_orderkey % 4 as string) as FLOOR_LEVEL, cast(1 + o_orderkey % 9 as string) as NUMBER_HABITABLE_ROOMS, cast(1 + o_orderkey % 8 as string) as NUMBER_HEATED_ROOMS, cast(o_orderkey % 3 as string) as EXTENSION_COUNT,
 'domestic-' || cast(n_nationkey as string) || '/certificates.csv' as filename
from (select o.*, c.*, n.*, r.r_name, 1 + cast(floor(o_totalprice) as bigint) % 100 as sap, least(1 + cast(floor(o_totalprice) as bigint) % 100 + o_orderkey % 45, 100) as pot
 from {orders} o join {customer} c on o_custkey = c_custkey join {nation} n on c_nationkey = n_nationkey join {region} r on n_regionkey = r_regionkey) b
"""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_certificates(spark: SparkSession, sf_dir: str, copies: int = 1) -> DataFrame:
    """All raw rows; ``copies`` > 1 repeats them under distinct keys."""
    sources = {n: read_table(spark, sf_dir, n) for n in ("orders", "customer", "nation", "region")}
    raw = spark.sql(RAW_SQL, **sources)
    if copies == 1:
        return raw
    # Spread the few source files over the cluster before multiplying their rows.
    numbered = raw.repartition(spark.sparkContext.defaultParallelism).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    suffix = F.concat(F.lit("-"), F.col("copy").cast("string"))
    return numbered.withColumns(
        {"LMK_KEY": F.concat("LMK_KEY", suffix), "UPRN": F.concat("UPRN", suffix)}
    ).drop("copy")
