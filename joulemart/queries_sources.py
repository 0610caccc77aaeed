"""Registered queries that go through files: CSV, tables, JSON, boundaries, streams.

Each writes data derived from the given tables below the shared work folder
and reads it back through the source under test.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joulemart import constants as K
from joulemart.operators import quality
from joulemart.oracle import mean, query, rnd
from joulemart.plans import checks, reports
from joulemart.plans.staging import lower_case_columns, stage_certificates
from joulemart.queries_core import AGGREGATE_SQL, SUMMARY_SQL, raw, retrofit, star, written_star
from joulemart.session import new_work_dir
from joulemart.sources.boundary_rows import boundary_documents
from joulemart.sources.csv_landing import CSV_OPTIONS, append_chunk, read_csv_by_name, write_csv_folders
from joulemart.sources.geojson import (
    match_districts, read_features, simplified_rings, unmatched_districts,
)
from joulemart.sources.tables import Warehouse, write_json_summary
from joulemart.sources.versions import Versions
from joulemart.streaming.aggregates import merge_available_aggregates, read_aggregates
from joulemart.streaming.incremental import compact, merge_available, read_state
from joulemart.streaming.landing import append_available, csv_stream, land_available, read_landed

_MAP_COUNT = 50
_AS_OF = "2013-06-30"


def _foldered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with the folder their file belongs to, in place of its name."""
    folder = F.substring_index("filename", "/", 1)
    return raw(spark, sf_dir).withColumn("folder", folder).drop("filename")


def _write_variants(spark: SparkSession, sf_dir: str, root: str, numbers: tuple[int, ...] = (0, 1, 2)) -> None:
    """Raw rows as CSV files with three different headers, by their folder's number."""
    rows = _foldered(spark, sf_dir)
    kind = F.regexp_extract("folder", "([0-9]+)$", 1).cast("int") % 3
    columns = [c for c in rows.columns if c != "folder"]
    variants = [columns, columns[::-1], [c for c in columns if c != "FLOOR_LEVEL"]]
    for number in numbers:
        write_csv_folders(rows.filter(kind == number).select("folder", *variants[number]), f"{root}/part{number}", "folder")


def landed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows after a trip through CSV files with three different headers."""
    root = new_work_dir(spark, "landing")
    _write_variants(spark, sf_dir, root)
    return read_csv_by_name(spark, root)


def streamed_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a stream of two runs, of which the second finds wider headers in another order."""
    root = new_work_dir(spark, "any-header")
    for numbers in ((2,), (0, 1)):
        _write_variants(spark, sf_dir, f"{root}/landing", numbers)
        land_available(spark, f"{root}/landing", f"{root}/table", f"{root}/checkpoint", files_per_batch=4)
    return lower_case_columns(read_landed(spark, f"{root}/table")).select(*_SCANNED)


def csv_by_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses with line breaks and quotes, from two large CSV files that are read by blocks."""
    path = new_work_dir(spark, "large-csv")
    address = F.concat_ws("", F.lit('"'), F.col("POSTCODE"), F.lit('"\n'), F.col("COUNTY"), F.lit(",\n"), F.col("WALLS_DESCRIPTION"))
    rows = raw(spark, sf_dir).select(F.col("LMK_KEY").alias("lmk_key"), address.alias("address"), F.col("UPRN").alias("uprn"))
    rows.repartition(2).write.options(**CSV_OPTIONS, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)
    return read_csv_by_name(spark, path, whole_file_bytes=0).drop("filename")


_SCANNED = ["lmk_key", "uprn", "postcode", "county", "walls_description", "floor_level", "main_fuel"]


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lower_case_columns(landed_csv(spark, sf_dir)).select(*_SCANNED)


def file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per source folder, from the file names alone."""
    folder = F.regexp_extract("filename", "folder=([^/]+)", 1)
    return landed_csv(spark, sf_dir).groupBy(folder.alias("folder")).agg(F.count("*").alias("n"))


def staged_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands of certificates staged from landed files."""
    staged = stage_certificates(landed_csv(spark, sf_dir))
    return staged.groupBy("energy_rating_current").agg(
        F.count("*").alias("n"), F.sum("total_floor_area_sqm").cast("decimal(38,2)").alias("area")
    )


def appended_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw keys after landing them in four chunks."""
    path = new_work_dir(spark, "chunks")
    rows = raw(spark, sf_dir).select(F.col("LMK_KEY").alias("lmk_key"), F.col("UPRN").alias("uprn"))
    chunk = F.pmod(F.xxhash64("lmk_key"), F.lit(4))
    for number in range(4):
        append_chunk(rows.filter(chunk == number), path, first=number == 0)
    return spark.read.parquet(path)


def materialised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of a freshly built warehouse."""
    return Warehouse(spark, new_work_dir(spark, "warehouse")).build(raw(spark, sf_dir)).row_counts()


def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Certificates per county as readers see them: before a replacement, after one that failed, and after one that went well."""
    tables = Versions(spark, new_work_dir(spark, "versions"))
    rows = raw(spark, sf_dir).select(F.col("COUNTY").alias("county"), F.col("INSPECTION_DATE").alias("inspection_date"))
    tables.replace("certificates", rows.filter("inspection_date < '2010-01-01'"))
    before = tables.pin()
    broken = F.when(F.col("inspection_date") >= "2012-01-01", F.raise_error(F.lit("broken row"))).otherwise(F.col("county"))
    with suppress(PySparkException):
        tables.replace("certificates", rows.withColumn("county", broken))
    failed = tables.read("certificates")
    tables.replace("certificates", rows.withColumn("year", F.substring("inspection_date", 1, 4)))
    states = {"pinned": before.read("certificates"), "after failure": failed, "latest": tables.read("certificates").drop("year")}
    counted = [df.groupBy("county").agg(F.count("*").alias("n")).withColumn("state", F.lit(state)) for state, df in states.items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def json_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The national summary, read back from its JSON file."""
    path = new_work_dir(spark, "summary")
    summary = reports.national_summary(star(spark, sf_dir))
    write_json_summary(summary, path)
    return spark.read.schema(summary.schema).json(path)


def _drop(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").options(header="true", quote='"', escape='"').csv(path)


def _two_drops(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Newer certificates first, the older ones as late arrivals."""
    rows = raw(spark, sf_dir).drop("filename")
    newer = F.col("INSPECTION_DATE") >= "2010-01-01"
    return rows.filter(newer), rows.filter(~newer)


def streamed_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw keys appended by two runs of a file stream with one checkpoint."""
    root = new_work_dir(spark, "stream")
    for number, rows in enumerate(_two_drops(spark, sf_dir)):
        _drop(rows, f"{root}/landing/drop{number}")
        stream = csv_stream(spark, f"{root}/landing", rows.columns)
        append_available(stream, f"{root}/table", f"{root}/checkpoint")
    return lower_case_columns(spark.read.parquet(f"{root}/table")).select("lmk_key", "uprn", "postcode")


def incremental_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property state after two incremental merges and a compaction."""
    root = new_work_dir(spark, "latest")
    for number, rows in enumerate(_two_drops(spark, sf_dir)):
        _drop(rows, f"{root}/landing/drop{number}")
        staged = stage_certificates(csv_stream(spark, f"{root}/landing", rows.columns))
        merge_available(staged, f"{root}/log", f"{root}/checkpoint")
    compact(spark, f"{root}/log", f"{root}/compacted")
    return read_state(spark, f"{root}/compacted")


def incremental_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The yearly aggregate after two streamed merges: newer certificates first, then older ones, which come late."""
    root = new_work_dir(spark, "aggregates")
    for number, rows in enumerate(_two_drops(spark, sf_dir)):
        _drop(rows, f"{root}/landing/drop{number}")
        staged = stage_certificates(csv_stream(spark, f"{root}/landing", rows.columns))
        merge_available_aggregates(staged, f"{root}/state", f"{root}/checkpoint")
    return read_aggregates(spark, f"{root}/state", staged)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundary features after a trip through GeoJSON documents."""
    path = new_work_dir(spark, "boundaries")
    boundary_documents(spark, sf_dir).write.text(path)
    return read_features(spark, path, multi_line=False)


def feature_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    outer = F.transform("polygons", lambda polygon: F.size(polygon[0]))
    return features(spark, sf_dir).select(
        "lad_code", "lad_name", "geometry_type",
        F.when(F.col("polygons").isNotNull(), F.size("polygons")).alias("n_polygons"),
        F.array_max(outer).alias("n_vertices"),
    )


def simplified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices per ring before and after simplification."""
    rings = simplified_rings(features(spark, sf_dir), 0.05)
    return rings.select("lad_code", "polygon_no", "ring_no", "n_before", F.size("ring").alias("n_after"))


def _figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.map_figures(retrofit(spark, sf_dir), _MAP_COUNT)


def district_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = reports.la_map(retrofit(spark, sf_dir), features(spark, sf_dir), _MAP_COUNT)
    return drawn.withColumn("n_vertices", F.size("outline")).drop("outline")


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.quality_report(lower_case_columns(raw(spark, sf_dir)), written_star(spark, sf_dir), _AS_OF)


def line_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uniqueness of (order, line number), which the line table does not have."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return quality.run_checks(lines, [quality.unique("l_orderkey", "l_linenumber"), quality.not_null("l_partkey")])


_FIGURES = f"""
select local_authority, county,
  {rnd(mean("cast(avg_efficiency_current as decimal(20, 1))"), 1)} as avg_efficiency,
  {rnd(mean("cast(avg_retrofit_priority_score as decimal(20, 1))"), 1)} as avg_retrofit_score,
  cast(sum(property_count) as bigint) as property_count,
  {rnd("cast(sum(total_co2_saving_potential_tonnes) as double) / 1000", 1)} as co2_saving_kt
from retrofit where local_authority is not null group by 1, 2 having sum(property_count) > {_MAP_COUNT}
"""
# Authorities are named LA_<nation>_<quarter>; nations 3, 10, 17 and 24 have no boundary.
_NATION = "cast(split_part(local_authority, '_', 2) as integer)"
_QUARTER = "split_part(local_authority, '_', 3)"


def _outline_sql(tolerance: float) -> str:
    """Vertices of every boundary ring before and after simplification, span by span."""
    away = (
        "list_transform(range(first + 1, last), lambda i: case when length > 0"
        " then abs(cx * (pts[i][2] - fy) - cy * (pts[i][1] - fx)) / length"
        " else sqrt((pts[i][1] - fx) ** 2 + (pts[i][2] - fy) ** 2) end)"
    )
    return f"""
with recursive corners as (
  select c_nationkey as n, c_custkey % 4 as q, c_custkey % 360 as degree, 1 + max(c_acctbal) / 20000 as radius
  from customer where c_nationkey % 7 <> 3 and c_nationkey <> 24 group by 1, 2, 3
), outers as (
  select n, q, list([round(n + radius * cos(radians(degree)), 5), round(q + radius * sin(radians(degree)), 5)] order by degree) as open
  from corners group by 1, 2
), rings as (
  select concat('E', n, q) as lad_code, case when n % 5 = 1 then 1 else 0 end as polygon_no, list_concat(open, open[1:1]) as pts from outers
  union all select concat('E', n, q), 0, list_concat(open, open[1:1])[1:3] from outers where n % 5 = 1
), spans as (
  select lad_code, polygon_no, pts, 1 as first, len(pts) as last from rings where len(pts) >= 3
  union all
  select lad_code, polygon_no, pts, case when side = 0 then first else split end, case when side = 0 then split else last end
  from (
    select *, first + list_position(far, list_max(far)) as split from (
      select *, {away} as far from (
        select *, pts[first][1] as fx, pts[first][2] as fy, pts[last][1] - pts[first][1] as cx, pts[last][2] - pts[first][2] as cy,
          sqrt((pts[last][1] - pts[first][1]) ** 2 + (pts[last][2] - pts[first][2]) ** 2) as length
        from spans where last - first >= 2
      ) a
    ) b where list_max(far) > {tolerance}
  ) c cross join (values (0), (1)) sides(side)
), kept as (
  -- a span that is split becomes two, so that of s rows (s + 1) / 2 are left, with as many inner ends
  select lad_code, polygon_no, (count(*) + 1) // 2 + 1 as n from spans group by 1, 2
)
select r.lad_code as lad_code, cast(r.polygon_no as integer) as polygon_no, cast(0 as integer) as ring_no, cast(len(r.pts) as integer) as n_before,
  cast(case when k.n >= 4 then k.n else len(r.pts) end as integer) as n_after
from rings r left join kept k on r.lad_code = k.lad_code and r.polygon_no = k.polygon_no
"""


def _check(dataset: str, check: str, column: str, failed: str, rows: str, source: str, passed: str | None = None) -> str:
    return (
        f"select '{dataset}' as dataset, '{check}' as \"check\", '{column}' as \"column\","
        f" cast({failed} as bigint) as n_failed, cast({rows} as bigint) as n_rows,"
        f" {passed or f'{failed} = 0'} as passed from {source}"
    )


def _quality_sql() -> str:
    stg, ext = "stg_certificates", "stg_certificates extended"
    keys = "(select {0}, count(*) as n from {1} where {2} group by {0}) k"
    dup, total = "count(*) filter (where n > 1)", "sum(n)"
    parts = [
        _check("raw", "unique", "lmk_key", dup, total, keys.format("lmk_key", "epc_raw", "lmk_key is not null")),
        _check("raw", "not_null", "lmk_key", "count(*) - count(lmk_key)", "count(*)", "epc_raw"),
        _check(stg, "unique", "certificate_key", dup, total, keys.format("certificate_key", "stg", "true")),
    ]
    for c in ("certificate_key", "uprn", "energy_rating_current", "inspection_at", "postcode"):
        parts.append(_check(stg, "not_null", c, f"count(*) - count({c})", "count(*)", "stg"))
    parts += [
        _check(stg, "accepted_values", "energy_rating_current",
               "count(*) filter (where energy_rating_current not in ('A','B','C','D','E','F','G'))", "count(*)", "stg"),
        _check(ext, "no_future_date", "inspection_at",
               f"count(*) filter (where inspection_at > date '{_AS_OF}')", "count(*)", "stg"),
        _check(ext, "unique_combination", "uprn,inspection_at", dup, total,
               keys.format("uprn, inspection_at", "stg", "uprn is not null and inspection_at is not null")),
        _check(ext, "not_null_proportion", "postcode", "count(*) - count(postcode)", "count(*)", "stg",
               "count(postcode) >= 0.9 * count(*)"),
        _check(ext, "recency", "inspection_at",
               f"case when max(inspection_at) >= date '{_AS_OF}' - 365 then 0 else 1 end", "count(*)", "stg"),
        _check(ext, "accepted_range", "energy_efficiency_current",
               "count(*) filter (where energy_efficiency_current < 1 or energy_efficiency_current > 100)", "count(*)", "stg"),
    ]
    return query(" union all ".join(parts), "stg")


_SCAN_SQL = """
select lmk_key as lmk_key, uprn as uprn, postcode as postcode, county as county,
  walls_description as walls_description,
  case when cast(regexp_extract(filename, '([0-9]+)/', 1) as integer) % 3 <> 2 then floor_level end as floor_level,
  main_fuel as main_fuel
from epc_raw
"""

# name -> (DataFrame query, SQL to check it against)
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "csv_glob_scan": (csv_scan, query(_SCAN_SQL, "epc_raw")),
    "csv_by_blocks": (
        csv_by_blocks,
        query(
            """select lmk_key as lmk_key, uprn as uprn,
  concat('"', postcode, '"', chr(10), county, ',', chr(10), walls_description) as address from epc_raw""",
            "epc_raw",
        ),
    ),
    "append_stream_any_header": (streamed_variants, query(_SCAN_SQL, "epc_raw")),
    "file_lineage": (
        file_lineage,
        query(
            "select split_part(filename, '/', 1) as folder, cast(count(*) as bigint) as n from epc_raw group by 1",
            "epc_raw",
        ),
    ),
    "staged_from_csv": (
        staged_from_csv,
        query(
            "select energy_rating_current, cast(count(*) as bigint) as n,"
            " cast(sum(total_floor_area_sqm) as decimal(38, 2)) as area from stg group by 1",
            "stg",
        ),
    ),
    "append_chunks": (
        appended_chunks,
        query("select lmk_key as lmk_key, uprn as uprn from epc_raw", "epc_raw"),
    ),
    "append_stream": (
        streamed_append,
        query("select lmk_key as lmk_key, uprn as uprn, postcode as postcode from epc_raw", "epc_raw"),
    ),
    "incremental_latest": (
        incremental_latest,
        query("select * exclude (property_id) from props", "props"),
    ),
    "incremental_aggregates": (incremental_aggregates, AGGREGATE_SQL),
    "materialize": (
        materialised,
        query(
            """
with fpa as (select 1 from facts f left join props p on f.property_id = p.property_id
    left join locs l on f.location_id = l.location_id
  group by county, property_type, tenure, construction_age_band, year(inspection_at))
select 'stg_certificates' as table_name, cast(count(*) as bigint) as n_rows from stg
union all select 'dim_properties', count(*) from props
union all select 'dim_locations', count(*) from locs
union all select 'fct_certificates', count(*) from facts
union all select 'fct_property_energy_performance', count(*) from stg
union all select 'fct_property_aggregations', count(*) from fpa
union all select 'v_retrofit_priority', count(*) from retrofit
""",
            "retrofit", "facts", "props", "locs",
        ),
    ),
    "ctas_overwrite": (
        replaced_table,
        query(
            """
with old as (select county as county, cast(count(*) as bigint) as n from epc_raw where inspection_date < '2010-01-01' group by 1)
select 'pinned' as state, county, n from old union all select 'after failure', county, n from old
union all select 'latest', county, cast(count(*) as bigint) from epc_raw group by 2
""",
            "epc_raw",
        ),
    ),
    "json_summary_sink": (json_summary, query(SUMMARY_SQL, "facts")),
    "geojson_scan": (
        feature_scan,
        """
with c as (select c_nationkey as n, c_custkey % 4 as q, count(distinct c_custkey % 360) + 1 as v
  from customer where c_nationkey % 7 <> 3 group by 1, 2)
select concat('E', n, q) as lad_code, concat(' la_', n, '_', q, ' ') as lad_name,
  case when n = 24 then null when n % 5 = 1 then 'MultiPolygon' else 'Polygon' end as geometry_type,
  cast(case when n = 24 then null when n % 5 = 1 then 2 else 1 end as integer) as n_polygons,
  cast(case when n <> 24 then v end as integer) as n_vertices
from c
""",
    ),
    "polyline_simplify": (simplified, _outline_sql(0.05)),
    "lookup_map_join": (
        lambda spark, d: match_districts(_figures(spark, d), features(spark, d)),
        query(
            f"select f.*, case when {_NATION} % 7 <> 3 then concat('E', {_NATION}, {_QUARTER}) end as lad_code"
            f" from ({_FIGURES}) f",
            "retrofit",
        ),
    ),
    "unmatched_rows": (
        lambda spark, d: unmatched_districts(_figures(spark, d), features(spark, d)),
        query(f"select f.* from ({_FIGURES}) f where {_NATION} % 7 = 3", "retrofit"),
    ),
    "la_map": (
        district_map,
        query(
            f"""
select f.*, o.lad_code, o.n_vertices,
  least(greatest((f.avg_efficiency - {K.DISTRICT_SCALE[0]}) / ({K.DISTRICT_SCALE[1]} - {K.DISTRICT_SCALE[0]}), 0), 1) as colour
from ({_FIGURES}) f join (select lad_code, max(n_after) as n_vertices from ({_outline_sql(K.OUTLINE_TOLERANCE)}) s group by 1) o
  on o.lad_code = concat('E', {_NATION}, {_QUARTER})
""",
            "retrofit",
        ),
    ),
    "dq_report": (quality_report, _quality_sql()),
    "check_unique_combination": (
        line_key_check,
        """
with k as (select count(*) as n from lineitem group by l_orderkey, l_linenumber)
select 'unique_combination' as "check", 'l_orderkey,l_linenumber' as "column",
  cast(count(*) filter (where n > 1) as bigint) as n_failed, cast(sum(n) as bigint) as n_rows,
  count(*) filter (where n > 1) = 0 as passed from k
union all
select 'not_null', 'l_partkey', cast(count(*) - count(l_partkey) as bigint), cast(count(*) as bigint),
  count(*) = count(l_partkey) from lineitem
""",
    ),
}
