"""Boundary documents derived from the customer table, for trying the map.

One feature per local authority of the certificate-shaped rows: a ring with at
most one vertex per degree, as far out as the richest customer in that
direction. Some authorities get two polygons, some no geometry, some no
feature at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joulemart.sources.certificate_rows import read_table


def boundary_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature collection per row, as JSON text in ``value``."""
    nation, quarter = F.col("c_nationkey"), F.col("c_custkey") % 4
    degree = F.col("c_custkey") % 360
    customers = read_table(spark, sf_dir, "customer").filter(nation % 7 != 3)
    corners = customers.groupBy(nation.alias("n"), quarter.alias("q"), degree.alias("degree")).agg(
        (1 + F.max("c_acctbal") / 20000).alias("radius")
    )
    angle = F.radians("degree")
    corner = F.struct(
        "degree",
        F.round(F.col("n") + F.col("radius") * F.cos(angle), 5).alias("lon"),
        F.round(F.col("q") + F.col("radius") * F.sin(angle), 5).alias("lat"),
    )
    # At most 360 corners per authority, whatever the number of customers.
    rings = corners.groupBy("n", "q").agg(F.array_sort(F.collect_list(corner)).alias("corners"))
    ring = F.transform("corners", lambda c: F.array(c.lon, c.lat))
    closed = F.concat(ring, F.slice(ring, 1, 1))
    rings = rings.withColumn("ring", closed)
    polygon = F.to_json(F.array("ring"))
    islet = F.slice("ring", 1, 3)
    several = F.to_json(F.array(F.array(islet), F.array("ring")))
    geometry = (
        F.when(F.col("n") == 24, F.lit("null"))
        .when(F.col("n") % 5 == 1, F.concat(F.lit('{"type":"MultiPolygon","coordinates":'), several, F.lit("}")))
        .otherwise(F.concat(F.lit('{"type":"Polygon","coordinates":'), polygon, F.lit("}")))
    )
    return rings.select(
        F.format_string(
            '{"type":"FeatureCollection","features":[{"type":"Feature","id":"E%d%d",'
            '"properties":{"LAD13NM":" la_%d_%d "},"geometry":%s}]}',
            "n", "q", "n", "q", geometry,
        ).alias("value")
    )
