"""District boundaries from GeoJSON feature collections."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joulemart import constants as K
from joulemart.functions.labels import match_key
from joulemart.functions.outlines import simplify_ring

# Coordinates stay text here: their depth depends on the geometry type.
_SCHEMA = """
    features array<struct<
        id: string,
        properties: struct<LAD13CD: string, LAD13NM: string>,
        geometry: struct<type: string, coordinates: string>>>
"""
_RING = "array<array<double>>"


def read_features(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per feature: ``lad_code, lad_name, geometry_type, polygons``.

    ``polygons`` is a list of polygons, each a list of rings, whatever the
    geometry type. ``multi_line`` reads one document per file; without it
    every line is a document.
    """
    documents = spark.read.schema(_SCHEMA).option("multiLine", multi_line).json(path)
    feature = documents.select(F.explode("features").alias("f")).select(
        F.coalesce("f.properties.LAD13CD", "f.id").alias("lad_code"),
        F.col("f.properties.LAD13NM").alias("lad_name"),
        F.col("f.geometry.type").alias("geometry_type"),
        F.col("f.geometry.coordinates").alias("text"),
    )
    one = F.array(F.from_json("text", f"array<{_RING}>"))
    many = F.from_json("text", f"array<array<{_RING}>>")
    kind = F.col("geometry_type")
    polygons = F.when(kind == "Polygon", one).when(kind == "MultiPolygon", many)
    return feature.withColumn("polygons", polygons).drop("text")


def simplify_rings(rings: pd.Series, tolerance: float) -> pd.Series:
    return rings.map(
        lambda ring: simplify_ring(np.array([list(p[:2]) for p in ring], dtype=float).reshape(-1, 2), tolerance).tolist()
    )


def simplified_rings(features: DataFrame, tolerance: float = K.OUTLINE_TOLERANCE) -> DataFrame:
    """One row per ring, simplified: ``lad_code, polygon_no, ring_no, ring``.

    Rings are independent of each other, so they are simplified where they
    are, batch by batch, without a shuffle.
    """

    @F.pandas_udf(_RING)
    def simplify(rings: pd.Series) -> pd.Series:
        return simplify_rings(rings, tolerance)

    polygons = features.select("lad_code", F.posexplode("polygons").alias("polygon_no", "rings"))
    rings = polygons.select("lad_code", "polygon_no", F.posexplode("rings").alias("ring_no", "ring"))
    return rings.withColumn("n_before", F.size("ring")).withColumn("ring", simplify("ring"))


def main_outline(features: DataFrame, tolerance: float = K.OUTLINE_TOLERANCE) -> DataFrame:
    """Each feature's outer ring; of several polygons the one with most vertices."""
    outer = simplified_rings(features, tolerance).filter(F.col("ring_no") == 0)
    # The first polygon wins among equals.
    rank = F.struct(F.size("ring"), -F.col("polygon_no"))
    return outer.groupBy("lad_code").agg(F.max_by("ring", rank).alias("outline"))


def match_districts(rows: DataFrame, features: DataFrame) -> DataFrame:
    """Add ``lad_code`` by authority name; NULL where no boundary has it."""
    names = (
        features.filter(F.length("lad_name") > 0)
        .groupBy(match_key(F.col("lad_name")).alias("lad_key"))
        # One code per name, so that matching never repeats a row.
        .agg(F.max("lad_code").alias("lad_code"))
    )
    keyed = rows.withColumn("lad_key", match_key(F.col("local_authority")))
    return keyed.join(names, "lad_key", "left").drop("lad_key")


def unmatched_districts(rows: DataFrame, features: DataFrame) -> DataFrame:
    """Rows whose authority has no boundary."""
    names = features.filter(F.length("lad_name") > 0).select(match_key(F.col("lad_name")).alias("lad_key"))
    keyed = rows.withColumn("lad_key", match_key(F.col("local_authority")))
    return keyed.join(names, "lad_key", "left_anti").drop("lad_key")
