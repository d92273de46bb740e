"""Zone boundaries and hand-labelled training areas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridfill.functions.mercator import rings_to_mercator
from gridfill.functions.shapes import slug

GEOJSON_FEATURE = (
    "type STRING, geometry STRUCT<type: STRING, coordinates: ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>>")


def country_lookup(zones: DataFrame, name_or_code: str) -> DataFrame:
    """The first zone, by code, whose code is the argument or whose name reads like it; may be empty."""
    wanted = F.lit(name_or_code)
    hits = zones.where((F.col("code") == wanted) | (slug(F.col("name")) == slug(wanted)))
    first = hits.select("code").orderBy("code").limit(1)
    return hits.join(F.broadcast(first), "code", "left_semi")


def require_country(zones: DataFrame, name_or_code: str) -> DataFrame:
    """As ``country_lookup``; an unknown country is an error, found by reading one row."""
    found = country_lookup(zones, name_or_code)
    if found.isEmpty():
        raise LookupError(f"no zone has code or name {name_or_code!r}")
    return found


def zones_to_mercator(zones: DataFrame) -> DataFrame:
    return zones.withColumn("rings", rings_to_mercator(F.col("rings")))


def _to_rings(polygon: Column) -> Column:
    return F.transform(polygon, lambda ring: F.transform(
        ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))))


def polygons_of(features: DataFrame, *keep: str) -> DataFrame:
    """Polygons of all MultiPolygon features: ``*keep, part, rings``. Other types and empty ones give none."""
    multi = features.where(F.col("geometry.type") == "MultiPolygon")
    parts = multi.select(*keep, F.posexplode("geometry.coordinates").alias("part", "_polygon"))
    return parts.select(*keep, F.col("part").cast("bigint").alias("part"), _to_rings(F.col("_polygon")).alias("rings"))


def training_polygons(lines: DataFrame, column: str = "value", *keep: str) -> DataFrame:
    """Training areas from a column holding one GeoJSON feature per row (newline-delimited, so splittable)."""
    # a lone Polygon nests its numbers one level less: only the geometry type is read from such rows
    kind = F.get_json_object(column, "$.geometry.type")
    multi = lines.where(kind == "MultiPolygon")
    return polygons_of(multi.select(*keep, F.from_json(column, GEOJSON_FEATURE).alias("f")).select(*keep, "f.*"), *keep)


def read_training_polygons(spark: SparkSession, path: str, splittable: bool = False) -> DataFrame:
    """Training areas from GeoJSON files: a FeatureCollection, one feature, or one feature a line; told by the content.

    ``path`` is a file or a folder. A file is read as one value and must stay below 2 GB, which hand-drawn areas do; its
    features are spread out right behind the reader. Larger files of one feature a line are read with ``splittable``.
    Text of another kind is an error when it is read.
    """
    if splittable:
        features = spark.read.text(path).where("trim(value) <> ''")
    else:
        document = spark.read.text(path, wholetext=True)
        listed = F.from_json(F.get_json_object("value", "$.features"), "ARRAY<STRING>")
        lines = F.filter(F.split("value", "\n"), lambda x: F.trim(x) != "")
        by_line = F.when(F.get_json_object(F.get(lines, F.lit(0)), "$.type") == "Feature", lines)
        features = document.select(F.explode(F.coalesce(listed, by_line, F.array("value"))).alias("value"))
    return training_polygons(features.withColumn("value", _feature_or_error(F.col("value"))))


def _feature_or_error(text: Column) -> Column:
    kind = F.get_json_object(text, "$.type")
    return F.when(kind == "Feature", text).otherwise(F.raise_error(F.concat(F.lit("neither a GeoJSON FeatureCollection nor a feature: "), F.substring(text, 1, 80))))
