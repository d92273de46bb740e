"""Building features and the vector tile table they are filed in.

A feature row is ``geom_type STRING, rings, tags MAP<STRING,STRING>`` plus any identifiers and, where
features of several layers are mixed, ``layer``. Tile tables add ``zoom_level, tile_column, tile_row`` with the
row counted from the south.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfill.functions.grid import TILE_KEY, Grid
from gridfill.functions.shapes import building_levels, mended, polygon_defect


def tile_lookup(tiles: DataFrame, keys: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Features filed under the wanted ``tile_col, tile_row`` keys; a key without a tile gives no row."""
    wanted = keys.select(*TILE_KEY).distinct()
    filed = tiles.where(F.col("zoom_level") == F.lit(grid.zoom))
    filed = filed.withColumn("tile_col", F.col("tile_column").cast("bigint")).withColumn(
        "tile_row", grid.flip_row(F.col("tile_row").cast("bigint")))
    return filed.drop("tile_column", "zoom_level").join(wanted, TILE_KEY, "left_semi")


def tile_fetch(tiles: DataFrame, zoom: int, col: int, row: int) -> DataFrame:
    """Features of one tile: plain comparisons on stored columns, so they reach the scan."""
    south = Grid(zoom).tiles - 1 - row
    return tiles.where((F.col("zoom_level") == zoom) & (F.col("tile_column") == col) & (F.col("tile_row") == south))


def tile_scan(tiles: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """All features of a zoom, under north-counted keys."""
    filed = tiles.where(F.col("zoom_level") == F.lit(grid.zoom))
    rest = [c for c in tiles.columns if c not in ("zoom_level", "tile_column", "tile_row")]
    return filed.select(F.col("tile_column").cast("bigint").alias("tile_col"),
                        grid.flip_row(F.col("tile_row").cast("bigint")).alias("tile_row"), *rest)


def building_filter(features: DataFrame) -> DataFrame:
    """Features tagged as buildings, whatever the tag says."""
    return features.where(F.map_contains_key("tags", F.lit("building")))


def polygon_only(features: DataFrame, layer: str | None = None) -> DataFrame:
    polygons = features.where(F.col("geom_type") == "Polygon")
    return polygons if layer is None else polygons.where(F.col("layer") == layer)


def with_levels(features: DataFrame) -> DataFrame:
    return features.withColumn("levels", building_levels("tags"))


def check_polygons(features: DataFrame) -> DataFrame:
    """Mend ``rings`` (closed, no repeated points, no empty or crossed holes) and add ``defect``: NULL for polygons that are
    usable then, else the reason."""
    return mended(features).withColumn("defect", polygon_defect("rings"))


def valid_polygons(features: DataFrame) -> DataFrame:
    return check_polygons(features).where("defect IS NULL").drop("defect")


def rejected_polygons(features: DataFrame) -> DataFrame:
    """The polygons left out and why: those whose outer ring is no simple polygon even when closed."""
    return check_polygons(features).where("defect IS NOT NULL")


def building_polygons(features: DataFrame, layer: str | None = None) -> DataFrame:
    """Polygons to put on the grid, each with its ``levels``."""
    return with_levels(valid_polygons(building_filter(polygon_only(features, layer))))
