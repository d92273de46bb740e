"""Population pixels: ``lon, lat, value`` rows in, tile layers out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridfill.functions.grid import TILE_KEY, DegreeGrid
from gridfill.functions.mercator import MAX_LATITUDE


def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    """Pixel table of a raster; the scan reads three columns whatever else is stored."""
    return spark.read.parquet(path).select("lon", "lat", "value")


def _data_value(value: Column, sentinel: float | None) -> Column:
    valid = ~F.isnan(value)
    if sentinel is not None:
        valid = valid & (value != F.lit(sentinel))
    return F.when(valid, value)


def normalize_nodata(df: DataFrame, column: str = "value", sentinel: float | None = None) -> DataFrame:
    """NaN and the raster's own no-data number become NULL, which sums and counts skip."""
    return df.withColumn(column, _data_value(F.col(column).cast("double"), sentinel))


def data_pixels(pixels: DataFrame) -> DataFrame:
    """Pixels with data, as a filter the scan can use."""
    return pixels.where(F.col("value").isNotNull() & ~F.isnan("value"))


def in_world(pixels: DataFrame) -> DataFrame:
    """Pixels inside the square Mercator world, as a filter the scan can use."""
    return pixels.where(F.col("lon").between(-180.0, 180.0) & F.col("lat").between(-MAX_LATITUDE, MAX_LATITUDE))


def raster_tiles(pixels: DataFrame, grid: DegreeGrid = DegreeGrid()) -> DataFrame:
    """Tiles of the source layout holding data: ``tile_col, tile_row, n_pixels, n_data, value_sum``."""
    col, row = grid.pixel(F.col("lon"), F.col("lat"))
    tiles = (
        normalize_nodata(pixels)
        .groupBy(grid.tile(col).alias("tile_col"), grid.tile(row).alias("tile_row"))
        .agg(F.count(F.lit(1)).alias("n_pixels"), F.count("value").alias("n_data"), F.sum("value").alias("value_sum"))
    )
    return tiles.where("n_data > 0")


def raster_halo_tiles(pixels: DataFrame, grid: DegreeGrid = DegreeGrid(), halo: int = 3) -> DataFrame:
    """Every pixel under its own tile and under each tile whose halo reaches it.

    Columns ``tile_col, tile_row, pixel_col, pixel_row`` (counted from the halo's corner), ``value``,
    ``is_center``. Tiles without any data in their buffered window are dropped. No shuffle: a pixel finds its
    tiles by arithmetic.
    """
    col, row = grid.pixel(F.col("lon"), F.col("lat"))
    placed = data_pixels(pixels).select(col.alias("_c"), row.alias("_r"), "value")

    def reach(pixel: str) -> Column:
        return F.sequence(grid.tile(F.col(pixel) - halo), grid.tile(F.col(pixel) + halo), F.lit(1).cast("bigint"))

    copies = placed.select("*", F.explode(reach("_c")).alias("tile_col")).select(
        "*", F.explode(reach("_r")).alias("tile_row"))
    px = F.lit(grid.px).cast("bigint")
    return copies.select(
        *TILE_KEY,
        (F.col("_c") - F.col("tile_col") * px + halo).alias("pixel_col"),
        (F.col("_r") - F.col("tile_row") * px + halo).alias("pixel_row"),
        "value",
        ((grid.tile(F.col("_c")) == F.col("tile_col")) & (grid.tile(F.col("_r")) == F.col("tile_row"))).alias("is_center"))
