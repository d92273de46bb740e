"""Cell layers stored along a Z-shaped curve, so that a box on the map is a few runs of rows."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridfill.functions.grid import CELL_KEY, Grid
from gridfill.functions.mercator import WORLD_HALF_WIDTH
from gridfill.functions.morton import key_ranges, morton
from gridfill.sources.layers import current_version, enter_version, to_bands

Box = tuple[float, float, float, float]


def write_clustered(cells: DataFrame, path: str, bands: Sequence[str], row_group_bytes: int | None = None) -> None:
    """Store the bands of a layer ordered by the curve key of their tile, replacing the layer there as a whole.

    Rows are dealt by ranges of (key, cell), so a tile with many cells may span files. Every row group then holds a short run of
    the curve, which its statistics tell a reader. ``row_group_bytes`` is Parquet's ``parquet.block.size``.
    """
    version = uuid.uuid4().hex
    keyed = to_bands(cells, bands).withColumn("key", morton(F.col("tile_col"), F.col("tile_row")))
    order = ["key", "cell_row", "cell_col", "band"]
    writer = keyed.repartitionByRange(*order).sortWithinPartitions(*order).write
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(f"{path}/data/{version}")
    enter_version(cells.sparkSession, path, version)


def tiles_of_box(box: Box, grid: Grid) -> tuple[tuple[int, int], tuple[int, int]]:
    """First and last column and row of the tiles that a box ``xmin, ymin, xmax, ymax`` touches, within the world.

    A box beyond the world has a last tile before its first.
    """
    def index(offset: float) -> int:
        return math.floor(offset / grid.tile_size)

    xmin, ymin, xmax, ymax = box
    last = grid.tiles - 1
    return ((max(index(xmin + WORLD_HALF_WIDTH), 0), min(index(xmax + WORLD_HALF_WIDTH), last)),
            (max(index(WORLD_HALF_WIDTH - ymax), 0), min(index(WORLD_HALF_WIDTH - ymin), last)))


def in_box(box: Box, grid: Grid, limit: int = 64) -> Column:
    """Whether a stored row's tile touches a box. Key ranges come first: the scan skips row groups by them."""
    cols, rows = tiles_of_box(box, grid)
    runs = [F.col("key").between(low, high) for low, high in key_ranges(cols, rows, grid.zoom, limit)]
    return reduce(Column.__or__, runs, F.lit(False)) & F.col("tile_col").between(*cols) & F.col("tile_row").between(*rows)


def read_box(spark: SparkSession, path: str, box: Box, band: int, column: str, grid: Grid = Grid()) -> DataFrame:
    """One band of the tiles that a box touches (map coordinates ``xmin, ymin, xmax, ymax``), as ``CELL_KEY, column``."""
    stored = spark.read.parquet(f"{path}/data/{current_version(spark, path)}")
    return stored.where(in_box(box, grid) & (F.col("band") == band)).select(*CELL_KEY, F.col("value").alias(column))
