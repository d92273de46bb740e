"""Stored cell layers: parquet partitioned by zoom, ordered by tile, one row per cell and band."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from gridfill.functions.grid import CELL_KEY, TILE_KEY, Grid
from gridfill.operators.cells import cell_histogram, coarser_level


def to_bands(cells: DataFrame, bands: Sequence[str]) -> DataFrame:
    """Wide bands to ``CELL_KEY, band INT, value``; cells without data in a band have no row for it."""
    entries = F.array(*[F.struct(F.lit(i).alias("band"), F.col(b).alias("value")) for i, b in enumerate(bands)])
    return cells.select(*CELL_KEY, F.explode(entries).alias("e")).select(*CELL_KEY, "e.*").where("value IS NOT NULL")


def write_layer(cells: DataFrame, path: str, bands: Sequence[str], grid: Grid = Grid(), min_zoom: int | None = None) -> None:
    """Store the bands of a layer from its own zoom up to ``min_zoom``, coarser levels being sums."""
    level = to_bands(cells, bands)
    for zoom in range(grid.zoom, (grid.zoom if min_zoom is None else min_zoom) - 1, -1):
        if zoom < grid.zoom:
            stored = level.sparkSession.read.parquet(f"{path}/zoom={zoom + 1}")
            level = coarser_level(stored, Grid(zoom + 1, grid.px), ["value"], ["band"])
        _write_level(level, f"{path}/zoom={zoom}", [*TILE_KEY, "band"])


def _write_level(level: DataFrame, path: str, order: Sequence[str]) -> None:
    # ordered by tile, so row-group statistics let a reader skip to the tiles it wants
    level.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def write_pyramid(cells: DataFrame, path: str, column: str, grid: Grid = Grid(), buckets: int = 100) -> None:
    """Store ``column`` at every zoom up to 0 with its histogram, replacing the pyramid there as a whole.

    A version's levels stand in a folder of their own, beside those of earlier versions. Each is read back before the next is
    built: a level is computed once, and a lost executor costs no more than the level being written. Only when all are there
    is the version entered in ``versions``, in one file, and from then on ``read_pyramid`` finds it; a run that breaks
    before leaves the old pyramid as it was. Earlier versions stay until ``drop_old_versions``.
    """
    spark = cells.sparkSession
    version = uuid.uuid4().hex
    level = cells.select(*CELL_KEY, column).where(F.col(column).isNotNull())
    for zoom in range(grid.zoom, -1, -1):
        target = f"{path}/data/{version}/levels/zoom={zoom}"
        _write_level(level, target, TILE_KEY)
        level = coarser_level(spark.read.parquet(target), Grid(zoom, grid.px), [column])
    base = spark.read.parquet(f"{path}/data/{version}/levels/zoom={grid.zoom}")
    cell_histogram(base, column, buckets).write.parquet(f"{path}/data/{version}/histogram")
    enter_version(spark, path, version)


_VERSION = "number long, version string"


def enter_version(spark: SparkSession, path: str, version: str) -> None:
    """Make a version whose tables are written the current one."""
    number = _versions(spark, path).agg(F.coalesce(F.max("number"), F.lit(0)).alias("n")).first()["n"] + 1
    spark.createDataFrame([(number, version)], _VERSION).coalesce(1).write.mode("append").parquet(f"{path}/versions")


def _versions(spark: SparkSession, path: str) -> DataFrame:
    """``number, version`` of the complete versions in a folder: a row for each."""
    try:
        return spark.read.schema(_VERSION).parquet(f"{path}/versions")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _VERSION)


def current_version(spark: SparkSession, path: str) -> str:
    """The newest complete version in a folder."""
    newest = _versions(spark, path).agg(F.max_by("version", F.struct("number", "version")).alias("v")).first()["v"]
    if newest is None:
        raise LookupError(f"no complete version in {path}")
    return newest


def read_pyramid(spark: SparkSession, path: str) -> DataFrame:
    """All levels of the newest complete version, under ``zoom``; a filter on it prunes folders."""
    return spark.read.parquet(f"{path}/data/{current_version(spark, path)}/levels")


def read_histogram(spark: SparkSession, path: str) -> DataFrame:
    """The histogram of the newest complete version."""
    return spark.read.parquet(f"{path}/data/{current_version(spark, path)}/histogram")


def drop_old_versions(spark: SparkSession, path: str) -> int:
    """Delete all versions but the newest complete one, broken ones too, and say how many. Nobody may be writing or still be reading an
    old one."""
    current = current_version(spark, path)
    data = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    files = data.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [f.getPath() for f in files.listStatus(data) if f.getPath().getName() != current]
    return sum(files.delete(folder, True) for folder in old)


def read_band(spark: SparkSession, path: str, band: int, column: str, zoom: int = 12) -> DataFrame:
    """One band of a stored layer as a named column; zoom prunes directories, band prunes row groups."""
    stored = spark.read.parquet(path).where((F.col("zoom") == zoom) & (F.col("band") == band))
    return stored.select(*CELL_KEY, F.col("value").alias(column))
