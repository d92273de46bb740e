"""A stored report that is brought up to date: only tiles whose buildings changed are computed again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridfill.functions.grid import TILE_KEY, Grid
from gridfill.operators.coverage import footprint_grid, in_tiles, touched_tiles
from gridfill.operators.joins import coverage_change, tile_stats_with_footprint
from gridfill.operators.regression import predict_footprint
from gridfill.operators.report import completeness_index
from gridfill.plans.coverage_model import LABELED_PX, Model
from gridfill.sources.features import building_filter, building_polygons, polygon_only, valid_polygons
from gridfill.sources.layers import current_version, enter_version


def _content(features: DataFrame, layer: str | None) -> DataFrame:
    """``content, rings`` of the buildings: 128 bits of a hash of what a report reads of them, their geometry and storeys."""
    levels = F.coalesce(F.try_element_at("tags", F.lit("building:levels")), F.lit("\0"))
    told = F.concat(F.to_json(F.struct("rings")), F.lit("\1"), levels)
    return polygon_only(building_filter(features), layer).select(F.unhex(F.substring(F.sha2(told, 256), 1, 32)).alias("content"), "rings")


def changed_features(before: DataFrame, after: DataFrame, layer: str | None = None) -> DataFrame:
    """``rings`` of the buildings that stand in only one of two feature tables, or in one more often than in the other.

    A building that moved or was drawn anew counts with its old and its new shape. Tables are compared by hashes of the
    content, so identifiers and other tags may differ, and copies of a building are counted, not paired. One shuffle of
    hashes with partial counts; the shape of a changed building is carried along, once.
    """
    one = F.lit(1).cast("bigint")
    both = _content(before, layer).withColumn("n", -one).unionByName(_content(after, layer).withColumn("n", one))
    return both.groupBy("content").agg(F.sum("n").alias("n"), F.first("rings").alias("rings")).where("n <> 0").select("rings")


def changed_tiles(before: DataFrame, after: DataFrame, grid: Grid = Grid(), layer: str | None = None) -> DataFrame:
    """Tiles that a changed building's box touches; features that are no usable polygon change nothing."""
    return touched_tiles(valid_polygons(changed_features(before, after, layer)), grid)


def updated_report(stored: DataFrame, pop: DataFrame, before: DataFrame, after: DataFrame, model: Model, px: int = LABELED_PX, grid: Grid = Grid(),
                   layer: str | None = None) -> DataFrame:
    """The report of ``after``, from the ``stored`` one of ``before`` (``tile_col, tile_row`` and the columns of ``completeness_index``).

    ``pop`` is the population layer on the analysis grid, which doesn't change; the model is the one of the stored report.
    Tiles without a changed building keep their rows; of the others, population, footprints and index are computed anew
    from the buildings whose boxes touch them. So what is mended and put on the grid follows the number of changes.
    """
    tiles = changed_tiles(before, after, grid, layer)
    touched = in_tiles(building_filter(polygon_only(after, layer)), tiles, grid)  # before they are mended, and so mended once
    footprint = footprint_grid(building_polygons(touched, layer), grid.with_px(px)).join(tiles, TILE_KEY, "left_semi")
    scored = predict_footprint(pop.join(tiles, TILE_KEY, "left_semi"), model)
    renewed = completeness_index(tile_stats_with_footprint(scored, footprint))
    return stored.join(tiles, TILE_KEY, "left_anti").unionByName(renewed.select(*stored.columns))


def write_report_version(report: DataFrame, path: str) -> None:
    """Store a report beside earlier ones in ``path``; it becomes the current one when all of it is there."""
    version = uuid.uuid4().hex
    report.write.parquet(f"{path}/data/{version}")
    enter_version(report.sparkSession, path, version)


def read_report_version(spark: SparkSession, path: str) -> DataFrame:
    """The current report in ``path``."""
    return spark.read.parquet(f"{path}/data/{current_version(spark, path)}")


def renew_report(spark: SparkSession, path: str, pop: DataFrame, before: DataFrame, after: DataFrame, model: Model, px: int = LABELED_PX, grid: Grid = Grid(),
                 layer: str | None = None) -> DataFrame:
    """Bring the report in ``path`` up to date and give what changed, tile by tile. The new report is stored and read back, so
    its tiles are computed once."""
    old = read_report_version(spark, path)
    write_report_version(updated_report(old, pop, before, after, model, px, grid, layer), path)
    return coverage_change(old, read_report_version(spark, path))
