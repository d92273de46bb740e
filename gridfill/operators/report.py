"""Completeness index and the per-tile report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfill.functions.grid import TILE_KEY, Grid


def completeness_index(stats: DataFrame) -> DataFrame:
    """Per tile: ``index`` = (actual - expected) / expected and the sums and averages reported with it.

    Missing footprints count as 0; a missing population stays NULL, as does any ratio to zero. The average of
    the prediction runs over population cells, since there is one prediction for each.
    """
    actual, expected = F.coalesce("osm_sum", F.lit(0.0)), F.coalesce("prediction_sum", F.lit(0.0))
    return stats.select(
        *TILE_KEY, F.try_divide(actual - expected, expected).alias("index"), "pop_sum",
        actual.alias("osm_sum"), F.try_divide(actual, F.col("osm_count")).alias("osm_avg"),
        expected.alias("prediction_sum"), F.try_divide(expected, F.col("pop_count")).alias("prediction_avg"))


def report_rows(completeness: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """``tile`` ("zoom/col/row") and ``record``, the nested report of the tile."""
    record = F.struct(
        F.col("index"),
        F.struct("pop_sum", "osm_sum", "osm_avg").alias("actual"),
        F.struct(F.col("prediction_sum").alias("osm_sum"), F.col("prediction_avg").alias("osm_avg")).alias("prediction"))
    return completeness.select(grid.key_string(F.col("tile_col"), F.col("tile_row")).alias("tile"), record.alias("record"))


def report_json(completeness: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """One JSON object per tile, ``{"zoom/col/row": {...}}``, as the text column ``value``."""
    rows = report_rows(completeness, grid)
    return rows.select(F.to_json(F.create_map("tile", "record"), {"ignoreNullFields": "false"}).alias("value"))


def write_report(completeness: DataFrame, path: str, grid: Grid = Grid()) -> None:
    """Write the report as text files of one object per line, every task its own."""
    report_json(completeness, grid).write.mode("overwrite").text(path)
