"""Joins between layers and between runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfill.functions.grid import CELL_KEY, TILE_KEY, Grid
from gridfill.operators.cover import tiles_in_cover, zone_cover
from gridfill.operators.coverage import box_tiles, footprint_grid, in_tiles
from gridfill.operators.zonal import tile_stats


def pop_with_footprint(pop: DataFrame, footprint: DataFrame) -> DataFrame:
    """Population tiles with the whole of their footprint tiles, cell by cell.

    A tile with population gets every footprint cell of the same tile, also those without population (``pop`` NULL);
    ``osm`` is NULL where nothing is mapped. Footprints of tiles without population are left out. Both sides hold one
    row per cell.
    """
    tiles = pop.select(*TILE_KEY).distinct()
    return pop.join(footprint.join(tiles, TILE_KEY, "left_semi"), CELL_KEY, "full_outer")


def tile_stats_with_footprint(scored: DataFrame, footprint: DataFrame) -> DataFrame:
    """Statistics of population tiles (``pop``, ``prediction``) and of all footprint (``osm``) in the same tiles.

    What ``tile_stats`` gives for cells joined by ``pop_with_footprint``, from one small join of tiles.
    """
    return tile_stats(scored, ["pop", "prediction"]).join(tile_stats(footprint, ["osm"]), TILE_KEY, "left").withColumn(
        "osm_count", F.coalesce("osm_count", F.lit(0).cast("bigint")))


def country_footprint(buildings: DataFrame, zone: DataFrame, grid: Grid = Grid(12, 12), key: str = "code") -> DataFrame:
    """Footprint cells of all tiles covering a zone. The buildings' tiles meet the squares of its cover; no tile without any is listed."""
    covered = tiles_in_cover(box_tiles(buildings, grid), zone_cover(zone, grid, key), key).select(*TILE_KEY).distinct()
    return footprint_grid(in_tiles(buildings, covered, grid), grid).join(covered, TILE_KEY, "left_semi")


def coverage_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two completeness tables side by side, tile by tile, with what changed."""
    old = before.select(*TILE_KEY, F.col("index").alias("index_before"), F.col("osm_sum").alias("osm_before"))
    new = after.select(*TILE_KEY, F.col("index").alias("index_after"), F.col("osm_sum").alias("osm_after"))
    both = old.join(new, TILE_KEY, "full_outer")
    return both.select(
        *TILE_KEY, "osm_before", "osm_after", "index_before", "index_after",
        (F.coalesce("osm_after", F.lit(0.0)) - F.coalesce("osm_before", F.lit(0.0))).alias("osm_change"),
        (F.col("index_after") - F.col("index_before")).alias("index_change"))
