"""Statistics of tiles and zones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfill.functions.grid import TILE_KEY, Grid
from gridfill.operators.coverage import cells_by_zone, zone_spans
from gridfill.sources.scratch import checkpointed


def tile_stats(cells: DataFrame, bands: Sequence[str] = ("pop", "osm", "prediction")) -> DataFrame:
    """Sum and count of the data cells of every band, per tile. A band without data sums to NULL."""
    stats = [agg for b in bands for agg in (F.sum(b).alias(f"{b}_sum"), F.count(b).alias(f"{b}_count"))]
    return cells.groupBy(*TILE_KEY).agg(*stats)


def tile_totals(cells: DataFrame) -> DataFrame:
    """Population, actual and expected footprint of every tile."""
    return tile_stats(cells).select(
        *TILE_KEY, F.col("pop_sum").alias("population"), F.col("osm_sum").alias("actual"),
        F.col("prediction_sum").alias("expected"))


def zonal_building_area(footprint: DataFrame, zones: DataFrame, grid: Grid, key: str = "code") -> DataFrame:
    """Footprint in the cells of each zone, and the number of all its cells: ``key, area_m2, cells``.

    Zone cells are counted from their spans, never listed; only footprint cells are joined. Spans are made once and stored,
    since both uses read them.
    """
    spans = checkpointed(zone_spans(zones, grid, key))
    counts = spans.groupBy(key).agg(F.sum(F.col("row_to") - F.col("row_from") + 1).alias("cells"))
    area = cells_by_zone(footprint, spans, grid, key).groupBy(key).agg(F.sum("osm").alias("area_m2"))
    return counts.join(area, key, "left").select(key, F.coalesce("area_m2", F.lit(0.0)).alias("area_m2"), "cells")
