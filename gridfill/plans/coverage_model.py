"""Training and prediction, put together from the operators."""

from __future__ import annotations

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfill.functions.grid import TILE_KEY, Grid
from gridfill.operators.cells import fill_missing_footprint, filter_both_valid, pop_grid, resample
from gridfill.operators.coverage import footprint_grid, in_tiles, mask_cells, pixels_in_tiles, touched_tiles
from gridfill.operators.joins import pop_with_footprint, tile_stats_with_footprint
from gridfill.operators.regression import fit_through_origin, predict_footprint
from gridfill.operators.report import completeness_index
from gridfill.sources.features import building_polygons
from gridfill.sources.scratch import checkpointed

Model = DataFrame | LinearRegressionModel | float

# Analysis cells per tile side: fixed values of the two kinds of model.
UNLABELED_PX = 16
LABELED_PX = 4


def analysis_layers(pixels: DataFrame, features: DataFrame, px: int, grid: Grid = Grid(), masks: DataFrame | None = None,
                    mask_both: bool = False, clip_zone: DataFrame | None = None, clip_to_tile: bool = False,
                    layer: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Population and footprint cells, ``px`` per tile side, each on its own.

    Sums compose, so what is not masked is summed straight onto the analysis grid and never exists on the
    working grid. ``masks`` cut population on the working grid, with ``mask_both`` footprints too; ``clip_zone``
    always cuts both. What lies in tiles that no area touches is left out before anything is summed.
    """
    def cut(areas: list[DataFrame | None], source: DataFrame, prune, on_grid) -> DataFrame:
        areas = [a for a in areas if a is not None]
        if not areas:
            return on_grid(source, grid.with_px(px))
        for area in areas:
            source = prune(source, checkpointed(touched_tiles(area, grid)), grid)  # few rows, read at several places of the plan
        cells = on_grid(source, grid)
        for area in areas:
            cells = mask_cells(cells, area, grid)
        band = cells.columns[-1]
        return resample(cells, grid, px, [band])

    def buildings_in_tiles(buildings: DataFrame, tiles: DataFrame, grid: Grid) -> DataFrame:
        return buildings.join(tiles, TILE_KEY, "left_semi") if clip_to_tile else in_tiles(buildings, tiles, grid)

    pop = cut([clip_zone, masks], pixels, pixels_in_tiles, pop_grid)
    footprint = cut([clip_zone, masks if mask_both else None], building_polygons(features, layer), buildings_in_tiles,
                    lambda b, g: footprint_grid(b, g, clip_to_tile=clip_to_tile))
    return pop, footprint


def analysis_cells(pixels: DataFrame, features: DataFrame, px: int, grid: Grid = Grid(), **options) -> DataFrame:
    """``analysis_layers`` joined: population tiles with all their footprint cells."""
    return pop_with_footprint(*analysis_layers(pixels, features, px, grid, **options))


def _trained(cells: DataFrame) -> DataFrame:
    # stored: a fit reads the cells twice, and who predicts with it then plans and computes none of the training again
    model = fit_through_origin(checkpointed(cells.select("pop", "osm")))
    return model.withColumn("coefficient", F.when(F.col("n") > 0, F.col("coefficient")).otherwise(F.raise_error(F.lit("no cell to train on"))))


def train_unlabeled(pixels: DataFrame, features: DataFrame, px: int = UNLABELED_PX, grid: Grid = Grid(), **options) -> DataFrame:
    """Fit on every cell where both population and footprint are known; none is an error when the model is read."""
    return _trained(filter_both_valid(analysis_cells(pixels, features, px, grid, **options)))


def train_labeled(pixels: DataFrame, features: DataFrame, masks: DataFrame, px: int = LABELED_PX, grid: Grid = Grid(),
                  **options) -> DataFrame:
    """Fit inside hand-labelled areas, where no footprint means no building; no cell there is an error when the model is read."""
    return _trained(fill_missing_footprint(analysis_cells(pixels, features, px, grid, masks=masks, **options)))


def _completeness(pixels: DataFrame, features: DataFrame, model: Model, px: int, grid: Grid, **options) -> DataFrame:
    pop, footprint = analysis_layers(pixels, features, px, grid, **options)
    return completeness_index(tile_stats_with_footprint(predict_footprint(pop, model), footprint))


def predict_unlabeled(pixels: DataFrame, features: DataFrame, model: Model, px: int = UNLABELED_PX,
                      grid: Grid = Grid(), **options) -> DataFrame:
    """Completeness of every tile with population, from a model fitted without labels."""
    return _completeness(pixels, features, model, px, grid, **options)


def predict_labeled(pixels: DataFrame, features: DataFrame, model: Model, px: int = LABELED_PX,
                    grid: Grid = Grid(), **options) -> DataFrame:
    """Completeness of every tile with population, from a model fitted on labelled areas."""
    return _completeness(pixels, features, model, px, grid, **options)
