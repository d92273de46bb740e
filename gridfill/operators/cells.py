"""Cell layers: one row per data cell, one nullable DOUBLE column per band."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridfill.functions.grid import CELL_KEY, TILE_KEY, Grid
from gridfill.functions.mercator import lat_to_y, lon_to_x
from gridfill.sources.pixels import data_pixels, in_world

# Zoom levels of a pyramid summed from one shuffle.
BLOCK_LEVELS = 4


def pop_grid(pixels: DataFrame, grid: Grid = Grid(), column: str = "pop") -> DataFrame:
    """Population pixels on the working grid: each pixel counts in full for the cell holding its centre.

    One shuffle of partly summed cells. Summing straight onto a coarse grid gives what summing onto a fine
    one and down-sampling would, so ask for the grid that is needed. Pixels outside the square world count nowhere.
    """
    data = in_world(data_pixels(pixels))
    gcol, grow = grid.cell_index(lon_to_x(F.col("lon")), lat_to_y(F.col("lat")))
    last = F.lit(grid.tiles * grid.px - 1).cast("bigint")  # the date line and the lower edge close the last cells
    placed = data.select(F.least(gcol, last).alias("gcol"), F.least(F.greatest(grow, F.lit(0).cast("bigint")), last).alias("grow"), "value")
    # grouped by the key layers are joined on, so that a join needs no second shuffle
    return placed.groupBy(*grid.split(F.col("gcol"), F.col("grow"))).agg(F.sum("value").alias(column))


def resample(cells: DataFrame, grid: Grid, px: int, bands: Sequence[str], extra_keys: Sequence[str] = (),
             method: Callable[[str], Column] = F.sum) -> DataFrame:
    """Down-sample to ``px`` cells per tile side, never across a tile border. ``px`` must divide the old one."""
    if grid.px % px:
        raise ValueError(f"{px} cells do not divide a tile of {grid.px}")
    step = F.lit(grid.px // px)
    coarse = [F.floor(F.col(c) / step).cast("bigint").alias(c) for c in ("cell_col", "cell_row")]
    return cells.groupBy(*TILE_KEY, *coarse, *extra_keys).agg(*[method(b).alias(b) for b in bands])


def resample_sum(cells: DataFrame, grid: Grid, px: int, bands: Sequence[str] = ("pop", "osm")) -> DataFrame:
    return resample(cells, grid, px, bands)


def resample_multiband(cells: DataFrame, grid: Grid, px: int) -> DataFrame:
    """As ``resample_sum`` for the long form ``CELL_KEY, band, value``."""
    return resample(cells, grid, px, ["value"], ["band"])


def coarser_level(cells: DataFrame, grid: Grid, bands: Sequence[str], extra_keys: Sequence[str] = ()) -> DataFrame:
    """The layer one zoom further out: two by two cells summed into one."""
    up = Grid(grid.zoom - 1, grid.px)
    half = [F.floor(g / F.lit(2)).cast("bigint") for g in (grid.gcol(), grid.grow())]
    return cells.groupBy(*up.split(*half), *extra_keys).agg(*[F.sum(b).alias(b) for b in bands])


def pyramid_sum(cells: DataFrame, grid: Grid, bands: Sequence[str], min_zoom: int = 0) -> DataFrame:
    """All levels from the layer's own zoom to ``min_zoom``, under an added ``zoom``.

    Cells are shuffled once per BLOCK_LEVELS levels, by the coarsest cell of these levels that holds them; at
    most 4**BLOCK_LEVELS cells share one. The levels in between group within that partitioning.
    """
    def level(zoom: int, summed: DataFrame) -> DataFrame:
        return summed.select(F.lit(zoom).alias("zoom"), *grid.split(F.col("gcol"), F.col("grow")), *bands)

    base = cells.select(grid.gcol().alias("gcol"), grid.grow().alias("grow"), *bands)
    levels = level(grid.zoom, base)
    for start in range(grid.zoom, min_zoom, -BLOCK_LEVELS):
        steps = min(BLOCK_LEVELS, start - min_zoom)
        block = [f"{c} div {1 << steps} AS block_{c}" for c in ("gcol", "grow")]
        blocked = base.selectExpr("*", *block).repartition("block_gcol", "block_grow")
        for step in range(1, steps + 1):
            up = [F.expr(f"{c} div {1 << step}").alias(c) for c in ("gcol", "grow")]
            base = blocked.groupBy("block_gcol", "block_grow", *up).agg(*[F.sum(b).alias(b) for b in bands]).drop("block_gcol", "block_grow")
            levels = levels.unionByName(level(start - step, base))
    return levels


def drop_nodata_tiles(cells: DataFrame, column: str) -> DataFrame:
    """Rows of tiles with at least one data cell in ``column``."""
    data = F.max(F.col(column).isNotNull()).over(Window.partitionBy(*TILE_KEY))  # one pass: a tile holds at most px * px cells
    return cells.withColumn("_data", data).where("_data").drop("_data")


def layer_metadata(cells: DataFrame, grid: Grid) -> DataFrame:
    """One row: key bounds, extent, grid and CRS of a layer."""
    bounds = cells.agg(*[f(c).alias(f"{n}_{c}") for c in TILE_KEY for n, f in (("min", F.min), ("max", F.max))])
    low = grid.tile_extent(F.col("min_tile_col"), F.col("max_tile_row"))
    high = grid.tile_extent(F.col("max_tile_col"), F.col("min_tile_row"))
    return bounds.select(
        "*", low["xmin"].alias("xmin"), low["ymin"].alias("ymin"), high["xmax"].alias("xmax"), high["ymax"].alias("ymax"),
        F.lit("EPSG:3857").alias("crs"), F.lit("float64").alias("cell_type"),
        F.lit(grid.zoom).alias("zoom"), F.lit(grid.px).alias("px"))


def assemble_tiles(cells: DataFrame, grid: Grid, bands: Sequence[str] = ("pop", "osm", "prediction")) -> DataFrame:
    """One dense row-major array per tile and band, NULL where there is no cell.

    A tile gathers at most ``px * px`` rows: the input has one row per cell.
    """
    size = F.lit(grid.px * grid.px)
    position = (F.col("cell_row") * grid.px + F.col("cell_col")).cast("int")
    entry = F.struct(position.alias("i"), F.struct(*[F.col(b).alias(b) for b in bands]).alias("v"))
    tiles = cells.groupBy(*TILE_KEY).agg(F.array_sort(F.collect_list(entry)).alias("cells"))
    following = F.concat(F.transform(F.slice("cells", F.lit(2), F.size("cells")), lambda e: e["i"]), F.array(size))

    def band(name: str) -> Column:
        empty = F.lit(None).cast("double")
        head = F.array_repeat(empty, F.get("cells", F.lit(0))["i"])
        body = F.zip_with("cells", following, lambda e, nxt: F.concat(
            F.array(e["v"][name]), F.array_repeat(empty, nxt - e["i"] - 1)))
        return F.concat(head, F.flatten(body))

    return tiles.select(*TILE_KEY, *[band(b).alias(b) for b in bands])


def explode_tiles(tiles: DataFrame, grid: Grid, bands: Sequence[str] = ("pop", "osm"), require: Sequence[str] = ()) -> DataFrame:
    """Dense tiles to one row per cell, keeping cells with data in every band of ``require``."""
    rows = tiles.select(*TILE_KEY, F.posexplode(F.arrays_zip(*bands)).alias("_i", "_v"))
    cells = rows.select(
        *TILE_KEY, (F.col("_i") % grid.px).cast("bigint").alias("cell_col"),
        F.floor(F.col("_i") / grid.px).cast("bigint").alias("cell_row"), *[F.col("_v")[b].alias(b) for b in bands])
    return cells.dropna(subset=list(require)) if require else cells


def filter_both_valid(cells: DataFrame) -> DataFrame:
    return cells.dropna(subset=["pop", "osm"])


def fill_missing_footprint(cells: DataFrame) -> DataFrame:
    """Cells with population; in a labelled area no footprint means no building."""
    return cells.dropna(subset=["pop"]).fillna(0.0, subset=["osm"])


def cell_histogram(cells: DataFrame, column: str, buckets: int = 100) -> DataFrame:
    """Counts in ``buckets`` equal parts of the value range: ``bucket, low, high, cells``; empty parts have no row."""
    data = cells.where(F.col(column).isNotNull()).select(F.col(column).alias("_v"))
    extremes = data.agg(F.struct(F.min("_v").alias("_low"), F.max("_v").alias("_high"))).scalar()
    ranged = data.withColumn("_range", extremes).select("_v", "_range.*")
    width = (F.col("_high") - F.col("_low")) / buckets
    bucket = F.least(F.coalesce(F.floor(F.try_divide(F.col("_v") - F.col("_low"), width)), F.lit(0)), F.lit(buckets - 1))
    counted = ranged.groupBy(bucket.cast("bigint").alias("bucket"), "_low", "_high").agg(F.count(F.lit(1)).alias("cells"))
    return counted.select("bucket", (F.col("_low") + F.col("bucket") * width).alias("low"),
                          (F.col("_low") + (F.col("bucket") + 1) * width).alias("high"), "cells")


def approx_histogram(cells: DataFrame, column: str, buckets: int = 100) -> DataFrame:
    """Streaming histogram of at most ``buckets`` uneven bars: ``x, y``, in one pass."""
    bars = cells.agg(F.histogram_numeric(column, F.lit(buckets)).alias("h"))
    return bars.select(F.explode("h").alias("b")).select("b.*")
