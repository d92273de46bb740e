"""Rasters as blocks: one row per block of pixels, from which tiles are cut as slices of arrays.

A block has ``pixel_col, pixel_row`` (its north-west pixel, counted over the whole world), ``width`` and ``values``, its rows of
pixels one after the other. No data is NULL or NaN. Blocks may have any size and lie anywhere, but must not overlap. Null or empty
``values`` and a width below 1 are no block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfill.functions.grid import TILE_KEY, DegreeGrid
from gridfill.sources.pixels import data_pixels

BLOCK_KEY = ["pixel_col", "pixel_row"]


def pixel_blocks(pixels: DataFrame, grid: DegreeGrid = DegreeGrid(), side: int = 64) -> DataFrame:
    """Square blocks of a pixel table, those without data left out. Values at one pixel are added up.

    Pixels are gathered along a block's rows first and rows to blocks then, so a group holds ``side`` entries.
    """
    col, row = grid.pixel(F.col("lon"), F.col("lat"))
    one = data_pixels(pixels).groupBy(col.alias("_c"), row.alias("_r")).agg(F.sum("value").alias("value"))
    placed = one.selectExpr(f"_c - pmod(_c, {side}) AS pixel_col", f"_r - pmod(_r, {side}) AS pixel_row",
                            f"int(pmod(_c, {side})) AS _c", f"int(pmod(_r, {side})) AS _r", "value")
    along = F.expr(f"sequence(0, {side - 1})")
    lines = placed.groupBy(*BLOCK_KEY, "_r").agg(F.map_from_entries(F.collect_list(F.struct("_c", "value"))).alias("_at"))
    lines = lines.select(*BLOCK_KEY, "_r", F.transform(along, lambda i: F.col("_at")[i]).alias("_line"))
    empty = F.array_repeat(F.lit(None).cast("double"), side)
    whole = lines.groupBy(*BLOCK_KEY).agg(F.map_from_entries(F.collect_list(F.struct("_r", "_line"))).alias("_at"))
    values = F.flatten(F.transform(along, lambda i: F.coalesce(F.col("_at")[i], empty)))
    return whole.select(*BLOCK_KEY, F.lit(side).alias("width"), values.alias("values"))


def tile_pieces(blocks: DataFrame, grid: DegreeGrid = DegreeGrid(), halo: int = 0) -> DataFrame:
    """What each block gives to each tile: ``tile_col, tile_row, piece_col, piece_row, width, values``.

    ``piece_col`` and ``piece_row`` count from the corner of the tile's halo. A block is copied once for every tile that its
    pixels or their halo reach, cut to what that tile needs; pixels are never rows of their own. No shuffle.
    """
    px = grid.px
    known = blocks.where("width >= 1 AND size(values) >= 1").selectExpr(
        "bigint(pixel_col) AS _c", "bigint(pixel_row) AS _r", "bigint(width) AS _w", "size(values) div width AS _h",
        "transform(values, v -> IF(isnan(v), NULL, double(v))) AS _values")

    def reach(start: str, length: str) -> str:
        return f"explode(sequence(bigint(floor(({start} - {halo}) / {px})), bigint(floor(({start} + {length} - 1 + {halo}) / {px}))))"

    met = known.selectExpr("*", f"{reach('_c', '_w')} AS tile_col").selectExpr("*", f"{reach('_r', '_h')} AS tile_row")
    cut = met.selectExpr(
        "*", f"greatest(_c, tile_col * {px} - {halo}) AS _west", f"least(_c + _w, (tile_col + 1) * {px} + {halo}) AS _east",
        f"greatest(_r, tile_row * {px} - {halo}) AS _north", f"least(_r + _h, (tile_row + 1) * {px} + {halo}) AS _south")
    line = "slice(_values, int((r - _r) * _w + _west - _c + 1), int(_east - _west))"
    return cut.selectExpr(
        *TILE_KEY, f"_west - tile_col * {px} + {halo} AS piece_col", f"_north - tile_row * {px} + {halo} AS piece_row",
        "int(_east - _west) AS width", f"flatten(transform(sequence(_north, _south - 1), r -> {line})) AS values")


def block_tiles(blocks: DataFrame, grid: DegreeGrid = DegreeGrid()) -> DataFrame:
    """Tiles holding data: ``tile_col, tile_row, n_pixels, n_data, value_sum``; every pixel of a block counts in ``n_pixels``."""
    sums = tile_pieces(blocks, grid).selectExpr(
        *TILE_KEY, "size(values) AS _n", "filter(values, v -> v IS NOT NULL) AS _data").selectExpr(
        *TILE_KEY, "_n", "size(_data) AS _n_data", "aggregate(_data, 0D, (s, v) -> s + v) AS _sum")
    tiles = sums.groupBy(*TILE_KEY).agg(F.sum("_n").alias("n_pixels"), F.sum("_n_data").alias("n_data"), F.sum("_sum").alias("value_sum"))
    return tiles.where("n_data > 0")


def block_halo_tiles(blocks: DataFrame, grid: DegreeGrid = DegreeGrid(), halo: int = 3) -> DataFrame:
    """Every pixel with data under its own tile and under each tile whose halo reaches it, as ``pixels.raster_halo_tiles``."""
    pieces = tile_pieces(blocks, grid, halo).where("exists(values, v -> v IS NOT NULL)")
    placed = pieces.selectExpr("*", "posexplode(values) AS (_at, value)").where("value IS NOT NULL").selectExpr(
        *TILE_KEY, "piece_col + _at % width AS pixel_col", "piece_row + _at div width AS pixel_row", "value")
    own = " AND ".join(f"{c} BETWEEN {halo} AND {halo + grid.px - 1}" for c in ("pixel_col", "pixel_row"))
    return placed.selectExpr("*", f"{own} AS is_center")
