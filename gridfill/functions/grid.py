"""Tile grids: the arithmetic between points, tiles, cells and extents.

A grid is ``zoom`` (2**zoom tiles a side, row 0 in the north) and ``px`` cells per tile side. Inside the
package a cell is addressed either by ``(tile_col, tile_row, cell_col, cell_row)`` or, where whole rows or
columns of cells are walked, by its world-wide index ``(gcol, grow)``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridfill.functions.mercator import WORLD_HALF_WIDTH, x_to_lon, y_to_lat

TILE_KEY = ["tile_col", "tile_row"]
CELL_KEY = ["tile_col", "tile_row", "cell_col", "cell_row"]


def _index(value: Column) -> Column:
    return F.floor(value).cast("bigint")


@dataclass(frozen=True)
class Grid:
    """Web Mercator tile scheme at one zoom."""

    zoom: int = 12
    px: int = 256

    @property
    def tiles(self) -> int:
        return 1 << self.zoom

    @property
    def tile_size(self) -> float:
        return 2 * WORLD_HALF_WIDTH / self.tiles

    @property
    def cell_size(self) -> float:
        return self.tile_size / self.px

    def with_px(self, px: int) -> Grid:
        return Grid(self.zoom, px)

    # -- points ---------------------------------------------------------------------------------
    def u(self, x: Column) -> Column:
        """Distance from the western border, in cells."""
        return (x + F.lit(WORLD_HALF_WIDTH)) / F.lit(self.cell_size)

    def v(self, y: Column) -> Column:
        """Distance from the northern border, in cells."""
        return (F.lit(WORLD_HALF_WIDTH) - y) / F.lit(self.cell_size)

    def tile_col(self, x: Column) -> Column:
        return _index((x + F.lit(WORLD_HALF_WIDTH)) / F.lit(self.tile_size))

    def tile_row(self, y: Column) -> Column:
        return _index((F.lit(WORLD_HALF_WIDTH) - y) / F.lit(self.tile_size))

    def cell_index(self, x: Column, y: Column) -> tuple[Column, Column]:
        """World-wide index of the cell holding a point."""
        return _index(self.u(x)), _index(self.v(y))

    # -- cell addresses -------------------------------------------------------------------------
    def split(self, gcol: Column, grow: Column) -> list[Column]:
        px = F.lit(self.px).cast("bigint")
        return [
            _index(gcol / px).alias("tile_col"),
            _index(grow / px).alias("tile_row"),
            F.pmod(gcol, px).alias("cell_col"),
            F.pmod(grow, px).alias("cell_row"),
        ]

    def gcol(self) -> Column:
        return F.col("tile_col") * F.lit(self.px).cast("bigint") + F.col("cell_col")

    def grow(self) -> Column:
        return F.col("tile_row") * F.lit(self.px).cast("bigint") + F.col("cell_row")

    def cell_center(self) -> tuple[Column, Column]:
        """Map coordinates of the centre of the cell named by the CELL_KEY columns."""
        half = F.lit(WORLD_HALF_WIDTH)
        x = (self.gcol() + F.lit(0.5)) * F.lit(self.cell_size) - half
        y = half - (self.grow() + F.lit(0.5)) * F.lit(self.cell_size)
        return x, y

    # -- tiles ----------------------------------------------------------------------------------
    def tile_extent(self, col: Column, row: Column) -> dict[str, Column]:
        """Mercator bounds of a tile: xmin, ymin, xmax, ymax."""
        t, half = F.lit(self.tile_size), F.lit(WORLD_HALF_WIDTH)
        return {
            "xmin": col * t - half,
            "ymin": half - (row + 1) * t,
            "xmax": (col + 1) * t - half,
            "ymax": half - row * t,
        }

    def tile_extent_lonlat(self, col: Column, row: Column) -> dict[str, Column]:
        e = self.tile_extent(col, row)
        return {
            "lon_min": x_to_lon(e["xmin"]),
            "lat_min": y_to_lat(e["ymin"]),
            "lon_max": x_to_lon(e["xmax"]),
            "lat_max": y_to_lat(e["ymax"]),
        }

    def tile_ring_lonlat(self, col: Column, row: Column) -> Column:
        """Closed five-vertex lon/lat ring of a tile, starting south-west."""
        e = self.tile_extent_lonlat(col, row)
        corners = [("lon_min", "lat_min"), ("lon_max", "lat_min"), ("lon_max", "lat_max"),
                   ("lon_min", "lat_max"), ("lon_min", "lat_min")]
        return F.array(*[F.struct(e[a].alias("x"), e[b].alias("y")) for a, b in corners])

    def key_bounds(self, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> dict[str, Column]:
        """First and last tile touched by an extent; an extent ending on a tile border stops before it."""
        t, half = F.lit(self.tile_size), F.lit(WORLD_HALF_WIDTH)
        col_min, row_min = self.tile_col(xmin), self.tile_row(ymax)
        return {
            "col_min": col_min,
            "row_min": row_min,
            "col_max": F.greatest(col_min, (F.ceil((xmax + half) / t) - 1).cast("bigint")),
            "row_max": F.greatest(row_min, (F.ceil((half - ymin) / t) - 1).cast("bigint")),
        }

    def key_string(self, col: Column, row: Column) -> Column:
        return F.concat_ws("/", F.lit(str(self.zoom)), col.cast("string"), row.cast("string"))

    def flip_row(self, row: Column) -> Column:
        """North-counted row to south-counted row, or back."""
        return F.lit(self.tiles - 1).cast("bigint") - row


@dataclass(frozen=True)
class DegreeGrid:
    """Tiles of ``px`` square pixels of ``cell`` degrees over the whole lon/lat world."""

    cell: float = 0.0008333  # fixed value: source pixel side in degrees
    px: int = 256

    @property
    def tile_size(self) -> float:
        return self.cell * self.px

    def pixel(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """World-wide index of the pixel holding a point."""
        return (_index((lon + F.lit(180.0)) / F.lit(self.cell)), _index((F.lit(90.0) - lat) / F.lit(self.cell)))

    def tile(self, pixel: Column) -> Column:
        return _index(pixel / F.lit(self.px))

    def pixel_window(self, col: Column, row: Column, origin_lon: Column, origin_lat: Column,
                     buffer: int = 0) -> dict[str, Column]:
        """Pixel window of a tile in a raster whose upper-left corner is the origin. Not clamped to the raster."""
        def low(cells: Column) -> Column:
            return F.floor(F.round(cells, 6)).cast("bigint") - F.lit(buffer)

        def high(cells: Column) -> Column:
            return F.ceil(F.round(cells, 6)).cast("bigint") - F.lit(1 - buffer)

        west = (col * F.lit(self.tile_size) - F.lit(180.0) - origin_lon) / F.lit(self.cell)
        north = (origin_lat - F.lit(90.0) + row * F.lit(self.tile_size)) / F.lit(self.cell)
        return {"col_min": low(west), "row_min": low(north),
                "col_max": high(west + F.lit(float(self.px))), "row_max": high(north + F.lit(float(self.px)))}


def snap_bits(grid: Grid) -> int:
    """Fraction bits left for a cell coordinate of this grid in a 52-bit integer."""
    return 52 - math.ceil(math.log2(grid.tiles * grid.px))
