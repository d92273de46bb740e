"""Ground area of grid cells in the Albers equal-area projection used for Africa.

The area asked for is that of the quadrilateral through the four projected corners of a tile. Albers maps
parallels to concentric arcs and meridians to radii, so two corners on one parallel and the cone's apex form
an isosceles triangle; the quadrilateral is the difference of two such triangles and its area needs only the
authalic terms of its two parallels. It does not depend on the tile column.
"""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridfill.functions.grid import Grid
from gridfill.functions.mercator import EARTH_RADIUS, WORLD_HALF_WIDTH

# WGS84 ellipsoid and the standard parallels of the projection.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
PARALLELS = (20.0, -23.0)

_E2 = FLATTENING * (2 - FLATTENING)
_E = math.sqrt(_E2)


def _q(s: float) -> float:
    return (1 - _E2) * (s / (1 - _E2 * s * s) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


def _cone() -> float:
    sines = [math.sin(math.radians(p)) for p in PARALLELS]
    m2 = [(1 - s * s) / (1 - _E2 * s * s) for s in sines]
    return (m2[0] - m2[1]) / (_q(sines[1]) - _q(sines[0]))


CONE = _cone()


def _q_of_y(y: Column) -> Column:
    s = F.tanh(y / F.lit(EARTH_RADIUS))  # sine of the latitude at a Mercator northing
    return F.lit(1 - _E2) * (
        s / (1 - F.lit(_E2) * s * s) - F.log((1 - F.lit(_E) * s) / (1 + F.lit(_E) * s)) / F.lit(2 * _E)
    )


def tile_area_m2(grid: Grid, tile_row: Column) -> Column:
    north = F.lit(WORLD_HALF_WIDTH) - tile_row * F.lit(grid.tile_size)
    south = F.lit(WORLD_HALF_WIDTH) - (tile_row + 1) * F.lit(grid.tile_size)
    turn = math.sin(abs(CONE) * 2 * math.pi / grid.tiles)
    scale = SEMI_MAJOR * SEMI_MAJOR * turn / (2 * abs(CONE))
    return (_q_of_y(north) - _q_of_y(south)) * F.lit(scale)


def cell_area_m2(grid: Grid, tile_row: Column) -> Column:
    """Mean ground area of a cell: one value for all cells of a tile."""
    return tile_area_m2(grid, tile_row) / F.lit(float(grid.px * grid.px))
