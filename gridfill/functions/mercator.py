"""Spherical Web Mercator (EPSG:3857) to and from lon/lat, as Column expressions."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of EPSG:3857.
EARTH_RADIUS = 6378137.0
WORLD_HALF_WIDTH = 20037508.342789244

# The latitude at which the world becomes a square.
MAX_LATITUDE = math.degrees(math.atan(math.sinh(math.pi)))


def lon_to_x(lon: Column) -> Column:
    return F.radians(lon) * F.lit(EARTH_RADIUS)


def lat_to_y(lat: Column) -> Column:
    return F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * F.lit(EARTH_RADIUS)


def x_to_lon(x: Column) -> Column:
    return F.degrees(x / F.lit(EARTH_RADIUS))


def y_to_lat(y: Column) -> Column:
    return F.degrees(F.atan(F.exp(y / F.lit(EARTH_RADIUS))) * 2 - F.lit(math.pi / 2))


def rings_to_mercator(rings: Column) -> Column:
    """Project every vertex of ``ARRAY<ARRAY<STRUCT<x,y>>>`` from lon/lat."""
    return F.transform(
        rings,
        lambda ring: F.transform(
            ring, lambda p: F.struct(lon_to_x(p["x"]).alias("x"), lat_to_y(p["y"]).alias("y"))
        ),
    )
