"""Spatial inputs derived by Spark from the relational test tables.

The test tables carry no geometry, so places are computed from keys: one degree square, lon 25.5 to 26.5 and
lat -25 to -24, with one population pixel per order, one building per part, one labelled area per supplier
and one zone per nation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridfill.functions.grid import Grid
from gridfill.functions.mercator import EARTH_RADIUS
from gridfill.functions.spread import spread

GRID = Grid()


def _lon(a: int) -> str:
    return f"(25.5D + double((k * {a}L) % 10000L) / 10000D)"


def _lat(b: int) -> str:
    return f"(-25D + double((k * {b}L) % 10007L) / 10007D)"


def _x(a: int) -> str:
    return f"round(radians({_lon(a)}) * {EARTH_RADIUS}D, 3)"


def _y(b: int) -> str:
    return f"round(ln(tan(pi() / 4 + radians({_lat(b)}) / 2)) * {EARTH_RADIUS}D, 3)"


def _closed(corners: list[tuple[str, str]]) -> str:
    return "array(" + ", ".join(f"named_struct('x', {x}, 'y', {y})" for x, y in [*corners, corners[0]]) + ")"


def _shapes(w: str, h: str) -> str:
    """A box for even keys, a diamond for odd ones."""
    box = _closed([(f"x - {w}", f"y - {h}"), (f"x + {w}", f"y - {h}"), (f"x + {w}", f"y + {h}"), (f"x - {w}", f"y + {h}")])
    diamond = _closed([(f"x - {w}", "y"), ("x", f"y - {h}"), (f"x + {w}", "y"), ("x", f"y + {h}")])
    return f"IF(k % 2 = 0, {box}, {diamond})"


def _made_once(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Columns as if they were stored: behind a generator the optimizer does not copy the expressions that make a
    geometry into every place that reads it."""
    row = ", ".join(f"'{name}', {sql}" for name, sql in fields.items())
    return df.selectExpr(f"inline(array(named_struct({row})))")


def _keyed(spark: SparkSession, sf_dir: str, table: str, key: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").selectExpr(f"bigint({key}) AS k", *columns)


def pixels(spark: SparkSession, sf_dir: str, with_nodata: bool = False) -> DataFrame:
    """One population pixel per order; with_nodata turns every 97th into NaN."""
    value = "IF(k % 97 = 0, double('NaN'), value)" if with_nodata else "value"
    orders = _keyed(spark, sf_dir, "orders", "o_orderkey", "o_totalprice AS value")
    return orders.selectExpr(f"{_lon(7919)} AS lon", f"{_lat(104729)} AS lat", f"{value} AS value")


def features(spark: SparkSession, sf_dir: str, snapshot: str = "new") -> DataFrame:
    """One tagged building per part: boxes and diamonds, every fifth with a hole.

    The ``old`` snapshot lacks the parts whose key ends in 3. Keys are spread over all tasks before they become geometry, since a
    part takes a few bytes in its file and a building takes long to mend: else one task gets a million of them.
    """
    part = _keyed(spark, sf_dir, "part", "p_partkey", "double(p_size) AS s")
    if snapshot == "old":
        part = part.where("k % 10 <> 3")
    placed = spread(part).selectExpr("k", f"{_x(15485863)} AS x", f"{_y(32452843)} AS y", "s + 5 AS w", "s / 2 + 5 AS h")
    outer, hole = _shapes("w", "h"), _shapes("w / 2", "h / 2")
    tags = """map_from_entries(filter(array(
        named_struct('key', 'building', 'value', IF(k % 11 = 0, NULL, 'yes')),
        named_struct('key', 'building:levels', 'value',
                     CASE k % 8 WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN '2.5' WHEN 4 THEN '2;3' WHEN 5 THEN '1'
                                WHEN 7 THEN ' 4 ' END)), e -> e.value IS NOT NULL))"""
    return _made_once(placed, {
        "building_id": "k", "layer": "'osm'", "geom_type": "IF(k % 13 = 0, 'LineString', 'Polygon')",
        "rings": f"IF(k % 5 = 0, array({outer}, {hole}), array({outer}))", "tags": tags, "x": "x", "y": "y"})


def vector_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The buildings filed under the tile of their centre, row counted from the south."""
    placed = features(spark, sf_dir)
    return placed.select(
        GRID.tile_col(placed.x).alias("tile_column"), GRID.flip_row(GRID.tile_row(placed.y)).alias("tile_row"), "*"
    ).selectExpr("12 AS zoom_level", "* EXCEPT (x, y)")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One zone of 0.2 x 0.2 degrees per nation, in lon/lat."""
    west, south = "(25.5D + double(k % 5) / 5D)", "(-25D + double(floor(k / 5)) / 5D)"
    east, north = f"({west} + 0.2D)", f"({south} + 0.2D)"
    box = _closed([(west, south), (east, south), (east, north), (west, north)])
    return _made_once(_keyed(spark, sf_dir, "nation", "n_nationkey"), {
        "code": "concat('N', k)", "name": "concat('Nation ', k)", "rings": f"array({box})"})


def training_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled areas as GeoJSON text: a diamond per supplier, and per hundred suppliers one empty MultiPolygon
    and one lone Polygon, which readers must skip."""
    supplier = _keyed(spark, sf_dir, "supplier", "s_suppkey")
    placed = spread(supplier).selectExpr("k", f"{_x(6271)} AS x", f"{_y(7919)} AS y", "1500D + 500 * (k % 7) AS r")
    ring = "array(array(x - r, y), array(x, y - r), array(x + r, y), array(x, y + r), array(x - r, y))"

    def feature(kind: str, coordinates: str) -> str:
        return (f"to_json(named_struct('type', 'Feature', 'properties', map(), 'geometry', "
                f"named_struct('type', '{kind}', 'coordinates', {coordinates})))")

    texts = [feature("MultiPolygon", f"array(array({ring}))"),
             f"IF(k % 100 = 0, {feature('MultiPolygon', 'array()')}, NULL)",
             f"IF(k % 100 = 0, {feature('Polygon', f'array({ring})')}, NULL)"]
    return placed.selectExpr("k", f"explode(array({', '.join(texts)})) AS value").where("value IS NOT NULL")
