"""Nearest buildings of every cell centre, and the density estimate drawn from them.

The neighbours of a cell are sought among the buildings of its own tile. Pairing all cells with all buildings
of a tile is avoided by descending through nested squares: a square is split in 4 x 4 while it holds many
buildings, and a cell keeps only the squares that can still hold one of its k nearest. The bound comes from
building counts alone - the k-th nearest building is no further than the far corner of the squares that
together hold k - so the result is exact.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridfill.functions.grid import CELL_KEY, TILE_KEY, Grid
from gridfill.functions.shapes import polygon_moments
from gridfill.functions.spread import spread
from gridfill.sources.scratch import checkpointed

SPLIT = 4  # squares per side a square is split into
SQUARE_POINTS = 64  # squares holding more buildings than this are split
MAX_DEPTH = 8  # smallest square: tile side / 4**8, about 15 cm
SLACK_M = 1e-6  # metres given to rounding when squares are left out

SQUARE = [*TILE_KEY, "depth", "sx", "sy"]


def building_points(buildings: DataFrame, grid: Grid, key: str = "building_id") -> DataFrame:
    """Centroid and weight (levels x planar area) of each building, placed from its tile's north-west corner."""
    known = buildings.where(F.col("levels").isNotNull())
    points = known.select(key, "levels", polygon_moments("rings").alias("m")).selectExpr(
        key, "m.x", "m.y", "levels * m.area AS weight")
    placed = points.select(key, "weight", "x", "y", grid.tile_col(F.col("x")).alias("tile_col"),
                           grid.tile_row(F.col("y")).alias("tile_row"))
    extent = grid.tile_extent(F.col("tile_col"), F.col("tile_row"))
    return placed.select(key, "weight", *TILE_KEY, (F.col("x") - extent["xmin"]).alias("east"),
                         (extent["ymax"] - F.col("y")).alias("south"))


def _in_squares(points: DataFrame, grid: Grid, depth: int) -> DataFrame:
    """Every point once per depth, under the square holding it."""

    def index(offset: str) -> str:
        per_side = f"power({SPLIT}D, depth)"
        return f"bigint(greatest(least(floor({offset} * {per_side} / {grid.tile_size!r}D), {per_side} - 1), 0D))"

    nested = points.selectExpr("*", f"explode(sequence(0, {depth})) AS depth")
    return nested.selectExpr("*", f"{index('east')} AS sx", f"{index('south')} AS sy")


def _children(squares: DataFrame, crowded: DataFrame) -> DataFrame:
    """Squares below a crowded one, under their parent's key."""
    parent = squares.where("depth > 0").selectExpr(
        *TILE_KEY, "depth - 1 AS depth", f"bigint(floor(sx / {SPLIT})) AS sx", f"bigint(floor(sy / {SPLIT})) AS sy",
        "sx AS to_sx", "sy AS to_sy", "n AS to_n", "depth AS to_depth")
    return parent.join(crowded.select(*SQUARE), SQUARE, "left_semi")


def leaf_squares(squares: DataFrame, crowded: DataFrame, depth: int) -> DataFrame:
    """Squares that aren't split though their parent is: each building lies in exactly one."""
    whole = squares.where((F.col("n") <= SQUARE_POINTS) | (F.col("depth") == depth))
    below = _children(whole, crowded).selectExpr(*TILE_KEY, "to_depth AS depth", "to_sx AS sx", "to_sy AS sy", "to_n AS n")
    return whole.where("depth = 0").select(*SQUARE, "n").unionByName(below)


def file_points(points: DataFrame, leaves: DataFrame, grid: Grid, depth: int) -> DataFrame:
    """Every point once, under the leaf square that holds it."""
    return _in_squares(points, grid, depth).join(leaves.select(*SQUARE), SQUARE, "left_semi")


def _prune(frontier: DataFrame, grid: Grid, k: int) -> DataFrame:
    """Drop the squares that lie beyond the distance within which k buildings are certain."""
    side = f"{grid.tile_size!r}D / power({SPLIT}D, depth)"
    cell = f"PARTITION BY {', '.join(CELL_KEY)}"
    measured = frontier.selectExpr(
        "*", f"sx * {side} - east AS _w", f"(sx + 1) * {side} - east AS _e",
        f"sy * {side} - south AS _n", f"(sy + 1) * {side} - south AS _s")
    measured = measured.selectExpr(
        *frontier.columns, "hypot(greatest(_w, -_e, 0D), greatest(_n, -_s, 0D)) AS _near",
        "hypot(greatest(abs(_w), abs(_e)), greatest(abs(_n), abs(_s))) AS _far")
    counted = measured.selectExpr("*", f"sum(n) OVER ({cell} ORDER BY _far) AS _held")
    bounded = counted.selectExpr("*", f"min(IF(_held >= {k}, _far, NULL)) OVER ({cell}) AS _bound")
    return bounded.where(f"_bound IS NULL OR _near <= _bound + {SLACK_M}D").select(*frontier.columns)


def knn_density_join(points: DataFrame, grid: Grid, k: int = 25, key: str = "building_id", depth: int | None = None) -> DataFrame:
    """The k nearest buildings of every cell centre of each tile with buildings, fewer where a tile has fewer.

    ``CELL_KEY, key, weight, distance, rank``; equal distances rank by ``key``. ``depth`` is how often squares
    may be split; by default one small job finds how deep crowded squares go.
    """
    # of buildings at one spot only the first k can be among the nearest
    spot = Window.partitionBy(*TILE_KEY, "east", "south").orderBy(key)
    points = points.withColumn("_at_spot", F.row_number().over(spot)).where(F.col("_at_spot") <= k).drop("_at_spot")
    points = checkpointed(points)  # read for the squares of every depth and for the final ranking

    def squares_to(limit: int) -> DataFrame:
        return _in_squares(points, grid, limit).groupBy(*SQUARE).agg(F.count(F.lit(1)).alias("n"))

    if depth is None:
        crowded_depth = squares_to(MAX_DEPTH - 1).where(F.col("n") > SQUARE_POINTS).agg(F.max("depth")).first()[0]
        depth = 0 if crowded_depth is None else crowded_depth + 1
    squares = squares_to(depth)
    crowded = squares.where((F.col("n") > SQUARE_POINTS) & (F.col("depth") < depth))
    single = leaf_squares(squares, crowded, depth)
    step = _children(squares, crowded).unionByName(
        single.selectExpr(*SQUARE, "sx AS to_sx", "sy AS to_sy", "n AS to_n", "depth AS to_depth"))

    along = f"explode(sequence(0L, {grid.px - 1}L))"
    columns = squares.where("depth = 0").selectExpr(*SQUARE, "n", f"{along} AS cell_col")
    cells = spread(columns, *TILE_KEY, "cell_col").selectExpr("*", f"{along} AS cell_row")
    frontier = cells.selectExpr(
        *CELL_KEY, f"(cell_col + 0.5D) * {grid.cell_size!r}D AS east", f"(cell_row + 0.5D) * {grid.cell_size!r}D AS south",
        "depth", "sx", "sy", "n")
    for _ in range(depth):
        moved = frontier.drop("n").join(step, SQUARE)
        frontier = _prune(moved.selectExpr(
            *CELL_KEY, "east", "south", "to_depth AS depth", "to_sx AS sx", "to_sy AS sy", "to_n AS n"), grid, k)

    filed = file_points(points, single, grid, depth)
    filed = filed.selectExpr(*SQUARE, key, "weight", "east AS _east", "south AS _south")
    pairs = frontier.join(filed, SQUARE).selectExpr(
        *CELL_KEY, key, "weight", "hypot(_east - east, _south - south) AS distance")
    nearest = Window.partitionBy(*CELL_KEY).orderBy("distance", key)
    return pairs.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)


def knn_density(neighbours: DataFrame) -> DataFrame:
    """Weight of a cell's nearest buildings over the disc reaching the furthest; NULL for a disc of no size."""
    reach = F.max("distance")
    return neighbours.groupBy(*CELL_KEY).agg(
        F.try_divide(F.sum("weight"), F.lit(math.pi) * reach * reach).alias("density"))
