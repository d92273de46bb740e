import math
import random

import pytest
from pyspark.sql import functions as F

from gridfill.functions.grid import Grid
from gridfill.operators import density

GRID = Grid(12, 8)
POINT = "building_id long, weight double, tile_col long, tile_row long, east double, south double"


def brute(points, k):
    out, c = {}, GRID.cell_size
    tiles = {(p[2], p[3]) for p in points}
    for col, row in tiles:
        local = [p for p in points if (p[2], p[3]) == (col, row)]
        for i in range(GRID.px):
            for j in range(GRID.px):
                x, y = (i + 0.5) * c, (j + 0.5) * c
                out[col, row, i, j] = sorted((math.hypot(p[4] - x, p[5] - y), p[0]) for p in local)[:k]
    return out


def crowd(seed):
    """A hot tile - one tight cluster, one spot with many copies, a sprinkle - and a tile with few buildings."""
    rnd, side = random.Random(seed), GRID.tile_size
    places = [(rnd.gauss(3000, 8), rnd.gauss(7000, 8)) for _ in range(600)] + [(5000.25, 5000.75)] * 400
    places += [(rnd.uniform(0, side), rnd.uniform(0, side)) for _ in range(100)]
    hot = [(i, 1.0 + i % 3, 2343, 2333, x, y) for i, (x, y) in enumerate(places)]
    return hot + [(9000 + i, 1.0, 2344, 2333, 500.0 * i, 100.0) for i in range(7)]


@pytest.mark.parametrize("depth", [None, 1, 4])
def test_nearest_against_brute_force(spark, depth):
    points, k = crowd(5), 25
    got = {}
    for r in density.knn_density_join(spark.createDataFrame(points, POINT), GRID, k, depth=depth).collect():
        got.setdefault((r.tile_col, r.tile_row, r.cell_col, r.cell_row), []).append((r["rank"], r.distance, r.building_id))
    want = brute(points, k)
    assert got.keys() == want.keys()
    for cell, ranked in got.items():
        ranked.sort()
        assert [b for _, _, b in ranked] == [b for _, b in want[cell]]
        assert [d for _, d, _ in ranked] == pytest.approx([d for d, _ in want[cell]])


def test_cells_keep_few_squares(spark):
    # the search must not hand a cell all buildings of a crowded tile
    crowded = [(i, 1.0, 2343, 2333, random.Random(i).uniform(0, GRID.tile_size), random.Random(-i).uniform(0, GRID.tile_size)) for i in range(20000)]
    neighbours = density.knn_density_join(spark.createDataFrame(crowded, POINT), GRID)
    assert neighbours.count() == 64 * 25
    plan = neighbours._jdf.queryExecution()
    assert plan.executedPlan().toString().count("CartesianProduct") == 0


def test_density_of_a_spot_is_null(spark):
    c = GRID.cell_size
    at_centre = [(1, 5.0, 2343, 2333, 0.5 * c, 0.5 * c)]
    cells = density.knn_density(density.knn_density_join(spark.createDataFrame(at_centre, POINT), GRID))
    by_cell = {(r.cell_col, r.cell_row): r.density for r in cells.collect()}
    assert by_cell[0, 0] is None and by_cell[1, 0] == pytest.approx(5 / (math.pi * c * c))


def test_every_point_is_filed_once(spark):
    points = spark.createDataFrame(crowd(5), POINT)
    depth = 4
    squares = density._in_squares(points, GRID, depth).groupBy(*density.SQUARE).agg(F.count("*").alias("n"))
    crowded = squares.where((F.col("n") > density.SQUARE_POINTS) & (F.col("depth") < depth))
    leaves = density.leaf_squares(squares, crowded, depth)
    assert density.file_points(points, leaves, GRID, depth).count() == points.count() == leaves.agg(F.sum("n")).first()[0]
