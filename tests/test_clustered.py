"""Layers along a Z-shaped curve and rasters as blocks."""

import glob
import math
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridfill.functions.grid import DegreeGrid, Grid
from gridfill.functions.morton import _key, key_ranges, morton
from gridfill.sources import blocks, clustered, pixels
from gridfill.sources.layers import current_version


def test_keys(spark):
    pick = random.Random(1)
    places = [(0, 0), (1, 0), (0, 1), (2**31 - 1, 2**31 - 1)] + [(pick.randrange(2**31), pick.randrange(2**31)) for _ in range(200)]
    got = spark.createDataFrame(places, "c long, r long").select("c", "r", morton(F.col("c"), F.col("r")).alias("key")).collect()
    assert all(g.key == _key(g.c, g.r) for g in got)
    assert [_key(*p) for p in places[:3]] == [0, 1, 2] and _key(*places[3]) == 2**62 - 1


@pytest.mark.parametrize("limit", [1, 4, 16, 1000])
def test_ranges_hold_the_box(limit):
    pick = random.Random(limit)
    for _ in range(60):
        cols, rows = (tuple(sorted((pick.randrange(32), pick.randrange(32)))) for _ in "cr")
        ranges = key_ranges(cols, rows, 5, limit)
        inside = {_key(c, r) for c in range(cols[0], cols[1] + 1) for r in range(rows[0], rows[1] + 1)}
        held = {k for low, high in ranges for k in range(low, high + 1)}
        assert inside <= held and len(ranges) <= limit and all(a[1] + 1 < b[0] for a, b in zip(ranges, ranges[1:]))
        if limit == 1000:
            assert inside == held
    assert key_ranges((3, 2), (0, 5), 5, limit) == []


GRID = Grid(9, 2)


@pytest.fixture(scope="module")
def layer(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layers") / "layer")
    at = spark.range(128 * 128 * 4).selectExpr("200 + id div 4 % 128 AS tile_col", "150 + id div 512 AS tile_row", "id % 2 AS cell_col",
                                               "id div 2 % 2 AS cell_row", "double(id) AS pop", "IF(id % 3 = 0, NULL, -double(id)) AS osm")
    clustered.write_clustered(at.limit(9), path, ["pop", "osm"])
    clustered.write_clustered(at, path, ["pop", "osm"], row_group_bytes=16384)
    return path, at


def box_of(cols, rows):
    t, half = GRID.tile_size, clustered.WORLD_HALF_WIDTH
    return ((cols[0] + 0.2) * t - half, half - (rows[1] + 0.7) * t, (cols[1] + 0.4) * t - half, half - (rows[0] + 0.1) * t)


def test_box_of_a_layer(spark, layer):
    path, at = layer
    for cols, rows in (((201, 207), (151, 153)), ((263, 264), (213, 215)), ((0, 511), (0, 511)), ((10, 20), (10, 20)), ((240, 240), (160, 160))):
        got = clustered.read_box(spark, path, box_of(cols, rows), 1, "osm", GRID)
        want = at.where(F.col("tile_col").between(*cols) & F.col("tile_row").between(*rows) & F.col("osm").isNotNull()).select(got.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    beyond = (5 * clustered.WORLD_HALF_WIDTH, 0.0, 6 * clustered.WORLD_HALF_WIDTH, 1.0)
    assert clustered.read_box(spark, path, beyond, 1, "osm", GRID).isEmpty()


def test_a_box_skips_row_groups(spark, layer):
    path, _ = layer
    files = glob.glob(f"{path}/data/{current_version(spark, path)}/*.parquet")
    groups = []
    for f in files:
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index("key")
        groups += [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
    ranges = key_ranges((201, 207), (151, 153), GRID.zoom)
    met = [g for g in groups if any(g.min <= high and low <= g.max for low, high in ranges)]
    assert len(groups) >= 16 and len(met) <= len(groups) / 4
    got = clustered.read_box(spark, path, box_of((201, 207), (151, 153)), 0, "pop", GRID)
    assert got.count() == 7 * 3 * 4
    plan = got._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(key," in pushed and "LessThanOrEqual(key," in pushed


# -- blocks -----------------------------------------------------------------------------------------------------

SOURCE = DegreeGrid(cell=0.5, px=8)
BLOCK = "pixel_col long, pixel_row long, width int, values array<double>"


def raster(seed, cuts_c, cuts_r):
    """A raster cut at the given pixels into blocks of several sizes, and its pixels as points."""
    pick = random.Random(seed)
    values = {(c, r): pick.choice([None, math.nan, pick.uniform(0, 9), pick.uniform(0, 9)])
              for c in range(cuts_c[0], cuts_c[-1]) for r in range(cuts_r[0], cuts_r[-1])}
    out = []
    for c0, c1 in zip(cuts_c, cuts_c[1:]):
        for r0, r1 in zip(cuts_r, cuts_r[1:]):
            out.append((c0, r0, c1 - c0, [values[c, r] for r in range(r0, r1) for c in range(c0, c1)]))
    points = [((c + 0.5) * SOURCE.cell - 180, 90 - (r + 0.5) * SOURCE.cell, v) for (c, r), v in values.items()]
    return out, points


@pytest.mark.parametrize("halo", [0, 1, 3, 11])
def test_blocks_give_the_tiles_of_their_pixels(spark, halo):
    cut, points = raster(halo, [3, 4, 16, 30, 37], [0, 9, 24, 25])
    cut += [(500, 100, 3, []), (510, 100, 0, [1.0]), (520, 100, 2, None), (528, 104, 2, [None, math.nan])]
    at = spark.createDataFrame(cut, BLOCK)
    pixel = spark.createDataFrame(points, "lon double, lat double, value double")
    got = blocks.block_halo_tiles(at, SOURCE, halo)
    want = pixels.raster_halo_tiles(pixel, SOURCE, halo).select(got.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    by_tile = lambda df: {(r.tile_col, r.tile_row): (r.n_pixels, r.n_data, pytest.approx(r.value_sum)) for r in df.collect()}
    assert by_tile(blocks.block_tiles(at, SOURCE)) == by_tile(pixels.raster_tiles(pixel, SOURCE))


def test_blocks_of_a_pixel_table(spark):
    _, points = raster(7, [3, 37], [0, 25])
    pixel = spark.createDataFrame(points + points[:50], "lon double, lat double, value double")
    at = blocks.pixel_blocks(pixel, SOURCE, side=5)
    assert {len(r["values"]) for r in at.collect()} == {25}
    got = {(r.tile_col, r.tile_row): (r.n_data, r.value_sum) for r in blocks.block_tiles(at, SOURCE).collect()}
    one = spark.createDataFrame(points, "lon double, lat double, value double")
    twice = {(r.tile_col, r.tile_row): r.value_sum for r in pixels.raster_tiles(pixel, SOURCE).collect()}
    assert got == {(r.tile_col, r.tile_row): (r.n_data, pytest.approx(twice[r.tile_col, r.tile_row])) for r in pixels.raster_tiles(one, SOURCE).collect()}
    assert blocks.pixel_blocks(pixel.limit(0), SOURCE).isEmpty()


def test_pieces_are_cut_without_a_shuffle_or_pixel_rows(spark):
    at = spark.createDataFrame(raster(1, [0, 64], [0, 64])[0], BLOCK)
    pieces = blocks.tile_pieces(at, SOURCE, 3)  # 8 x 8 tiles and those whose halo reaches in
    assert pieces.count() == 10 * 10 and "Exchange" not in pieces._jdf.queryExecution().executedPlan().toString()
