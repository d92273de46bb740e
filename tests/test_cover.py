import math
import random

import pytest
from pyspark.sql import functions as F

from gridfill.functions.grid import Grid
from gridfill.operators import cover, coverage, joins
from tests.shapes import FEATURE, box, closed

WORLD = Grid(9, 4)
SIDE = WORLD.tile_size


def zones_of(spark, named):
    rows = [(i, 1.0, [closed(r) for r in rings]) for i, (_, rings) in enumerate(named)]
    names = F.array(*[F.lit(n) for n, _ in named])
    return spark.createDataFrame(rows, FEATURE).select(F.get(names, F.col("building_id").cast("int")).alias("code"), "rings")


def blob(rnd, x, y, reach):
    """A star-shaped outline around a point."""
    angles = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(24))
    return [(x + rnd.uniform(0.5, 1) * reach * math.cos(a), y + rnd.uniform(0.5, 1) * reach * math.sin(a)) for a in angles]


def brute(tiles, levels):
    """Largest aligned squares, level by level from the tiles themselves."""
    out, here = set(), set(tiles)
    for level in range(levels):
        full = {(c // 2, r // 2) for c, r in here}
        full = {(c, r) for c, r in full if all((2 * c + i, 2 * r + j) in here for i in (0, 1) for j in (0, 1))}
        out |= {(level, c, r) for c, r in here if (c // 2, r // 2) not in full}
        here = full
    return out | {(levels, c, r) for c, r in here}


@pytest.fixture(scope="module")
def zones(spark):
    rnd = random.Random(8)
    far = [("A", [blob(rnd, 10 * SIDE, 14 * SIDE, 21 * SIDE)]), ("A", [blob(rnd, 70 * SIDE, 9 * SIDE, 6 * SIDE)]), ("B", [blob(rnd, 12 * SIDE, 5 * SIDE, 17 * SIDE)]),
           ("C", [box(0.25 * SIDE, 0.25 * SIDE, 0.5 * SIDE, 0.5 * SIDE)]),
           ("D", [box(0, 0, 64 * SIDE, 64 * SIDE), box(20.5 * SIDE, 20.5 * SIDE, 43.5 * SIDE, 30.5 * SIDE)])]
    return zones_of(spark, far).cache()


@pytest.mark.parametrize("levels", [0, 3, 6])
def test_cover_against_brute_force(spark, zones, levels):
    touched = {}
    for r in coverage.tiles_for_geometry(zones, WORLD).collect():
        touched.setdefault(r.code, set()).add((r.tile_col, r.tile_row))
    made = cover.zone_cover(zones, WORLD, levels=levels)
    got = {}
    for r in made.collect():
        got.setdefault(r.code, []).append((r.level, r.square_col, r.square_row))
    assert got.keys() == touched.keys() == set("ABCD")
    for code, squares in got.items():
        assert len(set(squares)) == len(squares)
        assert set(squares) == brute(touched[code], levels), code
    listed = [(r.code, r.tile_col, r.tile_row) for r in cover.cover_tiles(made).collect()]
    assert sorted(listed) == sorted((code, *t) for code, ts in touched.items() for t in ts)


def test_tiles_meet_their_ancestors(spark, zones):
    rnd = random.Random(2)
    tiles = [(256 + rnd.randint(-30, 90), 255 - rnd.randint(-30, 70)) for _ in range(900)]
    table = spark.createDataFrame(tiles, "tile_col long, tile_row long")
    made = cover.zone_cover(zones, WORLD)
    got = {(r.code, r.tile_col, r.tile_row) for r in cover.tiles_in_cover(table, made).collect()}
    every = {(r.code, r.tile_col, r.tile_row) for r in coverage.tiles_for_geometry(zones, WORLD).collect()}
    assert got == {z for z in every if z[1:] in set(tiles)} and len(got) > 300
    found = cover.tiles_in_cover(table, made)
    assert found.count() == len(got)  # a tile given twice counts once


def test_a_continent_needs_few_squares(spark):
    """At zoom 12 a box of 1,200 x 1,000 tiles and a bit: rows follow its border."""
    deep = Grid(12, 4)
    t = deep.tile_size
    land = zones_of(spark, [("X", [box(-603.5 * t, -501.5 * t, 597.5 * t, 499.5 * t)])])
    made = cover.zone_cover(land, deep)
    n, tiles = made.agg(F.count("*"), F.sum(F.expr("shiftleft(1L, 2 * level)"))).first()
    assert tiles == 1202 * 1002
    assert n < 13000 and made.agg(F.max("level")).first()[0] == 6


def test_no_zone_no_square(spark, zones):
    assert cover.zone_cover(zones.where("code = 'none'"), WORLD).isEmpty()


def test_country_footprint_meets_squares(spark, zones):
    rnd = random.Random(4)
    houses = [(i, 1.0 + i % 2, [closed(box(x, y, x + 9000, y + 7000))]) for i, (x, y) in enumerate((rnd.uniform(-20 * SIDE, 40 * SIDE), rnd.uniform(-20 * SIDE, 40 * SIDE)) for _ in range(200))]
    buildings = spark.createDataFrame(houses, FEATURE)
    zone = zones.where("code = 'A'")
    got = {tuple(r) for r in joins.country_footprint(buildings, zone, WORLD).collect()}
    covered = coverage.tiles_for_geometry(zone, WORLD).select("tile_col", "tile_row")
    want = {tuple(r) for r in coverage.footprint_grid(buildings, WORLD).join(covered, ["tile_col", "tile_row"], "left_semi").collect()}
    assert {r[:4] for r in got} == {r[:4] for r in want} and len(got) > 20
    assert sorted(r[4] for r in got) == pytest.approx(sorted(r[4] for r in want))
