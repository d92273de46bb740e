import math
import random
import re

import pytest
from pyspark.sql import functions as F

from gridfill.functions.albers import cell_area_m2
from gridfill.functions.grid import CELL_KEY, Grid, snap_bits
from gridfill.operators import coverage
from tests.shapes import FEATURE, GRID, area, box, closed, corner, fractions

C = GRID.cell_size


def polygons(spark, rows):
    """rows: (id, levels, [ring, ...]) with open rings."""
    return spark.createDataFrame([(i, lv, [closed(r) for r in rings]) for i, lv, rings in rows], FEATURE)


def measured(spark, rows, grid=GRID):
    cells = coverage.footprint_fraction(polygons(spark, rows), grid)
    return {(r.building_id, r.c, r.r): r.fraction
            for r in cells.select("building_id", grid.gcol().alias("c"), grid.grow().alias("r"), "fraction").collect()}


def star(rnd, x, y, reach):
    while True:
        angles = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(rnd.randint(3, 9)))
        if max((b - a) % (2 * math.pi) for a, b in zip([angles[-1], *angles], angles)) < 3:
            break
    ring = [(x + d * math.cos(a), y + d * math.sin(a)) for a in angles for d in [reach * rnd.uniform(0.3, 1)]]
    return ring[::-1] if rnd.random() < 0.5 else ring


@pytest.mark.parametrize("grid", [GRID, Grid(12, 12), Grid(15, 32)])
def test_random_polygons_against_clipping(spark, grid):
    rnd = random.Random(7)
    rings = [star(rnd, 2.85e6 + rnd.uniform(0, 20000), -2.85e6 + rnd.uniform(0, 20000), rnd.choice([10, 40, 300])) for _ in range(80)]
    want = {(i, *cell): share for i, ring in enumerate(rings) for cell, share in fractions(ring, grid).items()}
    got = measured(spark, [(i, 1.0, [ring]) for i, ring in enumerate(rings)], grid)
    assert want.keys() == got.keys()
    assert max(abs(want[k] - got[k]) for k in want) < 1e-8


X, Y = corner(600000, 596000)
SPECIAL = {
    "edges on cell borders": box(X, Y - 2 * C, X + 3 * C, Y),
    "vertex on a corner": [(X, Y), (X + 1.5 * C, Y - 0.5 * C), (X + 0.5 * C, Y - 1.5 * C)],
    "inside one cell": box(X + 3, Y - 9, X + 8, Y - 4),
    "over a tile border": box(X - (600000 % 256) * C - 20, Y - 30, X - (600000 % 256) * C + 20, Y - 10),
    "concave": [(X, Y), (X + 5 * C, Y), (X + 5 * C, Y - 5 * C), (X + 2.3 * C, Y - 0.7 * C), (X, Y - 5 * C)],
    "south of the equator and east of Greenwich": box(5, -60, 70, -3),
    "across both": box(-50, -50, 40, 60),
}


@pytest.mark.parametrize("name", SPECIAL)
def test_special_positions(spark, name):
    ring = SPECIAL[name]
    for turned in (ring, ring[::-1]):
        want, got = fractions(ring), measured(spark, [(1, 1.0, [turned])])
        assert {(1, *c) for c in want} == set(got)
        assert all(got[1, *c] == pytest.approx(share, abs=1e-9) for c, share in want.items())


def test_hole_is_left_out_whatever_its_turn(spark):
    outer, hole = box(X + 5, Y - 400, X + 300, Y - 5), box(X + 60, Y - 300, X + 250, Y - 50)
    shares = [sum(measured(spark, [(1, 1.0, [outer, h])]).values()) for h in (hole, hole[::-1])]
    assert shares[0] == shares[1] == pytest.approx((area(outer) - area(hole)) / C / C, abs=1e-7)


def test_levels_weigh_and_overlaps_add(spark):
    b = box(X + 1, Y - 11, X + 11, Y - 1)
    unknown = box(X + 1 + 5 * C, Y - 11, X + 11 + 5 * C, Y - 1)
    flat = box(X + 1 + 9 * C, Y - 11, X + 11 + 9 * C, Y - 1)
    rows = [(1, 2.0, [b]), (2, 0.5, [b]), (3, None, [unknown]), (4, 0.0, [flat])]
    cells = coverage.footprint_grid(polygons(spark, rows), GRID).withColumn("a", cell_area_m2(GRID, F.col("tile_row"))).collect()
    values = sorted(r.osm / r.a * C * C for r in cells)
    assert values == pytest.approx([0.0, 250.0], abs=1e-5)  # unknown levels leave no cell, level 0 leaves a zero


def test_copies_cancel_exactly_south_of_the_polygon(spark):
    # many copies of one building straddling a row border: nothing may leak into cells further south
    ring = [(X + 3.3, Y - C + 7.7), (X + 9.1, Y - C - 6.1), (X + 1.7, Y - C - 5.3)]
    one = polygons(spark, [(1, 3.7, [ring])])
    many = one.selectExpr("*", "explode(sequence(1, 200000)) AS copy")
    got = {tuple(r[k] for k in CELL_KEY): r.osm for r in coverage.footprint_grid(many, GRID).collect()}
    single = {tuple(r[k] for k in CELL_KEY): r.osm for r in coverage.footprint_grid(one, GRID).collect()}
    assert got.keys() == single.keys() and len(got) == 2
    assert all(got[k] == pytest.approx(200000 * single[k], rel=1e-9) for k in got)


def test_clipping_to_tiles_splits_a_building(spark):
    # a building over four tiles, filed under each: the clipped parts make up the whole
    tx, ty = corner(2343 * 256, 2333 * 256)
    ring = [(tx - 90, ty - 70), (tx + 110, ty - 130), (tx + 60, ty + 140), (tx - 30, ty + 100)]
    whole = polygons(spark, [(1, 1.0, [ring])])
    filed = whole.selectExpr("*", "explode(array(2342L, 2343L)) AS tile_col").selectExpr("*", "explode(array(2332L, 2333L)) AS tile_row")

    def collected(df):
        return {tuple(r[k] for k in CELL_KEY): r.osm for r in df.collect()}

    want = collected(coverage.footprint_grid(whole, GRID))
    assert collected(coverage.footprint_grid(filed, GRID, clip_to_tile=True)) == pytest.approx(want, rel=1e-6, abs=1e-6)
    one = collected(coverage.footprint_grid(filed.where("tile_col = 2343 AND tile_row = 2332"), GRID, clip_to_tile=True))
    assert one == pytest.approx({k: v for k, v in want.items() if k[:2] == (2343, 2332)}, rel=1e-6, abs=1e-6)


def test_mask_keeps_touched_cells_and_is_idempotent(spark):
    rnd = random.Random(3)
    masks = [star(rnd, X + rnd.uniform(0, 3000), Y - rnd.uniform(0, 3000), rnd.choice([15, 200, 900])) for _ in range(12)]
    hole = box(X + 400, Y - 800, X + 800, Y - 400)
    outer = box(X + 200, Y - 1000, X + 1000, Y - 200)
    touched = {c for m in masks for c in fractions(m)} | {c for c, s in fractions(outer).items() if s - fractions(hole).get(c, 0) > 1e-9}
    data = [(c, r, float(c * r % 97)) for c in range(599990, 600110) for r in range(595990, 596110)]
    cells = spark.createDataFrame(data, "gcol long, grow long, pop double").select(*GRID.split(F.col("gcol"), F.col("grow")), "pop")
    areas = polygons(spark, [(i, 1.0, [m]) for i, m in enumerate(masks)] + [(99, 1.0, [outer, hole])])
    kept = coverage.mask_cells(cells, areas, GRID)
    got = {(r.c, r.r): r.pop for r in kept.select(GRID.gcol().alias("c"), GRID.grow().alias("r"), "pop").collect()}
    assert got == {(c, r): v for c, r, v in data if (c, r) in touched}
    assert coverage.mask_cells(kept, areas, GRID).count() == len(got)
    assert coverage.mask_cells(cells, None, GRID) is cells
    copies = areas.selectExpr("*", "explode(sequence(1, IF(building_id = 99, 50000, 1))) AS copy")
    assert coverage.mask_cells(cells, copies, GRID).count() == len(got)  # one hot mask changes nothing


def test_zone_cells_count_once_and_zones_may_overlap(spark):
    zones = polygons(spark, [(0, 1.0, [box(X, Y - 6 * C, X + 4 * C, Y)]), (1, 1.0, [box(X + 2.5 * C, Y - 6 * C, X + 6 * C, Y)])])
    zones = zones.select(F.concat(F.lit("Z"), F.col("building_id")).alias("code"), "rings")
    spans = coverage.zone_spans(zones, GRID)
    assert {r.code: r.n for r in spans.groupBy("code").agg(F.sum(F.expr("row_to - row_from + 1")).alias("n")).collect()} == {"Z0": 24, "Z1": 24}
    data = spark.createDataFrame([(600000 + i, 596001, 1.0) for i in range(-2, 9)], "gcol long, grow long, osm double")
    cells = data.select(*GRID.split(F.col("gcol"), F.col("grow")), "osm")
    by_zone = coverage.cells_by_zone(cells, spans, GRID).groupBy("code").count().collect()
    assert {r.code: r["count"] for r in by_zone} == {"Z0": 4, "Z1": 4}


def test_cell_area_constants():
    # fixed values worked out independently from the four projected corners
    from pyspark.sql import SparkSession

    rows = SparkSession.active().createDataFrame([(2333,), (2048,)], "r long").select(cell_area_m2(GRID, F.col("r"))).collect()
    assert [r[0] for r in rows] == pytest.approx([1207.4063854, 1450.8755217], abs=1e-6)


def test_spoiled_areas(spark):
    """Open rings are closed, whichever side is open; what cannot be mended is an error, never a wrong region."""
    data = [(c, r, 1.0) for c in range(599990, 600030) for r in range(595990, 596030)]
    cells = spark.createDataFrame(data, "gcol long, grow long, pop double").select(*GRID.split(F.col("gcol"), F.col("grow")), "pop")
    square = box(X + 0.5 * C, Y - 9.5 * C, X + 9.5 * C, Y - 0.5 * C)
    for turn in range(4):  # without its closing point another side is missing each time
        ring = [{"x": x, "y": y} for x, y in [*square[turn:], *square[:turn]]]
        area = spark.createDataFrame([(1, 1.0, [ring])], FEATURE)
        assert coverage.mask_cells(cells, area, GRID).count() == 100
        assert coverage.zone_cells(area, GRID, "building_id").count() == 100
        assert coverage.footprint_fraction(area, GRID).count() == 100
    tie = polygons(spark, [(1, 1.0, [[square[0], square[2], square[1], square[3]]])])
    both = polygons(spark, [(i, 1.0, [[a, b, (X + 5 * C, Y - 5 * C)]]) for i, (a, b) in enumerate(((square[1], square[2]), (square[3], square[0])))])
    keys = ("tile_col", "tile_row", "cell_col", "cell_row")
    masked, zoned, shares = ([sorted(map(tuple, f(x).select(*keys).distinct().collect())) for x in (tie, both)] for f in (
        lambda x: coverage.mask_cells(cells, x, GRID), lambda x: coverage.zone_cells(x, GRID, "building_id"), lambda x: coverage.footprint_fraction(x, GRID)))
    assert masked[0] == masked[1] == zoned[0] == zoned[1] == shares[0] == shares[1] and len(masked[0]) < 100  # a bow tie is its two parts
    for points, reason in (([*square[:3], (math.nan, Y)], "no finite"), ([*square[:3], (math.inf, Y)], "no finite"), ([*square[:3], (X, 3e7)], "outside")):
        area = polygons(spark, [(1, 1.0, [points])])
        for spoiled in (coverage.mask_cells(cells, area, GRID), coverage.zone_cells(area, GRID, "building_id"), coverage.touched_tiles(area, GRID)):
            with pytest.raises(Exception, match=f"unusable area, {reason}"):
                spoiled.collect()
        assert coverage.footprint_fraction(area, GRID).isEmpty()


@pytest.mark.parametrize("block_rows", [1, 3, 16, 1000])
def test_walks_in_blocks(spark, block_rows):
    """Columns walked block by block give the cells of one walk, weighted and by key."""
    areas = polygons(spark, [(1, 2.0, [box(X - 3.3 * C, Y - 40.2 * C, X + 7.6 * C, Y + 2.5 * C), box(X, Y - 20.5 * C, X + 3 * C, Y - 9.1 * C)]),
                             (2, 3.0, [[(X + 2 * C, Y - 70.5 * C), (X + 9.5 * C, Y - 31.2 * C), (X - 2.5 * C, Y - 12.7 * C)]]), (3, 1.0, [box(X, Y - 300 * C, X + C, Y - 299 * C)])])

    def rows(df):
        spread_out = df.selectExpr("* EXCEPT (row_from, row_to)", "explode(sequence(row_from, row_to)) AS row")
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in spread_out.collect())

    for keys in ([], ["building_id"]):
        outline = coverage.outline_cells(areas, GRID, keys, weight="levels")
        assert rows(coverage.coverage_spans(outline, GRID, keys, block_rows)) == rows(coverage.coverage_spans(outline, GRID, keys))
    data = [(c, r, float(c + r)) for c in range(599990, 600015) for r in [*range(595990, 596110), 596299, 597000]]
    cells = spark.createDataFrame(data, "gcol long, grow long, pop double").select(*GRID.split(F.col("gcol"), F.col("grow")), "pop")
    one, many = (sorted(map(tuple, coverage.mask_cells(cells, areas, GRID, n).collect())) for n in (coverage.BLOCK_ROWS, block_rows))
    assert one == many and 0 < len(one) < len(data)


def test_deep_grids_are_walked_in_blocks(spark):
    """At zoom 20 a column of the world has 268 million rows; a window holds those of one block."""
    deep = Grid(20, 256)
    c, col, row = deep.cell_size, 150_000_000, 140_000_000
    x, y = corner(col, row, deep)
    areas = polygons(spark, [(1, 1.0, [box(x + 0.5 * c, y - 60_000_000.5 * c, x + 2.5 * c, y - 0.5 * c)])])
    spots = [(col + k, row + r) for k in range(-1, 4) for r in (-5, 0, 1, 7_000_000, 33_333_333, 60_000_000, 60_000_001)]
    cells = spark.createDataFrame([(a, b, 1.0) for a, b in spots], "gcol long, grow long, pop double").select(*deep.split(F.col("gcol"), F.col("grow")), "pop")
    masked = coverage.mask_cells(cells, areas, deep)
    assert masked.count() == sum(0 <= a - col <= 2 and 0 <= b - row <= 60_000_000 for a, b in spots)
    plan = masked._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_gcol#" in plan and re.search(r"windowspecdefinition\(_gcol#\d+L, _block#\d+L, _grow", plan)
    spans = coverage.zone_spans(areas.withColumnRenamed("building_id", "code"), deep).agg(F.sum("row_to") - F.sum("row_from") + F.count("*")).first()[0]
    assert spans == 3 * 60_000_001


def test_touch_share_follows_the_grid():
    assert [coverage.touch_share(Grid(z, p)) * 2 ** snap_bits(Grid(z, p)) for z, p in ((12, 256), (12, 4), (20, 256), (0, 1))] == [4.0] * 4
