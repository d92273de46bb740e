import json
import math
import random

import pytest
from pyspark.sql import functions as F

from gridfill.functions.shapes import polygon_moments
from gridfill.sources import features, zones
from tests.shapes import FEATURE, box, closed


def test_levels(spark):
    tags = [None, "2", " 4 ", "2.5", "2;3", "NaN", "Infinity", "-Infinity", "", "0"]
    rows = [(i, {"building": "yes", **({"building:levels": t} if t is not None else {})}) for i, t in enumerate(tags)]
    got = features.with_levels(spark.createDataFrame(rows, "i int, tags map<string,string>")).orderBy("i").collect()
    assert [r.levels for r in got] == [1.0, 2.0, 4.0, 2.5, None, None, None, None, None, 0.0]


def circle(n, wobble=0.0):
    return [(1e6 + (100 + wobble * (i % 2)) * math.cos(2 * math.pi * i / n), 2e6 + 100 * math.sin(2 * math.pi * i / n)) for i in range(n)]


def test_defects(spark):
    b, crossed = box(0, 0, 10, 10), circle(400)
    crossed[120], crossed[300] = crossed[300], crossed[120]
    eight = [(0, 0), (10, 10), (10, 0), (0, 6)]
    near = circle(400)
    near[200], near[202] = near[202], near[200]
    rings = {
        "fine": [closed(b)], "fine and round": [closed(circle(500, 1.0))], "none": None, "empty": [],
        "few": [closed(b)[:2] + closed(b)[:1]], "open": [closed(b)[:-1]], "flat": [closed([(0, 0), (5, 5), (9, 9)])],
        "eight": [closed(eight)], "long crossed": [closed(crossed)], "long crossed nearby": [closed(near)],
        "crossed hole": [closed(box(-20, -20, 40, 40)), closed(eight)], "empty hole": [closed(box(-20, -20, 40, 40)), closed(b)[:2]],
        "twice": [[p for p in closed(b) for _ in "ab"]], "no number": [closed([*b[:3], (math.nan, 1)])], "endless": [closed([*b[:3], (math.inf, 1)])],
        "far": [closed([*b[:3], (3e7, 1)])]}
    df = spark.createDataFrame([(k, v) for k, v in rings.items()], FEATURE.replace("building_id long, levels double", "name string"))
    got = {r.name: r.defect for r in features.check_polygons(df).collect()}
    assert got == {
        "fine": None, "fine and round": None, "none": "empty", "empty": "empty", "few": "ring of fewer than 4 points", "open": None,
        "flat": "no area", "eight": None, "long crossed": None, "long crossed nearby": None,
        "crossed hole": None, "empty hole": None, "twice": None, "no number": "no finite coordinates", "endless": "no finite coordinates", "far": "outside the world"}
    parts = features.valid_polygons(df).select("name", polygon_moments("rings")["area"].alias("area")).groupBy("name").agg(F.sum("area").alias("area"), F.count("*").alias("n"))
    got = {r.name: (r.area, r.n) for r in parts.collect()}
    want = {"fine": 100, "open": 100, "crossed hole": 3600, "empty hole": 3600, "twice": 100, "eight": enclosed(eight), "fine and round": enclosed(circle(500, 1.0)),
            "long crossed": enclosed(crossed), "long crossed nearby": enclosed(near)}
    assert {k: a for k, (a, _) in got.items()} == pytest.approx(want)
    assert {k for k, (_, n) in got.items() if n > 1} == {"eight", "long crossed", "long crossed nearby"}
    assert features.rejected_polygons(df).count() == len(rings) - len(want)


def turns(ring, x, y):
    """How often a ring runs around a point."""
    n = 0
    for a, b in zip(ring, [*ring[1:], ring[0]]):
        if (a[1] > y) != (b[1] > y) and x < a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]):
            n += 1 if b[1] > a[1] else -1
    return n


def enclosed(ring):
    """The area that a ring runs around, in strips between all ends and crossings: none of its edges meet inside a strip."""
    edges = [(a, b) for a, b in zip(ring, [*ring[1:], ring[0]]) if a[0] != b[0]]
    xs = {p[0] for p in ring}
    for i, (a, b) in enumerate(edges):
        for c, d in edges[:i]:
            s, t = (b[1] - a[1]) / (b[0] - a[0]), (d[1] - c[1]) / (d[0] - c[0])
            if s != t:
                xs.add((c[1] - a[1] + s * a[0] - t * c[0]) / (s - t))
    xs, area = sorted(xs), 0.0
    for x0, x1 in zip(xs, xs[1:]):
        mid, inside, low = (x0 + x1) / 2, 0, None
        spanning = sorted((a[1] + (mid - a[0]) * (b[1] - a[1]) / (b[0] - a[0]), 1 if a[0] < b[0] else -1) for a, b in edges if min(a[0], b[0]) < mid < max(a[0], b[0]))
        for y, turn in spanning:
            if inside == 0:
                low = y
            inside += turn
            if inside == 0:
                area += (y - low) * (x1 - x0)
    return area


def test_crossing_outlines_are_split(spark):
    """Whatever an outline runs around counts, as parts that neither cross nor overlap."""
    pick = random.Random(5)
    outlines = {i: [(pick.uniform(0, 100), pick.uniform(0, 100)) for _ in range(pick.randrange(4, 14))] for i in range(120)}
    outlines |= {200: [(0, 0), (10, 10), (10, 0), (0, 10)], 201: [(0, 0), (5, 5), (10, 10), (10, 0), (5, 5), (0, 10)],  # a bow tie; its knot as a point
                 202: [(0, 0), (10, 0), (10, 10), (2, 10), (2, 4), (6, 4), (6, 12), (0, 12)],  # runs around one region twice
                 203: [(0, 0), (10, 0), (10, 10), (5, 10), (5, 5), (3, 5), (3, 8), (7, 8), (7, 12), (0, 12)],  # and here around a hole
                 204: [(0, 0), (10, 0), (5, 0), (5, 8)], 205: [(0, 0), (8, 0), (8, 8), (4, 0), (0, 8)],  # touching only
                 206: [*[(100 * math.cos(6.283 * i / 300), 100 * math.sin(6.283 * i / 300)) for i in range(300)]]}
    outlines[206][80], outlines[206][200] = outlines[206][200], outlines[206][80]
    df = spark.createDataFrame([(k, float(k), [closed(v)]) for k, v in outlines.items()], FEATURE)
    parts = {}
    for r in features.valid_polygons(df).select("*", polygon_moments("rings")["area"].alias("area")).collect():
        assert r.levels == r.building_id  # parts keep the building's other columns
        parts.setdefault(r.building_id, []).append(([[tuple(p) for p in ring[:-1]] for ring in r.rings], r.area))
    for k, ring in outlines.items():
        assert sum(a for _, a in parts[k]) == pytest.approx(enclosed(ring), rel=1e-9, abs=1e-9), k
        for _ in range(40):
            x, y = pick.uniform(-5, 105), pick.uniform(-5, 105)
            held = sum(turns(rings[0], x, y) != 0 and not any(turns(h, x, y) for h in rings[1:]) for rings, _ in parts[k])
            assert held == (turns(ring, x, y) != 0), (k, x, y)
    assert len(parts[200]) == len(parts[201]) == 2 and len(parts[202]) == 1
    assert 2 in [len(rings) for rings, _ in parts[203]]
    again = spark.createDataFrame([(1, 1.0, [closed(r) for r in rings]) for p in parts.values() for rings, _ in p], FEATURE)
    assert features.valid_polygons(again).count() >= again.count()


def test_holes_of_split_outlines(spark):
    tie = [(0, 0), (100, 100), (100, 0), (0, 100)]
    left, right, across, outside = box(10, 45, 20, 55), box(80, 45, 90, 55), box(20, 40, 80, 60), box(45, 5, 55, 10)
    df = spark.createDataFrame([(1, 1.0, [closed(tie), *[closed(h) for h in (left, right, across, outside)]])], FEATURE)
    got = features.valid_polygons(df).select(F.size("rings").alias("n"), polygon_moments("rings")["area"].alias("area")).collect()
    assert sorted((r.n, round(r.area, 6)) for r in got) == [(2, 2400.0), (2, 2400.0)]  # a hole across both parts, or in none, is left out


def test_moments_with_hole(spark):
    rings = [closed(box(10, 10, 14, 14)), closed(box(11, 11, 12, 12)[::-1])]
    row = spark.createDataFrame([(1, 1.0, rings)], FEATURE).select(polygon_moments("rings").alias("m")).first().m
    assert (row.area, row.x, row.y) == pytest.approx((15, (16 * 12 - 11.5) / 15, (16 * 12 - 11.5) / 15))


def test_fetching_a_tile_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "tiles")
    spark.createDataFrame([(12, 2343, 4095 - 2333, 7), (12, 2343, 2333, 8), (11, 2343, 4095 - 2333, 9)],
                          "zoom_level int, tile_column int, tile_row int, building_id long").write.parquet(path)
    tiles = spark.read.parquet(path)
    fetched = features.tile_fetch(tiles, 12, 2343, 2333)
    assert [r.building_id for r in fetched.collect()] == [7]
    plan = fetched._jdf.queryExecution().executedPlan().toString()
    assert all(f"EqualTo({c}" in plan for c in ("zoom_level", "tile_column", "tile_row"))
    assert features.tile_fetch(tiles, 12, 1, 1).isEmpty()
    assert {(r.tile_row, r.building_id) for r in features.tile_scan(tiles).collect()} == {(2333, 7), (1762, 8)}


@pytest.fixture(scope="module")
def countries(spark):
    ring = [closed(box(0, 0, 1, 1))]
    return spark.createDataFrame([("BBB", "Great Land", ring), ("AAA", "great land", ring), ("CCC", "Else", ring)],
                                 "code string, name string, " + FEATURE.split(", ", 2)[2])


def test_country_lookup(countries):
    assert [r.code for r in zones.country_lookup(countries, "BBB").collect()] == ["BBB"]
    assert [r.code for r in zones.country_lookup(countries, "Great_Land").collect()] == ["AAA"]  # first by code
    assert zones.country_lookup(countries, "bbb").isEmpty()
    assert zones.require_country(countries, "else").count() == 1
    with pytest.raises(LookupError):
        zones.require_country(countries, "nowhere")


def test_training_files(spark, tmp_path):
    ring = [[0.0, 0.0], [9.0, 0.0], [9.0, 9.0], [0.0, 0.0]]
    geometries = [("MultiPolygon", [[ring, ring], [ring]]), ("MultiPolygon", []), ("Polygon", [ring]), ("Point", [1.0, 2.0]), ("MultiPolygon", [[ring]])]
    items = [{"type": "Feature", "properties": {}, "geometry": {"type": t, "coordinates": c}} for t, c in geometries]
    (tmp_path / "areas.json").write_text(json.dumps({"type": "FeatureCollection", "features": items}, indent=1))
    for name in ("areas.geojsonl", "areas.ndjson", "final"):
        (tmp_path / name).mkdir() if name == "final" else (tmp_path / name).write_text("\n".join(json.dumps(i) for i in items))
    (tmp_path / "final" / "part").write_text((tmp_path / "areas.json").read_text())
    (tmp_path / "wrong.json").write_text('{"type": "Topology", "objects": {}}')
    with pytest.raises(Exception, match="neither a GeoJSON"):
        zones.read_training_polygons(spark, str(tmp_path / "wrong.json")).collect()
    for name in ("areas.json", "areas.geojsonl", "areas.ndjson", "final"):
        got = zones.read_training_polygons(spark, str(tmp_path / name)).collect()
        assert sorted((r.part, len(r.rings)) for r in got) == [(0, 1), (0, 2), (1, 1)]
        assert got[0].rings[0][1] == (9.0, 0.0)
