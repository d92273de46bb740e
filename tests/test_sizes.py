"""Work that grows with the tables is dealt out to all tasks and done once. Every test builds its own tables."""

import pytest
from pyspark.sql import functions as F

from checks import fixtures, queries
from gridfill.functions.grid import Grid
from gridfill.operators.coverage import in_tiles
from gridfill.plans import changes
from gridfill.sources import features as feats

PART, ORDERS = "p_partkey bigint, p_size int", "o_orderkey bigint, o_totalprice double"
GRID = Grid()


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture()
def tables(spark, tmp_path):
    """Parts and orders in one small file each, as few bytes per row make them."""
    spark.createDataFrame([(k, k % 50 + 1) for k in range(1, 401)], PART).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(k, 100.0 + k) for k in range(1, 401)], ORDERS).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def rows_by_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]


def test_polygons_of_one_small_file_are_mended_by_all_tasks(spark, tables):
    mended = rows_by_task(feats.check_polygons(fixtures.features(spark, tables)))
    assert sum(mended) >= 400 and len(mended) == 4 and max(mended) < 200


def test_labelled_areas_of_one_small_file_are_spread(spark, tmp_path):
    spark.createDataFrame([(k,) for k in range(1, 401)], "s_suppkey bigint").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    assert len(rows_by_task(fixtures.training_lines(spark, str(tmp_path)))) == 4


def test_rows_without_a_key_are_spread_too(spark, tmp_path):
    spark.createDataFrame([(None, 1)] * 400, PART).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert len(rows_by_task(fixtures.features(spark, str(tmp_path)))) == 4


def test_cells_that_are_fitted_and_predicted_are_made_once(spark, tables):
    spark.createDataFrame([(k,) for k in range(25)], "n_nationkey bigint").write.parquet(f"{tables}/nation.parquet")
    totals = queries.tile_totals(spark, tables)
    assert "o_orderkey" not in plan(totals) and "rings" not in plan(totals)
    assert totals.agg(F.sum("population")).first()[0] == pytest.approx(sum(100.0 + k for k in range(1, 401)))


def test_no_task_holds_the_cells_of_all_polygons(spark, tables):
    """The rows that the first sums of a task take in, outline by outline, come from a share of the polygons."""
    cells = feats.valid_polygons(feats.polygon_only(fixtures.features(spark, tables))).select("building_id", F.explode("rings"))
    assert max(rows_by_task(cells)) < cells.count() / 2


def test_neighbours_are_sought_among_points_of_all_tasks(spark, tables):
    from gridfill.operators import density
    points = rows_by_task(density.building_points(feats.building_polygons(fixtures.features(spark, tables)), GRID.with_px(16)))
    assert len(points) == 4 and max(points) < sum(points) / 2


def test_buildings_are_cut_to_tiles_before_they_are_mended(spark):
    """Also where rings are open or missing, points missing, or coordinates hopeless: those can't be mended and touch nothing."""
    x, y = 2872000.0, -2826000.0
    box = [(x, y), (x + 9, y), (x + 9, y + 9), (x, y + 9), (x, y)]
    far = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 0.0)]
    rows = [("box", [box]), ("open", [box[:4]]), ("second", [None, box]), ("gap", [[box[0], (None, None), *box[1:]]]), ("crossed", [[box[0], box[2], box[1], box[3], box[0]]]),
            ("far", [far]), ("endless", [[(float("inf"), y), *box[1:]]]), ("nan", [[*box[:3], (float("nan"), y), box[0]]]),
            ("beyond", [[(p[0] * 1e200, p[1]) for p in box]]), ("no points", [[]]), ("no rings", []), ("null", None)]
    schema = "name string, rings array<array<struct<x: double, y: double>>>"
    features, tiles = spark.createDataFrame(rows, schema), spark.createDataFrame([("t", [box])], schema)
    tiles = tiles.select(GRID.tile_col(F.lit(x)).alias("tile_col"), GRID.tile_row(F.lit(y + 9)).alias("tile_row"))

    def names(df):
        return sorted({r["name"] for r in df.collect()})

    kept = in_tiles(features, tiles, GRID)
    assert names(kept) == ["box", "crossed", "gap", "open", "second"]
    assert names(feats.valid_polygons(kept)) == names(in_tiles(feats.valid_polygons(features), tiles, GRID))


def test_a_renewed_report_mends_the_buildings_once(spark, tables):
    features = fixtures.features(spark, tables)
    stored = spark.createDataFrame([], "tile_col bigint, tile_row bigint, index double, pop_sum double, osm_sum double, osm_avg double, prediction_sum double, prediction_avg double")
    pop = queries._pop(spark, tables, queries.LABELED)
    new = plan(changes.updated_report(stored, pop, fixtures.features(spark, tables, "old"), features, 0.5))
    tiles = plan(changes.changed_tiles(fixtures.features(spark, tables, "old"), features))
    read = new.count("Join LeftSemi")  # the tiles of changes are one part of the plan, read at several places
    mended, by_tiles = new.count("_parts#"), tiles.count("_parts#")
    assert read and mended and by_tiles
    whole = [line for line in new.splitlines() if "Generate inline" in line and "_parts" in line]
    assert len(whole) == 1 + 4 * len([line for line in tiles.splitlines() if "Generate inline" in line and "_parts" in line])


@pytest.mark.parametrize("n", [4, 5, 16, 17, 18, 40])
def test_a_ring_meets_itself_where_plain_python_says_with_runs_or_without(spark, n):
    """Stars of n points, whose crossings are counted pair by pair."""
    import math
    corners = [(math.cos(2 * math.pi * 2 * i / n) * (1 + i / 100), math.sin(2 * math.pi * 2 * i / n) * (1 + i / 100)) for i in range(n)]
    ring = [*corners, corners[0]]
    side = lambda s, t, p: (t[0] - s[0]) * (p[1] - s[1]) - (t[1] - s[1]) * (p[0] - s[0])
    edges = list(zip(ring, ring[1:]))
    want = [(i, j) for i in range(n) for j in range(i + 2, n) if (i > 0 or j < n - 1) and side(*edges[i], edges[j][0]) * side(*edges[i], edges[j][1]) <= 0
            and side(*edges[j], edges[i][0]) * side(*edges[j], edges[i][1]) <= 0]
    from gridfill.functions.shapes import meetings_sql
    got = spark.createDataFrame([(ring,)], "ring array<struct<x: double, y: double>>").selectExpr(f"{meetings_sql('ring')} AS m").first()["m"]
    assert sorted((m["s"]["i"], m["t"]["i"]) for m in got) == want
