import math

import pytest
from pyspark.sql import functions as F

from gridfill.functions.grid import CELL_KEY, DegreeGrid, Grid
from gridfill.operators import cells as C
from gridfill.sources import layers, pixels

GRID = Grid()


@pytest.fixture(scope="module")
def people(spark):
    return spark.range(3000).selectExpr("25.5 + (id * 7919 % 10000) / 10000D AS lon", "-25 + (id * 104729 % 10007) / 10007D AS lat",
                                        "double(id % 50) AS value")


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_population_is_conserved(people):
    want = total(people, "value")
    fine = C.pop_grid(people, GRID)
    assert total(fine, "pop") == want
    assert total(C.resample_sum(fine, GRID, 16, ["pop"]), "pop") == want
    levels = C.pyramid_sum(fine, GRID, ["pop"]).groupBy("zoom").agg(F.sum("pop").alias("pop")).collect()
    assert {r.zoom: r.pop for r in levels} == {z: want for z in range(13)}


def test_summing_straight_to_coarse_cells_is_the_same(people):
    direct = C.pop_grid(people, GRID.with_px(16))
    stepwise = C.resample_sum(C.pop_grid(people, GRID), GRID, 16, ["pop"])
    assert direct.exceptAll(stepwise).isEmpty() and stepwise.exceptAll(direct).isEmpty()


def test_resample_needs_a_divisor(people):
    with pytest.raises(ValueError):
        C.resample_sum(C.pop_grid(people, GRID), GRID, 10, ["pop"])


def test_other_methods(people):
    cells = C.pop_grid(people, GRID)
    largest = C.resample(cells, GRID, 1, ["pop"], method=F.max).agg(F.max("pop")).first()[0]
    assert largest == cells.agg(F.max("pop")).first()[0]


def test_assemble_and_explode_are_inverse(people):
    grid = GRID.with_px(8)
    cells = C.pop_grid(people, grid).withColumn("osm", F.when(F.col("cell_col") % 2 == 0, F.col("pop") + 1))
    tiles = C.assemble_tiles(cells, grid, ["pop", "osm"])
    assert tiles.where("size(pop) <> 64 OR size(osm) <> 64").isEmpty()
    back = C.explode_tiles(tiles, grid).where("pop IS NOT NULL")
    assert back.exceptAll(cells.select(*back.columns)).isEmpty() and back.count() == cells.count()
    assert C.explode_tiles(tiles, grid, require=["pop", "osm"]).count() == cells.where("osm IS NOT NULL").count()


def test_nodata_is_null_not_nan(spark):
    raw = spark.createDataFrame([(25.6, -24.1, 3.0), (25.6, -24.1, math.nan), (25.6, -24.1, -99999.0), (26.9, -24.1, math.nan)],
                                "lon double, lat double, value double")
    assert [r.value for r in pixels.normalize_nodata(raw, sentinel=-99999.0).collect()] == [3.0, None, None, None]
    assert [r.pop for r in C.pop_grid(pixels.normalize_nodata(raw, sentinel=-99999.0)).collect()] == [3.0]
    tiles = pixels.raster_tiles(raw).collect()
    assert len(tiles) == 1 and (tiles[0].n_pixels, tiles[0].n_data) == (3, 2)


def test_halo_copies_border_pixels(spark):
    grid = DegreeGrid()
    pixel = [256 * 960 + 1, 256 * 530 + 200]  # one column inside the western border of its tile
    lon, lat = (pixel[0] + 0.5) * grid.cell - 180, 90 - (pixel[1] + 0.5) * grid.cell
    got = pixels.raster_halo_tiles(spark.createDataFrame([(lon, lat, 1.0)], "lon double, lat double, value double"))
    assert {(r.tile_col, r.pixel_col, r.pixel_row, r.is_center) for r in got.collect()} == {(960, 4, 203, True), (959, 260, 203, False)}


def test_histogram_counts_everything(people):
    cells = C.pop_grid(people, GRID)
    bars = C.cell_histogram(cells, "pop").collect()
    assert sum(b.cells for b in bars) == cells.count() and max(b.bucket for b in bars) == 99
    assert C.approx_histogram(cells, "pop").agg(F.sum("y")).first()[0] == cells.count()


def test_layer_round_trip(spark, people, tmp_path):
    cells = C.pop_grid(people, GRID.with_px(16)).withColumn("osm", F.when(F.col("cell_row") < 8, F.lit(2.0)))
    path = str(tmp_path / "layer")
    layers.write_layer(cells, path, ["pop", "osm"], GRID.with_px(16), min_zoom=10)
    band = layers.read_band(spark, path, 0, "pop")
    assert band.exceptAll(cells.select(*CELL_KEY, "pop")).isEmpty() and band.count() == cells.count()
    assert layers.read_band(spark, path, 1, "osm").count() == cells.where("osm IS NOT NULL").count()
    assert total(layers.read_band(spark, path, 0, "pop", zoom=10), "pop") == total(cells, "pop")
    scan = band._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(zoom" in scan and "PushedFilters: [IsNotNull(band), EqualTo(band,0)]" in scan


def test_pyramid_is_replaced_as_a_whole(spark, people, tmp_path, monkeypatch):
    cells, path = C.pop_grid(people, GRID.with_px(4)), str(tmp_path / "pyramid")
    with pytest.raises(LookupError):
        layers.read_pyramid(spark, path)

    def totals():
        rows = layers.read_pyramid(spark, path).groupBy("zoom").agg(F.sum("pop").alias("pop")).collect()
        return {r.zoom: r.pop for r in rows}

    layers.write_pyramid(cells, path, "pop", GRID.with_px(4))
    first, bars = totals(), sorted(map(tuple, layers.read_histogram(spark, path).collect()))
    assert set(first) == set(range(13)) and len({round(v, 3) for v in first.values()}) == 1
    write = layers._write_level

    def breaks(level, target, order):
        if target.endswith("zoom=6"):
            raise OSError("disk gone")
        write(level, target, order)

    monkeypatch.setattr(layers, "_write_level", breaks)
    with pytest.raises(OSError):
        layers.write_pyramid(cells.withColumn("pop", F.col("pop") * 2), path, "pop", GRID.with_px(4))
    assert totals() == first and sorted(map(tuple, layers.read_histogram(spark, path).collect())) == bars  # old levels only
    monkeypatch.setattr(layers, "_write_level", write)
    layers.write_pyramid(cells.withColumn("pop", F.col("pop") * 2), path, "pop", GRID.with_px(4))
    assert totals() == pytest.approx({z: 2 * v for z, v in first.items()})
    assert layers.drop_old_versions(spark, path) == 2 and totals() == pytest.approx({z: 2 * v for z, v in first.items()})
