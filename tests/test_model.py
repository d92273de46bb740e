import json
import math

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from gridfill.functions.grid import Grid
from gridfill.operators import cells as layers
from gridfill.operators import coverage, regression, report, zonal
from gridfill.plans import changes
from gridfill.plans import coverage_model as plans
from gridfill.sources import features, zones

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def cells(spark):
    rows = [(1, 1, i % 4, i // 4, None if i == 3 else 10.0 * i, None if i % 5 == 0 else 65.0 * i + (-1) ** i) for i in range(16)]
    return spark.createDataFrame(rows, "tile_col long, tile_row long, cell_col long, cell_row long, pop double, osm double")


def test_sums_equal_ml(cells):
    fit, ml = regression.fit_through_origin(cells).first(), regression.fit_ml(cells)
    assert ml.intercept == 0.0
    assert fit.coefficient == pytest.approx(ml.coefficients[0], rel=1e-9)
    assert fit.rmse == pytest.approx(ml.summary.rootMeanSquaredError, rel=1e-7)
    assert fit.r2 == pytest.approx(ml.summary.r2, rel=1e-9)
    assert fit.n == ml.summary.numInstances
    quality = regression.fit_quality(regression.predict_footprint(cells, regression.fit_through_origin(cells))).first()
    assert (quality.rmse, quality.r2) == pytest.approx((fit.rmse, fit.r2))


def test_prediction_forms_agree(cells):
    ml = regression.predict_ml(cells, regression.fit_ml(cells)).orderBy("cell_row", "cell_col").collect()
    sums = regression.predict_footprint(cells, regression.fit_through_origin(cells)).orderBy("cell_row", "cell_col").collect()
    known = [i for i in range(16) if i != 3]
    assert [ml[i].prediction for i in known] == pytest.approx([sums[i].prediction for i in known])
    assert [r.prediction is None for r in ml] == [r.prediction is None for r in sums] == [i == 3 for i in range(16)]


def test_models_per_group(cells):
    grouped = cells.withColumn("country", F.when(F.col("cell_col") < 2, "A").otherwise("B"))
    models = regression.fit_through_origin(grouped, ["country"])
    scored = regression.predict_footprint(grouped, models, ["country"])
    coefficient = {r.country: r.coefficient for r in models.collect()}
    assert all(r.prediction == coefficient[r.country] * r.pop for r in scored.where("pop IS NOT NULL").collect())


def test_save_and_load(cells, tmp_path):
    model, path = regression.fit_ml(cells), str(tmp_path / "model")
    regression.save_model(model, path)
    with pytest.raises(Exception, match="(?i)already exists"):
        regression.save_model(model, path)
    regression.save_model(model, path, overwrite=True)
    assert regression.load_model(path).coefficients == model.coefficients


def completeness(spark, rows, model):
    cells = spark.createDataFrame(rows, "tile_col long, tile_row long, cell_col long, cell_row long, pop double, osm double")
    return report.completeness_index(zonal.tile_stats(regression.predict_footprint(cells, model)))


def test_index_edge_cases(spark):
    rows = [(1, 1, 0, 0, 10.0, None), (2, 1, 0, 0, 10.0, 130.0), (2, 1, 1, 0, 10.0, None), (3, 1, 0, 0, None, None)]
    got = {r.tile_col: r for r in completeness(spark, rows, 6.5).collect()}
    assert (got[1]["index"], got[1].osm_sum, got[1].osm_avg, got[1].prediction_avg) == (-1.0, 0.0, None, 65.0)
    assert (got[2]["index"], got[2].osm_avg, got[2].prediction_sum, got[2].prediction_avg) == (0.0, 130.0, 130.0, 65.0)
    assert (got[3]["index"], got[3].pop_sum, got[3].osm_sum, got[3].prediction_avg) == (None, None, 0.0, None)
    assert all(r["index"] is None for r in completeness(spark, rows, 0.0).collect())


def test_written_report(spark, tmp_path):
    rows = [(2337, 2337, 0, 0, 10.0, 130.0), (2338, 2337, 0, 0, 10.0, None)]
    report.write_report(completeness(spark, rows, 6.5), str(tmp_path / "report"))
    records = {}
    for r in spark.read.text(str(tmp_path / "report")).collect():
        records.update(json.loads(r.value))
    assert records == {
        "12/2337/2337": {"index": 1.0, "actual": {"pop_sum": 10.0, "osm_sum": 130.0, "osm_avg": 130.0}, "prediction": {"osm_sum": 65.0, "osm_avg": 65.0}},
        "12/2338/2337": {"index": -1.0, "actual": {"pop_sum": 10.0, "osm_sum": 0.0, "osm_avg": None}, "prediction": {"osm_sum": 65.0, "osm_avg": 65.0}}}


def test_tiles_without_population_are_not_reported(spark):
    pixels = spark.createDataFrame([(25.51, -24.01, 5.0), (26.4, -24.9, math.nan)], "lon double, lat double, value double")
    report_tiles = plans.predict_labeled(pixels, fixtures.features(spark, SF), 6.5).collect()
    assert [(r.tile_col, r.tile_row) for r in report_tiles] == [(2338, 2329)]


def test_saved_model_predicts_like_its_coefficient(spark, tmp_path):
    pixels, buildings = fixtures.pixels(spark, SF), fixtures.features(spark, SF)
    cells = plans.analysis_cells(pixels, buildings, 4)
    model = regression.fit_ml(cells)
    regression.save_model(model, str(tmp_path / "m"))
    loaded = regression.load_model(str(tmp_path / "m"))
    by_ml = report.completeness_index(zonal.tile_stats(regression.predict_ml(cells, loaded)))
    by_number = plans.predict_labeled(pixels, buildings, float(model.coefficients[0]))
    got, want = ({(r.tile_col, r.tile_row): r.prediction_sum for r in d.collect()} for d in (by_ml, by_number))
    assert got == pytest.approx(want)


def test_masked_training_can_leave_buildings_out_too(spark):
    pixels, buildings = fixtures.pixels(spark, SF), fixtures.features(spark, SF)
    masks = zones.training_polygons(fixtures.training_lines(spark, SF))
    loose, strict = (plans.analysis_cells(pixels, buildings, 4, masks=masks, mask_both=m).agg(F.sum("pop"), F.sum("osm")).first() for m in (False, True))
    assert loose[0] == strict[0] and (strict[1] or 0) <= (loose[1] or 0)
    assert features.building_polygons(buildings).count() > 0


def test_clipping_to_a_zone(spark):
    zone = zones.zones_to_mercator(zones.require_country(fixtures.zones(spark, SF), "nation_12"))
    pixels, buildings = fixtures.pixels(spark, SF), fixtures.features(spark, SF)
    inside = pixels.where("lon > 25.9 AND lon < 26.1 AND lat > -24.6 AND lat < -24.4").agg(F.sum("value")).first()[0]
    clipped, whole = (plans.analysis_cells(pixels, buildings, 4, clip_zone=z).agg(F.sum("pop"), F.count("pop")).first() for z in (zone, None))
    assert inside * (1 - 1e-9) <= clipped[0] < 1.1 * inside and clipped[1] < whole[1]


@pytest.mark.parametrize("px", [256, 64, 16, 4])
def test_whole_footprint_tiles_are_reported(spark, px):
    """Buildings count in every population tile, also where a cell holds no population, on any grid."""
    pixels, buildings = fixtures.pixels(spark, SF).where("lon < 25.8"), fixtures.features(spark, SF)
    tiles = layers.pop_grid(pixels, Grid(12, 1)).select("tile_col", "tile_row")
    mapped = coverage.footprint_grid(features.building_polygons(buildings), Grid(12, px))
    want = mapped.join(tiles, ["tile_col", "tile_row"], "left_semi").agg(F.sum("osm")).first()[0]
    got = plans.predict_labeled(pixels, buildings, 6.5, px=px).agg(F.sum("osm_sum")).first()[0]
    joined = plans.analysis_cells(pixels, buildings, px).agg(F.sum("osm"), F.sum(F.when(F.col("pop").isNull(), F.col("osm")))).first()
    assert want > 0 and got == pytest.approx(want) and joined[0] == pytest.approx(want) and (px == 4 or joined[1] > 0)


def test_masked_population_is_pruned_before_its_first_shuffle(spark):
    masks = zones.training_polygons(fixtures.training_lines(spark, SF))
    masked = plans.analysis_layers(fixtures.pixels(spark, SF), fixtures.features(spark, SF), 4, masks=masks)[0]
    plan = masked._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan[plan.index("Aggregate"):] and "scalar-subquery" in plan


def test_training_without_cells_is_an_error(spark):
    nowhere = fixtures.pixels(spark, SF).where("value < 0")
    with pytest.raises(Exception, match="no cell to train on"):
        plans.train_unlabeled(nowhere, fixtures.features(spark, SF)).collect()


def test_pixels_outside_the_world_count_nowhere(spark):
    rows = [(0.0, 90.0, 1.0), (0.0, -90.0, 1.0), (0.0, 86.0, 1.0), (180.0, 10.0, 2.0), (-180.0, 10.0, 4.0), (181.0, 0.0, 1.0), (None, 0.0, 1.0)]
    got = layers.pop_grid(spark.createDataFrame(rows, "lon double, lat double, value double"), Grid(12, 1)).collect()
    assert sorted((r.tile_col, r["pop"]) for r in got) == [(0, 4.0), (4095, 2.0)]


def test_a_loaded_model_predicts_in_the_plan(spark, tmp_path):
    pixels, buildings = fixtures.pixels(spark, SF), fixtures.features(spark, SF)
    model = regression.fit_ml(plans.analysis_cells(pixels, buildings, 4))
    regression.save_model(model, str(tmp_path / "m"))
    got, want = (plans.predict_labeled(pixels, buildings, m).agg(F.sum("prediction_sum")).first()[0]
                 for m in (regression.load_model(str(tmp_path / "m")), float(model.coefficients[0])))
    assert got == pytest.approx(want) and got > 0


def test_close_fits_keep_their_digits(spark):
    """Residuals of 1e-8 beside sums of squares of 1e12 and more."""
    x = [1e5 + i for i in range(200)]
    y = [6.5 * v + (1e-8 if i % 2 else -1e-8) for i, v in enumerate(x)]
    cells = spark.createDataFrame([(i % 3 or None, a, b) for i, (a, b) in enumerate(zip(x, y, strict=True))], "country int, pop double, osm double")
    slope = math.fsum(a * b for a, b in zip(x, y, strict=True)) / math.fsum(a * a for a in x)
    want = math.sqrt(math.fsum((b - slope * a) ** 2 for a, b in zip(x, y, strict=True)) / len(x))
    fit = regression.fit_through_origin(cells).first()
    assert fit.rmse == pytest.approx(want, rel=0.1, abs=2e-10) and fit.n == 200 and fit.r2 == 1.0
    assert sorted(r.n for r in regression.fit_through_origin(cells, ["country"]).collect()) == [66, 67, 67]
    assert regression.fit_through_origin(cells.limit(0)).first().n == 0


def test_report_is_renewed_by_changed_tiles(spark, tmp_path):
    """A stored report brought up to date equals one computed anew, and only tiles of changed buildings are touched."""
    old, new, grid = fixtures.features(spark, SF, "old"), fixtures.features(spark, SF), Grid().with_px(4)
    moved = new.where("building_id <> 20").unionByName(new.where("building_id = 20").withColumn("tags", F.expr("map('building', 'yes', 'building:levels', '9')")))
    people, path = fixtures.pixels(spark, SF), str(tmp_path / "report")
    pop = layers.pop_grid(people, grid)
    changes.write_report_version(plans.predict_labeled(people, old, 6.5), path)
    assert changes.changed_features(new, new.withColumn("building_id", F.col("building_id") + 1)).isEmpty()
    twice = new.unionByName(new.where("building_id = 1"))
    assert changes.changed_features(new, twice).count() == 1  # a copy more is a change

    def rows(df):
        return sorted((r.tile_col, r.tile_row, *[None if v is None else round(v, 4) for v in (r["index"], r.pop_sum, r.osm_sum, r.prediction_sum)]) for r in df.collect())

    renewed = changes.updated_report(changes.read_report_version(spark, path), pop, old, moved, 6.5)
    assert rows(renewed) == rows(plans.predict_labeled(people, moved, 6.5))
    tiles, all_tiles = changes.changed_tiles(new, moved), coverage.touched_tiles(features.building_polygons(new), Grid())
    assert 1 <= tiles.count() <= 4 < all_tiles.count()
    done = changes.renew_report(spark, path, pop, old, moved, 6.5)
    assert rows(changes.read_report_version(spark, path)) == rows(renewed)
    assert 0 < done.where("osm_change <> 0").count() < done.count() and changes.changed_tiles(new, new).isEmpty()
