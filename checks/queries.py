"""One query per operator, each over whole test tables. Numbers are rounded for comparison with ``oracle.py``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures
from gridfill.functions.albers import cell_area_m2
from gridfill.functions.grid import CELL_KEY, TILE_KEY, DegreeGrid, Grid
from gridfill.functions.mercator import lat_to_y, lon_to_x, x_to_lon, y_to_lat
from gridfill.functions.shapes import polygon_moments, slug
from gridfill.operators import cells as C
from gridfill.operators import cover, coverage, density, joins, regression, report, zonal
from gridfill.plans import changes
from gridfill.plans import coverage_model as plans
from gridfill.sources import features as feats
from gridfill.sources import blocks, clustered, layers, pixels, zones
from gridfill.sources.scratch import checkpointed, shared_folder

GRID = Grid()
FINE, QUARTER, COARSE, LABELED = GRID, GRID.with_px(64), GRID.with_px(16), GRID.with_px(4)

BOX = (2872000.0, -2826000.0, 2905500.0, -2790500.0)  # xmin, ymin, xmax, ymax on the map

REPORT_DIGITS = {"index": 6, "pop_sum": 2, "osm_sum": 2, "osm_avg": 2, "prediction_sum": 2, "prediction_avg": 2}
MODEL_DIGITS = {"coefficient": 9, "rmse": 4, "r2": 6}


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), n) for c, n in digits.items()})


# -- inputs -----------------------------------------------------------------------------------------------------


def _points(spark, sf):
    return fixtures.pixels(spark, sf).select("lon", "lat", lon_to_x(F.col("lon")).alias("x"), lat_to_y(F.col("lat")).alias("y"))


def _pop(spark, sf, grid):
    return C.pop_grid(fixtures.pixels(spark, sf), grid)


def _buildings(spark, sf, snapshot="new"):
    return feats.building_polygons(fixtures.features(spark, sf, snapshot))


def _masks(spark, sf):
    return zones.training_polygons(fixtures.training_lines(spark, sf))


def _zones(spark, sf):
    return zones.zones_to_mercator(fixtures.zones(spark, sf))


def _analysis(spark, sf, px, **options):
    return plans.analysis_cells(fixtures.pixels(spark, sf), fixtures.features(spark, sf), px, **options)


def _scored(spark, sf, px=16):
    cells = checkpointed(_analysis(spark, sf, px))  # read twice by the fit and once more for what it predicts
    return regression.predict_footprint(cells, regression.fit_through_origin(cells))


def _tiles(df):
    return df.select(*TILE_KEY).distinct()


def scratch_dir(spark: SparkSession) -> str:
    """A new folder in the shared one."""
    return f"{shared_folder(spark)}/gridfill-{uuid.uuid4().hex}"


# -- sources ----------------------------------------------------------------------------------------------------


def raster_tiles(spark, sf):
    return rounded(pixels.raster_tiles(fixtures.pixels(spark, sf, with_nodata=True)), value_sum=2)


def raster_halo_tiles(spark, sf):
    return pixels.raster_halo_tiles(fixtures.pixels(spark, sf, with_nodata=True))


def normalize_nodata(spark, sf):
    return pixels.normalize_nodata(fixtures.pixels(spark, sf, with_nodata=True))


def drop_nodata_tiles(spark, sf):
    grid = Grid(15, 2)
    cells = joins.pop_with_footprint(_pop(spark, sf, grid), coverage.footprint_grid(_buildings(spark, sf), grid))
    return rounded(C.drop_nodata_tiles(cells, "osm"), pop=2, osm=1)


def layer_metadata(spark, sf):
    return rounded(C.layer_metadata(_pop(spark, sf, FINE), FINE), xmin=3, ymin=3, xmax=3, ymax=3)


def tile_lookup(spark, sf):
    areas = _masks(spark, sf).select(polygon_moments("rings").alias("m")).select("m.x", "m.y")
    keys = areas.select(GRID.tile_col(F.col("x")).alias("tile_col"), GRID.tile_row(F.col("y")).alias("tile_row"))
    return feats.tile_lookup(fixtures.vector_tiles(spark, sf), keys).select(*TILE_KEY, "building_id", "geom_type")


def tile_scan(spark, sf):
    return feats.tile_scan(fixtures.vector_tiles(spark, sf)).select(*TILE_KEY, "building_id", "geom_type")


def country_lookup(spark, sf):
    found = zones.country_lookup(fixtures.zones(spark, sf), "NATION 7")
    corner = F.element_at("rings", 1)
    return found.select("code", "name", F.round(corner[0]["x"], 6).alias("west"), F.round(corner[0]["y"], 6).alias("south"),
                        F.round(corner[2]["x"], 6).alias("east"), F.round(corner[2]["y"], 6).alias("north"))


def training_polygons(spark, sf):
    polygons = zones.training_polygons(fixtures.training_lines(spark, sf), "value", "k")
    rings = polygons.select("k", "part", F.posexplode("rings").alias("ring_no", "ring"))
    return rings.select("k", "part", "ring_no", F.posexplode("ring").alias("vertex_no", "p")).select(
        "k", "part", "ring_no", "vertex_no", F.round("p.x", 3).alias("x"), F.round("p.y", 3).alias("y"))


def read_band(spark, sf):
    path = scratch_dir(spark)
    layers.write_layer(_analysis(spark, sf, 16), f"{path}/layer", ["pop", "osm"], COARSE, min_zoom=11)
    return rounded(layers.read_band(spark, f"{path}/layer", 1, "osm"), osm=2)


def read_box(spark, sf):
    path = scratch_dir(spark)
    clustered.write_clustered(_analysis(spark, sf, 16), f"{path}/layer", ["pop", "osm"])
    return rounded(clustered.read_box(spark, f"{path}/layer", BOX, 1, "osm", COARSE), osm=2)


def _raster_blocks(spark, sf):
    return blocks.pixel_blocks(fixtures.pixels(spark, sf, with_nodata=True), side=48)  # blocks that lie across tiles


def block_tiles(spark, sf):
    return rounded(blocks.block_tiles(_raster_blocks(spark, sf)), value_sum=2)


def block_halo_tiles(spark, sf):
    return rounded(blocks.block_halo_tiles(_raster_blocks(spark, sf)), value=2)


# -- projections and scalar functions ---------------------------------------------------------------------------


def lonlat_to_mercator(spark, sf):
    return rounded(_points(spark, sf), x=3, y=3)


def mercator_to_lonlat(spark, sf):
    points = rounded(_points(spark, sf), x=3, y=3).select("x", "y")
    return points.select("x", "y", F.round(x_to_lon(F.col("x")), 6).alias("lon"), F.round(y_to_lat(F.col("y")), 6).alias("lat"))


def point_to_tile(spark, sf):
    points = _points(spark, sf)
    return points.select("lon", "lat", GRID.tile_col(F.col("x")).alias("tile_col"), GRID.tile_row(F.col("y")).alias("tile_row"))


def tile_extent(spark, sf):
    tiles = _tiles(_pop(spark, sf, LABELED))
    col, row = F.col("tile_col"), F.col("tile_row")
    return tiles.select(
        *TILE_KEY, *[F.round(v, 3).alias(n) for n, v in GRID.tile_extent(col, row).items()],
        *[F.round(v, 6).alias(n) for n, v in GRID.tile_extent_lonlat(col, row).items()])


def extent_to_tiles(spark, sf):
    outer = F.element_at("rings", 1)

    def edge(f, axis):
        return f(F.transform(outer, lambda p: p[axis]))

    bounds = GRID.key_bounds(edge(F.array_min, "x"), edge(F.array_min, "y"), edge(F.array_max, "x"), edge(F.array_max, "y"))
    keys = fixtures.features(spark, sf).select("building_id", *[v.alias(n) for n, v in bounds.items()])
    keys = keys.select("*", F.explode(F.sequence("col_min", "col_max")).alias("tile_col"))
    return keys.select("building_id", "tile_col", F.explode(F.sequence("row_min", "row_max")).alias("tile_row"))


def tile_pixel_window(spark, sf):
    source = DegreeGrid()
    tiles = _tiles(pixels.raster_tiles(fixtures.pixels(spark, sf), source))
    windows = [(b, source.pixel_window(F.col("tile_col"), F.col("tile_row"), F.lit(25.5), F.lit(-24.0), b)) for b in (0, 3)]
    return tiles.select(*TILE_KEY, *[v.alias(f"{n}_{b}") for b, w in windows for n, v in w.items()])


def tile_grid(spark, sf):
    bounds = C.layer_metadata(_pop(spark, sf, LABELED), LABELED)
    cols = bounds.select("*", F.explode(F.sequence("min_tile_col", "max_tile_col")).alias("tile_col"))
    tiles = cols.select("tile_col", F.explode(F.sequence("min_tile_row", "max_tile_row")).alias("tile_row"))
    col, row = F.col("tile_col"), F.col("tile_row")
    name = F.concat(F.lit("("), col.cast("string"), F.lit(", "), row.cast("string"), F.lit(")"))
    vertices = tiles.select(name.alias("name"), F.posexplode(GRID.tile_ring_lonlat(col, row)).alias("vertex_no", "p"))
    return vertices.select("name", "vertex_no", F.round("p.x", 6).alias("lon"), F.round("p.y", 6).alias("lat"))


def tiles_for_geometry(spark, sf):
    return coverage.tiles_for_geometry(_zones(spark, sf), GRID)


def zone_cover(spark, sf):
    return cover.zone_cover(_zones(spark, sf), GRID)


def tms_row_flip(spark, sf):
    rows = fixtures.vector_tiles(spark, sf).select("building_id", "tile_row")
    return rows.select("building_id", "tile_row", GRID.flip_row(F.col("tile_row")).alias("north_row"))


def cell_area(spark, sf):
    tiles = _tiles(feats.tile_scan(fixtures.vector_tiles(spark, sf)))
    return tiles.select(*TILE_KEY, F.round(cell_area_m2(GRID, F.col("tile_row")), 6).alias("cell_area_m2"))


def building_filter(spark, sf):
    return feats.building_filter(fixtures.features(spark, sf)).select("building_id")


def polygon_only(spark, sf):
    return feats.polygon_only(fixtures.features(spark, sf), "osm").select("building_id")


def building_levels(spark, sf):
    return feats.with_levels(fixtures.features(spark, sf)).select("building_id", "levels")


def valid_polygons(spark, sf):
    """All buildings with their defect or their area; some outer rings are spoiled first, by key, of which open ones are mended."""
    k, ring = F.col("building_id"), F.element_at("rings", 1)
    spoiled = (
        F.when(k % 17 == 0, F.slice(ring, 1, 4))
        .when(k % 19 == 0, F.array(ring[0], ring[1], ring[0]))
        .when(k % 23 == 0, F.array(ring[0], ring[2], ring[1], ring[3], ring[0]))
        .when(k % 29 == 0, F.array(ring[0], ring[1], ring[0], ring[1], ring[0]))
        .otherwise(ring))
    holes = F.slice("rings", F.lit(2), F.size("rings"))
    features = fixtures.features(spark, sf).withColumn("rings", F.concat(F.array(spoiled), holes))
    checked = feats.check_polygons(features).withColumn("area", F.when(F.col("defect").isNull(), polygon_moments("rings")["area"]))
    return rounded(checked.select("building_id", "defect", "area"), area=2)


def filter_both_valid(spark, sf):
    return rounded(C.filter_both_valid(_analysis(spark, sf, 16)), pop=2, osm=2)


def fill_missing_footprint(spark, sf):
    return rounded(C.fill_missing_footprint(_analysis(spark, sf, 16)), pop=2, osm=2)


def slug_names(spark, sf):
    parts = spark.read.parquet(f"{sf}/part.parquet")
    return parts.select(F.col("p_partkey").cast("bigint").alias("k"), slug(F.initcap(F.concat_ws(" ", "p_name", "p_type"))).alias("slug"))


def cell_center(spark, sf):
    x, y = FINE.cell_center()
    return _pop(spark, sf, FINE).select(*CELL_KEY, F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


def polygon_measures(spark, sf):
    moments = fixtures.features(spark, sf).select("building_id", polygon_moments("rings").alias("m"))
    measured = moments.selectExpr("building_id", "m.x AS cx", "m.y AS cy", "m.area AS area")
    extent = GRID.tile_extent(GRID.tile_col(F.col("cx")), GRID.tile_row(F.col("cy")))
    distance = F.hypot(F.col("cx") - extent["xmin"], F.col("cy") - extent["ymin"])
    return rounded(measured.withColumn("to_corner", distance), cx=3, cy=3, area=2, to_corner=3)


def tile_key_string(spark, sf):
    points = _points(spark, sf)
    return points.select("lon", "lat", GRID.key_string(GRID.tile_col(F.col("x")), GRID.tile_row(F.col("y"))).alias("tile"))


# -- joins ------------------------------------------------------------------------------------------------------


def pop_with_footprint(spark, sf):
    return rounded(_analysis(spark, sf, 16), pop=2, osm=2)


def mask_cells(spark, sf):
    return rounded(coverage.mask_cells(_pop(spark, sf, FINE), _masks(spark, sf), FINE), pop=2)


def footprint_fraction(spark, sf):
    polygons = feats.polygon_only(fixtures.features(spark, sf))
    return rounded(coverage.footprint_fraction(polygons, FINE), fraction=5)


def zone_cells(spark, sf):
    return rounded(coverage.zone_cells(_zones(spark, sf), COARSE), fraction=5)


def _neighbours(spark, sf):
    return density.knn_density_join(density.building_points(_buildings(spark, sf), COARSE), COARSE)


def knn_density_join(spark, sf):
    return rounded(_neighbours(spark, sf).drop("weight"), distance=3)


def country_footprint(spark, sf):
    zone = zones.zones_to_mercator(zones.country_lookup(fixtures.zones(spark, sf), "nation_12"))
    return rounded(joins.country_footprint(_buildings(spark, sf), zone), osm=2)


def coverage_change(spark, sf):
    """The report of the old snapshot is stored; that of the new one is made from it and the tiles that changed."""
    px, old, new, path = fixtures.pixels(spark, sf), fixtures.features(spark, sf, "old"), fixtures.features(spark, sf), scratch_dir(spark)
    layers.write_layer(_pop(spark, sf, LABELED), f"{path}/pop", ["pop"], LABELED)
    pop = layers.read_band(spark, f"{path}/pop", 0, "pop")
    model = _train_labeled(spark, sf).select("coefficient").first()["coefficient"]
    changes.write_report_version(plans.predict_labeled(px, old, model), f"{path}/report")
    return rounded(changes.renew_report(spark, f"{path}/report", pop, old, new, model), osm_before=2, osm_after=2, index_before=6, index_after=6,
                   osm_change=2, index_change=6)


# -- aggregations -----------------------------------------------------------------------------------------------


def pop_grid(spark, sf):
    return rounded(_pop(spark, sf, FINE), pop=2)


def resample_sum(spark, sf):
    cells = joins.pop_with_footprint(_pop(spark, sf, FINE), coverage.footprint_grid(_buildings(spark, sf), FINE))
    return rounded(C.resample_sum(cells, FINE, 4), pop=2, osm=2)


def resample_multiband(spark, sf):
    bands = layers.to_bands(_analysis(spark, sf, 16), ["pop", "osm"])
    return rounded(C.resample_multiband(bands, COARSE, 4), value=2)


def footprint_grid(spark, sf):
    return rounded(coverage.footprint_grid(_buildings(spark, sf), FINE), osm=2)


def footprint_grid_clipped(spark, sf):
    tiles = feats.tile_scan(fixtures.vector_tiles(spark, sf))
    return rounded(coverage.footprint_grid(feats.building_polygons(tiles), FINE, clip_to_tile=True), osm=2)


def _dense(spark, sf):
    return C.assemble_tiles(_scored(spark, sf), COARSE)


def assemble_tiles(spark, sf):
    def text(band):  # hundredths, a dash where there is no data
        return F.array_join(F.transform(band, lambda v: F.coalesce(F.round(v * 100).cast("bigint").cast("string"), F.lit("-"))), ",")

    return _dense(spark, sf).select(*TILE_KEY, F.size("pop").cast("bigint").alias("size"), *[text(b).alias(b) for b in ("pop", "osm")])


def explode_tiles(spark, sf):
    return rounded(C.explode_tiles(_dense(spark, sf), COARSE, ["pop", "osm", "prediction"]), pop=2, osm=2, prediction=2)


def tile_stats(spark, sf):
    return rounded(zonal.tile_stats(_scored(spark, sf)), pop_sum=2, osm_sum=2, prediction_sum=2)


def zonal_building_area(spark, sf):
    footprint = coverage.footprint_grid(_buildings(spark, sf), QUARTER)
    return rounded(zonal.zonal_building_area(footprint, _zones(spark, sf), QUARTER), area_m2=2)


def cell_histogram(spark, sf):
    return rounded(C.cell_histogram(_pop(spark, sf, LABELED), "pop"), low=2, high=2)


def pyramid_sum(spark, sf):
    return rounded(C.pyramid_sum(_pop(spark, sf, FINE), FINE, ["pop"]), pop=2)


def fit_through_origin(spark, sf):
    return rounded(regression.fit_through_origin(C.filter_both_valid(_analysis(spark, sf, 16))), **MODEL_DIGITS)


def predict_footprint(spark, sf):
    return rounded(_scored(spark, sf), pop=2, osm=2, prediction=2)


def fit_quality(spark, sf):
    return rounded(regression.fit_quality(_scored(spark, sf)), rmse=4, r2=6)


def fit_per_country(spark, sf):
    cells = joins.pop_with_footprint(_pop(spark, sf, QUARTER), coverage.footprint_grid(_buildings(spark, sf), QUARTER))
    spans = coverage.zone_spans(_zones(spark, sf), QUARTER)
    return rounded(regression.fit_per_country(cells, spans, QUARTER, 4), **MODEL_DIGITS)


def completeness_index(spark, sf):
    return rounded(report.completeness_index(zonal.tile_stats(_scored(spark, sf))), **REPORT_DIGITS)


def report_json(spark, sf):
    """The report as text, read back from its JSON."""
    text = report.report_json(report.completeness_index(zonal.tile_stats(_scored(spark, sf))))
    average = "osm_sum: DOUBLE, osm_avg: DOUBLE"
    schema = f"MAP<STRING, STRUCT<index: DOUBLE, actual: STRUCT<pop_sum: DOUBLE, {average}>, prediction: STRUCT<{average}>>>"
    rows = text.select(F.explode(F.from_json("value", schema)).alias("tile", "r"))
    flat = rows.select(
        "tile", F.col("r.index").alias("index"), F.col("r.actual.pop_sum").alias("pop_sum"), F.col("r.actual.osm_sum").alias("osm_sum"),
        F.col("r.actual.osm_avg").alias("osm_avg"), F.col("r.prediction.osm_sum").alias("prediction_sum"),
        F.col("r.prediction.osm_avg").alias("prediction_avg"))
    return rounded(flat, **REPORT_DIGITS)


def tile_totals(spark, sf):
    return rounded(zonal.tile_totals(_scored(spark, sf, 4)), population=2, actual=2, expected=2)


def knn_density(spark, sf):
    return rounded(density.knn_density(_neighbours(spark, sf)), density=7)


# -- training and prediction ------------------------------------------------------------------------------------


def _train_labeled(spark, sf, **options):
    return plans.train_labeled(fixtures.pixels(spark, sf), fixtures.features(spark, sf), _masks(spark, sf), **options)


def train_unlabeled(spark, sf):
    return rounded(plans.train_unlabeled(fixtures.pixels(spark, sf), fixtures.features(spark, sf)), **MODEL_DIGITS)


def train_labeled(spark, sf):
    return rounded(_train_labeled(spark, sf), **MODEL_DIGITS)


def train_labeled_mask_both(spark, sf):
    return rounded(_train_labeled(spark, sf, mask_both=True), **MODEL_DIGITS)


def predict_unlabeled(spark, sf):
    px, features = fixtures.pixels(spark, sf), fixtures.features(spark, sf)
    return rounded(plans.predict_unlabeled(px, features, plans.train_unlabeled(px, features)), **REPORT_DIGITS)


def predict_labeled(spark, sf):
    px, features = fixtures.pixels(spark, sf), fixtures.features(spark, sf)
    return rounded(plans.predict_labeled(px, features, _train_labeled(spark, sf)), **REPORT_DIGITS)


def stored_model(spark, sf):
    """A model fitted by ``pyspark.ml``, saved, saved over, loaded and predicted with."""
    px, features, path = fixtures.pixels(spark, sf), fixtures.features(spark, sf), f"{scratch_dir(spark)}/model"
    model = regression.fit_ml(C.filter_both_valid(plans.analysis_cells(px, features, 16)))
    regression.save_model(model, path)
    regression.save_model(model, path, overwrite=True)
    return rounded(plans.predict_unlabeled(px, features, regression.load_model(path)), **REPORT_DIGITS)


def stored_pyramid(spark, sf):
    """All levels of a pyramid that replaced another one, read back, and its histogram as level -1."""
    path, pop = f"{scratch_dir(spark)}/pyramid", _pop(spark, sf, LABELED)
    layers.write_pyramid(pop.withColumn("pop", F.col("pop") * 2), path, "pop", LABELED)
    layers.write_pyramid(pop, path, "pop", LABELED)
    levels = layers.read_pyramid(spark, path).select(F.col("zoom").cast("int").alias("zoom"), *CELL_KEY, "pop")
    bars = layers.read_histogram(spark, path).select(
        F.lit(-1).alias("zoom"), F.col("bucket").alias("tile_col"), F.col("cells").alias("tile_row"), F.lit(0).cast("bigint").alias("cell_col"),
        F.lit(0).cast("bigint").alias("cell_row"), F.col("low").alias("pop"))
    return rounded(levels.unionByName(bars), pop=2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raster_tiles": raster_tiles,
    "raster_halo_tiles": raster_halo_tiles,
    "drop_nodata_tiles": drop_nodata_tiles,
    "normalize_nodata": normalize_nodata,
    "layer_metadata": layer_metadata,
    "tile_lookup": tile_lookup,
    "tile_scan": tile_scan,
    "country_lookup": country_lookup,
    "training_polygons": training_polygons,
    "report_json": report_json,
    "read_band": read_band,
    "read_box": read_box,
    "block_tiles": block_tiles,
    "block_halo_tiles": block_halo_tiles,
    "lonlat_to_mercator": lonlat_to_mercator,
    "mercator_to_lonlat": mercator_to_lonlat,
    "point_to_tile": point_to_tile,
    "tile_extent": tile_extent,
    "extent_to_tiles": extent_to_tiles,
    "tile_pixel_window": tile_pixel_window,
    "tile_grid": tile_grid,
    "tiles_for_geometry": tiles_for_geometry,
    "zone_cover": zone_cover,
    "tms_row_flip": tms_row_flip,
    "cell_area_m2": cell_area,
    "building_filter": building_filter,
    "polygon_only": polygon_only,
    "building_levels": building_levels,
    "valid_polygons": valid_polygons,
    "filter_both_valid": filter_both_valid,
    "fill_missing_footprint": fill_missing_footprint,
    "slug": slug_names,
    "cell_center": cell_center,
    "polygon_measures": polygon_measures,
    "tile_key_string": tile_key_string,
    "pop_with_footprint": pop_with_footprint,
    "mask_cells": mask_cells,
    "footprint_fraction": footprint_fraction,
    "zone_cells": zone_cells,
    "knn_density_join": knn_density_join,
    "country_footprint": country_footprint,
    "coverage_change": coverage_change,
    "pop_grid": pop_grid,
    "resample_sum": resample_sum,
    "resample_multiband": resample_multiband,
    "footprint_grid": footprint_grid,
    "footprint_grid_clipped": footprint_grid_clipped,
    "explode_tiles": explode_tiles,
    "assemble_tiles": assemble_tiles,
    "tile_stats": tile_stats,
    "zonal_building_area": zonal_building_area,
    "cell_histogram": cell_histogram,
    "pyramid_sum": pyramid_sum,
    "fit_through_origin": fit_through_origin,
    "predict_footprint": predict_footprint,
    "completeness_index": completeness_index,
    "fit_quality": fit_quality,
    "fit_per_country": fit_per_country,
    "tile_totals": tile_totals,
    "knn_density": knn_density,
    "train_unlabeled": train_unlabeled,
    "train_labeled": train_labeled,
    "train_labeled_mask_both": train_labeled_mask_both,
    "predict_unlabeled": predict_unlabeled,
    "predict_labeled": predict_labeled,
    "stored_model": stored_model,
    "stored_pyramid": stored_pyramid,
}
