"""Footprint per person: least squares through the origin, by sums or by ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfill.functions.grid import Grid
from gridfill.operators.coverage import cells_by_zone


def fit_through_origin(cells: DataFrame, by: Sequence[str] = (), x: str = "pop", y: str = "osm") -> DataFrame:
    """``*by, coefficient, n, rmse, r2`` of ``y ~ x`` without intercept, over cells holding both.

    Two passes of partial sums: the first gives the coefficients, the second sums what they leave over, cell by cell, so a
    fit much closer than the values are large keeps its digits. R2 is taken about zero, as is usual without an intercept.
    """
    both = cells.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    fit = F.try_divide(F.sum(F.col(x) * F.col(y)), F.sum(F.col(x) * F.col(x))).alias("coefficient")
    if by:
        slopes = both.groupBy(*by).agg(fit)
        known = both.select(*by, x, y).join(slopes.withColumnsRenamed({b: f"_{b}" for b in by}), _same(by), "left").drop(*[f"_{b}" for b in by])
    else:
        known = both.select(x, y, both.agg(fit).scalar().alias("coefficient"))
    residual = F.col(y) - F.col("coefficient") * F.col(x)
    sums = known.groupBy(*by).agg(F.first("coefficient").alias("coefficient"), F.count(F.lit(1)).alias("n"), F.sum(residual * residual).alias("error"),
                                  F.sum(F.col(y) * F.col(y)).alias("squares"))
    return sums.select(*by, "coefficient", "n", F.sqrt(F.try_divide("error", F.col("n"))).alias("rmse"), (1 - F.try_divide("error", "squares")).alias("r2"))


def _same(by: Sequence[str]):
    """Equal keys, null ones too."""
    same = F.lit(True)
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"_{b}"))
    return same


def fit_per_country(cells: DataFrame, spans: DataFrame, grid: Grid, px: int, key: str = "code") -> DataFrame:
    """One model per zone, all in one job. ``cells`` carry ``pop`` and ``osm`` on ``grid``; each zone sums its own
    cells to ``px`` per tile side and fits the cells where both have data."""
    inside = cells_by_zone(cells, spans, grid, key)
    step = F.lit(grid.px // px)
    coarse = [F.floor(F.col(c) / step).cast("bigint").alias(c) for c in ("cell_col", "cell_row")]
    zone_cells = inside.groupBy(key, "tile_col", "tile_row", *coarse).agg(F.sum("pop").alias("pop"), F.sum("osm").alias("osm"))
    return fit_through_origin(zone_cells, [key])


def predict_footprint(cells: DataFrame, model: DataFrame | LinearRegressionModel | float, by: Sequence[str] = ()) -> DataFrame:
    """Add ``prediction``: the coefficient times population, NULL without population.

    ``model`` is a number, a fitted or loaded ``LinearRegressionModel``, a one-row table (read as a scalar subquery) or,
    with ``by``, one row per group.
    """
    if isinstance(model, LinearRegressionModel):
        model = float(model.coefficients[0])
    if by:
        coefficients = model.select(*by, F.col("coefficient").alias("_coefficient"))
        scored = cells.join(coefficients, list(by), "left")
        return scored.withColumn("prediction", F.col("_coefficient") * F.col("pop")).drop("_coefficient")
    coefficient = model.select("coefficient").scalar() if isinstance(model, DataFrame) else F.lit(float(model))
    return cells.withColumn("prediction", coefficient * F.col("pop"))


def fit_quality(scored: DataFrame, actual: str = "osm", predicted: str = "prediction") -> DataFrame:
    """RMSE and R2 (about zero) of predictions, from the residuals."""
    both = scored.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    residual = F.col(actual) - F.col(predicted)
    return both.agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(residual * residual)).alias("rmse"),
        (1 - F.try_divide(F.sum(residual * residual), F.sum(F.col(actual) * F.col(actual)))).alias("r2"))


# -- pyspark.ml form --------------------------------------------------------------------------------------------


def with_features(cells: DataFrame, x: str = "pop") -> DataFrame:
    """Add the ``features`` vector; cells without population carry NaN in it instead of failing."""
    return VectorAssembler(inputCols=[x], outputCol="features", handleInvalid="keep").transform(cells)


def fit_ml(cells: DataFrame, x: str = "pop", y: str = "osm") -> LinearRegressionModel:
    """The same fit as a saveable model, its only parameters those that differ from the defaults."""
    training = with_features(cells.dropna(subset=[x, y]), x)
    return LinearRegression(fitIntercept=False, labelCol=y, featuresCol="features").fit(training)


def predict_ml(cells: DataFrame, model: LinearRegressionModel, x: str = "pop") -> DataFrame:
    scored = model.transform(with_features(cells, x)).drop("features")
    return scored.withColumn("prediction", F.when(~F.isnan("prediction"), F.col("prediction")))


def save_model(model: LinearRegressionModel, path: str, overwrite: bool = False) -> None:
    """Store a model; an existing path is an error unless it may be overwritten."""
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def load_model(path: str) -> LinearRegressionModel:
    return LinearRegressionModel.load(path)
