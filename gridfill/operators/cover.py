"""Zones as squares of many sizes: large ones inside, single tiles along the border.

A cover lists the tiles that a zone touches as the largest aligned squares that hold no other tile. It is made from
runs of tiles down each column, never from a list of tiles, so its work and size follow the zone's border.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfill.functions.grid import TILE_KEY, Grid
from gridfill.operators.coverage import zone_spans

LEVELS = 6  # the largest square is 2 ** LEVELS tiles wide: at zoom 12 the world has 4,096 of them
SQUARE = ["level", "square_col", "square_row"]


def _merged_runs(spans: DataFrame, key: str) -> DataFrame:
    """Runs that touch each other as one: ``key, square_col, row_from, row_to``."""
    column = f"(PARTITION BY `{key}`, gcol ORDER BY row_from"
    marked = spans.selectExpr(f"`{key}`", "gcol", "row_from", "row_to", f"IF(row_from = lag(row_to) OVER {column}) + 1, 0, 1) AS _new")
    numbered = marked.selectExpr("*", f"sum(_new) OVER {column}) AS _run")
    runs = numbered.groupBy(key, F.col("gcol").alias("square_col"), "_run").agg(F.min("row_from").alias("row_from"), F.max("row_to").alias("row_to"))
    return runs.drop("_run")


def _widened(runs: DataFrame, key: str, level: int) -> DataFrame:
    """One level up: where both columns of a pair hold a pair of rows, the four squares are one.

    ``runs`` has ``key, level, square_col, row_from, row_to``. Runs of the level before are cut at even rows; where the inner parts
    of two neighbouring columns run side by side they go up, everything else stays as it is from then on.
    """
    open_, first, last = f"level = {level - 1}", "row_from + row_from % 2", "row_to - (row_to + 1) % 2"
    piece = "named_struct('level', level, 'square_col', square_col, 'row_from', {0}, 'row_to', {1}, 'turn', CAST({2} AS INT))"
    pieces = ", ".join([
        f"IF({open_} AND row_from % 2 = 1, {piece.format('row_from', 'row_from', 'NULL')}, NULL)",
        f"IF({open_} AND row_to % 2 = 0, {piece.format('row_to', 'row_to', 'NULL')}, NULL)",
        f"IF({open_} AND {first} < {last}, {piece.format(first, 'NULL', '1')}, NULL)",
        f"IF({open_} AND {first} < {last}, {piece.format(f'{last} + 1', 'NULL', '-1')}, NULL)",
        f"IF({open_}, NULL, {piece.format('row_from', 'row_to', 'NULL')})"])
    cut = runs.selectExpr(f"`{key}`", f"inline(array_compact(array({pieces})))")
    pair = f"(PARTITION BY `{key}`, level, square_col div 2, turn IS NULL ORDER BY row_from"
    walked = cut.selectExpr("*", *[f"sum(IF(square_col % 2 = {side}, turn, 0)) OVER {pair} RANGE UNBOUNDED PRECEDING) AS _{side}" for side in (0, 1)],
                            f"lead(row_from) OVER {pair}) AS _next")
    stays = walked.selectExpr(f"`{key}`", "turn IS NULL AS _done", "_0 + _1 = 2 AS _both", "_0 + _1 AS _held", "level", "square_col", "row_from",
                              "IF(turn IS NULL, row_to, _next - 1) AS row_to", "square_col div 2 * 2 + _1 AS _side")
    return stays.where("_done OR (_held > 0 AND row_from <= row_to)").selectExpr(
        f"`{key}`", f"IF(NOT _done AND _both, {level}, level) AS level",
        "CASE WHEN _done THEN square_col WHEN _both THEN square_col div 2 ELSE _side END AS square_col",
        "IF(NOT _done AND _both, row_from div 2, row_from) AS row_from", "IF(NOT _done AND _both, row_to div 2, row_to) AS row_to")


def zone_cover(zones: DataFrame, grid: Grid, key: str = "code", levels: int = LEVELS) -> DataFrame:
    """The tiles touched by each zone as squares: ``key, level, square_col, square_row``.

    A square of a level is ``2 ** level`` tiles wide and aligned, all its tiles are touched, and no larger one of up to
    ``levels`` holds it. Squares of a zone don't overlap; each zone has its own.
    """
    runs = _merged_runs(zone_spans(zones, grid.with_px(1), key), key).selectExpr(f"`{key}`", "0 AS level", "square_col", "row_from", "row_to")
    for level in range(1, min(levels, grid.zoom) + 1):
        runs = _widened(runs, key, level)
    return runs.selectExpr(f"`{key}`", "level", "square_col", "explode(sequence(row_from, row_to, 1L)) AS square_row")


def tiles_in_cover(tiles: DataFrame, cover: DataFrame, key: str = "code", levels: int = LEVELS) -> DataFrame:
    """``key, tile_col, tile_row`` of each distinct tile of ``tiles`` and each zone whose cover holds it.

    Tiles look for their ancestors among the squares, so neither side lists the tiles of a zone.
    """
    above = tiles.select(*TILE_KEY).distinct().selectExpr("*", f"explode(sequence(0, {levels})) AS level")
    above = above.selectExpr("*", "shiftright(tile_col, level) AS square_col", "shiftright(tile_row, level) AS square_row")
    return above.join(cover, SQUARE).select(key, *TILE_KEY)


def cover_tiles(cover: DataFrame, key: str = "code") -> DataFrame:
    """Every tile of a cover, listed: ``key, tile_col, tile_row``."""
    along = "explode(sequence(square_{0} * shiftleft(1L, level), (square_{0} + 1) * shiftleft(1L, level) - 1, 1L)) AS tile_{0}"
    columns = cover.selectExpr("*", along.format("col"))
    return columns.selectExpr(f"`{key}`", "tile_col", along.format("row"))
