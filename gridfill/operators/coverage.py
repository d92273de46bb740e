"""Exact area coverage of grid cells by polygons.

The share of a cell covered by a polygon is a sum over the polygon's edges, so it can be aggregated without
ever building the polygon-by-cell product. Each edge is cut at the grid's columns and rows, and every piece
is booked on the one cell it runs through:

* ``area``  - the part of that cell lying south of the piece, within the piece's width;
* ``cover`` - the piece's width, which counts in full for every cell further south in the same column.

Eastward and westward edges carry opposite signs, so the coverage of a cell is its own ``area`` plus the
``cover`` of all cells north of it in its column. Widths are whole numbers of 2**-bits cells: south of a
polygon they cancel to exactly zero, in any order of summation. The work grows with the length of the
outlines, not with the area inside them, and the first shuffle carries one partly aggregated row per cell.

Both sums are linear, so polygons may be added up before the walk down the columns (``keys=[]``), weighted
for instance by storeys; or kept apart by ``keys``, for one result per polygon or zone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridfill.functions.albers import cell_area_m2
from gridfill.functions.grid import CELL_KEY, TILE_KEY, Grid, snap_bits
from gridfill.functions.mercator import WORLD_HALF_WIDTH, lat_to_y, lon_to_x
from gridfill.functions.shapes import segments_sql, signed_area_sql, usable_areas
from gridfill.functions.spread import spread
from gridfill.sources.features import valid_polygons

# Rows of a column that are walked in one window; deeper grids are walked block by block, with what is carried over.
BLOCK_ROWS = 1 << 20


def touch_share(grid: Grid) -> float:
    """The share from which on a cell counts as covered: four snapping steps, as the ends of an outline's edges on both sides of a
    cell may each be off by one."""
    return 4.0 / (1 << snap_bits(grid))


def _blocks(grid: Grid, block_rows: int) -> bool:
    """Whether the grid's columns are longer than a block."""
    return grid.tiles * grid.px > block_rows


def outline_edges(polygons: DataFrame, grid: Grid, keep: Sequence[str] = ()) -> DataFrame:
    """One row per edge that is not north-south, in cell units and running west to east.

    ``sign`` is +1 where the inside lies south of the edge, -1 where it lies north.
    """
    scale = 1 << snap_bits(grid)
    kept = ", ".join([*keep, ""])

    def u(x: str) -> str:
        return f"rint(({x} + {WORLD_HALF_WIDTH}D) / {grid.cell_size!r}D * {scale}D) / {scale}D"

    def v(y: str) -> str:
        return f"({WORLD_HALF_WIDTH}D - {y}) / {grid.cell_size!r}D"

    # counter-clockwise outer rings have their inside south of westward edges; holes the other way round
    rings = polygons.selectExpr(*keep, "posexplode(rings) AS (ring_no, ring)").selectExpr(
        *keep, "ring", f"signum({signed_area_sql('ring')}) * IF(ring_no = 0, -1D, 1D) AS turn")
    edges = rings.selectExpr(*keep, "turn", f"inline({segments_sql('ring')}) AS (a, b)").selectExpr(
        *keep, "turn", f"{u('a.x')} AS ua", f"{v('a.y')} AS va", f"{u('b.x')} AS ub", f"{v('b.y')} AS vb")
    return edges.where("ua <> ub").selectExpr(
        *keep, "IF(ua < ub, turn, -turn) AS sign", "least(ua, ub) AS u0", "greatest(ua, ub) AS u1",
        "IF(ua < ub, va, vb) AS v0", "IF(ua < ub, vb, va) AS v1")


def outline_pieces(edges: DataFrame, grid: Grid, keep: Sequence[str] = (), clip: bool = False) -> DataFrame:
    """Cut edges at columns and rows: ``gcol, grow, area DOUBLE, cover BIGINT`` per piece.

    With ``clip`` the input carries ``tile_col, tile_row`` and every outline is folded back into that tile:
    pieces further north count on its top row, pieces further south just below it.
    """
    scale, px = 1 << snap_bits(grid), grid.px
    first, last = "bigint(floor(u0))", "bigint(ceil(u1)) - 1"
    if clip:
        first, last = f"greatest({first}, tile_col * {px})", f"least({last}, tile_col * {px} + {px - 1})"
        edges = edges.where(f"{first} <= {last}")
    # columns: the edge between the two column borders, or its own end
    strips = edges.selectExpr("*", f"explode(sequence({first}, {last}, 1L)) AS gcol").selectExpr(
        *keep, "sign", "u0", "u1", "v0", "v1", "gcol", "greatest(u0, double(gcol)) AS w", "least(u1, double(gcol + 1)) AS e")

    def height(u: str) -> str:
        return f"CASE {u} WHEN u0 THEN v0 WHEN u1 THEN v1 ELSE v0 + (v1 - v0) * ({u} - u0) / (u1 - u0) END"

    strips = strips.selectExpr(*keep, "sign", "gcol", "w", "e", f"{height('w')} AS vw", f"{height('e')} AS ve").selectExpr(
        *keep, "sign", "gcol", "least(vw, ve) AS top", "greatest(vw, ve) AS bottom",
        "IF(vw <= ve, w, e) AS u_top", "IF(vw <= ve, e, w) AS u_bottom")
    # rows: where the strip crosses a row border, on the same snapped point for the rows above and below
    cells = strips.selectExpr(
        "*", "explode(sequence(bigint(floor(top)), greatest(bigint(floor(top)), bigint(ceil(bottom)) - 1), 1L)) AS r")

    def crossing(row: str) -> str:
        part = f"({row} - top) / nullif(bottom - top, 0D)"
        return f"rint((u_top + (u_bottom - u_top) * {part}) * {scale}D) / {scale}D"

    start = f"IF(r <= top, u_top, {crossing('r')})"
    end = f"IF(r + 1 >= bottom, u_bottom, {crossing('(r + 1)')})"
    cells = cells.selectExpr(
        *keep, "sign", "gcol", "r", f"abs({end} - {start}) AS width",
        "r + 1 - (greatest(top, double(r)) + least(bottom, double(r + 1))) / 2 AS below")
    grow, share = "r", "below"
    if clip:
        grow = f"least(greatest(r, tile_row * {px}), tile_row * {px} + {px})"
        share = f"IF(r BETWEEN tile_row * {px} AND tile_row * {px} + {px - 1}, below, 1D)"
    return cells.selectExpr(
        *keep, "gcol", f"{grow} AS grow", f"sign * width * {share} AS area", f"bigint(sign * width * {scale}D) AS cover")


def outline_cells(polygons: DataFrame, grid: Grid, keys: Sequence[str] = (), weight: str | None = None,
                  clip: bool = False, long_outlines: bool = False) -> DataFrame:
    """Edge bookings summed per cell: ``*keys, gcol, grow, area, cover[, w_area, w_cover]``.

    ``long_outlines`` is for zones and masks, whose few rows make very many pieces: equal edges are merged first
    (copies of a polygon, shared borders) and the rest spread over all tasks, instead of being cut up by the
    task that read them.
    """
    keep = list(dict.fromkeys([*keys, *([weight] if weight else []), *(TILE_KEY if clip else [])]))
    edges = outline_edges(polygons, grid, keep)
    if long_outlines:
        ends = ["u0", "v0", "u1", "v1"]
        merged = edges.groupBy(*keep, *ends).agg(F.sum("sign").alias("sign")).where("sign <> 0")
        edges = spread(merged, "u0", "v0")  # by other columns than the sums: an equal shuffle would be dropped
    pieces = outline_pieces(edges, grid, keep, clip)
    sums = [F.sum("area").alias("area"), F.sum("cover").alias("cover")]
    if weight:
        sums += [F.sum(F.col("area") * F.col(weight)).alias("w_area"),
                 F.sum(F.col("cover") * F.col(weight)).alias("w_cover")]
    return pieces.groupBy(*keys, "gcol", "grow").agg(*sums)


def coverage_spans(outline: DataFrame, grid: Grid, keys: Sequence[str] = (), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Walk down every column: ``*keys, gcol, row_from, row_to, fraction[, weighted]`` of all covered cells.

    A cell on an outline is a span of its own; the cells between two outline cells share one span. Columns of more than
    ``block_rows`` rows are walked in blocks: sums of whole blocks give what a block takes over from those above it and
    the row where the next one begins, so a window holds the outline cells of one block, or a row for each block.
    """
    scale = 1 << snap_bits(grid)
    weighted = "w_area" in outline.columns
    column = [*keys, "gcol"]
    sums = {"cover": "0L", **({"w_cover": "0D"} if weighted else {})}
    if _blocks(grid, block_rows):
        outline = outline.selectExpr("*", f"grow div {block_rows} AS block")
        whole = outline.groupBy(*column, "block").agg(F.min("grow").alias("_first"), *[F.sum(c).alias(f"_{c}") for c in sums])
        over = f"(PARTITION BY {', '.join(column)} ORDER BY block"
        carried = whole.selectExpr(*column, "block", f"lead(_first) OVER {over}) AS _next", *[
            f"coalesce(sum(_{c}) OVER {over} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), {zero}) AS _{c}" for c, zero in sums.items()])
        outline = outline.join(carried, [*column, "block"])
        column = [*column, "block"]
    down = f"(PARTITION BY {', '.join(column)} ORDER BY grow"
    above = f"{down} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    plus = lambda c: f" + _{c}" if "block" in column else ""
    following = f"lead(grow) OVER {down})"
    walked = outline.selectExpr(
        "*", f"{f'coalesce({following}, _next)' if 'block' in column else following} AS next_row", f"coalesce(sum(cover) OVER {above}, 0L){plus('cover')} AS above",
        *([f"coalesce(sum(w_cover) OVER {above}, 0D){plus('w_cover')} AS w_above"] if weighted else []))
    here = f"grow, grow, above / {scale}D + area"
    between = f"grow + 1, next_row - 1, (above + cover) / {scale}D"
    if weighted:
        here += f", w_above / {scale}D + w_area"
        between += f", (w_above + w_cover) / {scale}D"
    names = ", ".join(["row_from", "row_to", "fraction", *(["weighted"] if weighted else [])])
    spans = walked.selectExpr(*keys, "gcol", f"stack(2, {here}, {between}) AS ({names})")
    return spans.where(f"row_from <= row_to AND fraction > {touch_share(grid)!r}D")


def span_cells(spans: DataFrame, grid: Grid) -> DataFrame:
    """One row per covered cell, under CELL_KEY."""
    rest = [c for c in spans.columns if c not in ("gcol", "row_from", "row_to")]
    rows = spans.select(*rest, "gcol", F.explode(F.sequence("row_from", "row_to", F.lit(1).cast("bigint"))).alias("grow"))
    return rows.select(*grid.split(F.col("gcol"), F.col("grow")), *rest)


def footprint_fraction(polygons: DataFrame, grid: Grid, keys: Sequence[str] = ("building_id",)) -> DataFrame:
    """Covered share of every cell touched by each polygon: ``CELL_KEY, *keys, fraction``. Polygons beyond mending have none."""
    polygons = valid_polygons(polygons)
    return span_cells(coverage_spans(outline_cells(polygons, grid, keys), grid, keys), grid)


def footprint_grid(buildings: DataFrame, grid: Grid, column: str = "osm", clip_to_tile: bool = False) -> DataFrame:
    """Building floor area per cell in square metres: sum of share x ground area of the cell x levels.

    Overlapping buildings add up; buildings with NULL ``levels`` add nothing; untouched cells have no row.
    ``clip_to_tile`` keeps only the part of each building inside the ``tile_col, tile_row`` it is filed under.
    """
    known = buildings.where(F.col("levels").isNotNull())
    outline = outline_cells(known, grid, weight="levels", clip=clip_to_tile)
    cells = span_cells(coverage_spans(outline, grid), grid)
    return cells.select(*CELL_KEY, (F.col("weighted") * cell_area_m2(grid, F.col("tile_row"))).alias(column))


def mask_cells(cells: DataFrame, masks: DataFrame | None, grid: Grid, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Keep the cells touched by any mask polygon; ``masks=None`` keeps all.

    Cells and mask outlines are walked down the columns together, so a cell meets the running cover of its
    column once instead of being paired with polygons. Both sides hold one row per cell. Columns of more than ``block_rows``
    rows are walked in blocks: a block with cells begins with a row that carries the cover of the outlines above it.
    """
    if masks is None:
        return cells
    outline = outline_cells(usable_areas(masks), grid, long_outlines=True)
    scale, px = 1 << snap_bits(grid), grid.px
    marked = cells.selectExpr("*", f"tile_col * {px} + cell_col AS _gcol", f"tile_row * {px} + cell_row AS _grow", "true AS _is_cell")
    edges = outline.selectExpr("gcol AS _gcol", "grow AS _grow", "cover AS _cover", f"area - cover / {scale}D AS _local")
    column = "_gcol"
    if _blocks(grid, block_rows):
        column, block = "_gcol, _block", f"_grow div {block_rows} AS _block"
        marked, edges = marked.selectExpr("*", block), edges.selectExpr("*", block)
        met = marked.select("_gcol", "_block", F.lit(0).cast("bigint").alias("_cover"), F.lit(True).alias("_cells")).distinct()
        whole = edges.groupBy("_gcol", "_block").agg(F.sum("_cover").alias("_cover"), F.lit(False).alias("_cells"))
        blocks = met.unionByName(whole).groupBy("_gcol", "_block").agg(F.sum("_cover").alias("_cover"), F.max("_cells").alias("_cells"))
        carried = blocks.selectExpr("_gcol", "_block", f"_block * {block_rows} AS _grow", "0D AS _local", "_cells",
                                    "sum(_cover) OVER (PARTITION BY _gcol ORDER BY _block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _cover")
        edges = edges.unionByName(carried.where("_cells AND _cover <> 0").drop("_cells"))
    down = f"(PARTITION BY {column} ORDER BY _grow RANGE BETWEEN"
    walked = marked.unionByName(edges, allowMissingColumns=True).selectExpr(
        "*", f"coalesce(sum(_cover) OVER {down} UNBOUNDED PRECEDING AND CURRENT ROW), 0L) / {scale}D"
             f" + coalesce(sum(_local) OVER {down} CURRENT ROW AND CURRENT ROW), 0D) AS _share")
    return walked.where(f"_is_cell AND _share > {touch_share(grid)!r}D").select(*cells.columns)


def zone_cells(zones: DataFrame, grid: Grid, key: str = "code") -> DataFrame:
    """Cells of every zone, partial ones included: ``CELL_KEY, key, fraction``."""
    strips = tile_strips(zone_spans(zones, grid, key), grid)
    return span_cells(spread(strips, key, "gcol", "tile_row").drop("tile_row"), grid)


def tile_strips(spans: DataFrame, grid: Grid) -> DataFrame:
    """Spans cut at tile borders, with their ``tile_row``."""
    px = grid.px
    rest = [c for c in spans.columns if c not in ("row_from", "row_to")]
    cut = spans.selectExpr("*", f"explode(sequence(row_from div {px}, row_to div {px}, 1L)) AS tile_row")
    return cut.selectExpr(*rest, "tile_row", f"greatest(row_from, tile_row * {px}) AS row_from",
                          f"least(row_to, tile_row * {px} + {px - 1}) AS row_to")


def zone_spans(zones: DataFrame, grid: Grid, key: str = "code", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """As ``zone_cells``, as runs of rows in a column: what zones are stored and joined as."""
    outline = outline_cells(usable_areas(zones.select(key, "rings")), grid, [key], long_outlines=True)
    return coverage_spans(outline, grid, [key], block_rows)


def cells_by_zone(cells: DataFrame, spans: DataFrame, grid: Grid, key: str = "code") -> DataFrame:
    """Attach to each cell every zone it lies in; a border cell belongs to several zones.

    Spans are cut at tile rows, so cells and spans meet on (column of cells, tile row): at most ``px`` cells.
    """
    strips = tile_strips(spans, grid).selectExpr(key, "gcol AS _gcol", "tile_row", "row_from", "row_to")
    marked = cells.select("*", grid.gcol().alias("_gcol"), grid.grow().alias("_grow"))
    joined = marked.join(strips, ["_gcol", "tile_row"]).where(F.col("_grow").between(F.col("row_from"), F.col("row_to")))
    return joined.select(key, *cells.columns)


def touched_tiles(polygons: DataFrame, grid: Grid) -> DataFrame:
    """Distinct tiles that the polygons' bounding boxes touch: few rows, and enough to leave the rest of the world out."""
    return box_tiles(usable_areas(polygons), grid).select(*TILE_KEY).distinct()


def box_tiles(polygons: DataFrame, grid: Grid) -> DataFrame:
    """Each polygon once for every tile that its bounding box touches."""
    outer = F.get("rings", F.lit(0))

    def edge(pick, axis: str):
        return pick(F.transform(outer, lambda p: p[axis]))

    bounds = grid.key_bounds(edge(F.array_min, "x"), edge(F.array_min, "y"), edge(F.array_max, "x"), edge(F.array_max, "y"))
    boxed = polygons.withColumns({f"_{n}": v for n, v in bounds.items()})
    boxed = boxed.withColumn("tile_col", F.explode(F.sequence("_col_min", "_col_max")))
    return boxed.withColumn("tile_row", F.explode(F.sequence("_row_min", "_row_max"))).drop(*[f"_{n}" for n in bounds])


def pixels_in_tiles(pixels: DataFrame, tiles: DataFrame, grid: Grid) -> DataFrame:
    """Pixels whose centre lies in one of ``tiles``. The tiles' common box filters ``lon`` and ``lat`` in the scan already."""
    ends = tiles.agg(F.min("tile_col").alias("c0"), F.max("tile_col").alias("c1"), F.min("tile_row").alias("r0"), F.max("tile_row").alias("r1"))
    west, east = grid.tile_extent_lonlat(F.col("c0"), F.col("r1")), grid.tile_extent_lonlat(F.col("c1"), F.col("r0"))

    def bound(value) -> Column:
        return ends.select(value.alias("bound")).scalar()

    lon, lat, margin = F.col("lon"), F.col("lat"), F.lit(1e-6)  # rounding must not lose a pixel on the border
    near = pixels.where((lon >= bound(west["lon_min"] - margin)) & (lon <= bound(east["lon_max"] + margin))
                        & (lat >= bound(west["lat_min"] - margin)) & (lat <= bound(east["lat_max"] + margin)))
    keys = {"tile_col": grid.tile_col(lon_to_x(lon)), "tile_row": grid.tile_row(lat_to_y(lat))}
    return near.withColumns(keys).join(tiles, TILE_KEY, "left_semi").select(*pixels.columns)


def in_tiles(polygons: DataFrame, tiles: DataFrame, grid: Grid) -> DataFrame:
    """Polygons whose bounding box touches one of ``tiles``, mended or not: mending moves no outline out of its box, and what
    isn't finite or lies outside the world can't be mended and is left out. Polygons are known by a hash of their rings, so
    that only hashes are multiplied by tiles; should two share one, a polygon too many stays."""
    known = polygons.withColumn("_shape", F.xxhash64("rings"))
    outlines = known.selectExpr("_shape", "array(get(filter(rings, r -> r IS NOT NULL), 0)) AS rings")
    points = "get(rings, 0)"
    furthest = ", ".join(f"abs(array_{end}(transform({points}, p -> p.{axis})))" for axis in "xy" for end in ("min", "max"))
    outlines = outlines.where(f"greatest({furthest}) <= {WORLD_HALF_WIDTH}D * (1 + 1e-12D)")
    touching = box_tiles(outlines, grid).select("_shape", *TILE_KEY).join(tiles, TILE_KEY, "left_semi")
    return known.join(touching.select("_shape").distinct(), "_shape", "left_semi").drop("_shape")


def tiles_for_geometry(zones: DataFrame, grid: Grid, key: str = "code") -> DataFrame:
    """Tiles touched by each zone: ``key, tile_col, tile_row``."""
    return zone_cells(zones, grid.with_px(1), key).select(key, *TILE_KEY)
