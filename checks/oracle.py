"""The same results in plain SQL for another engine, over the same tables.

Written independently of the operators where there is more than one way to compute a thing: coverage is the
integral of each edge over each cell of a bounding box (the operators book edge pieces and walk down
columns), ground areas project the four corners of a tile, nearest neighbours rank all pairs.
"""

from __future__ import annotations

import math

W = "20037508.342789244::DOUBLE"
R = "6378137.0::DOUBLE"


def q(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(dict.fromkeys(ctes)) + "\n" + select if ctes else select


def lon(k: str, a: int) -> str:
    return f"(25.5::DOUBLE + (({k} * {a}) % 10000)::DOUBLE / 10000::DOUBLE)"


def lat(k: str, b: int) -> str:
    return f"((-25)::DOUBLE + (({k} * {b}) % 10007)::DOUBLE / 10007::DOUBLE)"


def to_x(expr: str) -> str:
    return f"(radians({expr}) * {R})"


def to_y(expr: str) -> str:
    return f"({R} * ln(tan(pi() / 4 + radians({expr}) / 2)))"


def tile(zoom: int = 12) -> str:
    return f"({W} * 2 / {1 << zoom}::DOUBLE)"


def cell(px: int, zoom: int = 12) -> str:
    return f"({W} * 2 / {(1 << zoom)}::DOUBLE / {px}::DOUBLE)"


def split(px: int) -> str:
    return f"gc // {px} AS tile_col, gr // {px} AS tile_row, gc % {px} AS cell_col, gr % {px} AS cell_row"


# -- inputs -----------------------------------------------------------------------------------------------------

PIX = f"""pix AS (SELECT *, {to_x('lon')} AS x, {to_y('lat')} AS y FROM (
    SELECT o_orderkey AS k, {lon('o_orderkey', 7919)} AS lon, {lat('o_orderkey', 104729)} AS lat, o_totalprice AS value FROM orders))"""

BLD = f"""bld AS (SELECT p_partkey AS k, round({to_x(lon('p_partkey', 15485863))}, 3) AS x,
    round({to_y(lat('p_partkey', 32452843))}, 3) AS y, p_size::DOUBLE + 5 AS w, p_size::DOUBLE / 2 + 5 AS h FROM part)"""

# vertices of boxes (even keys) and diamonds (odd keys), holes at half size for every fifth key
VERT = """corner(odd, i, fx, fy) AS (VALUES (0, 0, -1, -1), (0, 1, 1, -1), (0, 2, 1, 1), (0, 3, -1, 1), (0, 4, -1, -1),
    (1, 0, -1, 0), (1, 1, 0, -1), (1, 2, 1, 0), (1, 3, 0, 1), (1, 4, -1, 0)),
ringof(ring, f) AS (VALUES (0, 1.0::DOUBLE), (1, 0.5::DOUBLE)),
vert AS (SELECT k, ring, i, x + fx * f * w AS x, y + fy * f * h AS y
    FROM bld JOIN corner ON k % 2 = odd JOIN ringof ON ring = 0 OR k % 5 = 0)"""

LEVEL_TEXT = """CASE k % 8 WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN '2.5' WHEN 4 THEN '2;3' WHEN 5 THEN '1' WHEN 7 THEN ' 4 ' END"""
LEVELS = f"CASE WHEN {LEVEL_TEXT} IS NULL THEN 1::DOUBLE ELSE try_cast({LEVEL_TEXT} AS DOUBLE) END"
IS_BUILDING = "k % 11 <> 0 AND k % 13 <> 0"


def edges(name: str = "edge", vert: str = "vert", key: str = "k", ring: str = "ring") -> str:
    """Edges of counter-clockwise rings; those of holes count negative."""
    return f"""{name} AS (SELECT a.{key}, CASE WHEN a.{ring} = 0 THEN 1 ELSE -1 END AS s, a.x AS xa, a.y AS ya, b.x AS xb, b.y AS yb
    FROM {vert} a JOIN {vert} b ON a.{key} = b.{key} AND a.{ring} = b.{ring} AND b.i = a.i + 1 WHERE a.x <> b.x)"""


def box_cells(name: str, edge: str, px: int, zoom: int = 12, key: str = "k") -> str:
    """All cells of the bounding box of every polygon."""
    c = cell(px, zoom)
    return f"""{name} AS (SELECT {key}, gc, unnest(range(r0, r1 + 1)) AS gr FROM (
      SELECT {key}, unnest(range(c0, c1 + 1)) AS gc, r0, r1 FROM (
        SELECT {key}, floor((min(least(xa, xb)) + {W}) / {c})::BIGINT AS c0, floor((max(greatest(xa, xb)) + {W}) / {c})::BIGINT AS c1,
          floor(({W} - max(greatest(ya, yb))) / {c})::BIGINT AS r0, floor(({W} - min(least(ya, yb))) / {c})::BIGINT AS r1
        FROM {edge} GROUP BY {key})))"""


def fractions(name: str, cand: str, edge: str, px: int, zoom: int = 12, key: str = "k") -> str:
    """Covered share of every candidate cell: the height of each edge above the cell's floor, clamped to the cell
    and integrated along the cell's width."""
    c = cell(px, zoom)
    g = "CASE WHEN {t} <= 0 THEN 0 WHEN {t} <= h THEN {t} * {t} / 2 ELSE h * h / 2 + h * ({t} - h) END"
    return f"""{name} AS (SELECT {key}, gc, gr, abs(sum(s * CASE WHEN abs(v - u) < 1e-9 THEN (cb - ca) * least(greatest(u, 0), h)
        ELSE (cb - ca) * ({g.format(t='v')} - {g.format(t='u')}) / (v - u) END)) / ({c} * {c}) AS fraction
      FROM (SELECT {key}, gc, gr, s, h, ca, cb, ya - y0 + (yb - ya) * (ca - xa) / (xb - xa) AS u, ya - y0 + (yb - ya) * (cb - xa) / (xb - xa) AS v
        FROM (SELECT d.{key}, d.gc, d.gr, s, xa, ya, xb, yb, {c} AS h, {W} - (d.gr + 1) * {c} AS y0,
            least(greatest(xa, d.gc * {c} - {W}), (d.gc + 1) * {c} - {W}) AS ca, least(greatest(xb, d.gc * {c} - {W}), (d.gc + 1) * {c} - {W}) AS cb
          FROM {cand} d JOIN {edge} e ON d.{key} = e.{key}))
      WHERE ca <> cb GROUP BY {key}, gc, gr HAVING fraction > {4 / 2 ** (52 - math.ceil(math.log2((1 << zoom) * px)))!r})"""


# Albers equal-area, lat_1=20 lat_2=-23 lat_0=0 lon_0=25 on WGS84
A_N, A_C = "(-0.024384703378504177::DOUBLE)", "0.8671371403218877::DOUBLE"
E2 = "0.0066943799901413165::DOUBLE"


def albers(lon_rad: str, lat_rad: str, axis: str) -> str:
    s, e = f"sin({lat_rad})", f"sqrt({E2})"
    qq = f"((1 - {E2}) * ({s} / (1 - {E2} * {s} * {s}) - ln((1 - {e} * {s}) / (1 + {e} * {s})) / (2 * {e})))"
    rho = f"({R} * sqrt({A_C} - {A_N} * {qq}) / {A_N})"
    turn = f"({A_N} * ({lon_rad} - radians(25::DOUBLE)))"
    return f"{rho} * {'sin' if axis == 'x' else 'cos'}({turn})"


def tile_areas(tiles: str, name: str = "tile_area", zoom: int = 12) -> str:
    """Area of the quadrilateral through the projected corners of each tile."""
    t = tile(zoom)
    lon_of = lambda c: f"(({c} * {t} - {W}) / {R})"
    lat_of = lambda r: f"(2 * atan(exp(({W} - {r} * {t}) / {R})) - pi() / 2)"
    pts = [("tile_col", "(tile_row + 1)"), ("(tile_col + 1)", "(tile_row + 1)"), ("(tile_col + 1)", "tile_row"), ("tile_col", "tile_row")]
    cols = ", ".join(f"{albers(lon_of(c), lat_of(r), ax)} AS p{ax}{i}" for i, (c, r) in enumerate(pts) for ax in "xy")
    cross = " + ".join(f"((px{i} - px0) * (py{(i + 1) % 4} - py0) - (px{(i + 1) % 4} - px0) * (py{i} - py0))" for i in range(4))
    return f"{name} AS (SELECT tile_col, tile_row, abs({cross}) / 2 AS area FROM (SELECT tile_col, tile_row, {cols} FROM (SELECT DISTINCT tile_col, tile_row FROM {tiles})))"


def pop(px: int, name: str = "pop", zoom: int = 12) -> str:
    c = cell(px, zoom)
    return f"""{name}_g AS (SELECT floor((x + {W}) / {c})::BIGINT AS gc, floor(({W} - y) / {c})::BIGINT AS gr, sum(value) AS pop FROM pix GROUP BY 1, 2),
{name} AS (SELECT {split(px)}, pop FROM {name}_g)"""


def osm(px: int, name: str = "osm", zoom: int = 12, bld: str = "bld", clip: bool = False) -> list[str]:
    """Footprint per cell, from the exact share of every building in every cell of its box."""
    p = name
    vert = VERT.replace("vert AS", f"{p}_vert AS").replace("corner(", f"{p}_corner(").replace("ringof(", f"{p}_ringof(").replace(
        "FROM bld JOIN corner", f"FROM {bld} JOIN {p}_corner").replace("JOIN ringof", f"JOIN {p}_ringof")
    inside = ""
    if clip:
        inside = f" AND gc // {px} = floor((b.x + {W}) / {tile(zoom)})::BIGINT AND gr // {px} = floor(({W} - b.y) / {tile(zoom)})::BIGINT"
    return [
        BLD, vert, edges(f"{p}_edge", f"{p}_vert"), box_cells(f"{p}_cand", f"{p}_edge", px, zoom),
        fractions(f"{p}_frac", f"{p}_cand", f"{p}_edge", px, zoom),
        f"""{p}_sum AS (SELECT {split(px)}, sum(fraction * lv) AS covered FROM (
            SELECT f.gc, f.gr, f.fraction, {LEVELS.replace('k %', 'f.k %')} AS lv FROM {p}_frac f JOIN {bld} b ON f.k = b.k
            WHERE {IS_BUILDING.replace('k %', 'f.k %')}{inside}) WHERE lv IS NOT NULL GROUP BY gc, gr)""",
        tile_areas(f"{p}_sum", f"{p}_area", zoom),
        f"""{name} AS (SELECT s.tile_col, s.tile_row, cell_col, cell_row, covered * area / {px * px} AS osm
            FROM {p}_sum s JOIN {p}_area a ON s.tile_col = a.tile_col AND s.tile_row = a.tile_row)"""]


def both(px: int, name: str = "joined", zoom: int = 12, pop_name: str = "pop", osm_name: str = "osm") -> str:
    """Cells of both layers laid on top of each other, in tiles that hold population."""
    return f"""{name} AS (SELECT tile_col, tile_row, cell_col, cell_row, max(pop) AS pop, max(osm) AS osm FROM (
      SELECT tile_col, tile_row, cell_col, cell_row, pop, NULL::DOUBLE AS osm FROM {pop_name} UNION ALL
      SELECT tile_col, tile_row, cell_col, cell_row, NULL::DOUBLE, osm FROM {osm_name}
      WHERE (tile_col, tile_row) IN (SELECT (tile_col, tile_row) FROM {pop_name})) GROUP BY ALL)"""


def analysis(px: int, zoom: int = 12) -> list[str]:
    return [PIX, pop(px, zoom=zoom), *osm(px, zoom=zoom), both(px)]


def fit(name: str, cells: str, y: str = "osm") -> str:
    return f"""{name}_slope AS (SELECT sum(pop * {y}) / nullif(sum(pop * pop), 0) AS coefficient FROM {cells} WHERE pop IS NOT NULL AND {y} IS NOT NULL),
{name} AS (SELECT any_value(coefficient) AS coefficient, count(*) AS n, sqrt(avg(power({y} - coefficient * pop, 2))) AS rmse,
    1 - sum(power({y} - coefficient * pop, 2)) / nullif(sum({y} * {y}), 0) AS r2
    FROM {cells}, {name}_slope WHERE pop IS NOT NULL AND {y} IS NOT NULL)"""


def model(name: str = "model") -> str:
    return f"SELECT round(coefficient, 9) AS coefficient, n, round(rmse, 4) AS rmse, round(r2, 6) AS r2 FROM {name}"


def scored(px: int) -> list[str]:
    return [*analysis(px), fit("model", "joined"), "scored AS (SELECT joined.*, coefficient * pop AS prediction FROM joined, model)"]


def stats(cells: str = "scored", name: str = "stats") -> str:
    sums = ", ".join(f"sum({b}) AS {b}_sum, count({b}) AS {b}_count" for b in ("pop", "osm", "prediction"))
    return f"{name} AS (SELECT tile_col, tile_row, {sums} FROM {cells} GROUP BY tile_col, tile_row)"


def completeness(name: str = "report", stats_name: str = "stats") -> str:
    a, e = "coalesce(osm_sum, 0)", "coalesce(prediction_sum, 0)"
    return f"""{name} AS (SELECT tile_col, tile_row, ({a} - {e}) / nullif({e}, 0) AS index, pop_sum, {a} AS osm_sum,
    {a} / nullif(osm_count, 0) AS osm_avg, {e} AS prediction_sum, {e} / nullif(pop_count, 0) AS prediction_avg FROM {stats_name})"""


def report(name: str = "report", key: str = "tile_col, tile_row") -> str:
    sums = ", ".join(f"round({c}, 2) AS {c}" for c in ("pop_sum", "osm_sum", "osm_avg", "prediction_sum", "prediction_avg"))
    return f"SELECT {key}, round(index, 6) AS index, {sums} FROM {name}"


SUP = f"""sup AS (SELECT s_suppkey AS k, round({to_x(lon('s_suppkey', 6271))}, 3) AS x, round({to_y(lat('s_suppkey', 7919))}, 3) AS y,
    1500::DOUBLE + 500 * (s_suppkey % 7) AS r FROM supplier)"""
SUP_VERT = """sup_corner(i, fx, fy) AS (VALUES (0, -1, 0), (1, 0, -1), (2, 1, 0), (3, 0, 1), (4, -1, 0)),
sup_vert AS (SELECT k, 0 AS ring, i, x + fx * r AS x, y + fy * r AS y FROM sup, sup_corner)"""


def masked(cells: str, px: int, name: str) -> list[str]:
    """Cells with a positive share in any labelled area; candidates are cells inside an area's bounding box."""
    c = cell(px)
    return [SUP, SUP_VERT, edges("sup_edge", "sup_vert"),
            f"""{name}_cand AS (SELECT k, gc, gr FROM (SELECT tile_col * {px} + cell_col AS gc, tile_row * {px} + cell_row AS gr FROM {cells}) c
              JOIN sup ON c.gc * {c} - {W} < x + r AND (c.gc + 1) * {c} - {W} > x - r AND {W} - c.gr * {c} > y - r AND {W} - (c.gr + 1) * {c} < y + r)""",
            fractions(f"{name}_frac", f"{name}_cand", "sup_edge", px),
            f"""{name} AS (SELECT c.* FROM {cells} c SEMI JOIN {name}_frac f
              ON c.tile_col * {px} + c.cell_col = f.gc AND c.tile_row * {px} + c.cell_row = f.gr)"""]


def coarser(cells: str, px: int, to: int, band: str, name: str) -> str:
    s = px // to
    return f"""{name} AS (SELECT tile_col, tile_row, cell_col // {s} AS cell_col, cell_row // {s} AS cell_row, sum({band}) AS {band}
    FROM {cells} GROUP BY ALL)"""


def labeled_model(mask_both: bool = False) -> list[str]:
    out = [PIX, pop(256, "pop256"), *masked("pop256", 256, "pop_in"), coarser("pop_in", 256, 4, "pop", "pop_lab")]
    if mask_both:
        out += [*osm(256, "osm256"), *masked("osm256", 256, "osm_in"), coarser("osm_in", 256, 4, "osm", "osm_lab")]
    else:
        out += osm(4, "osm_lab")
    return out + [both(4, "lab", pop_name="pop_lab", osm_name="osm_lab"),
                  "lab_filled AS (SELECT * REPLACE (coalesce(osm, 0) AS osm) FROM lab WHERE pop IS NOT NULL)", fit("model", "lab_filled")]


ZON = """zon AS (SELECT 'N' || n_nationkey AS k, 'Nation ' || n_nationkey AS name, 25.5::DOUBLE + (n_nationkey % 5)::DOUBLE / 5 AS w,
    (-25)::DOUBLE + (n_nationkey // 5)::DOUBLE / 5 AS s FROM nation)"""
ZON_EDGE = f"""zon_edge AS (SELECT k, 1 AS s, {to_x('w')} AS xa, {to_y('s')} AS ya, {to_x('w + 0.2::DOUBLE')} AS xb, {to_y('s')} AS yb FROM zon
    UNION ALL SELECT k, 1, {to_x('w + 0.2::DOUBLE')}, {to_y('s + 0.2::DOUBLE')}, {to_x('w')}, {to_y('s + 0.2::DOUBLE')} FROM zon)"""


def zone_fractions(px: int, name: str = "zf") -> list[str]:
    return [ZON, ZON_EDGE, box_cells(f"{name}_cand", "zon_edge", px), fractions(name, f"{name}_cand", "zon_edge", px)]


def cells_in_zones(cells: str, px: int, name: str) -> list[str]:
    """Pairs of data cell and zone, the candidates taken from the zones' boxes."""
    c = cell(px)
    return [ZON, ZON_EDGE,
            f"""{name}_cand AS (SELECT b.k, gc, gr FROM (SELECT tile_col * {px} + cell_col AS gc, tile_row * {px} + cell_row AS gr FROM {cells}) c
              JOIN (SELECT k, min(least(xa, xb)) AS x0, max(greatest(xa, xb)) AS x1, min(least(ya, yb)) AS y0, max(greatest(ya, yb)) AS y1 FROM zon_edge GROUP BY k) b
              ON c.gc * {c} - {W} < x1 AND (c.gc + 1) * {c} - {W} > x0 AND {W} - c.gr * {c} > y0 AND {W} - (c.gr + 1) * {c} < y1)""",
            fractions(f"{name}_frac", f"{name}_cand", "zon_edge", px),
            f"""{name} AS (SELECT f.k AS code, c.* FROM {cells} c JOIN {name}_frac f
              ON c.tile_col * {px} + c.cell_col = f.gc AND c.tile_row * {px} + c.cell_row = f.gr)"""]


SRC = "0.0008333::DOUBLE"
SRC_PIX = f"""src AS (SELECT floor((lon + 180::DOUBLE) / {SRC})::BIGINT AS pc, floor((90::DOUBLE - lat) / {SRC})::BIGINT AS pr,
    CASE WHEN k % 97 = 0 THEN NULL ELSE value END AS value FROM pix)"""
ONE_PIX = "one AS (SELECT pc, pr, sum(value) AS value FROM src WHERE value IS NOT NULL GROUP BY pc, pr)"
SRC_BLOCKS = """blocks AS (SELECT DISTINCT pc // 48 AS bc, pr // 48 AS br FROM one),
covered AS (SELECT tile_col, tile_row, sum((least(bc * 48 + 48, tile_col * 256 + 256) - greatest(bc * 48, tile_col * 256))
        * (least(br * 48 + 48, tile_row * 256 + 256) - greatest(br * 48, tile_row * 256)))::BIGINT AS n_pixels
    FROM (SELECT *, unnest(range(br * 48 // 256, (br * 48 + 47) // 256 + 1)) AS tile_row
        FROM (SELECT bc, br, unnest(range(bc * 48 // 256, (bc * 48 + 47) // 256 + 1)) AS tile_col FROM blocks)) GROUP BY ALL)"""
VT = f"""vt AS (SELECT k, floor((x + {W}) / {tile()})::BIGINT AS tile_col, floor(({W} - y) / {tile()})::BIGINT AS tile_row,
    CASE WHEN k % 13 = 0 THEN 'LineString' ELSE 'Polygon' END AS geom_type FROM bld)"""
KEYS = "tile_col, tile_row, cell_col, cell_row"
EXTENT = {"xmin": f"tile_col * {tile()} - {W}", "ymin": f"{W} - (tile_row + 1) * {tile()}",
          "xmax": f"(tile_col + 1) * {tile()} - {W}", "ymax": f"{W} - tile_row * {tile()}"}
LON_OF = "degrees(({}) / " + R + ")"
LAT_OF = "degrees(2 * atan(exp(({}) / " + R + ")) - pi() / 2)"


def _window() -> str:
    out = []
    for b in (0, 3):
        west = f"((tile_col * ({SRC} * 256) - 180::DOUBLE - 25.5::DOUBLE) / {SRC})"
        north = f"(((-24)::DOUBLE - 90::DOUBLE + tile_row * ({SRC} * 256)) / {SRC})"
        out += [f"floor(round({west}, 6))::BIGINT - {b} AS col_min_{b}", f"floor(round({north}, 6))::BIGINT - {b} AS row_min_{b}",
                f"ceil(round({west} + 256, 6))::BIGINT - 1 + {b} AS col_max_{b}", f"ceil(round({north} + 256, 6))::BIGINT - 1 + {b} AS row_max_{b}"]
    return ", ".join(out)


def _neighbours() -> list[str]:
    c = cell(16)
    moment = "(a.x - o.x) * (b.y - o.y) - (b.x - o.x) * (a.y - o.y)"
    return [BLD, VERT, f"""ring_m AS (SELECT a.k, CASE WHEN a.ring = 0 THEN 1 ELSE -1 END AS s, any_value(o.x) AS ox, any_value(o.y) AS oy, sum({moment}) / 2 AS a,
          sum((a.x - o.x + b.x - o.x) * ({moment})) / 6 AS mx, sum((a.y - o.y + b.y - o.y) * ({moment})) / 6 AS my
        FROM vert a JOIN vert b ON a.k = b.k AND a.ring = b.ring AND b.i = a.i + 1 JOIN vert o ON a.k = o.k AND a.ring = o.ring AND o.i = 0 GROUP BY a.k, a.ring)""",
        """poly AS (SELECT k, sum(s * abs(a)) AS area, sum(s * (sign(a) * mx + abs(a) * ox)) / nullif(sum(s * abs(a)), 0) AS cx,
          sum(s * (sign(a) * my + abs(a) * oy)) / nullif(sum(s * abs(a)), 0) AS cy FROM ring_m GROUP BY k)""",
        f"""pts AS (SELECT k, {LEVELS} * area AS weight, cx, cy, floor((cx + {W}) / {tile()})::BIGINT AS tile_col,
          floor(({W} - cy) / {tile()})::BIGINT AS tile_row FROM poly WHERE {IS_BUILDING} AND {LEVELS} IS NOT NULL)""",
        f"""ask AS (SELECT tile_col, tile_row, i AS cell_col, j AS cell_row, (tile_col * 16 + i + 0.5::DOUBLE) * {c} - {W} AS qx, {W} - (tile_row * 16 + j + 0.5::DOUBLE) * {c} AS qy
          FROM (SELECT DISTINCT tile_col, tile_row FROM pts), range(16) a(i), range(16) b(j))""",
        f"""near AS (SELECT {', '.join('ask.' + n for n in KEYS.split(', '))}, pts.k AS building_id, weight, sqrt((cx - qx) * (cx - qx) + (cy - qy) * (cy - qy)) AS distance
          FROM ask JOIN pts ON ask.tile_col = pts.tile_col AND ask.tile_row = pts.tile_row),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY distance, building_id) AS rank FROM near QUALIFY rank <= 25)"""]


def _defects() -> str:
    """Spoiled outer rings, judged vertex by vertex and edge pair by edge pair; a ring crossed at one point is two parts, the edges
    between the crossing ones and the others, both closed through that point."""
    pick = """CASE WHEN k % 17 = 0 THEN [0, 1, 2, 3, 0] WHEN k % 19 = 0 THEN [0, 1, 0] WHEN k % 23 = 0 THEN [0, 2, 1, 3, 0]
        WHEN k % 29 = 0 THEN [0, 1, 0, 1, 0] ELSE [0, 1, 2, 3, 4] END"""
    side = lambda s, p: f"(({s}.xb - {s}.xa) * ({p[1]} - {s}.ya) - ({s}.yb - {s}.ya) * ({p[0]} - {s}.xa))"
    pt = lambda s, e: (f"{s}.x{e}", f"{s}.y{e}")
    crossing = f"sign({side('s', pt('t', 'a'))}) * sign({side('s', pt('t', 'b'))}) < 0 AND sign({side('t', pt('s', 'a'))}) * sign({side('t', pt('s', 'b'))}) < 0"
    share = f"({side('t', pt('s', 'a'))} / ({side('t', pt('s', 'a'))} - {side('t', pt('s', 'b'))}))"
    return q([BLD, VERT,
              f"picked AS (SELECT k, unnest(l) AS i, unnest(range(len(l))) AS n FROM (SELECT k, {pick} AS l FROM bld))",
              "sv AS (SELECT p.k, n, x, y FROM picked p JOIN vert v ON p.k = v.k AND p.i = v.i AND v.ring = 0)",
              "se AS (SELECT a.k, a.n, a.x AS xa, a.y AS ya, b.x AS xb, b.y AS yb FROM sv a JOIN sv b ON a.k = b.k AND b.n = a.n + 1)",
              f"""crossed AS (SELECT s.k, s.n AS n0, t.n AS n1, s.xa + {share} * (s.xb - s.xa) AS px, s.ya + {share} * (s.yb - s.ya) AS py
                  FROM se s JOIN se t ON s.k = t.k AND t.n > s.n + 1 WHERE {crossing})""",
              """lobes AS (SELECT e.k, e.n > n0 AND e.n < n1 AS between, abs(sum((xa - px) * (yb - py) - (xb - px) * (ya - py))) / 2 AS area
                  FROM se e JOIN crossed c ON e.k = c.k WHERE e.n <> n0 AND e.n <> n1 GROUP BY e.k, between)""",
              """shape AS (SELECT k, count(*) AS points, arg_min(x, n) = arg_max(x, n) AND arg_min(y, n) = arg_max(y, n) AS closed FROM sv GROUP BY k)""",
              "turned AS (SELECT e.k, abs(sum((xa - ox) * (yb - oy) - (xb - ox) * (ya - oy))) / 2 AS area FROM se e JOIN (SELECT k, arg_min(x, n) AS ox, arg_min(y, n) AS oy FROM sv GROUP BY k) o ON e.k = o.k GROUP BY e.k)"],
             """SELECT building_id, defect, CASE WHEN defect IS NULL THEN round(left_over, 2) END AS area FROM (
                SELECT s.k AS building_id, area - CASE WHEN s.k % 5 = 0 THEN hole ELSE 0 END AS left_over, CASE WHEN points < 4 THEN 'ring of fewer than 4 points' WHEN NOT closed THEN 'open ring'
                WHEN area - CASE WHEN s.k % 5 = 0 THEN hole ELSE 0 END <= 0 THEN 'no area' END AS defect
                FROM shape s ANTI JOIN crossed c ON s.k = c.k LEFT JOIN turned t ON s.k = t.k
                JOIN (SELECT k, CASE WHEN k % 2 = 0 THEN w * h ELSE w * h / 2 END AS hole FROM bld) b ON s.k = b.k
                UNION ALL SELECT k, area, NULL FROM lobes)""")


def _cells(cells: str, **digits: int) -> str:
    return f"SELECT {KEYS}, {', '.join(f'round({c}, {n}) AS {c}' for c, n in digits.items())} FROM {cells}"


def _text(band: str) -> str:
    return (f"array_to_string(list(coalesce(round({band} * 100)::BIGINT::VARCHAR, '-') ORDER BY cell_row, cell_col), ',') AS {band}")


def _dense(px: int) -> str:
    return f"""dense AS (SELECT t.tile_col, t.tile_row, c.i AS cell_col, r.i AS cell_row, pop, osm, prediction
        FROM (SELECT DISTINCT tile_col, tile_row FROM scored) t, range({px}) c(i), range({px}) r(i)
        LEFT JOIN scored s ON t.tile_col = s.tile_col AND t.tile_row = s.tile_row AND c.i = s.cell_col AND r.i = s.cell_row)"""


def _levels(px: int) -> str:
    levels = []
    for zoom in range(12, -1, -1):
        f = 1 << (12 - zoom)
        levels.append(f"SELECT {zoom} AS zoom, {split(px)}, round(sum(pop), 2) AS pop FROM (SELECT gc // {f} AS gc, gr // {f} AS gr, pop FROM pop_g) GROUP BY gc, gr")
    return " UNION ALL ".join(levels)


def _pyramid() -> str:
    return q([PIX, pop(256)], _levels(256))


BARS = """(SELECT bucket, low + bucket * (high - low) / 100 AS low, low + (bucket + 1) * (high - low) / 100 AS high, count(*) AS cells
        FROM (SELECT low, high, least(coalesce(floor((pop - low) / nullif((high - low) / 100, 0)), 0), 99)::BIGINT AS bucket
              FROM pop, (SELECT min(pop) AS low, max(pop) AS high FROM pop)) GROUP BY bucket, low, high)"""


def _change() -> str:
    out = [*labeled_model(), pop(4), *osm(4), both(4), "bld_old AS (SELECT * FROM bld WHERE k % 10 <> 3)", *osm(4, "osm_old", bld="bld_old"),
           both(4, "joined_old", osm_name="osm_old")]
    for n, b in (("new", "joined"), ("old", "joined_old")):
        out += [f"scored_{n} AS (SELECT {b}.*, coefficient * pop AS prediction FROM {b}, model)", stats(f"scored_{n}", f"stats_{n}"),
                completeness(f"report_{n}", f"stats_{n}")]
    return q(out, """SELECT tile_col, tile_row, round(o.osm_sum, 2) AS osm_before, round(n.osm_sum, 2) AS osm_after, round(o.index, 6) AS index_before,
        round(n.index, 6) AS index_after, round(coalesce(n.osm_sum, 0) - coalesce(o.osm_sum, 0), 2) AS osm_change, round(n.index - o.index, 6) AS index_change
        FROM report_old o FULL JOIN report_new n USING (tile_col, tile_row)""")


SCORED_REPORT = [*scored(16), stats(), completeness()]

ORACLE: dict[str, str] = {
    "raster_tiles": q([PIX, SRC_PIX], """SELECT pc // 256 AS tile_col, pr // 256 AS tile_row, count(*) AS n_pixels, count(value) AS n_data,
        round(sum(value), 2) AS value_sum FROM src GROUP BY 1, 2 HAVING count(value) > 0"""),
    "raster_halo_tiles": q([PIX, SRC_PIX], """SELECT pc // 256 + dc AS tile_col, pr // 256 + dr AS tile_row, pc - (pc // 256 + dc) * 256 + 3 AS pixel_col,
        pr - (pr // 256 + dr) * 256 + 3 AS pixel_row, value, dc = 0 AND dr = 0 AS is_center
        FROM src, (VALUES (-1), (0), (1)) a(dc), (VALUES (-1), (0), (1)) b(dr)
        WHERE value IS NOT NULL AND pc BETWEEN (pc // 256 + dc) * 256 - 3 AND (pc // 256 + dc) * 256 + 258
          AND pr BETWEEN (pr // 256 + dr) * 256 - 3 AND (pr // 256 + dr) * 256 + 258"""),
    "drop_nodata_tiles": q(analysis(2, 15), f"""{_cells('joined b', pop=2, osm=1)} WHERE EXISTS (SELECT 1 FROM joined t
        WHERE t.tile_col = b.tile_col AND t.tile_row = b.tile_row AND t.osm IS NOT NULL)"""),
    "block_tiles": q([PIX, SRC_PIX, ONE_PIX, SRC_BLOCKS], """SELECT tile_col, tile_row, n_pixels, n_data, round(value_sum, 2) AS value_sum FROM covered
        JOIN (SELECT pc // 256 AS tile_col, pr // 256 AS tile_row, count(*) AS n_data, sum(value) AS value_sum FROM one GROUP BY 1, 2) USING (tile_col, tile_row)"""),
    "block_halo_tiles": q([PIX, SRC_PIX, ONE_PIX], """SELECT pc // 256 + dc AS tile_col, pr // 256 + dr AS tile_row, pc - (pc // 256 + dc) * 256 + 3 AS pixel_col,
        pr - (pr // 256 + dr) * 256 + 3 AS pixel_row, round(value, 2) AS value, dc = 0 AND dr = 0 AS is_center
        FROM one, (VALUES (-1), (0), (1)) a(dc), (VALUES (-1), (0), (1)) b(dr)
        WHERE pc BETWEEN (pc // 256 + dc) * 256 - 3 AND (pc // 256 + dc) * 256 + 258
          AND pr BETWEEN (pr // 256 + dr) * 256 - 3 AND (pr // 256 + dr) * 256 + 258"""),
    "normalize_nodata": q([PIX], "SELECT lon, lat, CASE WHEN k % 97 = 0 THEN NULL ELSE value END AS value FROM pix"),
    "layer_metadata": q([PIX, pop(256)], f"""SELECT *, round(min_tile_col * {tile()} - {W}, 3) AS xmin, round({W} - (max_tile_row + 1) * {tile()}, 3) AS ymin,
        round((max_tile_col + 1) * {tile()} - {W}, 3) AS xmax, round({W} - min_tile_row * {tile()}, 3) AS ymax, 'EPSG:3857' AS crs, 'float64' AS cell_type,
        12 AS zoom, 256 AS px FROM (SELECT min(tile_col) AS min_tile_col, max(tile_col) AS max_tile_col, min(tile_row) AS min_tile_row, max(tile_row) AS max_tile_row FROM pop)"""),
    "tile_lookup": q([BLD, VT, SUP], f"""SELECT tile_col, tile_row, k AS building_id, geom_type FROM vt WHERE (tile_col, tile_row) IN
        (SELECT (floor((x + {W}) / {tile()})::BIGINT, floor(({W} - y) / {tile()})::BIGINT) FROM sup)"""),
    "tile_scan": q([BLD, VT], "SELECT tile_col, tile_row, k AS building_id, geom_type FROM vt"),
    "country_lookup": q([ZON], """SELECT k AS code, name, round(w, 6) AS west, round(s, 6) AS south, round(w + 0.2::DOUBLE, 6) AS east,
        round(s + 0.2::DOUBLE, 6) AS north FROM zon WHERE k = 'NATION 7' OR replace(lower(name), ' ', '_') = replace(lower('NATION 7'), ' ', '_') ORDER BY k LIMIT 1"""),
    "training_polygons": q([SUP, SUP_VERT], """SELECT k, 0::BIGINT AS part, 0 AS ring_no, i::INT AS vertex_no, round(x, 3) AS x, round(y, 3) AS y FROM sup_vert"""),
    "report_json": q(SCORED_REPORT, report(key="'12/' || tile_col || '/' || tile_row AS tile")),
    "read_band": q(osm(16) + [PIX, pop(16), both(16)], _cells("joined", osm=2) + " WHERE osm IS NOT NULL"),
    "read_box": q(osm(16) + [PIX, pop(16), both(16)], _cells("joined", osm=2) + f""" WHERE osm IS NOT NULL
        AND tile_col BETWEEN floor((2872000 + {W}) / {tile()}) AND floor((2905500 + {W}) / {tile()})
        AND tile_row BETWEEN floor(({W} + 2790500) / {tile()}) AND floor(({W} + 2826000) / {tile()})"""),
    "lonlat_to_mercator": q([PIX], "SELECT lon, lat, round(x, 3) AS x, round(y, 3) AS y FROM pix"),
    "mercator_to_lonlat": q([PIX], f"""SELECT x, y, round({LON_OF.format('x')}, 6) AS lon, round({LAT_OF.format('y')}, 6) AS lat
        FROM (SELECT round(x, 3) AS x, round(y, 3) AS y FROM pix)"""),
    "point_to_tile": q([PIX], f"SELECT lon, lat, floor((x + {W}) / {tile()})::BIGINT AS tile_col, floor(({W} - y) / {tile()})::BIGINT AS tile_row FROM pix"),
    "tile_extent": q([PIX, pop(4)], "SELECT tile_col, tile_row, " + ", ".join(f"round({v}, 3) AS {n}" for n, v in EXTENT.items()) + ", "
                     + ", ".join(f"round({f.format(EXTENT[e])}, 6) AS {n}" for n, f, e in (
                         ("lon_min", LON_OF, "xmin"), ("lat_min", LAT_OF, "ymin"), ("lon_max", LON_OF, "xmax"), ("lat_max", LAT_OF, "ymax")))
                     + " FROM (SELECT DISTINCT tile_col, tile_row FROM pop)"),
    "extent_to_tiles": q([BLD], f"""SELECT building_id, tile_col, unnest(range(r0, r1 + 1)) AS tile_row FROM (SELECT building_id, unnest(range(c0, c1 + 1)) AS tile_col, r0, r1
        FROM (SELECT k AS building_id, floor((x - w + {W}) / {tile()})::BIGINT AS c0, floor((x + w + {W}) / {tile()})::BIGINT AS c1,
        floor(({W} - y - h) / {tile()})::BIGINT AS r0, floor(({W} - y + h) / {tile()})::BIGINT AS r1 FROM bld))"""),
    "tile_pixel_window": q([PIX, SRC_PIX], f"SELECT tile_col, tile_row, {_window()} FROM (SELECT DISTINCT pc // 256 AS tile_col, pr // 256 AS tile_row FROM src)"),
    "tile_grid": q([PIX, pop(4)], f"""SELECT '(' || c || ', ' || r || ')' AS name, i AS vertex_no, round({LON_OF.format(f'(c + dc) * {tile()} - {W}')}, 6) AS lon,
        round({LAT_OF.format(f'{W} - (r + dr) * {tile()}')}, 6) AS lat
        FROM (SELECT unnest(range(c0, c1 + 1)) AS c, r0, r1 FROM (SELECT min(tile_col) c0, max(tile_col) c1, min(tile_row) r0, max(tile_row) r1 FROM pop)) a,
        LATERAL (SELECT unnest(range(r0, r1 + 1)) AS r) b, (VALUES (0, 0, 1), (1, 1, 1), (2, 1, 0), (3, 0, 0), (4, 0, 1)) v(i, dc, dr)"""),
    "zone_cover": q([*zone_fractions(1), """full_squares AS (SELECT k, l::INT AS l, gc >> l AS c, gr >> l AS r FROM zf, range(7) levels(l)
        GROUP BY ALL HAVING count(*) = 1 << (2 * l))"""], """SELECT k AS code, l AS level, c AS square_col, r AS square_row FROM full_squares f
        WHERE NOT EXISTS (SELECT 1 FROM full_squares g WHERE g.k = f.k AND g.l = f.l + 1 AND g.c = f.c >> 1 AND g.r = f.r >> 1)"""),
    "tiles_for_geometry": q(zone_fractions(1), "SELECT k AS code, gc AS tile_col, gr AS tile_row FROM zf"),
    "tms_row_flip": q([BLD, VT], "SELECT k AS building_id, 4095 - tile_row AS tile_row, tile_row AS north_row FROM vt"),
    "cell_area_m2": q([BLD, VT, tile_areas("vt")], "SELECT tile_col, tile_row, round(area / 65536, 6) AS cell_area_m2 FROM tile_area"),
    "building_filter": "SELECT p_partkey AS building_id FROM part WHERE p_partkey % 11 <> 0",
    "polygon_only": "SELECT p_partkey AS building_id FROM part WHERE p_partkey % 13 <> 0",
    "building_levels": f"SELECT k AS building_id, {LEVELS} AS levels FROM (SELECT p_partkey AS k FROM part)",
    "valid_polygons": _defects(),
    "filter_both_valid": q(analysis(16), _cells("joined", pop=2, osm=2) + " WHERE pop IS NOT NULL AND osm IS NOT NULL"),
    "fill_missing_footprint": q(analysis(16) + ["filled AS (SELECT * REPLACE (coalesce(osm, 0) AS osm) FROM joined WHERE pop IS NOT NULL)"], _cells("filled", pop=2, osm=2)),
    "slug": "SELECT p_partkey AS k, replace(lower(p_name || ' ' || p_type), ' ', '_') AS slug FROM part",
    "cell_center": q([PIX, pop(256)], f"""SELECT {KEYS}, round((tile_col * 256 + cell_col + 0.5::DOUBLE) * {cell(256)} - {W}, 3) AS x,
        round({W} - (tile_row * 256 + cell_row + 0.5::DOUBLE) * {cell(256)}, 3) AS y FROM pop"""),
    "polygon_measures": q(_neighbours()[:4], f"""SELECT k AS building_id, round(cx, 3) AS cx, round(cy, 3) AS cy, round(area, 2) AS area,
        round(sqrt(power(cx - (floor((cx + {W}) / {tile()}) * {tile()} - {W}), 2) + power(cy - ({W} - (floor(({W} - cy) / {tile()}) + 1) * {tile()}), 2)), 3) AS to_corner FROM poly"""),
    "tile_key_string": q([PIX], f"""SELECT lon, lat, '12/' || floor((x + {W}) / {tile()})::BIGINT || '/' || floor(({W} - y) / {tile()})::BIGINT AS tile FROM pix"""),
    "pop_with_footprint": q(analysis(16), _cells("joined", pop=2, osm=2)),
    "mask_cells": q([PIX, pop(256), *masked("pop", 256, "pop_in")], _cells("pop_in", pop=2)),
    "footprint_fraction": q([BLD, VERT, edges(), box_cells("cand", "edge", 256), fractions("frac", "cand", "edge", 256)],
                            f"SELECT {split(256)}, k AS building_id, round(fraction, 5) AS fraction FROM frac WHERE k % 13 <> 0"),
    "zone_cells": q(zone_fractions(16), f"SELECT {split(16)}, k AS code, round(fraction, 5) AS fraction FROM zf"),
    "knn_density_join": q(_neighbours(), f"SELECT {KEYS}, building_id, round(distance, 3) AS distance, rank::INT AS rank FROM ranked"),
    "country_footprint": q([*osm(12), *zone_fractions(1)], _cells("osm", osm=2) + " WHERE (tile_col, tile_row) IN (SELECT (gc, gr) FROM zf WHERE k = 'N12')"),
    "coverage_change": _change(),
    "pop_grid": q([PIX, pop(256)], _cells("pop", pop=2)),
    "resample_sum": q([*analysis(256), "small AS (SELECT tile_col, tile_row, cell_col // 64 AS cell_col, cell_row // 64 AS cell_row, sum(pop) AS pop, sum(osm) AS osm FROM joined GROUP BY ALL)"],
                      _cells("small", pop=2, osm=2)),
    "resample_multiband": q([*analysis(16), """bands AS (SELECT tile_col, tile_row, cell_col, cell_row, 0 AS band, pop AS value FROM joined WHERE pop IS NOT NULL
        UNION ALL SELECT tile_col, tile_row, cell_col, cell_row, 1, osm FROM joined WHERE osm IS NOT NULL)"""],
                            "SELECT tile_col, tile_row, cell_col // 4 AS cell_col, cell_row // 4 AS cell_row, band, round(sum(value), 2) AS value FROM bands GROUP BY ALL"),
    "footprint_grid": q(osm(256), _cells("osm", osm=2)),
    "footprint_grid_clipped": q(osm(256, clip=True), _cells("osm", osm=2)),
    "explode_tiles": q([*scored(16), _dense(16)], _cells("dense", pop=2, osm=2, prediction=2)),
    "assemble_tiles": q([*scored(16), _dense(16)], f"SELECT tile_col, tile_row, count(*) AS size, {_text('pop')}, {_text('osm')} FROM dense GROUP BY tile_col, tile_row"),
    "tile_stats": q([*scored(16), stats()], "SELECT tile_col, tile_row, " + ", ".join(f"round({b}_sum, 2) AS {b}_sum, {b}_count" for b in ("pop", "osm", "prediction")) + " FROM stats"),
    "zonal_building_area": q([*osm(64), *zone_fractions(64), *cells_in_zones("osm", 64, "zo")],
                             """SELECT n.k AS code, round(coalesce(a.area_m2, 0), 2) AS area_m2, n.cells FROM (SELECT k, count(*) AS cells FROM zf GROUP BY k) n
                                LEFT JOIN (SELECT code, sum(osm) AS area_m2 FROM zo GROUP BY code) a ON n.k = a.code"""),
    "cell_histogram": q([PIX, pop(4)], f"SELECT bucket, round(low, 2) AS low, round(high, 2) AS high, cells FROM {BARS}"),
    "pyramid_sum": _pyramid(),
    "fit_through_origin": q([*analysis(16), fit("model", "joined")], model()),
    "predict_footprint": q(scored(16), _cells("scored", pop=2, osm=2, prediction=2)),
    "completeness_index": q(SCORED_REPORT, report()),
    "fit_quality": q(scored(16), """SELECT count(*) AS n, round(sqrt(avg((osm - prediction) * (osm - prediction))), 4) AS rmse,
        round(1 - sum((osm - prediction) * (osm - prediction)) / nullif(sum(osm * osm), 0), 6) AS r2 FROM scored WHERE osm IS NOT NULL AND prediction IS NOT NULL"""),
    "fit_per_country": q([*analysis(64), *cells_in_zones("joined", 64, "zb"),
                          "zsum AS (SELECT code, tile_col, tile_row, cell_col // 16 AS cc, cell_row // 16 AS cr, sum(pop) AS pop, sum(osm) AS osm FROM zb GROUP BY ALL)",
                          "zslope AS (SELECT code, sum(pop * osm) / nullif(sum(pop * pop), 0) AS coefficient FROM zsum WHERE pop IS NOT NULL AND osm IS NOT NULL GROUP BY code)",
                          """zerror AS (SELECT code, coefficient, osm, osm - coefficient * pop AS e FROM zsum JOIN zslope USING (code) WHERE pop IS NOT NULL AND osm IS NOT NULL)"""],
                         """SELECT code, round(any_value(coefficient), 9) AS coefficient, count(*) AS n, round(sqrt(avg(e * e)), 4) AS rmse,
                            round(1 - sum(e * e) / nullif(sum(osm * osm), 0), 6) AS r2 FROM zerror GROUP BY code"""),
    "tile_totals": q([*scored(4), stats()], "SELECT tile_col, tile_row, round(pop_sum, 2) AS population, round(osm_sum, 2) AS actual, round(prediction_sum, 2) AS expected FROM stats"),
    "knn_density": q(_neighbours(), f"SELECT {KEYS}, round(sum(weight) / nullif(pi() * max(distance) * max(distance), 0), 7) AS density FROM ranked GROUP BY {KEYS}"),
    "train_unlabeled": q([*analysis(16), fit("model", "joined")], model()),
    "train_labeled": q(labeled_model(), model()),
    "train_labeled_mask_both": q(labeled_model(mask_both=True), model()),
    "predict_unlabeled": q(SCORED_REPORT, report()),
    "stored_model": q(SCORED_REPORT, report()),
    "stored_pyramid": q([PIX, pop(4)], f"{_levels(4)} UNION ALL SELECT -1, bucket, cells, 0, 0, round(low, 2) FROM {BARS}"),
    "predict_labeled": q([*labeled_model(), pop(4), *osm(4), both(4), "scored AS (SELECT joined.*, coefficient * pop AS prediction FROM joined, model)", stats(), completeness()], report()),
}
