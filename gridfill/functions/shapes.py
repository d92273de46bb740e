"""Ring, tag and name expressions. A polygon is ``rings ARRAY<ARRAY<STRUCT<x,y>>>``: outer ring, then holes.

Written as SQL text and parsed once each: nested lambdas built call by call from Python take longer to build
than to run. Arguments are SQL texts too, usually column names.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridfill.functions.mercator import WORLD_HALF_WIDTH


RUN = 16


def segments_sql(ring: str) -> str:
    """The edges of a ring, as ``ARRAY<STRUCT<a STRUCT<x,y>, b STRUCT<x,y>>>``."""
    n = f"greatest(size({ring}) - 1, 0)"
    return f"zip_with(slice({ring}, 1, {n}), slice({ring}, 2, {n}), (a, b) -> named_struct('a', a, 'b', b))"


# twice the area between the edge p-q and the ring's first vertex o: differences to it keep digits
_CROSS = "((acc.p.x - o.x) * (q.y - o.y) - (q.x - o.x) * (acc.p.y - o.y))"


def _fold_edges(ring: str, sums: dict[str, str], result: str) -> str:
    """Sums over the edges of a ring, in one walk along its vertices: ``acc.p`` is the one before ``q``."""
    zero = ", ".join(f"'{name}', 0D" for name in sums)
    step = ", ".join(f"'{name}', acc.{name} + {term}" for name, term in sums.items())
    step = step.replace("o.", f"get({ring}, 0).")
    return (f"aggregate({ring}, named_struct('p', get({ring}, 0), {zero}), (acc, q) -> named_struct('p', q, {step}), "
            f"sums -> {result})")


def signed_area_sql(ring: str) -> str:
    """Shoelace area of a closed ring, counter-clockwise positive."""
    return _fold_edges(ring, {"a": f"{_CROSS} / 2"}, "sums.a")


def _outer_minus_holes(rings: str, of_ring) -> str:
    holes = f"slice({rings}, 2, greatest(size({rings}) - 1, 0))"
    return f"aggregate({holes}, {of_ring(f'get({rings}, 0)')}, (total, hole) -> total - {of_ring('hole')})"


def _area_sql(rings: str) -> str:
    return _outer_minus_holes(rings, lambda r: f"abs({signed_area_sql(r)})")


def polygon_moments(rings: str = "rings") -> Column:
    """``STRUCT<area, x, y>``: planar area and area centroid of a polygon with holes, in one pass over its
    vertices. The centroid is NULL without area."""
    zero = "named_struct('a', 0D, 'x', 0D, 'y', 0D)"
    along = {axis: f"(acc.p.{axis} - o.{axis} + q.{axis} - o.{axis}) * {_CROSS} / 6" for axis in "xy"}
    about_first = _fold_edges("r", {"a": f"{_CROSS} / 2", **along}, "sums")
    per_ring = f"transform({rings}, (r, i) -> named_struct('m', {about_first}, 'first', get(r, 0), 'part', IF(i = 0, 1, -1)))"
    turn = "signum(p.m.a) * p.part"
    shifted = {axis: f"acc.{axis} + {turn} * (p.m.{axis} + p.m.a * p.first.{axis})" for axis in "xy"}
    add = f"named_struct('a', acc.a + {turn} * p.m.a, 'x', {shifted['x']}, 'y', {shifted['y']})"
    done = "named_struct('area', s.a, 'x', try_divide(s.x, s.a), 'y', try_divide(s.y, s.a))"
    return F.expr(f"aggregate({per_ring}, {zero}, (acc, p) -> {add}, s -> {done})")


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is worked out once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _side_sql(s: str, t: str, p: str) -> str:
    """On which side of the line from s to t the point p lies; 0 on the line."""
    return f"(({t}.x - {s}.x) * ({p}.y - {s}.y) - ({t}.y - {s}.y) * ({p}.x - {s}.x))"


def meetings_sql(ring: str) -> str:
    """The pairs of edges ``s, t`` of a ring that meet without being neighbours, ``NULL`` for a triangle. Rings are cut into runs
    of about sqrt(n) edges, and only runs whose boxes overlap are tested edge by edge; runs of less than ``RUN`` edges would
    cost more than they save, so a ring of no more edges is tested without runs."""
    segments = f"transform({segments_sql(ring)}, (g, i) -> named_struct('a', g.a, 'b', g.b, 'i', i))"
    step = f"greatest(cast(ceil(sqrt(size({ring}))) as int), {RUN})"
    bounds = ", ".join(
        f"'{axis}{n}', array_{pick}(transform(slice(r.all, p + 1, r.step), m -> {of}(m.a.{axis}, m.b.{axis})))"
        for axis in "xy" for n, pick, of in ((0, "min", "least"), (1, "max", "greatest")))
    runs = (f"flatten(transform(array(named_struct('all', {segments}, 'step', {step})), r -> "
            f"transform(sequence(0, size(r.all) - 1, r.step), p -> "
            f"named_struct('p', p, 'edges', slice(r.all, p + 1, r.step), {bounds}))))")
    overlapping = "w.p >= v.p AND w.x0 <= v.x1 AND w.x1 >= v.x0 AND w.y0 <= v.y1 AND w.y1 >= v.y0"
    apart = " AND ".join(f"greatest(s.a.{x}, s.b.{x}) >= least(t.a.{x}, t.b.{x}) AND greatest(t.a.{x}, t.b.{x}) >= least(s.a.{x}, s.b.{x})" for x in "xy")
    pair = (f"t.i > s.i + 1 AND (s.i > 0 OR t.i < size({ring}) - 2) AND {_side_sql('s.a', 's.b', 't.a')} * {_side_sql('s.a', 's.b', 't.b')} <= 0 "
            f"AND {_side_sql('t.a', 't.b', 's.a')} * {_side_sql('t.a', 't.b', 's.b')} <= 0 AND {apart}")
    met = lambda v, w: f"flatten(transform({v}, s -> transform(filter({w}, t -> {pair}), t -> named_struct('s', s, 't', t))))"
    pairs = _let("q", runs, f"flatten(transform(q, v -> flatten(transform(filter(q, w -> {overlapping}), w -> {met('v.edges', 'w.edges')}))))")
    few = _let("e", segments, met("e", "e"))
    return f"CASE WHEN size({ring}) BETWEEN 5 AND {RUN + 1} THEN {few} WHEN size({ring}) > {RUN + 1} THEN {pairs} END"


def _contains_sql(ring: str, x: str, y: str) -> str:
    """Whether a point lies inside a ring: a ray east of it meets an odd number of edges."""
    return (f"(size(filter({segments_sql(ring)}, g -> (g.a.y > {y}) <> (g.b.y > {y}) "
            f"AND {x} < g.a.x + ({y} - g.a.y) * (g.b.x - g.a.x) / nullif(g.b.y - g.a.y, 0D))) % 2 = 1)")


def _split_steps(rings: str, pairs: str) -> dict[str, str]:
    """Columns that lead, one from the other, from a polygon and the ``pairs`` in which its outer ring meets itself to ``_parts``,
    arrays of rings; NULL without pairs. They are columns since lambdas as deep as the whole are slow to analyse.

    What the ring runs around at least once, in either direction, is inside. The ring is cut at its meeting points, and where it
    crosses itself the two pieces that arrive go on with each other's next piece: that gives loops that touch but do not
    cross. They lie beside or inside one another, so the turns around a loop's inside are the sum of the directions of the loops
    that hold it. Loops with no turns outside are outer rings, those with none inside are holes. (Where a ring runs through
    one point three times or more, pieces are joined in the order of the visits.)

    Holes of the polygon go to the part that holds all their points; those that lie across parts are left out.
    """
    ring = f"get({rings}, 0)"
    s_of_t = {p: _side_sql("m.s.a", "m.s.b", f"m.t.{p}") for p in "ab"}
    t_of_s = {p: _side_sql("m.t.a", "m.t.b", f"m.s.{p}") for p in "ab"}
    between = ", ".join(f"'{x}', m.s.a.{x} + f * (m.s.b.{x} - m.s.a.{x})" for x in "xy")
    share = f"{t_of_s['a']} / ({t_of_s['a']} - {t_of_s['b']})"
    spot = (f"CASE WHEN {s_of_t['a']} = 0 THEN m.t.a WHEN {s_of_t['b']} = 0 THEN m.t.b WHEN {t_of_s['a']} = 0 THEN m.s.a "
            f"WHEN {t_of_s['b']} = 0 THEN m.s.b ELSE {_let('f', share, f'named_struct({between})')} END")
    # edges in one line meet in the ends that lie on both
    on = "p.x BETWEEN least(o.a.x, o.b.x) AND greatest(o.a.x, o.b.x) AND p.y BETWEEN least(o.a.y, o.b.y) AND greatest(o.a.y, o.b.y)"
    shared = f"filter(array(m.s.a, m.s.b, m.t.a, m.t.b), p -> forall(array(m.s, m.t), o -> {on}))"
    spots = f"IF({s_of_t['a']} = 0 AND {s_of_t['b']} = 0, {shared}, array({spot}))"
    cuts = f"flatten(transform({pairs}, m -> transform({spots}, p -> named_struct('s', m.s.i, 't', m.t.i, 'p', p))))"

    along = "(c.p.x - e.a.x) * (c.p.x - e.a.x) + (c.p.y - e.a.y) * (c.p.y - e.a.y)"
    inside = f"transform(array_sort(transform(filter(_cuts, c -> c.s = i OR c.t = i), c -> named_struct('d', {along}, 'p', c.p))), d -> d.p)"
    every = f"flatten(transform({segments_sql(ring)}, (e, i) -> concat(array(e.a), {inside})))"
    walk = "filter(_every, (p, i) -> p <> get(_every, IF(i = 0, size(_every) - 1, i - 1)))"
    nodes = "filter(sequence(0, size(_walk) - 1), i -> array_contains(transform(_cuts, c -> c.p), get(_walk, i)))"
    chains = ("transform(_nodes, (i, k) -> IF(k < size(_nodes) - 1, slice(_walk, i + 1, get(_nodes, k + 1) - i), "
              "concat(slice(_walk, i + 1, size(_walk) - i), slice(_walk, 1, get(_nodes, 0)))))")

    # the visits of one point in pairs; what only touches there is left as it is where a change would make it cross
    m = "size(_chains)"
    head = lambda v: f"get(get(_chains, {v}), 0)"
    others = f"filter(sequence(0, {m} - 1), w -> {head('w')} = {head('v')})"
    met = f"transform(sequence(0, {m} - 1), v -> named_struct('v', v, 'w', {_let('o', others, 'coalesce(get(filter(o, w -> w > v), 0), get(o, 0))')}))"
    ray = {"in": lambda v: f"element_at(get(_chains, ({v} + {m} - 1) % {m}), -1)", "out": lambda v: f"coalesce(get(get(_chains, {v}), 1), {head(f'(({v} + 1) % {m})')})"}
    angle = lambda v, way: f"atan2({ray[way](v)}.y - {head(v)}.y, {ray[way](v)}.x - {head(v)}.x)"
    low, high = "least(d.v, d.w)", "greatest(d.v, d.w)"
    turned = {f"{n}_{way}": f"pmod({angle(v, way)} - {angle(low, 'in')}, 2 * pi())" for n, v in (("a", low), ("b", high)) for way in ("in", "out")}
    crosses = f"({turned['a_out']} < {turned['b_out']}) <> ({turned['b_in']} < {turned['b_out']})"
    leave = f"transform(_met, d -> IF(d.v = d.w OR {crosses}, d.v, d.w))"
    follow = f"transform(_chains, (c, u) -> get(_leave, (u + 1) % {m}))"

    free = f"get(filter(sequence(0, {m} - 1), i -> NOT array_contains(used, i)), 0)"
    none = "slice(get(_chains, 0), 1, 0)"
    closed = f"array(concat(acc.open, get(_chains, acc.at), array({head('acc.first')})))"
    back = f"named_struct('at', {free}, 'first', {free}, 'used', used, 'open', {none}, 'loops', concat(acc.loops, {closed}))"
    further = "named_struct('at', get(_follow, acc.at), 'first', acc.first, 'used', used, 'open', concat(acc.open, get(_chains, acc.at)), 'loops', acc.loops)"
    step = _let("used", "concat(acc.used, array(acc.at))", f"IF(get(_follow, acc.at) = acc.first, {back}, {further})")
    start = f"named_struct('at', 0, 'first', 0, 'used', slice(array(0), 1, 0), 'open', {none}, 'loops', slice(_chains, 1, 0))"
    loops = f"aggregate(_chains, {start}, (acc, c) -> {step}, acc -> acc.loops)"

    measured = (f"transform(filter(_loops, l -> size(l) >= 4 AND {signed_area_sql('l')} <> 0), (l, i) -> named_struct('i', i, 'ring', l, "
                f"'turn', signum({signed_area_sql('l')}), 'x', (get(l, 0).x + get(l, 1).x) / 2, 'y', (get(l, 0).y + get(l, 1).y) / 2))")
    around = f"aggregate(_measured, 0D, (n, o) -> n + IF(o.i <> l.i AND {_contains_sql('o.ring', 'l.x', 'l.y')}, o.turn, 0D))"
    placed = f"transform(_measured, l -> named_struct('i', l.i, 'ring', l.ring, 'x', l.x, 'y', l.y, 'turn', l.turn, 'around', {around}))"
    nearer = f"exists(_outer, n -> n.i <> o.i AND {_contains_sql('n.ring', 'h.x', 'h.y')} AND {_contains_sql('o.ring', 'n.x', 'n.y')})"
    own = f"filter(_placed, h -> h.around <> 0 AND h.around + h.turn = 0 AND {_contains_sql('o.ring', 'h.x', 'h.y')} AND NOT {nearer})"
    given = f"filter(slice({rings}, 2, size({rings}) - 1), h -> forall(h, v -> {_contains_sql('o.ring', 'v.x', 'v.y')}))"
    parts = f"transform(_outer, o -> concat(array(o.ring), transform({own}, h -> h.ring), {given}))"
    def bound(steps: dict[str, str], last: str) -> str:
        for name, sql in reversed(steps.items()):
            last = _let(name, sql, last)
        return f"IF(_cuts IS NULL, NULL, {last})"

    return {"_cuts": f"IF(size({pairs}) > 0, {cuts}, NULL)", "_chains": bound({"_every": every, "_walk": walk, "_nodes": nodes}, chains),
            "_follow": bound({"_met": met, "_leave": leave}, follow), "_placed": bound({"_loops": loops, "_measured": measured}, placed),
            "_parts": bound({"_outer": "filter(_placed, o -> o.around = 0)"}, parts)}


def _closed_sql(ring: str) -> str:
    """A ring without repeated points, closed by its first one."""
    apart = lambda p, q: f"({p}.x <> {q}.x OR {p}.y <> {q}.y)"
    single = f"filter({ring}, (p, i) -> i = 0 OR {apart('p', f'get({ring}, i - 1)')})"
    ends = apart("get(q, 0)", "try_element_at(q, -1)")
    return f"get(transform(array({single}), q -> IF({ends}, concat(q, array(get(q, 0))), q)), 0)"


def _finite_sql(ring: str) -> str:
    return f"forall({ring}, p -> coalesce(abs(p.x) < double('Infinity') AND abs(p.y) < double('Infinity'), false))"


def _in_world_sql(ring: str) -> str:
    return f"forall({ring}, p -> greatest(abs(p.x), abs(p.y)) <= {WORLD_HALF_WIDTH}D * (1 + 1e-12D))"


def mended(polygons: DataFrame) -> DataFrame:
    """Polygons with their rings closed, without repeated points and without holes that enclose nothing or meet themselves. A
    polygon whose outer ring crosses or touches itself becomes one row for each of its parts, with its other columns.

    The rings stand behind a generator, so that the optimizer doesn't copy their making into every use of them.
    """
    closed = f"transform(filter(rings, r -> r IS NOT NULL), r -> {_closed_sql('r')})"
    hole = f"size(h) >= 4 AND {_finite_sql('h')} AND NOT coalesce(size({meetings_sql('h')}) > 0, false) AND {signed_area_sql('h')} <> 0"
    whole = _let("c", closed, f"concat(slice(c, 1, 1), filter(slice(c, 2, greatest(size(c) - 1, 0)), h -> {hole}))")
    outer = "get(_rings, 0)"
    pairs = f"IF(size(_rings) > 0 AND {_finite_sql(outer)} AND {_in_world_sql(outer)}, {meetings_sql(outer)}, NULL)"
    names = [c for c in polygons.columns if c != "rings"]
    checked = polygons.selectExpr(*([f"struct({', '.join(f'`{c}`' for c in names)}) AS _row"] if names else []), f"{whole} AS _rings").selectExpr("*", f"{pairs} AS _pairs")
    for name, sql in _split_steps("_rings", "_pairs").items():
        checked = checked.selectExpr("*", f"{sql} AS {name}")
    rest = [f"_row.`{c}` AS `{c}`" for c in names]
    return checked.selectExpr(*rest, "inline(transform(IF(size(_parts) > 0, _parts, array(_rings)), part -> named_struct('rings', part)))").select(*polygons.columns)


def usable_areas(polygons: DataFrame) -> DataFrame:
    """Masks or zones with mended rings. An area that is still no polygon is an error when it is read: left out or taken as it
    is, it would silently select the wrong cells."""
    known = ", ".join(f"`{c}`" for c in polygons.columns if c != "rings")
    told = f"concat('unusable area, ', _defect, ': ', to_json(struct({known})))" if known else "concat('unusable area, ', _defect)"
    checked = mended(polygons).withColumn("_defect", polygon_defect("rings"))
    return checked.withColumn("rings", F.expr(f"IF(_defect IS NULL, rings, raise_error({told}))")).select(*polygons.columns)


def polygon_defect(rings: str = "rings") -> Column:
    """Why a mended polygon cannot be put on a grid; NULL when it can."""
    return F.expr(f"""
        CASE WHEN {rings} IS NULL OR size({rings}) = 0 THEN 'empty'
             WHEN exists({rings}, r -> NOT {_finite_sql('r')}) THEN 'no finite coordinates'
             WHEN exists({rings}, r -> NOT {_in_world_sql('r')}) THEN 'outside the world'
             WHEN exists({rings}, r -> size(r) < 4) THEN 'ring of fewer than 4 points'
             WHEN exists({rings}, r -> get(r, 0) <> element_at(r, -1)) THEN 'open ring'
             WHEN {_area_sql(rings)} <= 0 THEN 'no area' END""")


def slug(name: Column) -> Column:
    return F.lower(F.replace(name, F.lit(" "), F.lit("_")))


def building_levels(tags: str = "tags") -> Column:
    """Storeys of a building: 1 when untagged, NULL when the tag is not a finite number."""
    text = f"try_element_at({tags}, 'building:levels')"
    number = f"try_cast({text} AS DOUBLE)"
    return F.expr(f"CASE WHEN {text} IS NULL THEN 1D WHEN abs({number}) < double('Infinity') THEN {number} END")
