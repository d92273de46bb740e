"""Plain-Python geometry to test against."""

from gridfill.functions.grid import Grid

GRID = Grid()
HALF = 20037508.342789244
FEATURE = "building_id long, levels double, rings array<array<struct<x:double,y:double>>>"


def closed(points):
    return [{"x": float(x), "y": float(y)} for x, y in [*points, points[0]]]


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def _cut(points, axis, border, keep_above):
    out = []
    for a, b in zip([points[-1], *points[:-1]], points):
        inside_a, inside_b = ((p[axis] >= border) if keep_above else (p[axis] <= border) for p in (a, b))
        if inside_a != inside_b:
            t = (border - a[axis]) / (b[axis] - a[axis])
            crossing = [a[0] + (b[0] - a[0]) * t, a[1] + (b[1] - a[1]) * t]
            crossing[axis] = border
            out.append(tuple(crossing))
        if inside_b:
            out.append(b)
    return out


def area(points):
    if len(points) < 3:
        return 0.0
    ox, oy = points[0]
    return abs(sum((a[0] - ox) * (b[1] - oy) - (b[0] - ox) * (a[1] - oy) for a, b in zip(points, [*points[1:], points[0]]))) / 2


def clipped_area(points, x0, y0, x1, y1):
    for axis, border, above in ((0, x0, True), (0, x1, False), (1, y0, True), (1, y1, False)):
        if not points:
            return 0.0
        points = _cut(points, axis, border, above)
    return area(points)


def fractions(points, grid=GRID):
    """(gcol, grow) -> covered share, by clipping the polygon to every cell of its box."""
    c, out = grid.cell_size, {}
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    for col in range(int((min(xs) + HALF) // c), int((max(xs) + HALF) // c) + 1):
        for row in range(int((HALF - max(ys)) // c), int((HALF - min(ys)) // c) + 1):
            share = clipped_area(points, col * c - HALF, HALF - (row + 1) * c, (col + 1) * c - HALF, HALF - row * c) / c / c
            if share > 1e-9:
                out[col, row] = share
    return out


def corner(col, row, grid=GRID):
    """Map coordinates of the north-west corner of a cell."""
    return col * grid.cell_size - HALF, HALF - row * grid.cell_size
