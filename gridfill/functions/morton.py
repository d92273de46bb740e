"""Keys along a Z-shaped curve over tiles: tiles that lie together have keys that lie together."""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_ZOOM = 31  # two coordinates of 31 bits fit a positive BIGINT

# shifts and masks that move bit i of a number to bit 2 i
_STEPS = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]


def _spread_bits(number: Column) -> Column:
    out = number.cast("bigint")
    for shift, mask in _STEPS:
        out = out.bitwiseOR(F.shiftleft(out, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return out


def morton(col: Column, row: Column) -> Column:
    """The bits of a tile's column and row (from 0) in turn, the row's first."""
    return _spread_bits(col).bitwiseOR(F.shiftleft(_spread_bits(row), 1))


def _key(col: int, row: int) -> int:
    return sum(((col >> i & 1) | (row >> i & 1) << 1) << 2 * i for i in range(MAX_ZOOM))


def key_ranges(cols: tuple[int, int], rows: tuple[int, int], zoom: int, limit: int = 64) -> list[tuple[int, int]]:
    """Ranges of keys, ends included, that hold every tile of a box: at most ``limit``, so they may hold others as well.

    The world is cut in four as long as a part lies on the box's border and there is room for more ranges, largest parts
    first; parts outside are left out. Ranges that meet are one.
    """
    if cols[0] > cols[1] or rows[0] > rows[1]:
        return []
    whole: list[tuple[int, int, int]] = []
    border: deque[tuple[int, int, int]] = deque()

    def sort_in(level: int, col: int, row: int) -> None:
        side = 1 << zoom - level  # tiles along a part's side
        west, north = col * side, row * side
        east, south = west + side - 1, north + side - 1
        if cols[0] <= west and east <= cols[1] and rows[0] <= north and south <= rows[1]:
            whole.append((level, col, row))
        elif east >= cols[0] and west <= cols[1] and south >= rows[0] and north <= rows[1]:
            border.append((level, col, row))

    sort_in(0, 0, 0)
    while border and len(whole) + len(border) + 3 <= limit:
        level, col, row = border.popleft()
        for j in (0, 1):
            for i in (0, 1):
                sort_in(level + 1, 2 * col + i, 2 * row + j)
    ranges: list[tuple[int, int]] = []
    for low, high in sorted((_key(col, row) << 2 * (zoom - level), (_key(col, row) + 1 << 2 * (zoom - level)) - 1)
                            for level, col, row in [*whole, *border]):
        if ranges and ranges[-1][1] + 1 == low:
            low = ranges.pop()[0]
        ranges.append((low, high))
    return ranges
