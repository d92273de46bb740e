"""Fill-in-the-middle: texts cut in three at code points, found by a learned index of their byte offsets."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gridfill.llm.common import map_batches, utf8

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = "<P>|<S>|<M>"
ERROR = 127  # bytes; what is left over then fits in one byte
BLOCK = 1 << 20  # bytes of text whose offsets are held at a time
POSITIONS = ("_n", "_low", "_high", "_from", "_to")


@dataclass(frozen=True)
class RankIndex:
    """Byte offsets of code points by their rank: line segments with an error of up to ``ERROR`` and what is left over.

    A segment starts at rank ``first`` and offset ``base`` and rises by ``slope`` bytes a rank; ``rest`` holds one byte for
    each rank, the difference between its offset and the rounded line. The last rank is the end of the bytes.
    """

    first: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    rest: np.ndarray

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.first, ranks, "right") - 1
        return self.base[at] + np.rint(self.slope[at] * (ranks - self.first[at])).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets: predicted, then corrected by what was left over."""
        return self.predict(ranks) + self.rest[ranks]


def _segments(offsets: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``first, slope, rest`` of segments through ``offsets``, none across one of ``starts``.

    A segment joins its first and last offset; those with a larger error than ``ERROR`` are halved, all at once. Halving
    ends: an offset is at most 4 bytes from the next.
    """
    rest = np.zeros(len(offsets), np.int8)
    low, high = starts, np.append(starts[1:], len(offsets))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(low):
        n = high - low
        slope = (offsets[high - 1] - offsets[low]) / np.maximum(n - 1, 1)
        begin = np.cumsum(n) - n
        step = np.arange(n.sum()) - np.repeat(begin, n)
        rank = np.repeat(low, n) + step
        left = offsets[rank] - np.repeat(offsets[low], n) - np.rint(np.repeat(slope, n) * step).astype(np.int64)
        good = np.maximum.reduceat(np.abs(left), begin) <= ERROR
        settled = np.repeat(good, n)
        rest[rank[settled]] = left[settled]
        found.append((low[good], slope[good]))
        low, high, half = low[~good], high[~good], (low[~good] + high[~good]) // 2
        low, high = np.stack((low, half), 1).ravel(), np.stack((half, high), 1).ravel()
    first, slope = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0))
    order = np.argsort(first)
    return first[order], slope[order], rest


def rank_index(data: np.ndarray, starts: np.ndarray) -> RankIndex:
    """An index of all code points of the UTF-8 bytes ``data``; texts begin at the bytes ``starts``, and no segment spans two.

    Offsets are listed for ``BLOCK`` bytes at a time, so that a very long text needs a byte of index for each of its code
    points and not eight.
    """
    parts: list[tuple[np.ndarray, ...]] = []
    ranks = 0
    for begin in range(0, len(data), BLOCK):
        offsets = begin + np.flatnonzero((data[begin: begin + BLOCK] & 0xC0) != 0x80)
        if not len(offsets):
            continue
        inside = starts[(starts > offsets[0]) & (starts <= offsets[-1])]
        first, slope, rest = _segments(offsets, np.unique(np.append(0, np.searchsorted(offsets, inside))))
        parts.append((first + ranks, offsets[first], slope, rest))
        ranks += len(offsets)
    parts.append((np.array([ranks]), np.array([len(data)]), np.zeros(1), np.zeros(1, np.int8)))
    return RankIndex(*[np.concatenate(x) for x in zip(*parts, strict=True)])


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    raw = utf8(batch.column(0))
    starts = np.cumsum([0, *map(len, raw)])
    index = rank_index(np.frombuffer(b"".join(raw), np.uint8), starts[:-1])
    n = pc.utf8_length(batch.column(0)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    rank = np.append(0, np.cumsum(n))  # of each text's first code point
    first, second = (batch.column(i).to_numpy(zero_copy_only=False) % (n + 1) for i in (1, 2))
    low, high = np.minimum(first, second), np.maximum(first, second)
    at = [index.offsets(rank[:-1] + c) - starts[:-1] for c in (low, high)]
    found = [pa.array(x.astype(np.int64)) for x in (n, low, high, *at)]
    return pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*batch.schema.names, *POSITIONS])


def _number(digest: Column, group: int) -> Column:
    """The ``group``-th eight hexadecimal digits, from 0, as an unsigned number."""
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def fill_in_middle(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = "1", plain: int = 10, suffix_first: int = 20) -> DataFrame:
    """The columns of ``documents`` with ``n, form, prefix_chars, middle_chars, output`` (replaced if there).

    SHA-256 of the seed and the id decides: two numbers where a text of ``n`` code points is cut, one whether it stays
    ``plain`` (so many of a hundred, and always where it is empty or holds one of the marks), one whether the suffix comes
    first (``spm``, so many of a hundred; else ``psm``). ``output`` is the text with marks before its parts; of a plain one,
    the text itself, and the lengths are null.

    Null texts count as empty. A null id counts as one without digits. Rows that repeat id and text get the same result.
    An empty table gives no rows.

    Rows stay where they are. Of a batch, a worker holds the bytes and one byte of index for each code point.
    """
    kept = [c for c in documents.columns if c not in ("n", "form", "prefix_chars", "middle_chars", "output")]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    whole = F.coalesce(F.col(text), F.lit(""))
    form = F.when((whole == "") | whole.rlike(MARKS) | (_number(digest, 2) % 100 >= 100 - plain), "plain").when(_number(digest, 3) % 100 < suffix_first, "spm").otherwise("psm")
    rest = F.struct(F.lit(True).alias("_there"), *[c for c in kept if c != text])
    rows = documents.select(F.col(text).alias("_text"), _number(digest, 0).alias("_h1"), _number(digest, 1).alias("_h2"), rest.alias("_row"), form.alias("_form"))
    cut = map_batches(rows, _cut, StructType([*rows.schema.fields, *[StructField(name, LongType()) for name in POSITIONS]]))

    raw = F.coalesce(F.col("_text"), F.lit("")).cast("binary")

    def part(begin: Column, length: Column) -> Column:
        return F.substring(raw, (begin + 1).cast("int"), length.cast("int"))

    first, middle, last = (part(F.lit(0), F.col("_from")), part(F.col("_from"), F.col("_to") - F.col("_from")), part(F.col("_to"), F.octet_length(raw) - F.col("_to")))
    mark = {m: F.lit(m).cast("binary") for m in (PREFIX, SUFFIX, MIDDLE)}
    psm = F.concat(mark[PREFIX], first, mark[SUFFIX], last, mark[MIDDLE], middle)
    spm = F.concat(mark[SUFFIX], last, mark[PREFIX], first, mark[MIDDLE], middle)
    is_plain = F.col("_form") == "plain"
    output = F.when(is_plain, raw).when(F.col("_form") == "spm", spm).otherwise(psm).cast("string")
    own = [F.col("_text").alias(c) if c == text else F.col("_row")[c].alias(c) for c in kept]
    return cut.select(*own, F.col("_n").alias("n"), F.col("_form").alias("form"), F.when(~is_plain, F.col("_low")).alias("prefix_chars"),
                      F.when(~is_plain, F.col("_high") - F.col("_low")).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of ``fill_in_middle`` was made of; its parts hold no marks."""
    parts = F.split(output, MARKS)
    at = lambda i: F.get(parts, F.lit(i))
    return F.when(form == "psm", F.concat(at(1), at(3), at(2))).when(form == "spm", F.concat(at(2), at(3), at(1))).otherwise(output)
