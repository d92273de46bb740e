"""Repeated byte strings: sampled positions whose suffixes are sorted by comparing prefix hashes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridfill.llm.common import map_batches, map_groups, mix64, stored, utf8

LENGTH = 200
GRAM = 48
"""Bytes of the string at a sampled position; it lies inside every repeated string."""

BLOCK = 512
CHUNK = 1 << 20
FILTER_BITS = 26

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2 ** 64."""
    known = _powers.get(str(base))
    if known is None or len(known) < n:
        known = np.ones(1, np.uint64)
        while len(known) < n:
            known = np.concatenate((known, known * known[-1] * base))
        _powers[str(base)] = known
    return known[:n]


def _prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums of byte * base ** place up to each place, so that two prefixes give the hash of what lies between."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data)), out=out[1:])
    return out


def _between(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return (prefix[stop] - prefix[start]) * _power(_INVERSE, len(prefix))[start]


def sample(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Sampled positions of ``texts``: (text, position, bytes to the left and right, least and greatest distance, key, context).

    Every window of ``length`` bytes takes the place of its least ``GRAM``-byte hash, so equal windows take the same place,
    wherever they stand. The windows that took a place start ``least`` to ``greatest`` bytes before it. ``context`` is a
    hash of all windows around the place, as far as the text goes.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(x) for x in texts])
    starts = ends - [len(x) for x in texts]
    width = length - GRAM + 1
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return (empty,) * 6 + (empty.astype(np.uint64),) * 2
    prefix = _prefix_hashes(data)
    grams = mix64(_between(prefix, np.arange(len(data) - GRAM + 1), np.arange(GRAM, len(data) + 1)))
    bits = np.uint64(len(data).bit_length())
    least = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    rest = width - step
    least = np.minimum(least[: len(least) - rest], least[rest:])
    place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    inside = np.zeros(len(data) + 1, np.int8)
    long = ends - starts >= length
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - length + 1, -1)
    window = np.flatnonzero(np.cumsum(inside)[: len(place)])
    place = place[window]
    text = np.searchsorted(ends, window, side="right")
    new = np.ones(len(window), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1 if len(first) else first
    at, text = place[first], text[first]
    left, right = np.minimum(at - starts[text], length - GRAM), np.minimum(ends[text] - at, length)
    around = mix64(_between(prefix, at - left, at + right) + (left * (2 * length) + right).astype(np.uint64))
    return text, at - starts[text], left, right, at - window[last], at - window[first], grams[at], around


def _anchors(rows: DataFrame, length: int) -> DataFrame:
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        docs, raws = batch.column(0).to_numpy(), utf8(batch.column(1))
        parts, row = [], 0
        while row < len(raws):
            end, size = row, 0
            while end < len(raws) and (end == row or size + len(raws[end]) <= CHUNK):
                size += len(raws[end])
                end += 1
            text, at, left, right, low, high, key, around = sample(raws[row:end], length)
            parts.append((docs[row:end][text], at, left << 32 | right << 16 | low << 8 | high, key.view(np.int64), around.view(np.int64)))
            row = end
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], names=["doc", "at", "shape", "key", "around"])

    if length - GRAM > 255:
        raise ValueError(f"strings of at most {GRAM + 255} bytes")
    return map_batches(rows.select("doc", "text"), one, "doc long, at long, shape long, key long, around long")


def _shape(shape: np.ndarray) -> tuple[np.ndarray, ...]:
    return shape >> 32, shape >> 16 & 0xFFFF, shape >> 8 & 0xFF, shape & 0xFF


# -- sorting suffixes -------------------------------------------------------------------------------------------


def _common(hashes: np.ndarray, sizes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The length of the common prefix of suffixes ``i`` and ``j``, by binary search over their prefix hashes."""
    low, high = np.zeros(len(i), np.int64), np.minimum(sizes[i], sizes[j])
    while (low < high).any():
        middle = (low + high + 1) // 2
        same = hashes[i, middle] == hashes[j, middle]
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def sorted_suffixes(data: np.ndarray, sizes: np.ndarray, base: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of suffixes in each group, and each one's common length with the one before it (0 for a group's first).

    Row ``i`` of ``data`` holds ``sizes[i]`` bytes of a suffix; rows of a group stand together, ``base[i]`` and ``count[i]`` are
    its first row and size. A merge sort, all runs of a width at a time: an element finds its place in the run beside it by
    binary search, and two suffixes are compared at their first difference, found by binary search over polynomial hashes
    of prefixes. The common lengths are then held against the bytes themselves; after a collision all is done again with
    another base.
    """
    n, width = data.shape
    for attempt in range(64):
        factor = np.uint64(0xD1342543DE82EF95 + 2 * attempt)
        hashes = np.zeros((n, width + 1), np.uint64)
        for k in range(width):
            hashes[:, k + 1] = hashes[:, k] * factor + data[:, k] + np.uint64(1)
        order, place, run_width = np.arange(n), np.arange(n), 1
        while n and run_width < count.max():
            local = place - base
            run = local // run_width
            beside = (run ^ 1) * run_width
            size = np.clip(count - beside, 0, run_width)
            low, high = np.zeros(n, np.int64), size.copy()
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                mine, other = order[open_], order[base[open_] + beside[open_] + middle]
                same = _common(hashes, sizes, mine, other)
                end_mine, end_other = same == sizes[mine], same == sizes[other]
                at = np.minimum(same, width - 1)
                before = np.where(end_other, False, np.where(end_mine, True, data[mine, at] < data[other, at]))  # mine < other
                equal = end_mine & end_other
                left = run[open_] % 2 == 0  # equal ones of the left run come first
                ahead = np.where(left, ~before & ~equal, ~before)  # other goes before mine
                low[open_] = np.where(ahead, middle + 1, low[open_])
                high[open_] = np.where(ahead, high[open_], middle)
            new = base + np.minimum(run, run ^ 1) * run_width + (local - run * run_width) + low
            merged = np.empty_like(order)
            merged[new] = order
            order, run_width = merged, 2 * run_width
        common = np.zeros(n, np.int64)
        follows = np.flatnonzero(place != base)
        i, j = order[follows], order[follows - 1]
        common[follows] = _common(hashes, sizes, i, j)
        equal = data[i] == data[j]
        inside = np.minimum(sizes[i], sizes[j])
        first = np.where(equal.all(axis=1), width, np.argmin(equal, axis=1))
        if (np.minimum(first, inside) == common[follows]).all():
            return order, common
    raise RuntimeError("prefix hashes collide under every base")


def _classes(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """A number for each suffix that is equal for those of a group that agree in their first ``depth`` bytes."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(common < depth)
    return out


def _sort_blocks(rows: pa.RecordBatch, bounds: np.ndarray, length: int) -> pa.RecordBatch:
    """Repeated strings inside each block, as (doc, start, stop, null), and in groups of several blocks a key of every other
    window, and of one window of each kind that repeats."""
    name = {c: i for i, c in enumerate(rows.schema.names)}
    doc, at, shape, blocks, edge, key = (rows.column(name[c]).to_numpy(zero_copy_only=False) for c in ("doc", "at", "shape", "blocks", "edge", "key"))
    left, right, low, high = _shape(shape)
    raw = rows.column(name["context"]).to_pylist()
    reach = length - GRAM
    forward = np.frombuffer(b"".join(x[k:].ljust(length, b"\0") for x, k in zip(raw, left.tolist(), strict=True)), np.uint8).reshape(-1, length)
    backward = np.frombuffer(b"".join(x[:k][::-1].ljust(reach, b"\0") for x, k in zip(raw, left.tolist(), strict=True)), np.uint8).reshape(-1, reach)
    count = np.repeat(np.diff(bounds), np.diff(bounds))
    base = np.repeat(bounds[:-1], np.diff(bounds))
    ahead, behind = sorted_suffixes(forward, right, base, count), sorted_suffixes(backward, left, base, count)
    repeated = np.zeros((len(doc), reach + 1), bool)
    loose: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for x in range(reach + 1):
        there = np.flatnonzero((left >= x) & (right >= length - x))
        if not len(there):
            continue
        kind = (_classes(*ahead, length - x) * (len(doc) + 1) + _classes(*behind, x))[there]  # groups differ in the first already
        _, seen, which, times = np.unique(kind, return_index=True, return_inverse=True, return_counts=True)
        twice = times[which] > 1
        own = (low[there] <= x) & (x <= high[there]) & edge[there]
        repeated[there[twice & own], x] = True
        first = np.zeros(len(there), bool)
        first[seen] = True
        open_ = there[(blocks[there] > 1) & (low[there] <= x) & (x <= high[there]) & (first | ~twice)]
        if len(open_):
            loose.append((open_, np.full(len(open_), x), _window_keys(forward[open_], backward[open_], key[open_], x, length)))
    row, start, stop = _runs(repeated)
    out = [(doc[row], at[row] - stop, at[row] - start + length, np.zeros(len(row), np.int64), np.zeros(len(row), bool))]
    out += [(doc[i], at[i] - x, at[i] - x + length, k, np.ones(len(i), bool)) for i, x, k in loose]
    docs, starts, stops, keys, given = (np.concatenate(x) for x in zip(*out, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(docs), pa.array(starts), pa.array(stops), pa.array(keys, mask=~given)], names=["doc", "start", "stop", "window"])


def _window_keys(forward: np.ndarray, backward: np.ndarray, key: np.ndarray, x: int, length: int) -> np.ndarray:
    """A hash of each whole window that starts ``x`` bytes before its place."""
    out = key.view(np.uint64) + np.uint64(x)
    data = np.concatenate((backward[:, :x][:, ::-1], forward[:, : length - x]), axis=1)
    words = np.ascontiguousarray(np.pad(data, ((0, 0), (0, -data.shape[1] % 8)))).view(np.uint64)
    for k in range(words.shape[1]):
        out = mix64(out * _BASE + words[:, k])
    return out.view(np.int64)


def _runs(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of every run of marks in a row."""
    edge = np.diff(np.pad(marks, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1] - 1


# -- the corpus -------------------------------------------------------------------------------------------------


def _id_filter(spark: SparkSession, ids: DataFrame):
    """A bitmap of 2 ** FILTER_BITS bits, whatever the corpus, in which the bit of every ``doc`` of ``ids`` is set."""
    bit = F.shiftrightunsigned("doc", 64 - FILTER_BITS).cast("int")
    words = ids.select((bit / 32).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(doc, {64 - FILTER_BITS}) % 32 as int))").alias("mask"))
    table = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(1 << FILTER_BITS - 5, np.uint32)
    out[table["word"].to_numpy()] = table["mask"].to_numpy().astype(np.uint32)
    return spark.sparkContext.broadcast(out)


def _maybe(rows: DataFrame, bitmap) -> DataFrame:
    """``doc, text`` of rows whose bit is set: all that are wanted and, the fuller the bitmap, others. It only saves shuffling."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        bit = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)
        keep = bitmap.value[(bit >> np.uint64(5)).astype(np.int64)] >> (bit & np.uint64(31)).astype(np.uint32) & np.uint32(1)
        return batch.filter(pa.array(keep.astype(bool)))

    return map_batches(rows.select("doc", "text"), one, "doc long, text string")


def _contexts(wanted: DataFrame, length: int) -> DataFrame:
    """For rows of ``doc, text, places``: the bytes around each place."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        docs, raws, places = batch.column(0), utf8(batch.column(1)), batch.column(2)
        take = np.repeat(np.arange(batch.num_rows), places.value_lengths().to_numpy())
        flat = pa.RecordBatch.from_struct_array(places.flatten())
        at = flat.column(flat.schema.get_field_index("at")).to_numpy()
        left, right, _, _ = _shape(flat.column(flat.schema.get_field_index("shape")).to_numpy())
        context = [raws[i][a - x: a + y] for i, a, x, y in zip(take.tolist(), at.tolist(), left.tolist(), right.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([docs.take(pa.array(take)), *flat.columns, pa.array(context, pa.binary())], names=["doc", *flat.schema.names, "context"])

    return map_batches(wanted, one, "doc long, key long, block int, blocks int, at long, shape long, edge boolean, context binary")


def repeated_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc, start, stop`` of stretches of bytes in which every string of ``length`` bytes also starts elsewhere.

    ``rows`` has ``doc``, a 64-bit key of the row's id and text, and ``text``.

    1. Places are sampled so that equal strings sample the same place in themselves. Only places whose key (the bytes at
       the place) occurs again matter. If all bytes around a place occur again, it is settled by that.
    2. For the others, and for one of each settled kind beside them, the bytes around go to their key. There, suffixes to
       the right and reversed prefixes to the left are sorted (``sorted_suffixes``); two places share a string just if they
       agree far enough to both sides.
    3. A key with more than ``BLOCK`` places is cut into blocks. What repeats inside one is settled there; hashes of
       the other windows, and of one of each kind that repeats, are counted over all blocks.
    """
    spark = rows.sparkSession
    anchors = stored(_anchors(rows, length))
    again = stored(anchors.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    chosen = stored(anchors.join(again, "key", "left_semi"))
    kinds = stored(chosen.groupBy("around").agg(F.count("*").alias("n"), F.min(F.struct("doc", "at")).alias("first")))
    marked = stored(chosen.join(kinds, "around").withColumn("edge", F.col("n") == 1).where(F.col("edge") | (F.struct("doc", "at") == F.col("first")))
                    .select("doc", "at", "shape", "key", "edge"))
    settled = chosen.join(kinds.where("n > 1").select("around"), "around", "left_semi")
    left, right = F.shiftright("shape", 32), F.shiftright("shape", 16).bitwiseAND(0xFFFF)
    whole = settled.select("doc", (F.col("at") - left).alias("start"), (F.col("at") + right).alias("stop"))

    sizes = stored(marked.groupBy("key").agg(F.count("*").alias("size"), F.max("edge").alias("open")).where("size > 1 AND open"))
    dealt = marked.join(sizes, "key").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    dealt = stored(dealt.withColumn("block", F.pmod(F.xxhash64("doc", "at"), F.col("blocks")).cast("int")).select("doc", F.struct("key", "block", "blocks", "at", "shape", "edge").alias("place")))
    places = dealt.groupBy("doc").agg(F.collect_list("place").alias("places"))
    wanted = _maybe(rows, _id_filter(spark, dealt.select("doc"))).join(places, "doc").select("doc", "text", "places")
    sorted_ = map_groups(_contexts(wanted, length), ["key", "block"], lambda r, b: _sort_blocks(r, b, length), "doc long, start long, stop long, window long")
    found = stored(sorted_)
    loose = found.where("window IS NOT NULL")
    twice = stored(loose.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window"))
    across = loose.join(twice, "window", "left_semi")
    parts = [whole, found.where("window IS NULL"), across]
    out = parts[0].select("doc", "start", "stop")
    for part in parts[1:]:
        out = out.union(part.select("doc", "start", "stop"))
    return out


def _cut(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What remains of ``raw`` without the spans, the bytes removed and the number of maximal removed runs."""
    kept, end, removed, runs, last = [], 0, 0, 0, -1
    for a, b in sorted(spans):
        if b <= end:
            continue
        if a > last:
            runs += 1
        a = max(a, end)
        kept.append(raw[end:a])
        removed += b - a
        end = last = b
    kept.append(raw[end:])
    return b"".join(kept), removed, runs


def remove_repeats(documents: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, if asked for, ``kept`` (bytes) for each row of ``documents``.

    Each byte covered by a string of ``length`` UTF-8 bytes that also starts anywhere else, in the same text or another, is
    removed; strings are judged on the input and never cross texts. ``n_spans`` counts the maximal removed runs. Null
    counts as empty. Repeated rows are texts of their own, so both lose what they share. An empty table gives no rows.

    Positions and contexts are shuffled, and those texts that hold repeats (found with a bitmap of fixed size, which may
    let others pass). A row is known by a 64-bit hash of its id and text.
    """
    spark = documents.sparkSession
    rows = documents.select(F.xxhash64(doc_id, text).alias("doc"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    spans = repeated_spans(rows, length)
    per_doc = stored(spans.groupBy("doc").agg(F.collect_set(F.struct("start", "stop")).alias("spans")))
    bitmap = _id_filter(spark, per_doc)
    schema = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        raws = utf8(batch.column(1))
        cut = [_cut(raw, [(s["start"], s["stop"]) for s in spans or ()]) for raw, spans in zip(raws, batch.column(2).to_pylist(), strict=True)]
        columns = [batch.column(0), pa.array(map(len, raws), pa.int64()), pa.array([x[1] for x in cut], pa.int64()), pa.array([x[2] for x in cut], pa.int64()),
                   pa.array([hashlib.sha256(x[0]).hexdigest() for x in cut])]
        if keep_text:
            columns.append(pa.array([x[0] for x in cut], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    cut = map_batches(_maybe(rows, bitmap).join(per_doc, "doc").select("doc", "text", "spans"), one, schema).dropDuplicates(["doc"])
    raw = F.coalesce(F.col("text"), F.lit(""))
    plain = rows.select("doc", "id", F.octet_length(raw).cast("long").alias("_bytes"), F.sha2(raw, 256).alias("_sha256"), *([raw.cast("binary").alias("_kept")] * keep_text))
    out = plain.join(stored(cut), "doc", "left")
    return out.select(F.col("id").alias(doc_id), F.col("_bytes").alias("n_bytes"), F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
                      F.coalesce("kept_sha256", "_sha256").alias("kept_sha256"), *([F.coalesce("kept", "_kept").alias("kept")] * keep_text))
