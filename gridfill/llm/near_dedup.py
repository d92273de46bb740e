"""Near-duplicate texts: MinHash bands find candidates, odd sketches sift them, full shingle sets confirm them."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfill.llm.common import blocks_of, components, least_root, map_batches, map_groups, mix64, only, stored, utf8

BANDS, ROWS = 32, 4
"""A pair at similarity 0.8 shares no band with probability (1 - 0.8 ** 4) ** 32 = 5e-8."""

SKETCH_BITS = 512
SKETCH_ERRORS = 4.5
"""Standard deviations that a pair's sketches may differ by beyond what its similarity suggests before it is left out."""

PERCENT = 80
BLOCK, SKETCH_BLOCK = 256, 1024
CHUNK = 1_000_000
CACHE = 100_000

_SEEDS = np.random.default_rng(11).integers(1, 1 << 32, (BANDS * ROWS, 2), dtype=np.uint64).astype(np.uint32)
_SEEDS[:, 0] |= 1


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = _Words()


def shingle_set(text: bytes, n: int) -> np.ndarray:
    """The sorted 64-bit hashes of the different runs of ``n`` words of UTF-8 text, split at ASCII white space, A-Z in lower
    case. Of fewer words, but not none, the whole sequence is one shingle."""
    split = text.lower().split()
    only(_words, limit=CACHE)
    words = np.fromiter(map(_words.__getitem__, split), np.uint64, len(split))
    if not len(words):
        return words
    k = min(n, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        out = mix64(out + words[i: i + len(out)])
    return np.unique(out)


def sketch_limit(percent: int = PERCENT, samples: int = BANDS * ROWS, bits: int = SKETCH_BITS, errors: float = SKETCH_ERRORS) -> int:
    """The largest XOR population count at which a pair may still be as similar as ``percent``.

    Of ``samples`` minima, some number differs, binomially; each that does flips two bits at random. The expected number
    of odd bits after 2d flips is bits / 2 * (1 - (1 - 2 / bits) ** 2d).
    """
    apart = samples * (100 - percent) / 100
    most = apart + errors * math.sqrt(apart * percent / 100)
    expected = bits / 2 * (1 - (1 - 2 / bits) ** (2 * most))
    return math.ceil(min(2 * most, expected + errors))


def _signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Minima (a row for each set) and odd sketches as 64-bit words."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    start = np.cumsum(sizes) - sizes
    low = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    minima = np.empty((len(sets), len(_SEEDS)), np.uint32)
    for i, (a, b) in enumerate(_SEEDS):
        minima[:, i] = np.minimum.reduceat(low * a + b, start)
    place = mix64(minima.astype(np.uint64) + (np.arange(len(_SEEDS), dtype=np.uint64) << np.uint64(32))) % np.uint64(SKETCH_BITS)
    flips = np.zeros((len(sets), SKETCH_BITS), np.uint8)
    np.add.at(flips, (np.arange(len(sets))[:, None], place.astype(np.int64)), 1)
    return minima, np.packbits(flips & 1, axis=1).view(np.uint64)


def signatures(documents: DataFrame, shingle: int) -> DataFrame:
    """``id, n, f1, f2, sketch, bands`` of ``documents(id, text)``: the size of the shingle set, a 128-bit fingerprint of it, its
    odd sketch and one key for each band. Empty sets have no bands."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        raws = utf8(batch.column(1))
        n, prints, sketches, bands = [], [], [], []
        row = 0
        while row < len(raws):
            sets, total = [], 0
            while row < len(raws) and (not sets or total < CHUNK):
                sets.append(shingle_set(raws[row], shingle))
                total += len(sets[-1])
                row += 1
            filled = [s for s in sets if len(s)]
            if filled:
                minima, sketch = _signatures(filled)
                keys = np.zeros((len(filled), BANDS), np.uint64)
                for r in range(ROWS):
                    keys = mix64(keys + minima[:, r::ROWS])
                keys = mix64(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
            at = 0
            for s in sets:
                n.append(len(s))
                prints.append((int(mix64(s).sum() if len(s) else 0), int(mix64(s + np.uint64(0x5851F42D4C957F2D)).sum() if len(s) else 0)))
                if len(s):
                    sketches.append(sketch[at].tobytes())
                    bands.append(keys[at])
                    at += 1
                else:
                    sketches.append(b"")
                    bands.append(np.zeros(0, np.int64))
        f = np.array(prints, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(f[:, 0]), pa.array(f[:, 1]), pa.array(sketches, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            names=["id", "n", "f1", "f2", "sketch", "bands"])

    return map_batches(documents.select("id", "text"), one, "id long, n long, f1 long, f2 long, sketch binary, bands array<long>")


def _near(sketches: np.ndarray, n: np.ndarray, limit: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """How far the sketches of each pair of a block are apart, and which pairs may be similar by that and by their sizes."""
    apart = np.zeros((len(n), len(n)), np.uint16)
    for word in range(sketches.shape[1]):
        apart += np.bitwise_count(sketches[:, None, word] ^ sketches[None, :, word])
    return apart, (apart <= limit) & (100 * np.minimum.outer(n, n) >= percent * np.maximum.outer(n, n))


def _columns(rows: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    return [rows.column(rows.schema.names.index(c)).to_numpy(zero_copy_only=False) for c in names]


def _candidate_blocks(rows: pa.RecordBatch, bounds: np.ndarray, limit: int, percent: int) -> pa.RecordBatch:
    """For each set of a pair of blocks that has candidates there: the least id that candidates lead to, and of candidates
    with lower ids (if any) the one nearest by sketch."""
    ids, n = _columns(rows, ["id", "n"])
    sketches = np.frombuffer(b"".join(rows.column(rows.schema.names.index("sketch")).to_pylist()), np.uint64).reshape(rows.num_rows, -1)
    out = [[np.zeros(0, np.int64)] * 4]
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a > 1:
            order = a + np.argsort(ids[a:b])
            apart, near = _near(sketches[order], n[order], limit, percent)
            root = least_root(near)
            some = np.flatnonzero(root != np.arange(b - a))
            lower = np.where(np.tril(near, -1), apart, np.uint16(0xFFFF))[some]
            best = np.argmin(lower, axis=1)
            out.append([ids[order[some]], ids[order[root[some]]], ids[order[best]], lower[np.arange(len(some)), best].astype(np.int64)])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["a", "root", "near", "apart"])


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _confirm_blocks(rows: pa.RecordBatch, bounds: np.ndarray, limit: int, percent: int) -> pa.RecordBatch:
    """A spanning forest of the confirmed links in every pair of blocks; ``label`` tells what is linked already.

    A pair inside a part that is linked already isn't compared again, so of a group of copies nearly every comparison links.
    """
    ids, n, label = _columns(rows, ["id", "n", "label"])
    sketches = np.frombuffer(b"".join(rows.column(rows.schema.names.index("sketch")).to_pylist()), np.uint64).reshape(rows.num_rows, -1)
    raw = rows.column(rows.schema.names.index("shingles")).to_pylist()
    a_out, b_out = [], []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a < 2:
            continue
        sets = [np.frombuffer(x, np.uint64) for x in raw[a:b]]
        part = np.unique(label[a:b], return_inverse=True)[1]
        near = np.triu(_near(sketches[a:b], n[a:b], limit, percent)[1], 1)
        for i in range(b - a):
            for j in np.flatnonzero(near[i] & (part != part[i])).tolist():
                if part[i] != part[j] and _similar(sets[i], sets[j], percent):
                    part[part == part[j]] = part[i]
                    a_out.append(ids[a + i])
                    b_out.append(ids[a + j])
    return pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])


def _confirm_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links among ``pairs(a, b)``, each compared on its full sets."""
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = [_similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_batches(both, one, "a long, b long")


def _shingle_sets(documents: DataFrame, shingle: int) -> DataFrame:
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(x, shingle).tobytes() for x in utf8(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["id", "shingles"])

    return map_batches(documents.select("id", "text"), one, "id long, shingles binary")


def near_duplicates(documents: DataFrame, shingle: int = 5, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``documents``.

    Two texts are linked if 100 * (common shingles) >= ``percent`` * (all shingles of both); a shingle is ``shingle``
    consecutive words, in a shorter text the whole sequence. ``component_id`` is the least id reachable by links, ``kept``
    tells whether that is the row's own id.

    1. Each text gives the minima of its shingle set, keys of bands of minima, and an odd sketch: a bitmap in which every
       minimum flips one bit, so that the XOR of two sketches counts the minima that differ.
    2. Rows with the same set become one (by a 128-bit fingerprint and the size). Sets that share a band are candidates if
       their sketches and sizes allow the similarity. Full buckets are met in pairs of blocks; each returns for a
       set the least one that candidates lead to, and the nearest. The components of these split all further work.
    3. Links are confirmed on the full sets inside each component. One of up to ``BLOCK`` sets is one block. In a larger
       one, each set and its nearest are confirmed first; then only blocks of differently linked sets are compared.

    A text without words, or null, links with nothing. So does a row without an id: its component is null and it isn't
    kept. Rows with the same id and different texts are one node to others. An empty table gives no rows.
    """
    rows = documents.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    signs = stored(signatures(rows, shingle))
    good = signs.where("n > 0 AND id IS NOT NULL")
    classes = stored(good.groupBy("f1", "f2", "n").agg(F.min("id").alias("id"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands")))
    limit = sketch_limit(percent)

    places = classes.select("id", F.explode("bands").alias("band"))
    crowded = stored(places.groupBy("band").agg(F.count("*").alias("size")).where("size > 1"))
    met = blocks_of(places.join(crowded, "band"), ["band"], "size", "id", SKETCH_BLOCK).select("id", "band", "_own", "_p", "_q")
    sifted = met.join(classes.select("id", "n", "sketch"), "id").select("id", "band", "_p", "_q", "n", "sketch")
    forest = stored(map_groups(sifted, ["band", "_p", "_q"], lambda r, b: _candidate_blocks(r, b, limit, percent), "a long, root long, near long, apart long"))
    groups = components(forest.select("a", F.col("root").alias("b")).distinct())

    sizes = stored(groups.groupBy("component").agg(F.count("*").alias("size")))
    members = stored(groups.join(sizes, "component").select(F.col("node").alias("id"), "component", "size"))
    sets = stored(_shingle_sets(rows.join(members.select("id"), "id", "left_semi"), shingle).distinct())
    large = members.where(F.col("size") > BLOCK).select(F.col("id").alias("a"))
    nearest = forest.where("apart < 65535").groupBy("a").agg(F.min(F.struct("apart", "near")).alias("s")).select("a", F.col("s.near").alias("b"))
    first = stored(_confirm_pairs(nearest.join(large, "a"), sets, percent))
    labels = components(first).select(F.col("node").alias("id"), F.col("component").alias("label"))
    labelled = stored(members.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id")))

    kinds = labelled.groupBy("component", "label").agg(F.count("*").alias("n_label")).withColumn("alone", F.col("n_label") > BLOCK)
    mixed = kinds.groupBy("component").agg(F.count("*").alias("n_labels"), F.sum(F.when(~F.col("alone"), F.col("n_label")).otherwise(0)).alias("rest"),
                                           F.collect_list(F.when(F.col("alone"), F.struct("label", "n_label"))).alias("large"))
    kinds = kinds.join(mixed, "component").where("n_labels > 1")
    dealt = labelled.join(kinds, ["component", "label"]).select("id", "component", "label", "alone", "n_label", "rest", "large")
    met = _label_blocks(dealt)
    info = classes.select("id", "n", "sketch").join(sets, "id")
    full = met.join(info, "id").select("id", "component", "_p", "_q", "label", "n", "sketch", "shingles")
    second = map_groups(full, ["component", "_p", "_q"], lambda r, b: _confirm_blocks(r, b, limit, percent), "a long, b long")
    linked = components(first.select("a", "b").union(second))

    keys = classes.select("f1", "f2", "n", F.col("id").alias("class"))
    out = signs.join(keys, ["f1", "f2", "n"], "left").join(linked, F.col("class") == F.col("node"), "left")
    component = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.coalesce("component", "class")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))


def _label_blocks(dealt: DataFrame) -> DataFrame:
    """Rows for every pair of blocks of one candidate component, but for pairs of blocks of one label.

    Labels of more than ``BLOCK`` sets have blocks of their own, the others share blocks. Blocks are numbered through:
    the shared ones first, then those of each large label.
    """
    count = lambda n: F.ceil(n / BLOCK).cast("int")
    large = F.array_sort("large")
    before = lambda until: F.aggregate(F.filter(large, lambda s: until(s["label"])), count(F.col("rest")), lambda acc, s: acc + count(s["n_label"]))
    first = F.when(F.col("alone"), before(lambda x: x < F.col("label"))).otherwise(F.lit(0))
    own_n = F.when(F.col("alone"), count(F.col("n_label"))).otherwise(count(F.col("rest")))
    total = before(lambda x: F.lit(True))
    row = dealt.withColumns({"_first": first, "_n": own_n, "_total": total}).withColumn("_own", F.col("_first") + F.pmod(F.xxhash64("id"), F.col("_n")).cast("int"))
    other = F.explode(F.filter(F.sequence(F.lit(0), F.col("_total") - 1),
                               lambda k: ~F.col("alone") | (k < F.col("_first")) | (k >= F.col("_first") + F.col("_n"))))
    met = row.withColumn("_other", other)
    return met.withColumns({"_p": F.least("_own", "_other"), "_q": F.greatest("_own", "_other")}).select("id", "component", "label", "_p", "_q")


def keep_first(documents: DataFrame, shingle: int = 5, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` without the rows that ``near_duplicates`` doesn't keep; the columns stay.

    Of rows that repeat id and text, one stays; different texts under one id are judged by their groups. Rows without an id or
    without words all stay.
    """
    groups = near_duplicates(documents, shingle, percent, doc_id, text).where(F.col(doc_id).isNotNull() & ~F.col("kept"))
    gone = stored(groups.select(F.col(doc_id).alias("_gone")).distinct())
    left = documents.join(gone, documents[doc_id] == gone["_gone"], "left_anti")
    each = F.when(F.col(doc_id).isNull(), F.monotonically_increasing_id())
    return left.withColumn("_each", each).dropDuplicates([doc_id, text, "_each"]).drop("_each")
