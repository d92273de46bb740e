"""Benchmark decontamination: a broadcast set of hashed test n-grams is looked up in every token window."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfill.llm.common import lists, map_batches, mix64, stored, utf8

WINDOW = 10
BLOCK_BYTES = 8_000_000
"""Bytes of test text broadcast at once. A larger test set is looked up block after block, and the hits add up."""

FILTER_BITS = 22
CHUNK_BYTES = 4_000_000

_WORD_BYTES = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TO_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD_BYTES else 0x20 for b in range(256))

FINDINGS = "n_words long, n_hit long, hit_from array<int>, hit_to array<int>, hit_items array<string>"


def words(text: bytes) -> list[bytes]:
    """Words of UTF-8 text: A-Z in lower case, split at every ASCII character that is neither letter nor digit."""
    return text.translate(_TO_WORDS).split()


class TestSet:
    """The windows of some test items: a vocabulary, and for each window length the sorted hashes, words and owners."""

    __test__ = False

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set[int]]] = defaultdict(lambda: defaultdict(set))
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            n = min(window, len(ids))
            for i in range(len(ids) - n + 1 if n else 0):
                by_length[n][tuple(ids[i: i + n])].add(number[name])
        self.by_length = {}
        for n, grams in by_length.items():
            rows = np.array(list(grams), np.int64).reshape(-1, n)
            hashes = window_hashes(rows.reshape(-1), n)[::n]
            order = np.argsort(hashes, kind="stable")
            owners = [sorted(x) for x in grams.values()]
            owners = [owners[i] for i in order]
            maybe = np.zeros(1 << FILTER_BITS, bool)
            maybe[hashes >> np.uint64(64 - FILTER_BITS)] = True
            first = np.concatenate(([0], np.cumsum([len(x) for x in owners])))
            self.by_length[n] = (hashes[order], rows[order], maybe, first, np.fromiter(chain.from_iterable(owners), np.int64))


def window_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of ``n`` ids."""
    out = np.zeros(max(0, len(ids) - n + 1), np.uint64)
    ids = ids.astype(np.uint64)
    for i in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + ids[i: i + len(out)]
    return mix64(out)


def find_windows(ids: np.ndarray, tests: TestSet) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each window length: the length, the places of its windows in ``ids`` (0: no word of the test set), each
    confirmed word for word, and for each place and owning item the place's number and the item."""
    unknown = np.concatenate(([0], np.cumsum(ids == 0)))
    for n, (hashes, rows, maybe, first, owners) in tests.by_length.items():
        if len(ids) < n:
            continue
        places = np.flatnonzero(unknown[n:] == unknown[:-n])
        own = window_hashes(ids, n)[places]
        keep = maybe[own >> np.uint64(64 - FILTER_BITS)]
        places, own = places[keep], own[keep]
        at = np.searchsorted(hashes, own)
        views, hit = sliding_window_view(ids, n), np.full(len(places), -1)
        open_ = np.arange(len(places))
        while len(open_):  # different windows that share a hash stand side by side
            open_ = open_[at[open_] < len(hashes)]
            open_ = open_[hashes[at[open_]] == own[open_]]
            same = (views[places[open_]] == rows[at[open_]]).all(axis=1)
            hit[open_[same]] = at[open_[same]]
            open_ = open_[~same]
            at[open_] += 1
        places, hit = places[hit >= 0], hit[hit >= 0]
        if len(places):
            count = first[hit + 1] - first[hit]
            which = np.repeat(np.arange(len(places)), count)
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            yield n, places, which, owners[np.repeat(first[hit], count) + step]


def _findings(raws: list[bytes], old: list[list[tuple[int, int]]], old_items: list[list[str]], tests: TestSet) -> list[pa.Array]:
    split = [words(x) for x in raws]
    n = np.fromiter(map(len, split), np.int64, len(split))
    start = np.cumsum(n + 1) - (n + 1)  # one place without a word after each text
    total = int((n + 1).sum())
    ids = np.fromiter(map(tests.vocabulary.get, chain.from_iterable(chain(x, (b"",)) for x in split), repeat(0)), np.int64, total)
    depth = np.zeros(total + 1, np.int64)
    for row, spans in enumerate(old):
        for a, b in spans:
            depth[start[row] + a] += 1
            depth[start[row] + b] -= 1
    pairs = [np.zeros(0, np.int64)]
    for length, places, which, items in find_windows(ids, tests):
        np.add.at(depth, places, 1)
        np.add.at(depth, places + length, -1)
        row = np.searchsorted(start, places, side="right") - 1
        pairs.append(row[which] * len(tests.names) + items)
    hit = np.cumsum(depth[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    row = np.searchsorted(start, begin, side="right") - 1
    per_row = np.bincount(row, minlength=len(raws))
    own = np.unique(np.concatenate(pairs))
    at_row, item = own // max(1, len(tests.names)), own % max(1, len(tests.names))
    cut = np.searchsorted(at_row, np.arange(len(raws) + 1))
    items = [[tests.names[i] for i in item[cut[i]: cut[i + 1]].tolist()] for i in range(len(raws))]
    items = [sorted({*a, *b}) if b else a for a, b in zip(items, old_items, strict=True)]
    n_hit = np.add.reduceat(hit, start).astype(np.int64) if len(raws) else n
    return [pa.array(n), pa.array(n_hit), lists((begin - start[row]).astype(np.int32), per_row, pa.int32()),
            lists((end - start[row]).astype(np.int32), per_row, pa.int32()), pa.array(items, pa.list_(pa.string()))]


def _test_blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    items = (benchmark.where(F.col(text).isNotNull() & F.col(item_id).isNotNull())
             .select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text")).distinct())
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = 1 + size // block_bytes
    for k in range(n):
        yield [(r.id, r.text.encode()) for r in items.where(F.pmod(F.xxhash64("id"), F.lit(n)) == k).toLocalIterator()]


def scan(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, text: str = "text",
         item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The columns of ``documents`` with ``n_words``, ``n_hit``, ``hit_from``, ``hit_to``, ``hit_items`` (replaced if there).

    A window is ``window`` consecutive words of a test item; an item of fewer words, but not none, is one window. Words
    of a document inside any occurrence of a window are hit: ``n_hit`` counts them, ``hit_from`` and ``hit_to`` (first
    word, word behind the last) list the runs, ``hit_items`` the owning items' ids as sorted strings.

    The windows are broadcast in blocks of about ``block_bytes`` of test text (whole items), whatever the size of the
    test set; documents never move. A window counts only where all its words agree.

    A null or wordless text has no words; repeated rows are scanned each for itself; test items with null id or text
    are not used; an empty test set hits nothing.
    """
    own = [x.split()[0] for x in FINDINGS.split(", ")]
    kept = [c for c in documents.columns if c not in own]
    out, first = documents.select(*kept), True
    schema = "".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}, " for f in out.schema) + FINDINGS
    for items in _test_blocks(benchmark, item_id, item_text, block_bytes):
        out = _scan_block(out if first else stored(out), items, window, text, kept, schema, first)
        first = False
    return out


_built: dict[int, TestSet] = {}


def _scan_block(documents: DataFrame, items: list[tuple[str, bytes]], window: int, text: str, kept: list[str], schema: str, first: bool) -> DataFrame:
    shared, key = documents.sparkSession.sparkContext.broadcast(items), hash((window, *items))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        if key not in _built:
            _built.clear()
            _built[key] = TestSet(shared.value, window)
        table = pa.Table.from_batches([batch])
        parts, row = [], 0
        raws = utf8(batch.column(batch.schema.get_field_index(text)))
        while row < len(raws):
            end, size = row, 0
            while end < len(raws) and (end == row or size + len(raws[end]) <= CHUNK_BYTES):
                size += len(raws[end])
                end += 1
            if first:
                old, old_items = [[]] * (end - row), [[]] * (end - row)
            else:
                piece = table.slice(row, end - row).to_pydict()
                old = [list(zip(a, b, strict=True)) for a, b in zip(piece["hit_from"], piece["hit_to"], strict=True)]
                old_items = piece["hit_items"]
            parts.append(_findings(raws[row: end], old, old_items, _built[key]))
            row = end
        found = [pa.concat_arrays(x) for x in zip(*parts, strict=True)]
        own = ["n_words", "n_hit", "hit_from", "hit_to", "hit_items"]
        return pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in kept] + found, names=kept + own)

    return map_batches(documents, one, schema)


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """``documents`` without the rows in which any test window occurs; its columns stay as they are."""
    found = scan(documents.select(F.struct(*documents.columns).alias("_row"), F.col(text).alias("_text")), benchmark, window, text="_text")
    return found.where("n_hit = 0").select("_row.*")


def cut_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """``documents`` with every hit run of words cut out of its text, up to the next word that stays; a null text stays null."""
    found = scan(documents.select(F.struct(*documents.columns).alias("_row"), F.col(text).alias("_text")), benchmark, window, text="_text")
    # Splitting at word starts gives one piece a word: the word and what stands behind it, and first what stands before all words.
    pieces = F.split("_text", r"(?<![^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])(?=[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])")
    lead = F.when(F.col("_text").rlike(r"^[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"), 0).otherwise(1)
    inside = lambda i: F.exists(F.arrays_zip("hit_from", "hit_to"), lambda s: (i - lead >= s["hit_from"]) & (i - lead < s["hit_to"]))
    left = F.concat_ws("", F.transform(F.filter(F.transform(pieces, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda p: ~inside(p["i"])), lambda p: p["x"]))
    text_out = F.when(F.col("n_hit") > 0, left).otherwise(F.col("_text"))
    return found.select(*[text_out.alias(text) if c == text else F.col("_row")[c].alias(c) for c in documents.columns])
