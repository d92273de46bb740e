"""Best-fit packing of documents into sequences under several capacities at once."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridfill.llm.common import map_batches, stored, texts
from gridfill.llm.tokens import word_tokens

END = 0
"""Id put after every document."""


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds: tokens, pieces of documents, and the attention cost (the sum of squared piece lengths).

    With the defaults only tokens bind, which gives the fewest sequences.
    """

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], np.int64)


@dataclass
class Step:
    """``count`` pieces of ``length``, the ``first``-th of that length onwards: ``each`` to a sequence, from place ``offset``
    of sequence ``sequence`` on."""

    length: int
    first: int
    count: int
    sequence: int
    each: int
    offset: int


def plan(counts: dict[int, int], capacity: Capacity) -> list[Step]:
    """Vector best-fit, longest pieces first, over the number of pieces of each length.

    Every demand of a piece follows from its length, so sequences with the same residual capacities are one class, kept as
    runs of sequence numbers. A piece goes to the class whose weighted residual vector has the smallest norm after it,
    among those with room in every capacity, and a sequence takes pieces of one length while they fit, as best-fit
    would place them one by one. The plan's size depends on the lengths, not on the number of pieces.
    """
    full, weights = capacity.vector(), np.array(capacity.weights)
    residuals = np.zeros((0, 3), np.int64)
    runs: list[list[tuple[int, int]]] = []
    number: dict[tuple[int, ...], int] = {}
    steps: list[Step] = []
    opened = 0

    def put(residual: np.ndarray, run: tuple[int, int]) -> None:
        nonlocal residuals
        if residual[0] == 0 or residual[1] == 0 or run[1] == 0:
            return
        key = tuple(residual.tolist())
        if key not in number:
            number[key] = len(runs)
            runs.append([])
            residuals = np.vstack([residuals, residual])
        runs[number[key]].append(run)

    def place(length: int, demand: np.ndarray, first: int, run: tuple[int, int], each: int, last: int, residual: np.ndarray) -> None:
        """``each`` pieces to each sequence of ``run``, but ``last`` to its last one."""
        start, n = run
        steps.append(Step(length, first, (n - 1) * each + last, start, each, int(full[0] - residual[0])))
        put(residual - each * demand, (start, n - (last < each)))
        if last < each:
            put(residual - last * demand, (start + n - 1, 1))

    for length in sorted(counts, reverse=True):
        demand, left, first = np.array([1, 0, 0]) * length + np.array([0, 1, 0]) + np.array([0, 0, 1]) * length * length, counts[length], 0
        if (demand > full).any():
            raise ValueError(f"a piece of {length} tokens exceeds a capacity")
        while left:
            fits = (residuals >= demand).all(axis=1) & np.fromiter(map(bool, runs), bool, len(runs)) if runs else np.zeros(0, bool)
            if fits.any():
                norm = ((((residuals - demand) / full) * weights) ** 2).sum(axis=1)
                best = int(np.argmin(np.where(fits, norm, np.inf)))
                residual, (start, n) = residuals[best], runs[best].pop()
            else:
                residual, (start, n) = full, (opened, -1)
            each = int((residual // demand).min())
            need = -(-left // each)
            if n < 0:
                n, opened = need, opened + need
            use = min(n, need)
            if use < n:
                runs[best].append((start + use, n - use))
            count = min(left, use * each)
            place(length, demand, first, (start, use), each, count - (use - 1) * each, residual)
            first, left = first + count, left - count
    return steps


def token_pieces(documents: DataFrame, tokenizer: str, tokens: int = 2048, text: str = "text", keep_ids: bool = False) -> DataFrame:
    """The columns of ``documents`` but the text, and ``piece, start, length, ids_crc32`` for every piece of its ids.

    A document's ids are the tokenizer's (no special tokens) and then ``END``; null counts as empty. Only a document of
    more than ``tokens`` ids is cut, every ``tokens`` ids. ``ids_crc32`` is taken over little-endian unsigned 32-bit ids.
    """
    kept = [c for c in documents.columns if c not in (text, "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset")]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in documents.select(*kept).schema) + "piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<long>" * keep_ids
    end = np.array([END], "<u4").tobytes()

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = word_tokens(tokenizer).packed
        row, piece, start, length, crc, ids = [], [], [], [], [], []
        for i, value in enumerate(texts(batch.column(len(kept)))):
            raw = encode(value) + end
            for k, a in enumerate(range(0, len(raw), 4 * tokens)):
                part = raw[a: a + 4 * tokens]
                row.append(i)
                piece.append(k)
                start.append(a // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                if keep_ids:
                    ids.append(np.frombuffer(part, "<u4").astype(np.int64))
        take = pa.array(row, pa.int64())
        made = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        names = ["piece", "start", "length", "ids_crc32"]
        if keep_ids:
            made.append(pa.array(ids, pa.list_(pa.int64())))
            names.append("ids")
        return pa.RecordBatch.from_arrays([batch.column(i).take(take) for i in range(len(kept))] + made, names=kept + names)

    return map_batches(documents.select(*kept, text), one, schema)


def pack(pieces: DataFrame, capacity: Capacity = Capacity()) -> DataFrame:
    """``pieces`` (with ``length``) with ``sequence_id`` and ``offset``, the piece's place there; offsets have no gaps.

    The number of pieces of each length (at most ``capacity.tokens`` numbers) is planned by ``plan``. Pieces of a length
    are then numbered: they are dealt into about the square root of their number of salted groups, numbered
    inside, and the groups' sizes are added up, so neither a group nor the list of groups is long, however common a
    length is. Equal rows may trade places, which makes no difference. An empty table packs into nothing.
    """
    spark, columns = pieces.sparkSession, [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    steps = sorted(plan(counts, capacity), key=lambda s: (s.length, s.first))
    table = np.array([[s.length << 40 | s.first, s.first, s.sequence, s.each, s.offset] for s in steps], np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(table)

    sizes = pieces.groupBy("length").agg(F.ceil(F.sqrt(F.count("*"))).alias("_salts"))
    plain = [f.name for f in pieces.schema if f.name in columns and f.dataType.typeName() not in ("map", "variant")]
    salted = pieces.select(*columns).join(F.broadcast(sizes), "length").withColumn("_salt", F.pmod(F.xxhash64(*plain), F.col("_salts"))).drop("_salts")
    groups = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = groups.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).drop("_n")
    order = Window.partitionBy("length", "_salt").orderBy(*[c for c in plain if c != "length"])
    ranked = salted.withColumn("_rank", F.row_number().over(order)).join(before, ["length", "_salt"])
    ranked = ranked.select(*columns, (F.col("_before") + F.col("_rank") - 1).cast("long").alias("_rank"))
    at_length, at_rank = ranked.columns.index("length"), ranked.columns.index("_rank")

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (at_length, at_rank))
        key, first, sequence, each, offset = shared.value[np.searchsorted(shared.value[:, 0], length << 40 | rank, side="right") - 1].T
        inside = rank - first
        made = [pa.array(sequence + inside // each), pa.array(offset + inside % each * length)]
        return pa.RecordBatch.from_arrays([*batch.columns[:at_rank], *made], names=[*columns, "sequence_id", "offset"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in ranked.drop("_rank").schema) + "sequence_id long, offset long"
    return map_batches(ranked, one, schema)


def pack_documents(documents: DataFrame, tokenizer: str, capacity: Capacity = Capacity(), text: str = "text", keep_ids: bool = False) -> DataFrame:
    """``token_pieces`` of ``documents``, stored once, and packed by ``pack``. Texts are not shuffled."""
    return pack(stored(token_pieces(documents, tokenizer, capacity.tokens, text, keep_ids)), capacity)
