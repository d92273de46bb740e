"""Helpers shared by the text operators: shared storage, Arrow workers, hashing and linked groups."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

ROWS = 1000

_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``. Only a local session may go without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _own_folder:
            _own_folder.append(tempfile.mkdtemp(prefix="gridfill-"))
        root = _own_folder[0]
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder: read again without being computed again,
    and there after executors are lost."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(column):
    """A-Z in lower case; other letters stay."""
    return F.translate(column, UPPER, LOWER)


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; a null counts as empty."""
    return column.cast(pa.binary()).fill_null(b"").to_pylist()


def texts(column: pa.Array) -> list[str]:
    """The strings of a column; a null counts as empty."""
    return column.fill_null("").to_pylist()


_word_tables: list[dict] = []


def only(*tables: dict, limit: int) -> None:
    """Keeps a worker's memory to the word tables of one operator: empties all others, and those of over ``limit`` words."""
    for known in _word_tables:
        if not any(known is t for t in tables):
            known.clear()
    _word_tables[:] = tables
    for table in tables:
        if len(table) > limit:
            table.clear()


BATCH_BYTES = "67108864b", "16m"
"""Spark's own bound on an Arrow batch, and the one set in its place; a session's own bound stays."""


def with_workers(spark: SparkSession) -> None:
    """Lets workers import this package, and bounds the bytes of the Arrow batches that they get.

    On a cluster the package comes by ``--py-files``; workers on this machine find it here.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) == BATCH_BYTES[0]:
        spark.conf.set(name, BATCH_BYTES[1])


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType) -> DataFrame:
    """``function`` over the Arrow batches of ``df``, up to ``ROWS`` rows at a time; it must look at each row for itself."""
    with_workers(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, ROWS):  # Python objects of a few rows at a time
                out = function(batch.slice(row, ROWS))
                if out is not None and out.num_rows:
                    yield out
                del out
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from all values in a row and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def least_root(links: np.ndarray) -> np.ndarray:
    """For a square boolean matrix of links, the least index that each row reaches."""
    n = len(links)
    root = np.arange(n)
    links = links | links.T
    np.fill_diagonal(links, True)
    while True:
        new = np.where(links, root[None, :], n).min(axis=1)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node reachable) for every node of ``edges(a, b)``.

    Labels fall to the least label among neighbours and then jump to their label's label, so the number of rounds
    grows with the logarithm of a group's width. Labels and edges are stored tables: both sides of each join are
    plain exchanges, which adaptive execution may split where a node or label is hot. Null ends are no edges.
    """
    pairs = edges.where("a <> b")
    sides = stored(pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(sides.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component")))
    while True:
        near = (sides.join(labels, sides.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        met = stored(labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("label")))
        jump = met.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = stored(met.join(jump, "label").select("node", "old", F.least("label", "next").alias("component")))
        if new.where("component <> old").isEmpty():
            return new.select("node", "component")
        labels = new.select("node", "component")


def map_groups(df: DataFrame, keys: list[str], function: Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """``function(rows, bounds)`` over rows dealt and sorted by ``keys`` (integer columns without nulls).

    Each call gets whole groups only: group ``i`` is ``rows[bounds[i]:bounds[i + 1]]``. Memory holds one batch and one
    group, so callers bound their groups.
    """
    spark = df.sparkSession
    with_workers(spark)
    at = [df.columns.index(k) for k in keys]

    def bounds(rows: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(rows.num_rows, bool)
        new[:1] = True
        for i in at:
            column = rows.column(i).to_numpy(zero_copy_only=False)
            new[1:] |= column[1:] != column[:-1]
        return np.append(np.flatnonzero(new), rows.num_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if open_ and all(open_[-1].column(i)[-1].as_py() == batch.column(i)[0].as_py() == batch.column(i)[-1].as_py() for i in at):
                open_.append(batch)  # still the same group
                continue
            rows = pa.concat_batches([*open_, batch])
            cut = bounds(rows)
            if len(cut) > 2:
                yield function(rows.slice(0, cut[-2]), cut[:-1])
            open_ = [rows.slice(cut[-2])]
        if open_:
            rows = pa.concat_batches(open_)
            yield function(rows, bounds(rows))

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def blocks_of(groups: DataFrame, keys: list[str], size: str, row: str, block: int) -> DataFrame:
    """Rows of ``groups`` once for every pair of blocks that they stand in: ``_p`` <= ``_q``, and ``_own``, the row's block.

    A group of ``size`` rows is dealt into ``size / block`` blocks by a hash of ``row``, so that any two rows of a group
    meet in exactly one pair of blocks and no task sees much more than two blocks.
    """
    n = F.greatest(F.lit(1), F.ceil(F.col(size) / block)).cast("int")
    dealt = groups.withColumn("_n", n).withColumn("_own", F.pmod(F.xxhash64(row), F.col("_n")).cast("int"))
    met = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return met.withColumns({"_p": F.least("_own", "_other"), "_q": F.greatest("_own", "_other")}).drop("_n", "_other")
