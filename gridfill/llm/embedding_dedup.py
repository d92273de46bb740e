"""Near-duplicate vectors: random-hyperplane signs in several tables, exact cosines, and linked groups."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfill.llm.common import blocks_of, components, least_root, map_batches, map_groups, stored

COSINE = 0.95
MISS = 0.002
"""The share of pairs exactly at the threshold that all tables together may miss; closer pairs are missed less often."""

BLOCK = 256
MAX_BITS = 31


def tables_for(n: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """Sign bits in a table, so that unrelated vectors rarely share a bucket, and tables, so that no more is missed than ``miss``."""
    bits = min(MAX_BITS, max(8, math.ceil(math.log2(max(2, n) / 4))))
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-agree))


def sign_codes(vectors: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """``id, codes``: for each vector one code a table, of the signs of ``bits`` projections on random hyperplanes."""
    planes: dict[int, np.ndarray] = {}
    weights = (1 << np.arange(bits, dtype=np.int64))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(1)
        values, cut = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy())))
        width = np.diff(cut)
        codes = np.zeros((batch.num_rows, tables), np.int64)
        for d in np.unique(width).tolist():
            if d not in planes:
                planes[d] = np.random.default_rng([seed, d]).standard_normal((d, tables * bits))
            rows = np.flatnonzero(width == d)
            x = values[cut[rows][:, None] + np.arange(d)]
            signs = (x @ planes[d] > 0).reshape(len(rows), tables, bits)
            codes[rows] = signs @ weights + (d << 32)  # vectors of different widths never meet
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(codes), pa.list_(pa.int64()))], names=["id", "codes"])

    return map_batches(vectors.select("id", "embedding"), one, "id long, codes array<long>")


def _link_blocks(rows: pa.RecordBatch, bounds: np.ndarray, cosine: float) -> pa.RecordBatch:
    name = {n: i for i, n in enumerate(rows.schema.names)}
    own, p, q, ids, m, table = (rows.column(name[c]).to_numpy(zero_copy_only=False) for c in ("_own", "_p", "_q", "id", "m", "table"))
    column = rows.column(name["embedding"])
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    cut = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy())))
    all_codes = rows.column(name["codes"])
    codes = all_codes.flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a < 2:
            continue
        x = values[cut[a]: cut[b]].reshape(b - a, -1)
        x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components stay in range
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        links = np.triu(x @ x.T >= cosine, 1)
        if p[a] != q[a]:  # pairs inside one block are met where a block stands alone
            links &= own[a:b, None] != own[None, a:b]
        i, j = np.nonzero(links)
        keep = ids[a + i] != ids[a + j]
        if table[a]:  # a pair counts in the first table where it meets
            keep &= ~(codes[a + i, : table[a]] == codes[a + j, : table[a]]).any(axis=1)
        i, j = i[keep], j[keep]
        if len(i):
            met = np.zeros((b - a, b - a), bool)
            met[i, j] = True
            n = np.bincount(i, m[a + j], b - a) + np.bincount(j, m[a + i], b - a)
            some = np.flatnonzero(n)
            out.append((ids[a + some], n[some].astype(np.int64), ids[a + least_root(met)[some]]))
    joined = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
    return pa.RecordBatch.from_arrays([pa.array(x) for x in joined], names=["id", "n", "root"])


def link_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE, miss: float = MISS, seed: int = 7) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors``.

    Pairs whose codes agree in any table are linked if their cosine, in double precision, is ``cosine`` or more.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the least id reachable, ``kept`` tells whether
    that is the row's own id.

    Equal vectors are first made one, with their number. A bucket (all vectors with one code in one table) is cut into
    blocks of about ``BLOCK`` vectors, and two blocks at a time are multiplied; a pair that meets in several tables
    counts in the first. A pair of blocks returns, for each vector, a count and one link towards its group inside the pair,
    never the pairs. The numbers of bits and tables follow from the number of different vectors.

    Vectors that are null, empty, zero or hold nulls or non-finite numbers link with nothing; so do rows without an id
    (their component is null and they are not kept). Vectors of different widths never link. Rows with the same id are
    one vector to others: their links add up. An empty table gives no rows.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.coalesce(F.col("id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    good = rows.where(usable)
    classes = stored(good.groupBy("embedding").agg(F.min("id").alias("id"), F.count("*").alias("m")))
    bits, tables = tables_for(classes.count(), cosine, miss)
    codes = stored(sign_codes(classes, bits, tables, seed))
    places = codes.select("id", F.posexplode("codes").alias("table", "code"))
    crowded = stored(places.groupBy("table", "code").agg(F.count("*").alias("size")).where("size > 1"))
    met = blocks_of(places.join(crowded, ["table", "code"]), ["table", "code"], "size", "id", BLOCK).select("id", "table", "code", "_own", "_p", "_q")
    full = met.join(classes, "id").join(codes, "id").select("id", "table", "code", "_own", "_p", "_q", "m", "embedding", "codes")
    found = stored(map_groups(full, ["table", "code", "_p", "_q"], lambda r, b: _link_blocks(r, b, cosine), "id long, n long, root long"))
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    groups = components(found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")).distinct())
    known = (classes.select("id", "m", "embedding").join(links, "id", "left")
             .join(groups.withColumnRenamed("node", "id"), "id", "left")
             .select("embedding", "m", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "id").alias("component")))
    out = rows.withColumn("_good", usable).join(known.withColumn("_good", F.lit(True)), ["embedding", "_good"], "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(vec_id), F.coalesce(F.col("m") - 1 + F.col("n"), F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))
