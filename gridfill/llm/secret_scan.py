"""Secret scanning over an incremental ledger of content-addressed texts."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfill.llm.common import map_batches, stored, texts

RULES = {
    "assign": (1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": (1, r"AKIA[A-Z0-9]+"),
    "hex": (1, r"[0-9a-f]+"),
    "pem": (1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    "jwt": (1, r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
}
"""Kind: (version, pattern). A changed pattern gets a new version, and every known text is scanned for it again."""

BASE = ("assign", "access", "hex")

_ASSIGN = re.compile(RULES["assign"][1], re.IGNORECASE | re.ASCII)
_KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
# A run that is too short holds no long enough run either, so the bound may stand in the pattern.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_PEM = re.compile(RULES["pem"][1])
_JWT = re.compile(RULES["jwt"][1])


def find_secrets(text: str, kinds: tuple[str, ...] = tuple(RULES)) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points of all secrets, by start and then by the order of the kinds."""
    found = []
    if "assign" in kinds and any(k in low for k in _KEYWORDS for low in (text.lower(),)):
        found += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "access" in kinds and "AKIA" in text:
        found += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    if "hex" in kinds:
        found += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    if "pem" in kinds and "PRIVATE KEY-----" in text:
        found += [(*m.span(), "pem") for m in _PEM.finditer(text)]
    if "jwt" in kinds and "eyJ" in text:
        found += [(*m.span(), "jwt") for m in _JWT.finditer(text)]
    order = list(RULES)
    return sorted(found, key=lambda s: (s[0], order.index(s[2]), s[1]))


LEDGER = "blob string, scanned array<string>, found array<struct<start:int,rank:int,end:int,kind:string>>"


def _rule(kind: str) -> str:
    return f"{kind}:{RULES[kind][0]}"


def _scan_blobs(todo: DataFrame) -> DataFrame:
    """Ledger rows for ``todo(blob, text, seen)``: each text is scanned for the rules that ``seen`` lacks."""
    rank = {kind: i for i, kind in enumerate(RULES)}

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        scanned, found = [], []
        for text, seen in zip(texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            kinds = tuple(k for k in RULES if _rule(k) not in seen)
            scanned.append([_rule(k) for k in kinds])
            found.append([{"start": a, "rank": rank[k], "end": b, "kind": k} for a, b, k in find_secrets(text, kinds)])
        kind = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scanned, pa.list_(pa.string())), pa.array(found, pa.list_(kind))],
                                          names=["blob", "scanned", "found"])

    return map_batches(todo.select("blob", "text", "seen"), one, LEDGER)


def scan_versions(versions: DataFrame, path: list[str], ledger: DataFrame | None = None, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The secrets of every version, and the ledger rows to append.

    ``versions`` holds every historical version of every path, ``path`` names the columns that tell versions apart.
    A text is known by its SHA-256 (null counts as empty). Of each text, one version is scanned, and only for rules
    (kind and version) that ``ledger`` doesn't list for it; findings, old and new, then go to all versions with that
    text. The first result has the ``path`` columns and ``found`` in code points, by start and then by kind; one row for
    each row of ``versions``. Append the second, a stored table, to the ledger (schema ``LEDGER``).

    Only hashes and one copy of each unseen text are shuffled. The join back to the versions is on blobs with findings,
    and may be split where one blob has very many versions. Null paths are allowed; rows that repeat path and text
    are scanned once more, and give the same; an empty table gives empty results.
    """
    spark = versions.sparkSession
    keys = [f"_{i}" for i in range(len(path))]
    rows = versions.select(*[F.col(p).alias(k) for p, k in zip(path, keys, strict=True)], F.coalesce(F.col(text), F.lit("")).alias("text"))
    named = rows.select(*keys, F.sha2("text", 256).alias("blob"))
    known = (spark.createDataFrame([], LEDGER) if ledger is None else ledger).select("blob", F.explode("scanned").alias("rule"))
    seen = known.where(F.col("rule").isin([_rule(k) for k in RULES])).groupBy("blob").agg(F.sort_array(F.collect_set("rule")).alias("seen"))
    one = named.groupBy("blob").agg(F.min(F.struct(*keys)).alias("at")).select("at.*", "blob")
    if ledger is None:
        one = one.withColumn("seen", F.array().cast("array<string>"))
    else:
        one = one.join(seen, "blob", "left").where(F.coalesce(F.size("seen"), F.lit(0)) < len(RULES)).withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
    place = [one[k].eqNullSafe(rows[k]) for k in keys]
    todo = rows.join(one, on=place, how="inner").where(F.sha2(rows.text, 256) == one.blob).select("blob", "text", "seen")
    new = stored(_scan_blobs(todo).dropDuplicates(["blob"]))
    every = new if ledger is None else ledger.select(*[x.split()[0] for x in LEDGER.split(", ")]).unionByName(new)
    rules = F.array(*[F.lit(k) for k in RULES])
    hits = every.where(F.size("found") > 0).select("blob", F.explode("found").alias("f")).where(F.array_contains(rules, F.col("f.kind"))).distinct()
    hits = hits.groupBy("blob").agg(F.sort_array(F.collect_list("f")).alias("found"))
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    out = named.join(hits, "blob", "left").select(*[F.col(k).alias(p) for p, k in zip(path, keys, strict=True)], F.coalesce("found", empty).alias("found"))
    return out, new
