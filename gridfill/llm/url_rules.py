"""Allow and block rules over URLs, found through hashed host-suffix and path-prefix expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridfill.llm.common import ascii_lower

SHORT_PREFIX = 8
"""Hexadecimal digits of a digest that are looked up first; the full digest is confirmed afterwards."""

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, _PARTS, 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """The columns of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (columns of these names are replaced).

    ``rules`` has ``host``, ``path`` (null: any) and ``action``, ``allow`` or ``block``. A rule fits its host and all
    subdomains where the URL's path starts with the rule's. Of several, the longest ``host`` + ``path`` wins, and of
    equally long ones ``block``. Without a rule, ``rule`` is null and ``verdict`` is ``default``.

    Each different host and path is expanded into its host suffixes and path prefixes, of those label counts and
    lengths that occur among the rules (so their number doesn't grow with the pages). Expressions meet rules on the
    first digits of their SHA-256; then the whole digest must agree. Everything is equi-joins and one partly
    aggregated grouping: a URL or host with a third of all rows is one row here, and the last join, from rows to
    decisions, may be split where it is hot.

    A null URL, or one without ``://``, has empty host and path and fits no rule. Rules without a host or with
    another action are not used. Repeated pages are judged alike, each as a row of its own; an empty table gives no rows.
    """
    rules = (rules.where("host <> '' AND action IN ('allow', 'block')")
             .select(ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "action"))
    shapes = rules.agg(F.collect_set(F.size(F.split("host", r"\."))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")).first()
    known = (rules.groupBy("host", "path").agg(F.max("action").alias("action"))
             .select(_digest(F.col("host"), F.col("path")).alias("digest"), F.concat("host", "path").alias("rule"), "action")
             .withColumn("short", F.substring("digest", 1, SHORT_PREFIX)))

    rows = pages.select(F.struct("*").alias("row"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    kinds = rows.select("host", "path").where("host <> ''").distinct()
    parts = F.split("host", r"\.")
    suffixes = F.array(*[F.when(F.size(parts) >= n, F.array_join(F.slice(parts, F.size(parts) - (n - 1), n), ".")) for n in shapes.labels])
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in shapes.lengths])
    seen = (kinds.withColumn("suffix", F.explode(suffixes)).where("suffix IS NOT NULL")
            .withColumn("prefix", F.explode(prefixes)).where("prefix IS NOT NULL")
            .select("host", "path", _digest(F.col("suffix"), F.col("prefix")).alias("found"))
            .withColumn("short", F.substring("found", 1, SHORT_PREFIX)))
    best = F.max(F.struct(F.length("rule"), "action", "rule"))
    decided = (seen.join(known, "short").where("found = digest").groupBy("host", "path").agg(best.alias("best"))
               .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.action").alias("verdict")))
    kept = [F.col("row")[c].alias(c) for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    return rows.join(decided, ["host", "path"], "left").select(
        *kept, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
