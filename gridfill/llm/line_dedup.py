"""Boilerplate lines: lines that stand on a large share of one site's pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_SHARE = 0.1
MIN_PAGES = 2


def _hash(column: Column) -> Column:
    return F.unhex(F.substring(F.sha2(column, 256), 1, 32))


def _lines(text: Column) -> Column:
    """Number, hash and emptiness of each line; blank lines are never boilerplate."""
    return F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("at"), F.when(F.trim(x) != "", _hash(F.trim(x))).alias("line")))


def boilerplate_lines(documents: DataFrame, host: str = "source", text: str = "text", max_share: float = MAX_SHARE, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, line, pages, host_pages`` of lines on more than ``max_share`` of a host's pages and on ``min_pages`` at least.

    ``line`` is a 128-bit hash of the line without spaces around it. Documents of one host with the same text are one
    page, so a page that was fetched many times makes no boilerplate. Null hosts are one host, null texts no pages.
    Counts are summed in every task before they are shuffled by (host, line).
    """
    pages = documents.where(F.col(text).isNotNull()).select(F.col(host).alias("host"), _hash(F.col(text)).alias("page"), F.col(text).alias("text"))
    totals = pages.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("host_pages"))
    lines = pages.select("host", "page", F.explode(F.array_distinct(F.transform(_lines(F.col("text")), lambda s: s["line"]))).alias("line"))
    counts = (lines.where("line IS NOT NULL").distinct().groupBy("host", "line").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages))
    return (counts.join(totals.withColumnRenamed("host", "_host"), F.col("host").eqNullSafe(F.col("_host")))
            .where(F.col("pages") > F.lit(max_share) * F.col("host_pages")).select("host", "line", "pages", "host_pages"))


def drop_boilerplate(documents: DataFrame, host: str = "source", text: str = "text", max_share: float = MAX_SHARE, min_pages: int = MIN_PAGES) -> DataFrame:
    """``documents`` without their hosts' boilerplate lines, with ``n_lines`` and ``n_dropped`` (replaced if there).

    Lines end at ``\\n`` and are compared without spaces around them; the lines that stay are joined by ``\\n``. Lines of
    up to ``min_pages - 1`` pages always stay, so small sites keep their pages. A null text stays null with 0 lines;
    an empty one has one, blank, line. Repeated rows lose the same lines.

    Texts move once, to their (host, page) hash; what moves otherwise are line hashes. No group is gathered: only the
    numbers of one page's dropped lines meet in a list.
    """
    mark = boilerplate_lines(documents, host, text, max_share, min_pages).select("host", "line")
    rows = documents.select(F.struct("*").alias("row"), F.col(host).alias("host"), F.col(text).alias("text"), _hash(F.col(text)).alias("page"))
    lines = rows.where("text IS NOT NULL").select("host", "page", F.explode(_lines(F.col("text"))).alias("s")).select("host", "page", "s.*").where("line IS NOT NULL")
    hit = (lines.join(mark.withColumnsRenamed({"host": "_host", "line": "_line"}), F.col("host").eqNullSafe(F.col("_host")) & (F.col("line") == F.col("_line")), "left_semi")
           .groupBy(F.col("host").alias("_host"), F.col("page").alias("_page")).agg(F.collect_set("at").alias("drop")))
    split = F.split("text", "\n")
    kept = F.array_join(F.filter(split, lambda x, i: ~F.array_contains("drop", i)), "\n")
    out = rows.join(hit, F.col("host").eqNullSafe(F.col("_host")) & (F.col("page") == F.col("_page")), "left")
    new = F.when(F.col("drop").isNull(), F.col("text")).otherwise(kept)
    own = [new.alias(c) if c == text else F.col("row")[c].alias(c) for c in documents.columns if c not in ("n_lines", "n_dropped")]
    return out.select(*own, F.coalesce(F.size(split), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"))
