"""Filter interaction audit: what every order of the filters keeps and loses, from one table of failing rows per filter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridfill.llm.common import stored

MAX_FILTERS = 6  # orders are listed in the plan: 720 of them

_SPACE = r"[\x20\x09-\x0D]+"

TEXT_FILTERS: dict[str, str] = {
    "A": "size(words) < 200",
    "B": "100 * size(array_distinct(words)) < 50 * size(words)",
    "C": "100 * regexp_count(text, '[A-Z]') > 2 * length(text)",
    "D": "rlike(text, '[#$%&*|]')",
}
"""Failure conditions over ``text`` (never null) and its ``words``: short, repetitive, in capitals, full of signs."""

COPY_FILTER = "E"


def _row(digest: Column, doc_id: Column) -> Column:
    """A row's key: 128 bits of its text's SHA-256, then its id in digits; rows of equal id and text share it."""
    return F.concat(digest, F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def text_marks(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source", conditions: Mapping[str, str] = TEXT_FILTERS) -> DataFrame:
    """``row, doc_id, digest, part`` and a boolean for each condition: one narrow row per document, made in one scan.

    Null texts count as empty, null parts as the empty string.
    """
    words = f"filter(split(text, r'{_SPACE}'), w -> w <> '')"
    plain = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                             F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    judged = plain.selectExpr("*", f"{words} AS words").selectExpr(
        "doc_id", "part", "unhex(substr(sha2(text, 256), 1, 32)) AS digest", *[f"{sql} AS `{name}`" for name, sql in conditions.items()])
    return judged.select(_row(F.col("digest"), F.col("doc_id")).alias("row"), "*")


def later_copies(marks: DataFrame) -> DataFrame:
    """``row`` of every document whose text stands under a smaller id too: all rows with an id but each text's first.

    The first row's key follows from the text's digest and its least id, so copies never meet on the text: the join is
    by row, and of a text with very many copies each task sends one line.
    """
    known = marks.where("doc_id IS NOT NULL")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).select(_row(F.col("digest"), F.col("doc_id")).alias("row"))
    return known.select("row").join(first, "row", "left_anti")


def failing_tables(marks: DataFrame, conditions: Sequence[str] = tuple(TEXT_FILTERS), copies: str | None = COPY_FILTER) -> dict[str, DataFrame]:
    """One stored table of failing rows per filter, by its letter."""
    tables = {name: stored(marks.where(F.col(name)).select("row").distinct()) for name in conditions}
    if copies:
        tables[copies] = stored(later_copies(marks).distinct())
    return tables


def survivors(rows: DataFrame, failing: Mapping[str, DataFrame], prefix: str) -> DataFrame:
    """The rows that pass all filters of ``prefix``."""
    for name in prefix:
        rows = rows.join(failing[name], "row", "left_anti")
    return rows


def removals(rows: DataFrame, failing: Mapping[str, DataFrame], prefix: str, name: str) -> DataFrame:
    """The rows that filter ``name`` removes after ``prefix``."""
    return survivors(rows, failing, prefix).join(failing[name], "row", "left_semi")


def redundancies(rows: DataFrame, failing: Mapping[str, DataFrame], prefix: str, name: str) -> DataFrame:
    """The rows that fail filter ``name`` but are gone before it."""
    fails = rows.join(failing[name], "row", "left_semi")
    return fails.join(survivors(fails, failing, prefix).select("row").distinct(), "row", "left_anti")


def _split(rows: DataFrame, relation: DataFrame, key: str, column: str, value: Column) -> DataFrame:
    """``rows`` with ``column`` set to ``value`` where the relation holds their key: a left-semi and a left-anti join, whose
    sides share their exchanges."""
    inside = rows.join(relation, key, "left_semi").withColumn(column, value)
    return inside.unionByName(rows.join(relation, key, "left_anti"))


def exact_sets(marks: DataFrame, failing: Mapping[str, DataFrame], labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: how many rows of each part fail exactly the filters of ``mask`` (bit i: the i-th of
    ``failing``), and how many of them are labelled good and toxic.

    The rows are split by one relation after the other, each time into those it holds (left-semi) and those it doesn't
    (left-anti), so each row is joined once per relation and not once per prefix. Every prefix's survivors are the union
    of the sets that share no filter with it. Each step is a stored table of narrow rows.
    """
    ids = {"good": labels.where("quality = 1"), "toxic": labels.where("toxic = 1")}
    rows = stored(marks.groupBy("row", "doc_id", "part").agg(F.count("*").alias("n"))
                  .withColumns({"mask": F.lit(0), "good": F.lit(False), "toxic": F.lit(False)}))
    for i, relation in enumerate(failing.values()):
        rows = stored(_split(rows, relation, "row", "mask", F.col("mask").bitwiseOR(F.lit(1 << i))))
    for name, labelled in ids.items():
        relation = labelled.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
        split = _split(rows, relation, "doc_id", name, F.lit(True))
        rows = split if name == "toxic" else stored(split)
    of = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("good"), of("toxic"))


def _steps(names: Sequence[str]) -> str:
    """SQL of an array: a struct for each filter after each set of others, with the orders and steps where it stands so."""
    places: dict[tuple[int, int], list[tuple[str, int]]] = {}
    for order in permutations(range(len(names))):
        before = 0
        for step, i in enumerate(order, 1):
            places.setdefault((1 << i, before), []).append(("".join(names[j] for j in order), step))
            before |= 1 << i
    structs = []
    for (bit, before), at in sorted(places.items()):
        orders = ", ".join(f"named_struct('filter_order', '{order}', 'step', {step})" for order, step in at)
        structs.append(f"named_struct('bit', {bit}, 'before', {before}, 'places', array({orders}))")
    return f"array({', '.join(structs)})"


def audit(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source",
          conditions: Mapping[str, str] = TEXT_FILTERS, copies: str | None = COPY_FILTER) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley`` for every part, every
    order of the filters and every step of it.

    ``kept`` rows pass this step's filter and those before it; ``removed`` ones fail it first, ``redundant`` ones fail it but
    were removed earlier, ``unique_fails`` fail no other filter. ``good_lost`` and ``toxic_lost`` are the removed ones with a
    label quality = 1 and toxic = 1 (any label of the id counts). ``shapley`` is what the filter removes in all orders together.

    Null texts count as empty and null parts as the empty string. A row without an id has no label and is nobody's copy.
    Repeated rows count each; rows of one id are no copies of one another. Without documents there is no part and no row.

    Joins run over keys, never over texts. What is gathered for one part are its counts, 2 ** filters at most.
    """
    names = [*conditions, *([copies] if copies else [])]
    if len(names) > MAX_FILTERS:
        raise ValueError(f"{len(names)} filters have too many orders; {MAX_FILTERS} are the most")
    marks = stored(text_marks(documents, doc_id, text, part, conditions))
    sets = exact_sets(marks, failing_tables(marks, list(conditions), copies), labels)
    gathered = sets.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("sets"))
    orders = 1
    for k in range(2, len(names) + 1):
        orders *= k

    def total(count: str, of: str) -> str:
        return f"aggregate(filter(sets, s -> {of}), 0L, (a, s) -> a + {count})"

    fails, before = "s.mask & bit <> 0", "s.mask & before"
    each = gathered.selectExpr("part", "sets", f"inline({_steps(names)})").selectExpr(
        "part", "places", f"{total('s.n', f's.mask & (bit | before) = 0')} AS kept", f"{total('s.n', f'{fails} AND {before} = 0')} AS removed",
        f"{total('s.n', f'{fails} AND {before} <> 0')} AS redundant", f"{total('s.n', 's.mask = bit')} AS unique_fails",
        f"{total('s.good', f'{fails} AND {before} = 0')} AS good_lost", f"{total('s.toxic', f'{fails} AND {before} = 0')} AS toxic_lost",
        # of a row that fails k filters, each is the first one in a k-th of all orders
        f"{total(f's.n * ({orders} div bit_count(s.mask))', fails)} AS shapley")
    counts = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return each.selectExpr("part", "inline(places)", *counts)
