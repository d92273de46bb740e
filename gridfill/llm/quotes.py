"""Quotation linking: quoted passages lead back to the messages that they come from."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from gridfill.llm.common import map_batches, stored, texts

WINDOW = 5  # words of a window
_MARK = re.compile(r"[ \t]*>[> \t]*")
_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+")
_INTRO = re.compile(r"\s*(on .* wrote:|le .* a écrit ?:|am .* schrieb.*:|el .* escribió:)\s*", re.DOTALL)
_QUOTING = r"(?m)^[ \t]*>"
BLOCK = 1024


def words(text: str) -> list[str]:
    """Letters and digits only, in lower case."""
    return _WORD.findall(text.lower())


def runs(text: str) -> list[tuple[int, int, int, list[str]]]:
    """``level, first line, line after the last, bare lines`` of each run of lines with the same number of quote marks."""
    out: list[tuple[int, int, int, list[str]]] = []
    for i, line in enumerate(text.split("\n")):
        mark = _MARK.match(line)
        level = mark.group().count(">") if mark else 0
        bare = line[mark.end():] if mark else line
        if out and out[-1][0] == level:
            out[-1] = (level, out[-1][1], i + 1, out[-1][3])
            out[-1][3].append(bare)
        else:
            out.append((level, i, i + 1, [bare]))
    return out


def _passages(batch: pa.RecordBatch) -> pa.RecordBatch:
    at, level, run, spoken = [], [], [], []

    def add(i: int, of_level: int, number: int, said: list[str]) -> None:
        if said:
            at.append(i), level.append(of_level), run.append(number), spoken.append(said)

    for i, text in enumerate(texts(batch.column("text"))):
        for number, (of_level, _, _, lines) in enumerate(runs(text)):
            add(i, of_level, number, words("\n".join(lines)))
            if of_level == 0:  # what a quotation too short for a window may be: a whole line or sentence
                for line in lines:
                    for part in {line, *_SENTENCE.split(line)}:
                        said = words(part)
                        if len(said) < WINDOW:
                            add(i, 0, number, said)
    kept = batch.select(["conv", "turn", "message"]).take(pa.array(at, pa.int64()))
    return pa.RecordBatch.from_arrays([*kept.columns, pa.array(level, pa.int32()), pa.array(run, pa.int32()), pa.array(spoken, pa.list_(pa.string()))],
                                      names=["conv", "turn", "message", "level", "run", "words"])


def passages(messages: DataFrame) -> DataFrame:
    """``conv, turn, message, level, run, gram`` of ``messages(conv, turn, message, text)``.

    A gram is a 128-bit hash of ``WINDOW`` consecutive words of a run of lines of one quote level, wherever its lines break; of all words if
    they are fewer. Own runs (level 0) also give their whole lines and sentences of fewer words.
    """
    kinds = messages.schema
    schema = StructType([kinds["conv"], kinds["turn"], kinds["message"], StructField("level", IntegerType()), StructField("run", IntegerType()),
                         StructField("words", ArrayType(StringType()))])
    split = map_batches(messages.select("conv", "turn", "message", "text"), _passages, schema)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (WINDOW - 1), F.lit(1)))
    windows = F.transform(starts, lambda i: F.array_join(F.slice("words", i, F.lit(WINDOW)), " "))
    return split.select("conv", "turn", "message", "level", "run", F.explode(windows).alias("said")).select(
        "conv", "turn", "message", "level", "run", _hash(F.col("said")).alias("gram"))


def _hash(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def unquoted(text: str, quotations: set[int]) -> tuple[str, int]:
    """A message without the given runs and the lines that introduce them, and how many quoted lines with words went."""
    every = runs(text)
    lines = text.split("\n")
    gone: set[int] = set()
    n = 0
    for number, (_, first, end, bare) in enumerate(every):
        if number not in quotations:
            continue
        gone.update(range(first, end))
        n += sum(1 for line in bare if _WORD.search(line))
        if first and first - 1 not in gone and _INTRO.fullmatch(lines[first - 1].lower()):
            gone.add(first - 1)
    return "\n".join(line for i, line in enumerate(lines) if i not in gone).strip(" \t\n\x0b\f\r"), n


def _with_blocks(df: DataFrame) -> DataFrame:
    """Turns in blocks of ``BLOCK``, so that windows over one conversation hold one block, or one row a block."""
    return df.withColumn("block", F.floor(F.col("turn") / BLOCK))


def _last_before(events: DataFrame, keys: list[str]) -> DataFrame:
    """``events`` with ``last``: the greatest ``own`` (a turn or null) of an earlier turn with the same keys."""
    inside = Window.partitionBy(*keys, "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = events.groupBy(*keys, "block").agg(F.max("own").alias("_own")).withColumn("_carried", F.max("_own").over(ahead)).drop("_own")
    near = events.withColumn("_near", F.max("own").over(inside))
    return near.join(blocks, [*keys, "block"]).withColumn("last", F.coalesce("_near", "_carried")).drop("_near", "_carried")


def _messages(rows: DataFrame, conv_id: str, turn: str, text: str) -> DataFrame:
    """``conv, turn, text, message``: the last is a hash that tells messages of one turn apart."""
    return rows.select(F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("message", _hash(F.col("text")))


def find_quotations(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """``conv, turn, message, level, run, source, n_found``: which earlier message of its conversation each quotation comes from.

    A run of quoted lines is a quotation if at least half of its grams (``passages``) stand in own text of earlier messages, so it may be
    wrapped anew, be part of a line or leave words out. Each gram comes from the latest earlier message that has it; of these
    messages the one with most of the run's grams is the source, and of several the latest. A run of fewer than ``WINDOW``
    words has one gram and has to be a whole own line, sentence or run. Conversations and turns that are null link nothing.

    Only conversations with a quote mark are read for passages. Own grams meet quoted ones by (conversation, gram), never in
    pairs: turns are sorted, and each quoted gram looks back.
    """
    known = _messages(messages, conv_id, turn, text).where("conv IS NOT NULL AND turn IS NOT NULL")
    quoting = known.where(F.col("text").rlike(_QUOTING)).select("conv").distinct()
    every = stored(passages(known.join(quoting, "conv", "left_semi").dropDuplicates(["conv", "turn", "message"])).distinct())
    quoted = every.where("level > 0")
    asked = quoted.select("conv", "gram", "turn").distinct()
    original = every.where("level = 0").select("conv", "gram", "turn").distinct().join(asked.select("conv", "gram").distinct(), ["conv", "gram"], "left_semi")
    # a message that quotes and says the same looks back from one row
    events = original.withColumns({"own": F.col("turn"), "asks": F.lit(False)}).unionByName(
        asked.withColumns({"own": F.lit(None).cast(asked.schema["turn"].dataType), "asks": F.lit(True)}))
    latest = _last_before(_with_blocks(events), ["conv", "gram"]).where("asks AND last IS NOT NULL").select("conv", "gram", "turn", F.col("last").alias("source"))
    votes = quoted.join(latest, ["conv", "gram", "turn"], "left")
    run = ["conv", "turn", "message", "level", "run"]
    counts = votes.groupBy(*run, "source").agg(F.count("*").alias("n"))
    best = F.max(F.when(F.col("source").isNotNull(), F.struct("n", "source")))
    found = F.sum(F.when(F.col("source").isNotNull(), F.col("n")).otherwise(0))
    return counts.groupBy(*run).agg(F.sum("n").alias("n_grams"), found.alias("n_found"), best.alias("best")).where("2 * n_found >= n_grams").select(
        *run, F.col("best.source").alias("source"), F.col("best.n").alias("n_found"))


def link_quotes(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """``conv, turn, level, source_turn, n_grams``: the source of each quotation level (``find_quotations``).

    Of several sources the one with most grams of the level, and of several such the latest.
    """
    return _sources(find_quotations(messages, conv_id, turn, text))


def _sources(quotations: DataFrame) -> DataFrame:
    counts = quotations.groupBy("conv", "turn", "level", "source").agg(F.sum("n_found").alias("n_grams"))
    return (counts.groupBy("conv", "turn", "level").agg(F.max(F.struct("n_grams", "source")).alias("best"))
            .select("conv", "turn", "level", F.col("best.source").alias("source_turn"), F.col("best.n_grams").alias("n_grams")))


def _clean(batch: pa.RecordBatch) -> pa.RecordBatch:
    gone = batch.column("quotations").to_pylist()
    done = [unquoted(t, set(g or ())) for t, g in zip(texts(batch.column("text")), gone)]
    kept = [batch.column(c) for c in ("conv", "turn", "role")]
    return pa.RecordBatch.from_arrays([*kept, pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())],
                                      names=["conv", "turn", "role", "text", "n_quoted"])


def _depths(parents: DataFrame) -> DataFrame:
    """``conv, turn, parent, depth`` of ``conv, turn, parent``; ancestors are followed by doubling."""
    known = stored(parents.select("conv", "turn", "parent", F.col("parent").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("depth")))
    while not known.where("up IS NOT NULL").isEmpty():
        above = known.select("conv", F.col("turn").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"))
        moved = known.where("up IS NOT NULL").join(above, ["conv", "up"]).select(
            "conv", "turn", "parent", F.col("_up").alias("up"), (F.col("depth") + F.col("_depth")).alias("depth"))
        known = stored(known.where("up IS NULL").unionByName(moved))
    return known.select("conv", "turn", "parent", "depth")


def thread_conversations(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, parent_turn, depth, position, n_quoted`` for each row of ``messages``: in reply order, without quotes.

    The parent is the source of the least quoted level that has one (``find_quotations``); without any it is the message before,
    by ``turn``. ``depth`` counts the steps from the conversation's first message. ``position`` numbers a conversation's turns
    from 0; a message stands after its parent. Quotations go, with the line that introduces them; ``n_quoted`` counts their lines that
    have words. Lines behind a quote mark that quote no earlier message stay: they may be a prompt or code.

    Null texts count as empty; rows with a null conversation or turn stand alone (parent null, depth 0, position null, text kept).
    Rows that repeat conversation and turn share parent, depth and position. An empty table gives no rows.

    Windows hold a block of turns, or one row for each block, so a conversation with very many messages is many tasks;
    parents are followed by doubling, so long chains need few rounds.
    """
    found = stored(find_quotations(messages, conv_id, turn, text))
    rows = _messages(messages, conv_id, turn, text).select("conv", "turn")
    links = _sources(found).groupBy("conv", "turn").agg(F.min(F.struct("level", "source_turn")).alias("nearest"))
    turns = rows.where("conv IS NOT NULL AND turn IS NOT NULL").distinct()
    turns = _with_blocks(turns).withColumn("own", F.col("turn"))
    ahead = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = turns.groupBy("conv", "block").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
    placed = _last_before(turns, ["conv"]).join(blocks, ["conv", "block"])
    placed = placed.withColumn("position", F.col("_before") + F.row_number().over(Window.partitionBy("conv", "block").orderBy("turn")) - 1)
    placed = stored(placed.join(links, ["conv", "turn"], "left").select("conv", "turn", "position", F.coalesce("nearest.source_turn", "last").alias("parent")))
    known = placed.select("conv", "turn", "position").join(_depths(placed), ["conv", "turn"])
    named = messages.select(F.col(role).alias("role"), F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    gone = found.groupBy("conv", "turn", "message").agg(F.collect_set("run").alias("quotations"))  # at most a message's own runs
    marked = named.withColumn("message", _hash(F.col("text"))).join(gone, ["conv", "turn", "message"], "left")
    kinds = named.schema
    schema = StructType([kinds["conv"], kinds["turn"], kinds["role"], kinds["text"], StructField("n_quoted", LongType())])
    clean = map_batches(marked.select("conv", "turn", "role", "text", "quotations"), _clean, schema)
    out = clean.join(known, ["conv", "turn"], "left")
    return out.select(F.col("conv").alias(conv_id), F.col("turn").alias(turn), F.col("role").alias(role), F.col("text").alias(text),
                      F.col("parent").alias("parent_turn"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
                      F.col("position").cast("long").alias("position"), "n_quoted")
