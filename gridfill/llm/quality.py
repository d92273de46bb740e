"""A weak-label quality classifier: heuristic labellers, an EM model of their accuracies, and a hashed linear scorer."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, IntegerType, StructField, StructType

from gridfill.llm.common import ROWS, lists, map_batches, map_groups, only, stored, texts, with_workers

BITS = 18
SHAPES = 4096
LABEL_TRUST = 0.99
STEM = 5
STEMS = range(4, 9)
CACHE = 300_000

INSULTS = """
    arschloch asshole bastard bête clown conne connard crétin crap depp disgusting dumb dummkopf estúpido freak garbage
    gilipollas hideous idiot idiota idiote idioten imbécil imbecile imbécile jerk loser lowlife maldito moron nutjob
    pathetic pig rat salaud salope scum scumbag stupid stupide trash trottel verlierer vermin worthless
""".split()
"""Common insults of four languages, for the labeller that knows words only."""

LOW = ("capitals", "marks", "symbols", "repetition", "echo", "run-on", "prose")
TOXIC = ("insults", "insult share", "learned words")
"""The labellers. Most know one kind of fault and keep silent otherwise; "prose" finds none, "insults" votes either way."""

_EDGE = "".join(chr(i) for i in range(33, 192) if not chr(i).isalnum())
_KINDS = {i: "A" if chr(i).isupper() else "a" if chr(i).isalpha() else "0" for i in range(1 << 16) if chr(i).isalnum()}
_LOWER_RUN, _UPPER_RUN = re.compile("a{2,}"), re.compile("A{2,}")
_MARKS = re.compile(r"[^\w\s.,;:?'\"()-]{2,}$|^[^\w\s]+$|[!?]{2,}$")
_PLAIN = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100)) + b" \t\r\n"


@dataclass(frozen=True)
class Settings:
    """Bounds of the samples that are fitted on; everything else sees all rows.

    ``labelled`` rows with labels teach the learned-words labeller at most, ``sample`` rows with posteriors the scorer: a
    share of ``gold`` with labels and the rest without, at every size; where one kind is too few, the other fills up. All
    are the rows with the least hashes of their ids, so they are the same ones wherever the table is read. A posterior
    without a label counts ``weak`` times as much as a label, since labellers miss faults that labels show.
    """

    labelled: int = 8000
    sample: int = 8000
    gold: float = 0.8
    weak: float = 0.2
    lexicon: int = 500
    reject: float = 0.5


class _Words(dict):
    """Per word: its hashed feature, its shape, that of its stem, and five flags (in capitals, marked, at a sentence's end, an
    insult, taught by labels), packed into one number."""

    def __init__(self, lexicon: frozenset[str]):
        super().__init__()
        self.lexicon = lexicon
        self.stems: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        core = (word if word.isalpha() else word.strip(_EDGE)).lower()
        begun = core[:STEM]
        if (stem := self.stems.get(begun)) is None:
            if len(self.stems) > CACHE:
                self.stems.clear()
            stem = self.stems[begun] = _hash(begun + "-") % (1 << BITS)
        value = self[word] = _hash(core) % (1 << BITS) | _shape(_outline(word)) << BITS | stem << 30 | self.flags(word, core) << 48
        return value

    def flags(self, word: str, core: str) -> int:
        flags = (core in _INSULTS) << 3
        if not word.islower():
            flags |= len(core) > 1 and word.isupper()
        if not word.isalpha():
            flags |= bool(_MARKS.search(word)) << 1 | (word[-1] in ".!?") << 2
        if known := self.lexicon:
            flags |= (core in known or core[:4] in known or core[:5] in known or core[:6] in known or core[:7] in known or core[:8] in known) << 4
        return flags


def _outline(word: str) -> str:
    """A word's letters as A and a and its figures as 0, runs of small letters as one."""
    if word.isalpha() and word.isascii():  # most are, and need no search for runs
        if word.islower():
            return "a"
        if word[0].isupper() and word[1:].islower():
            return "Aa"
    return _runs(word)


def _runs(word: str) -> str:
    return _UPPER_RUN.sub("AA", _LOWER_RUN.sub("a", word[:40].translate(_KINDS)))[:8]


@lru_cache(maxsize=1 << 14)
def _shape(outline: str) -> int:
    return _hash(outline) % SHAPES


def _hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode())


_INSULTS = frozenset(INSULTS)
_tables: dict[frozenset[str], _Words] = {}


def _table(lexicon: frozenset[str]) -> _Words:
    if lexicon not in _tables:
        _tables.clear()
        _tables[lexicon] = _Words(lexicon)
    table = _tables[lexicon]
    only(table, limit=CACHE)
    return table


def _votes(share: list[float], symbols: float, top: float, echo: float, span: float, n: int) -> list[int]:
    prose = share[0] < 0.1 and share[1] < 0.03 and symbols < 0.06 and top < 0.2 and echo < 0.05 and span < 60
    votes = [share[0] > 0.2, share[1] > 0.08, symbols > 0.1, top > 0.3 and n >= 10, echo > 0.15 and n >= 10, span > 80, -prose,
             1 if share[3] else -1, share[3] > 0.004, share[4] > 0]
    return [int(v) for v in votes]


def describe(text: str, table: _Words) -> tuple[list[int], np.ndarray, np.ndarray]:
    """What one look at a text gives: the votes of the labellers (1 bad, -1 good, 0 none), its hashed features, and the values of
    those that are shapes; all others have the value 1. Features are words and their stems, then shapes, then ``STEPS`` steps."""
    words = text.split()
    n = len(words)
    counts = Counter(words)
    packed = np.fromiter(map(table.__getitem__, counts), np.int64, len(counts))
    times = np.fromiter(counts.values(), np.float64, len(counts))
    flags = packed >> 48
    some = np.flatnonzero(flags)
    share = (((flags[some, None] >> _FLAGS & 1) * times[some, None]).sum(axis=0) / max(n, 1)).tolist()
    raw = text.encode()
    symbols = len(raw.translate(None, _PLAIN)) / max(len(raw), 1)
    top = float(times.max()) / n if n else 1.0
    echo = sum(map(eq, words, words[1:])) / max(n, 1)
    span = n / (share[2] * n + 1)

    shapes = np.bincount(packed >> BITS & SHAPES - 1, times)
    kinds = np.flatnonzero(shapes)
    bucket = (1 << BITS) + SHAPES
    steps = [bucket + min(9, int(10 * top)), bucket + 10 + min(9, int(20 * echo)), bucket + 20 + min(9, int(np.log2(n + 1))), bucket + 30 + min(9, int(50 * symbols)),
             bucket + 40 + min(9, int(np.log2(span + 1)))]
    features = np.concatenate((_distinct(np.concatenate((packed, packed >> 30)) & (1 << BITS) - 1), (1 << BITS) + kinds, steps))
    return _votes(share, symbols, top, echo, span, n), features, 4 * shapes[kinds] / max(n, 1)


def _values(lengths: np.ndarray, shapes: np.ndarray, n_shapes: np.ndarray) -> np.ndarray:
    """The values of all features of several texts in a row, from the values of their shapes."""
    values = np.ones(lengths.sum())
    first = np.cumsum(lengths) - STEPS - n_shapes
    values[np.repeat(first - (np.cumsum(n_shapes) - n_shapes), n_shapes) + np.arange(len(shapes))] = shapes
    return values


def _distinct(x: np.ndarray) -> np.ndarray:
    x.sort()
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


STEPS = 5
N_FEATURES = (1 << BITS) + SHAPES + 50
_FLAGS = np.arange(5)


def _learned_words(documents: DataFrame, labels: DataFrame, settings: Settings) -> frozenset[str]:
    """Words and beginnings of words (of ``STEMS`` letters) that labelled toxic texts hold far more often than others."""
    known = labels.where("toxic IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.labelled)
    whole = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}_]+"))
    begun = F.flatten(F.transform(whole, lambda w: F.array(w, *[F.substring(w, 1, k) for k in STEMS])))
    words = documents.join(F.broadcast(known), "doc_id").select("toxic", F.explode(F.array_distinct(begun)).alias("word")).where("length(word) >= 3")
    total = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = max(1, total.get(1, 0)), max(1, total.get(0, 0))
    counts = words.groupBy("word").agg(F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("bad"), F.sum(F.when(F.col("toxic") == 0, 1).otherwise(0)).alias("good"))
    found = counts.where((F.col("bad") >= F.greatest(F.lit(5), F.lit(0.05 * bad))) & (F.col("bad") / bad > 20 * (F.col("good") + 0.5) / good))
    return frozenset(r.word for r in found.orderBy(F.desc("bad"), "word").limit(settings.lexicon).collect())


def accuracies(patterns: np.ndarray, counts: np.ndarray, known: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns: the posterior of "bad" for each pattern, and each labeller's chance of a vote given the truth.

    Votes are taken as independent given the truth. Where the truth is ``known`` (1 or -1; 0: it isn't) the posterior stays
    at ``LABEL_TRUST``. It starts from the majority of votes; a share of a vote is added to every count, so that no
    chance is 0. The second result has an entry [truth, labeller, vote + 1].
    """
    votes = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)
    fixed = np.where(known > 0, LABEL_TRUST, 1 - LABEL_TRUST)
    bad = np.where(known != 0, fixed, 1 / (1 + np.exp(-2.0 * patterns.sum(axis=1))))
    chance = np.zeros((2, patterns.shape[1], 3))
    for _ in range(rounds):
        weight = np.stack((counts * (1 - bad), counts * bad))
        chance = np.einsum("yp,pjv->yjv", weight, votes) + 0.1
        chance /= chance.sum(axis=2, keepdims=True)
        prior = np.log((weight.sum(axis=1) + 1) / (weight.sum() + 2))
        logs = prior[:, None] + np.einsum("pjv,yjv->yp", votes, np.log(chance))
        new = np.where(known != 0, fixed, 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500))))
        if np.abs(new - bad).max() < 1e-6:
            return new, chance
        bad = new
    return bad, chance


def _posteriors(votes: DataFrame, columns: slice, gold: str) -> DataFrame:
    """``key, p``: the posterior for each pattern of votes; there are at most 3 ** labellers patterns."""
    pattern = F.concat(F.slice("votes", columns.start + 1, columns.stop - columns.start), F.array(F.col(gold).cast("int")))
    counted = sorted(votes.groupBy(pattern.alias("pattern")).agg(F.count("*").alias("n")).collect(), key=lambda r: r.pattern)
    if not counted:
        return votes.sparkSession.createDataFrame([], "key string, p double")
    patterns = np.array([r.pattern for r in counted])
    bad, _ = accuracies(patterns[:, :-1], np.array([r.n for r in counted], float), patterns[:, -1])
    return votes.sparkSession.createDataFrame([(",".join(map(str, p)), float(b)) for p, b in zip(patterns.tolist(), bad, strict=True)], "key string, p double")


def _chosen(votes: DataFrame, settings: Settings) -> DataFrame:
    """The rows of ``votes`` that the scorer learns from: so many with and without labels as ``settings`` says."""
    rows = votes.where("doc_id IS NOT NULL").withColumn("known", (F.col("gold_low") != 0) | (F.col("gold_toxic") != 0))
    n = {r.known: r.n for r in rows.groupBy("known").agg(F.count("*").alias("n")).collect()}
    known = min(n.get(True, 0), max(round(settings.gold * settings.sample), settings.sample - n.get(False, 0)))
    least = lambda of, k: rows.where(of).orderBy(F.xxhash64("doc_id"), "doc_id", "votes").limit(k)
    return least(F.col("known"), known).union(least(~F.col("known"), settings.sample - known)).drop("known")


_READ = {"votes": ArrayType(IntegerType()), "features": ArrayType(IntegerType()), "shapes": ArrayType(FloatType())}


def _read(documents: DataFrame, lexicon: frozenset[str], text: str = "text", keep_text: bool = True) -> DataFrame:
    """``documents`` as structs ``row`` (without the text, where it isn't kept), with ``votes, features, shapes`` of their texts.

    Each text is split and looked up here once; the scorer is fitted on and applied to what this gives.
    """
    kept = [c for c in documents.columns if keep_text or c != text]
    at = kept.index(text) if keep_text else None  # a kept text goes to Python once, inside its row
    rows = documents.select(F.struct(*kept).alias("row"), *([] if keep_text else [F.col(text).alias("text")]))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = _table(lexicon)
        found = [describe(t, table) for t in texts(batch.column(1) if at is None else batch.column(0).field(at))]
        votes, features, shapes = zip(*found, strict=True)
        cut = [lists(np.concatenate(x).astype(kind), np.array(list(map(len, x))), arrow) for x, kind, arrow in (
            (features, np.int32, pa.int32()), (shapes, np.float32, pa.float32()))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(votes, pa.list_(pa.int32())), *cut], names=["row", *_READ])

    return map_batches(rows, one, StructType([rows.schema["row"], *[StructField(c, t) for c, t in _READ.items()]]))


def fit_logistic(feature: np.ndarray, value: np.ndarray, cut: np.ndarray, target: np.ndarray, trust: np.ndarray, order: np.ndarray, rounds: int = 4,
                 rate: float = 0.3, l1: float = 1.0, l2: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model of soft targets of some ``trust``, by follow-the-regularised-leader: one row at a time, every
    feature with a learning rate of its own, and weight 0 until its gradients outweigh ``l1``. Each round shuffles ``order`` anew, by
    fixed seeds: what is learned depends on it, so it has to follow from the rows and not from how they came."""
    total, squares = np.zeros(N_FEATURES + 1), np.zeros(N_FEATURES + 1)
    for turn in range(rounds):
        for i in np.random.default_rng(turn).permutation(order).tolist():
            at, x = np.append(feature[cut[i]: cut[i + 1]], N_FEATURES), np.append(value[cut[i]: cut[i + 1]], 1.0)
            w = _weights(total[at], squares[at], rate, l1, l2)
            gradient = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - target[i]) * trust[i] * x
            grown = squares[at] + gradient * gradient
            total[at] += gradient - (np.sqrt(grown) - np.sqrt(squares[at])) / rate * w
            squares[at] = grown
    w = _weights(total, squares, rate, l1, l2)
    return w[:-1], float(w[-1])


def _weights(total: np.ndarray, squares: np.ndarray, rate: float, l1: float, l2: float) -> np.ndarray:
    return -np.sign(total) * np.maximum(np.abs(total) - l1, 0) / ((1 + np.sqrt(squares)) / rate + l2)


def _train(rows: pa.RecordBatch, bounds: np.ndarray) -> pa.RecordBatch:
    feature, lengths = rows.column(1).flatten().to_numpy(), rows.column(1).value_lengths().to_numpy()
    value = _values(lengths, rows.column(2).flatten().to_numpy(), rows.column(2).value_lengths().to_numpy())
    keep = np.bincount(feature, minlength=N_FEATURES)[feature] >= 3
    ends = np.cumsum(lengths)
    cut = np.concatenate(([0], np.cumsum(keep)[ends - 1])) if len(ends) else np.zeros(1, np.int64)  # no row is without features
    feature, value = feature[keep], value[keep]
    order = np.lexsort((rows.column(8).to_numpy(), rows.column(7).to_numpy()))
    scorers = [fit_logistic(feature, value, cut, rows.column(i).to_numpy(), rows.column(i + 2).to_numpy(), order) for i in (3, 4)]
    table = np.stack([np.append(w, b) for w, b in scorers])
    at = np.flatnonzero((table != 0).any(axis=0))
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[0, at]), pa.array(table[1, at])], names=["feature", "low", "toxic"])


@dataclass(frozen=True)
class Scorer:
    """Weights of the two linear scorers by hashed feature, the bias last, and the words that the labels taught."""

    weights: np.ndarray
    lexicon: frozenset[str]


def _fit(read: DataFrame, gold: DataFrame, lexicon: frozenset[str], settings: Settings) -> Scorer:
    """A scorer from the stored table of ``_read`` and one row of labels per id."""
    ids = read.select(F.col("row.doc_id").cast("long").alias("doc_id"), "votes")
    votes = stored(ids.join(gold, "doc_id", "left").select(
        "doc_id", "votes", F.coalesce(1 - 2 * F.col("quality"), F.lit(0)).cast("int").alias("gold_low"), F.coalesce(2 * F.col("toxic") - 1, F.lit(0)).cast("int").alias("gold_toxic")))
    low, toxic = slice(0, len(LOW)), slice(len(LOW), len(LOW) + len(TOXIC))
    chosen = _chosen(votes, settings)
    for part, name, gold_name in ((low, "p_low", "gold_low"), (toxic, "p_toxic", "gold_toxic")):
        key = F.array_join(F.concat(F.slice("votes", part.start + 1, part.stop - part.start), F.array(F.col(gold_name))), ",")
        chosen = chosen.withColumn("key", key).join(F.broadcast(_posteriors(votes, part, gold_name)), "key").drop("key").withColumnRenamed("p", name)
        chosen = chosen.withColumn(name.replace("p_", "w_"), F.when(F.col(gold_name) != 0, 1.0).otherwise(settings.weak))
    learned = F.min(F.struct("p_low", "p_toxic", "w_low", "w_toxic")).alias("learned")  # of texts under one id
    chosen = stored(chosen.groupBy("doc_id").agg(learned).select("doc_id", "learned.*"))
    told = read.select(F.col("row.doc_id").cast("long").alias("doc_id"), "features", "shapes").join(F.broadcast(chosen), "doc_id")
    sample = stored(told.select(F.lit(0).alias("one"), "features", "shapes", "p_low", "p_toxic", "w_low", "w_toxic", "doc_id", F.xxhash64("features", "shapes").alias("tie")))
    rows = map_groups(sample, ["one"], _train, "feature long, low double, toxic double").collect()
    weights = np.zeros((2, N_FEATURES + 1))
    for r in rows:
        weights[:, r.feature] = r.low, r.toxic
    return Scorer(weights, lexicon)


def _gold(labels: DataFrame) -> DataFrame:
    """The worst label of each id."""
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return stored(known.agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")))


def fit(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Scorer:
    """A scorer of ``documents`` (``doc_id, text``), with ``labels`` (``doc_id, quality, toxic``; 0, 1 or null) where there are some.

    Heuristic labellers vote on every document. How often each vote comes with either truth is estimated by EM from the
    counts of vote patterns over all documents; a label, where there is one, is taken for the truth. The posteriors of a
    bounded sample, part of it always without labels, then train two hashed linear scorers, for low quality and for toxicity, in
    one task.

    Null texts count as empty. Of several labels of one id the worst counts; null ids and labels don't. Without documents
    all weights are 0. The order and partitions in which rows come change nothing.
    """
    gold = _gold(labels)
    lexicon = _learned_words(documents, gold, settings)
    return _fit(stored(_read(documents.select("doc_id", "text"), lexicon, keep_text=False)), gold, lexicon, settings)


def _apply(read: DataFrame, scorer: Scorer) -> DataFrame:
    """``row, p_low, p_toxic`` of what ``_read`` gave. Only features go to Python; rows and their texts wait in the JVM."""
    with_workers(read.sparkSession)
    shared = read.sparkSession.sparkContext.broadcast(scorer.weights)

    def some(feature: pa.Array, shape: pa.Array) -> np.ndarray:
        weights = shared.value
        lengths = feature.value_lengths().to_numpy()  # no row is without features
        values = _values(lengths, shape.flatten().to_numpy(), shape.value_lengths().to_numpy())
        return np.add.reduceat(weights[:, feature.flatten().to_numpy()] * values, np.cumsum(lengths) - lengths, axis=1) + weights[:, -1:]

    def chances(feature: pa.Array, shape: pa.Array) -> pa.Array:
        parts = [some(feature.slice(i, ROWS), shape.slice(i, ROWS)) for i in range(0, len(feature), ROWS)]
        p = 1 / (1 + np.exp(-np.clip(np.concatenate(parts, axis=1) if parts else np.zeros((2, 0)), -30, 30)))
        return pa.StructArray.from_arrays([pa.array(p[0]), pa.array(p[1])], names=["low", "toxic"])

    # taken for nondeterministic, so that a filter on the chances does not compute them a second time
    chance = F.arrow_udf(chances, "low double, toxic double").asNondeterministic()
    scored = read.select("row", chance("features", "shapes").alias("chance"))
    return scored.select("row", F.col("chance.low").alias("p_low"), F.col("chance.toxic").alias("p_toxic"))


def score(documents: DataFrame, scorer: Scorer, text: str = "text") -> DataFrame:
    """The columns of ``documents`` with ``p_low`` and ``p_toxic`` (replaced if there): how likely a text is low or toxic.

    Null counts as empty. Rows are scored each for itself, where they are.
    """
    kept = [c for c in documents.columns if c not in ("p_low", "p_toxic")]
    return _apply(_read(documents.select(*kept), scorer.lexicon, text), scorer).select("row.*", "p_low", "p_toxic")


def fit_and_score(documents: DataFrame, labels: DataFrame, settings: Settings = Settings(), keep_text: bool = True) -> DataFrame:
    """``fit`` and ``score`` of the same documents: ``row`` (a struct of their columns), ``p_low, p_toxic``. Texts are looked at
    once; their features lie in a stored table in between, with the texts themselves where they are kept."""
    gold = _gold(labels)
    lexicon = _learned_words(documents, gold, settings)
    read = stored(_read(documents, lexicon, keep_text=keep_text))
    return _apply(read, _fit(read, gold, lexicon, settings))


def keep_good(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``documents`` that the scorer fitted on them finds neither low nor toxic; the columns stay."""
    scored = fit_and_score(documents, labels, settings)
    return scored.where((F.col("p_low") < settings.reject) & (F.col("p_toxic") < settings.reject)).select("row.*")
