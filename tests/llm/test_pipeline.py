"""The pipeline's stages, each against plain Python on its own input, and the classifier's parts that they rest on."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gridfill.llm import quality, queries
from gridfill.llm.common import stored
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's name with its input and its result."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = docs, (docs := stored(stage(spark, docs, SF)))
    return out


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_all_but_the_last_keep_the_columns(spark, stages):
    names = list(stages)
    assert len(names) == 5
    for name in names[:-1]:
        assert stages[name][1].columns == spark.read.parquet(f"{SF}/documents.parquet").columns
        assert stages[name][1].count()


def test_classifier_stage(spark, stages):
    before, after = stages["quality classifier"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality.score(before, quality.fit(before, labels))
    assert texts(after) == texts(scored.where("p_low < 0.5 AND p_toxic < 0.5"))
    assert after.count() < before.count()


def test_line_stage(stages):
    before, after = stages["line dedup"]
    pages, on = defaultdict(set), defaultdict(set)
    rows = before.select("doc_id", "source", "text").collect()
    for r in rows:
        if r.text is not None:
            pages[r.source].add(r.text)
            for line in r.text.split("\n"):
                on[r.source, line.strip(" ")].add(r.text)
    drop = {k for k, v in on.items() if k[1] and len(v) >= 2 and len(v) > 0.1 * len(pages[k[0]])}
    want = [(r.doc_id, r.text and "\n".join(x for x in r.text.split("\n") if (r.source, x.strip(" ")) not in drop)) for r in rows]
    assert texts(after) == sorted(want)


def test_near_duplicate_stage(stages):
    before, after = stages["near-duplicates"]
    groups = brute.near_groups(texts(before), 5)
    keep = {doc for doc, n, _, kept in groups if kept or not n}
    assert texts(after) == [t for t in texts(before) if t[0] in keep]


def test_decontamination_stage(spark, stages):
    before, after = stages["benchmark decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {r[0] for r in brute.contamination(texts(before), items) if not r[5]}
    assert texts(after) == [t for t in texts(before) if t[0] in clean] and len(clean) < before.count()


def test_packing_stage(spark, stages):
    before, after = stages["best-fit packing"]
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    want = sorted(brute.token_pieces(texts(before), Tokenizer.from_file(queries.tokenizer_file())))
    assert sorted(tuple(r) for r in after.select(*columns).collect()) == want
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).select(*columns).collect()) == want


def test_stages_on_odd_tables(spark):
    docs = spark.createDataFrame([(None, None, None, None, None, 1, 2.0), (1, "", "en", "s", 0, 1, 2.0), (2, "A river runs past the old town. It bends twice.", "en", None, 5, 1, 2.0)] * 2,
                                 "doc_id long, text string, lang string, source string, n_chars long, p_low int, n_hit double")
    for rows in (docs, docs.limit(0)):
        left = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            left = stored(stage(spark, left, SF))
            assert left.columns == docs.columns
        packed = corpus_pipeline.STAGES[-1][1](spark, left, SF)
        assert packed.where("doc_id = 2").count() == (rows is docs)


def em(patterns, counts, known, rounds=200):
    """EM with plain loops: posteriors of "bad" by pattern."""
    bad = [quality.LABEL_TRUST if k > 0 else 1 - quality.LABEL_TRUST if k < 0 else 1 / (1 + math.exp(-2 * sum(p))) for p, k in zip(patterns, known, strict=True)]
    for _ in range(rounds):
        chance = [[Counter({v: 0.1 for v in (-1, 0, 1)}) for _ in patterns[0]] for _ in "gb"]
        total = [0.0, 0.0]
        for p, n, b in zip(patterns, counts, bad, strict=True):
            for truth, weight in ((0, n * (1 - b)), (1, n * b)):
                total[truth] += weight
                for j, v in enumerate(p):
                    chance[truth][j][v] += weight
        new = []
        for p, k, b in zip(patterns, known, bad, strict=True):
            logs = [math.log((total[t] + 1) / (sum(total) + 2)) + sum(math.log(chance[t][j][v] / sum(chance[t][j].values())) for j, v in enumerate(p)) for t in (0, 1)]
            new.append(b if k else 1 / (1 + math.exp(min(500, max(-500, logs[0] - logs[1])))))
        done = max(abs(a - b) for a, b in zip(new, bad, strict=True)) < 1e-6
        bad = new
        if done:
            break
    return bad


def test_em_on_the_documents_own_votes(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    gold = quality._gold(labels)
    lexicon = quality._learned_words(docs, gold, quality.Settings())
    read = stored(quality._read(docs.select("doc_id", "text"), lexicon, keep_text=False))
    toxic = {r.doc_id: r.toxic for r in gold.collect()}
    first, last = len(quality.LOW), len(quality.LOW) + len(quality.TOXIC)
    voted = Counter((*r.votes[first:last], {None: 0, 0: -1, 1: 1}[toxic.get(r.doc_id)]) for r in read.select("row.doc_id", "votes").collect())
    patterns = sorted(voted)
    want = em([p[:-1] for p in patterns], [voted[p] for p in patterns], [p[-1] for p in patterns])
    votes = read.select("votes", F.col("row.doc_id").alias("doc_id")).join(gold, "doc_id", "left").withColumn("gold", F.coalesce(2 * F.col("toxic") - 1, F.lit(0)))
    got = {r.key: r.p for r in quality._posteriors(votes, slice(first, last), "gold").collect()}
    assert len(got) == len(patterns) > 4
    assert [got[",".join(map(str, p))] for p in patterns] == pytest.approx(want, abs=1e-6)

    both = {r.doc_id: (r.p_low, r.p_toxic) for r in quality.score(docs.select("doc_id", "text"), quality.fit(docs, labels)).collect()}
    once = {r.doc_id: (r.p_low, r.p_toxic) for r in quality.fit_and_score(docs.select("doc_id", "text"), labels).select("row.doc_id", "p_low", "p_toxic").collect()}
    assert both.keys() == once.keys() and np.allclose([both[k] for k in both], [once[k] for k in both])


def test_classifier_does_not_depend_on_the_order_of_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet") for name in ("documents", "labels"))
    docs = docs.select("doc_id", "text").unionByName(docs.selectExpr("doc_id", "concat(text, ' again, differently') AS text").limit(20))
    settings = quality.Settings(sample=150)
    one = quality.fit(docs.orderBy(F.desc("doc_id")).coalesce(1), labels, settings)
    two = quality.fit(docs.repartition(7, "text"), labels.orderBy("toxic", F.desc("doc_id")), settings)
    assert one.lexicon == two.lexicon and np.abs(one.weights).sum() > 0
    assert np.array_equal(one.weights, two.weights)
