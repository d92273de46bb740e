"""Every query over a small table against SQL or plain Python."""

import pytest
from tokenizers import Tokenizer

from checks.compare import connect, difference
from gridfill.llm import oracle, quality, queries
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def rows(spark, table, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/{table}.parquet").select(*columns).orderBy(columns[0]).collect()]


def result(spark, name, *columns):
    return sorted(tuple(r) for r in queries.QUERIES[name](spark, SF).select(*columns).collect())


@pytest.fixture(scope="module")
def documents(spark):
    return rows(spark, "documents", "doc_id", "text")


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_sql(spark, name):
    con = connect(SF)
    assert difference(queries.QUERIES[name](spark, SF), con, oracle.ORACLE[name]) is None
    con.close()


def test_op1(spark, documents):
    want = brute.contamination(documents, rows(spark, "benchmark", "item_id", "text"))
    assert result(spark, "op1_decontaminate", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(want)
    assert any(r[5] for r in want)


def test_op2(spark):
    want = rows(spark, "conversations", "conv_id", "turn", "role", "text")
    got = queries.QUERIES["op2_quotes"](spark, SF).orderBy("conv_id", "position").collect()
    assert [(r.conv_id, r.turn, r.role) for r in got] == [w[:3] for w in sorted(want, key=lambda w: w[:2])]
    assert all(r.parent_turn is None if r.position == 0 else r.parent_turn < r.turn for r in got)


def test_op3(spark, documents):
    want = brute.near_groups(documents, 2)
    assert result(spark, "op3_near_dedup", "doc_id", "n_shingles", "component_id", "kept") == want
    assert not all(r[3] for r in want)


def test_op4(spark, documents):
    want = brute.repeats(documents)
    assert result(spark, "op4_repeats", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want)
    assert any(r[2] for r in want)


def test_op5_on_held_out_labels(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    documents, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    scorer = quality.fit(documents, labels.where("doc_id % 2 = 0"))
    scored = quality.score(documents.select("doc_id", "text"), scorer).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    low = [(r.quality == 0, r.p_low >= 0.5) for r in scored]
    assert sum(a == b for a, b in low) >= 0.95 * len(low)
    assert sum(b for a, b in low if a) >= 0.9 * sum(a for a, _ in low)
    clean = [r for r in scored if r.quality == 1 and r.toxic == 0]
    assert sum(r.p_low >= 0.5 or r.p_toxic >= 0.5 for r in clean) <= 0.05 * len(clean)
    insulting = [r for r in scored if r.toxic == 1 and any(w in r.text.lower().split() for w in ("idiot", "moron", "stupid", "trash"))]
    assert insulting and sum(r.p_toxic >= 0.5 for r in insulting) >= 0.9 * len(insulting)


def test_op7(spark):
    want = brute.vector_links(rows(spark, "embeddings", "vec_id", "embedding"))
    assert result(spark, "op7_embedding_dedup", "vec_id", "n_links", "component_id", "kept") == want


def test_op9(spark, documents):
    want = brute.secrets(documents)
    assert result(spark, "op9_secret_scan", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == sorted(want)


def test_op10(spark, documents):
    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    want = brute.token_pieces(documents, tokenizer)
    assert result(spark, "op10_packing", "doc_id", "piece", "start", "length", "ids_crc32") == sorted(want)
    places = {}
    for sequence, offset, length in result(spark, "op10_packing", "sequence_id", "offset", "length"):
        assert places.get(sequence, 0) == offset
        places[sequence] = offset + length
    assert max(places.values()) <= 2048 and len(places) <= 1.02 * sum(w[3] for w in want) / 2048 + 1
