"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from gridfill.llm import common, decontaminate, embedding_dedup, line_dedup, near_dedup, packing, quality, queries, quotes, repeats, secret_scan, url_rules
from gridfill.llm.tokens import WordTokens
from tests.llm import brute

TEXT = "doc_id long, text string"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def test_decontaminate(spark):
    items = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Short item"), (3, None), (None, "ghost words here"), (2, "Short item"), (4, "")]
    documents = [(1, None), (2, ""), (3, "x ONE two, three-four five six seven eight nine ten y"), (4, "a short ITEM and short item"), (4, "a short ITEM and short item"),
                 (None, "ghost words here"), (5, LONG + " short item")]
    left = spark.createDataFrame([(*d, 7, ["z"]) for d in documents], TEXT + ", n_hit int, hit_items array<string>")
    right = spark.createDataFrame(items, "item_id long, text string")
    want = brute.contamination(documents, [i for i in items if None not in i])
    columns = ("doc_id", "n_words", "n_hit", F.size("hit_items"), F.sha2(F.array_join("hit_items", ","), 256), F.col("n_hit") > 0)
    assert rows(decontaminate.scan(left, right), *columns) == sorted(want, key=repr)
    assert rows(decontaminate.scan(left, right, block_bytes=20), *columns) == sorted(want, key=repr)
    assert sorted(r.doc_id or 0 for r in decontaminate.drop_contaminated(left, right).collect()) == [0, 1, 2]
    cut = {r.doc_id: r.text for r in decontaminate.cut_contaminated(left, right).collect()}
    assert cut[4] == "a and " and cut[3] == "x y" and cut[1] is None and cut[None] == "ghost words here"
    assert decontaminate.scan(left, right.limit(0)).where("n_hit > 0").isEmpty() and decontaminate.scan(left.limit(0), right).isEmpty()


def test_quotes(spark):
    schema = "conv_id long, turn long, role string, text string, depth string, parent int"
    talk = [(1, 0, "u", "Hello there friend.\nHow are you?"), (1, 1, "a", "On Monday x wrote:\n> Hello there friend.\nFine."), (1, 2, "u", ">> hello  THERE friend\n> Fine.\nOk"),
            (1, 3, "a", "> How are you?\nGood"), (1, 3, "a", "> How are you?\nGood"), (2, 5, "u", None), (None, 1, "u", "> x"), (3, None, "a", "y"), (1, 4, "u", "> said by nobody\n")]
    messages = spark.createDataFrame([(*t, "d", 1) for t in talk], schema)
    got = rows(quotes.thread_conversations(messages))
    want = [(1, 0, "u", talk[0][3], None, 0, 0, 0), (1, 1, "a", "Fine.", 0, 1, 1, 1), (1, 2, "u", "Ok", 1, 2, 2, 2), *[(1, 3, "a", "Good", 0, 1, 3, 1)] * 2,
            (2, 5, "u", "", None, 0, 0, 0), (None, 1, "u", "> x", None, 0, None, 0), (3, None, "a", "y", None, 0, None, 0), (1, 4, "u", "> said by nobody", 3, 2, 4, 0)]
    assert got == sorted(want, key=repr)
    assert quotes.thread_conversations(messages.limit(0)).isEmpty()
    chain = spark.range(3000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"), F.concat(F.lit("line "), "id").alias("text"))
    assert rows(quotes.thread_conversations(chain).agg(F.max("depth"), F.max("position"))) == [(2999, 2999)]


def near_rows(n, seed):
    pick = random.Random(seed)
    bases = [[f"w{pick.randrange(300)}" for _ in range(pick.choice((1, 2, 30, 120)))] for _ in range(6)]
    out = []
    for i in range(n):
        words = list(pick.choice(bases))
        for _ in range(pick.randrange(6)):
            words[pick.randrange(len(words))] = f"v{pick.randrange(50)}"
        out.append((i, " ".join(words)))
    return out


@pytest.mark.parametrize("shingle, block", [(2, 256), (5, 256), (2, 8)])
def test_near_duplicates(spark, monkeypatch, shingle, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "SKETCH_BLOCK", 2 * block)
    documents = [*near_rows(150, shingle), (200, None), (201, ""), (202, " \t\n"), (203, LONG), (204, LONG + " more"), (205, "One"), (206, "one")]
    table = spark.createDataFrame([(*d, 1, 2) for d in documents], TEXT + ", n int, component long").repartition(3)
    assert rows(near_dedup.near_duplicates(table, shingle)) == sorted(brute.near_groups(documents, shingle), key=repr)


def test_near_duplicates_of_repeated_and_missing_ids(spark):
    table = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, "a b c d e f"), (3, None)], TEXT)
    assert rows(near_dedup.near_duplicates(table)) == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 2, None, False), (None, 2, None, False), (3, 0, 3, True)], key=repr)
    assert [r.doc_id for r in near_dedup.keep_first(table).orderBy("doc_id").collect()] == [None, None, 1, 3]
    other = spark.createDataFrame([(1, "an old text under this id"), (1, "and quite another one here"), (1, "an old text under this id")], TEXT)
    assert len(rows(near_dedup.keep_first(other))) == 2  # different texts under one id both stay
    assert near_dedup.near_duplicates(table.limit(0)).isEmpty() and near_dedup.keep_first(table.limit(0)).isEmpty()


@pytest.mark.parametrize("block", [512, 3])
def test_repeats(spark, monkeypatch, block):
    monkeypatch.setattr(repeats, "BLOCK", block)
    pick = random.Random(block)
    word = lambda: "".join(pick.choice("abé") for _ in range(pick.randint(1, 4)))
    bases = [" ".join(word() for _ in range(pick.randint(20, 200))) for _ in range(6)]
    documents = [(0, None), (1, ""), (2, "x" * 199), (3, "y" * 200), (4, "z" * 201), (5, "q" * 240), (5, "q" * 240), (None, "ab" * 300)]
    for i in range(10, 80):
        base, other = pick.choice(bases), pick.choice(bases)
        a, b = pick.randrange(len(base)), pick.randrange(len(other))
        kind = pick.random()
        documents.append((i, base if kind < 0.2 else base[:a] + word() + base[a:] if kind < 0.5 else base[a: a + pick.randint(150, 400)] + word() + other[b: b + pick.randint(190, 230)]))
    table = spark.createDataFrame([(*d, 1) for d in documents], TEXT + ", n_bytes int")
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    got = repeats.remove_repeats(table)
    assert rows(got, *columns) == sorted(brute.repeats(documents), key=repr)
    assert rows(got, F.sha2("kept", 256)) == rows(got, "kept_sha256")
    assert repeats.remove_repeats(table.limit(0)).isEmpty()


def test_sorted_suffixes():
    pick = np.random.default_rng(3)
    sizes = pick.integers(0, 13, 200)
    data = np.where(np.arange(12) < sizes[:, None], pick.integers(97, 99, (200, 12)), 0).astype(np.uint8)
    base, count = np.repeat([0, 150], [150, 50]), np.repeat([150, 50], [150, 50])
    order, shared = repeats.sorted_suffixes(data, sizes, base, count)
    words = [bytes(d[:n]) for d, n in zip(data, sizes, strict=True)]
    for group in (range(150), range(150, 200)):
        got = [words[order[i]] for i in group]
        assert got == sorted(words[i] for i in group)
        assert all(shared[i] == len(__import__("os").path.commonprefix([words[order[i]], words[order[i - 1]]])) for i in group if i != group[0])


def test_quality(spark):
    clean = [f"The river number {i} runs past the old town. It bends twice before the bridge." for i in range(60)]
    junk = [f"WORD{i}!! SHOUT!! NOISE%%% ###### $$$ MORE!! &&& CAPS{i}!!" for i in range(30)]
    toxic = [f"The clown number {i} is a worthless idiot. He is pathetic scum." for i in range(30)]
    documents = [*enumerate([*clean, *junk, *toxic]), (500, None), (501, ""), (None, "Nobody has this number."), (0, clean[0]), (502, LONG)]
    table = spark.createDataFrame([(*d, "x") for d in documents], TEXT + ", p_low string")
    labels = spark.createDataFrame([(i, int(not 60 <= i < 90), int(i >= 90)) for i in range(0, 120, 4)] + [(None, 1, 1), (1, None, None), (0, 1, 0)], "doc_id long, quality int, toxic int")
    scored = {r.doc_id: r for r in quality.score(table, quality.fit(table, labels)).collect()}
    assert all(scored[i].p_low < 0.5 and scored[i].p_toxic < 0.5 for i in range(60))
    assert all(scored[i].p_low > 0.5 for i in range(60, 90)) and all(scored[i].p_toxic > 0.5 for i in range(90, 120))
    kept = quality.keep_good(table, labels)
    assert kept.columns == table.columns and {r.doc_id for r in kept.where("doc_id < 120").collect()} == set(range(60))
    none = quality.score(table.limit(0), quality.fit(table.limit(0), labels.limit(0)))
    assert none.isEmpty()
    assert quality.score(table, quality.fit(table, labels.limit(0))).count() == len(documents)


def test_unlabelled_documents_teach_the_scorer_at_every_size(spark):
    clean = [f"The river number {i} runs past the old town. It bends twice before the bridge." for i in range(1000)]
    junk = [f"WORD{i}!! SHOUT!! NOISE%%% ###### $$$ MORE!! &&& CAPS{i}!!" for i in range(300)]
    toxic = [f"The clown number {i} is a worthless idiot. He is pathetic scum." for i in range(300)]
    table = spark.createDataFrame(list(enumerate([*clean, *junk, *toxic])), TEXT)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(700)], "doc_id long, quality int, toxic int")  # more than the sample, all good
    scored = {r.doc_id: r for r in quality.score(table, quality.fit(table, labels, quality.Settings(sample=600))).collect()}
    assert all(scored[i].p_low < 0.5 and scored[i].p_toxic < 0.5 for i in range(1000))
    assert all(scored[i].p_low > 0.5 for i in range(1000, 1300)) and all(scored[i].p_toxic > 0.5 for i in range(1300, 1600))


def test_accuracies_find_the_better_labeller():
    pick = np.random.default_rng(5)
    truth = pick.random(4000) < 0.3
    votes = np.stack([np.where(pick.random(4000) < right, truth, ~truth) * 2 - 1 for right in (0.95, 0.8, 0.7)], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    bad, chance = quality.accuracies(patterns, counts.astype(float), np.zeros(len(patterns), int))
    assert chance[1, :, 2] == pytest.approx([0.95, 0.8, 0.7], abs=0.07)
    posterior = dict(zip(map(tuple, patterns.tolist()), bad > 0.5, strict=True))
    right = np.mean([posterior[tuple(v)] == t for v, t in zip(votes.tolist(), truth, strict=True)])
    assert right > np.mean((votes.sum(axis=1) > 0) == truth) + 0.02
    held, _ = quality.accuracies(patterns, counts.astype(float), np.where(np.arange(len(patterns)) == 0, 1, 0))
    assert held[0] == quality.LABEL_TRUST


def test_url_rules(spark):
    pages = [(1, None), (2, "no scheme"), (3, "http://A.Example.COM/en/x?q#f"), (4, "http://www.example.com/en/"), (5, "http://notexample.com/en/x"), (6, "http://x.net?y"),
             (7, "http://x.net/es/a"), (8, "http://x.net/es/a"), (9, "://com/"), (10, "http://" + "a." * 3000 + "com/" + "p/" * 3000), (11, "")]
    table = spark.createDataFrame([(*p, "h", "v") for p in pages], "page_id long, url string, host string, verdict string")
    rules = spark.sql(queries.URL_RULES + " UNION ALL VALUES ('com', '/', 'block'), (NULL, '/', 'block'), ('org', NULL, 'block'), ('net', '/es/', 'unknown')")
    got = {r.page_id: (r.host[:20], r.rule, r.verdict) for r in url_rules.judge_urls(table, rules).collect()}
    assert got[1] == got[2] == got[11] == ("", None, "allow") and got[3] == ("a.example.com", "example.com/en/", "block")
    assert got[4][1:] == ("www.example.com/en/", "allow") and got[5][1:] == ("com/", "block") == got[9][1:] == got[10][1:]
    assert got[6] == ("x.net", None, "allow") and got[7] == got[8] == ("x.net", "net/es/", "block")
    assert url_rules.judge_urls(table.limit(0), rules).isEmpty() and url_rules.judge_urls(table, rules.limit(0)).where("rule IS NOT NULL").isEmpty()


@pytest.mark.parametrize("block", [256, 4])
def test_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    pick = np.random.default_rng(block)
    centres = pick.standard_normal((4, 16))
    vectors = [(i, (centres[i % 4] + 0.12 * pick.standard_normal(16)).tolist()) for i in range(80)]
    vectors += [(100, vectors[0][1]), (101, vectors[0][1]), (102, None), (103, []), (104, [0.0] * 16), (105, [None, 1.0]), (106, [float("nan"), 1.0]), (107, [1.0, 2.0]), (108, [2.0, 4.0]), (109, [float("inf")] * 2)]
    table = spark.createDataFrame([(*v, 1) for v in vectors], "vec_id long, embedding array<double>, n_links int")
    assert rows(embedding_dedup.link_vectors(table, miss=1e-6)) == sorted(brute.vector_links(vectors), key=repr)
    assert embedding_dedup.link_vectors(table.limit(0)).isEmpty()
    extreme = spark.createDataFrame([(1, [1e200, 0.0]), (2, [2e200, 0.0]), (3, [1e-200, 0.0]), (4, [0.0, 1e-300]), (5, [0.0, 3.0])], "vec_id long, embedding array<double>")
    assert rows(embedding_dedup.link_vectors(extreme)) == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 1, 4, True), (5, 1, 4, False)]
    twice = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [1.0, 0.01])], "vec_id long, embedding array<double>")
    assert rows(embedding_dedup.link_vectors(twice)) == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 0, None, False), (2, 2, 1, False)], key=repr)


def test_lines(spark):
    pages = [(i, "s", f"Menu\nown text {i}\n\n Menu \nend") for i in range(8)] + [(i, "t", "Menu\nother") for i in range(20, 24)]
    pages += [(30, None, None), (31, None, ""), (32, "s", "same\nMenu"), (33, "s", "same\nMenu"), *[(40 + i, None, f"x\ny{i}") for i in range(6)], (50, "long", LONG)]
    table = spark.createDataFrame([(*p, 1) for p in pages], "doc_id long, source string, text string, n_lines int")
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup.drop_boilerplate(table).collect()}
    assert got[3] == ("own text 3\n", 5, 3) and got[20] == ("Menu\nother", 2, 0) and got[32] == got[33] == ("same", 2, 1)
    assert got[30] == (None, 0, 0) and got[31] == ("", 1, 0) and got[42] == ("y2", 2, 1) and got[50] == (LONG, 1, 0)
    assert line_dedup.drop_boilerplate(table.limit(0)).isEmpty()


def test_secrets(spark):
    key, token = "AKIA" + "A1" * 9, "deadbeef" * 4
    documents = [(1, None), (1, ""), (2, f"token = {token} é AKIA {key}"), (3, f"token = {token} é AKIA {key}"), (None, "API_KEY: abcdef, passwd='abc'"), (4, LONG + " secret=abcdefgh"),
                 (5, "secret=token:abcdefgh ſecret=abcdefgh"), (6, "-----BEGIN RSA PRIVATE KEY-----")]
    table = spark.createDataFrame([(*d, "x") for d in documents], TEXT + ", found string")
    found, new = secret_scan.scan_versions(table, ["doc_id"])
    base = F.filter("found", lambda s: s["kind"].isin(*secret_scan.BASE))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind))
    got = rows(found, "doc_id", *[count(k) for k in secret_scan.BASE], F.sha2(queries._joined(base), 256))
    assert got == sorted(brute.secrets(documents), key=repr)
    assert new.count() == 6 and found.where("doc_id = 6").first().found[0].kind == "pem"
    later = table.unionByName(spark.createDataFrame([(9, "password: hunter22", "x")], table.schema))
    again, fresh = secret_scan.scan_versions(later, ["doc_id"], new)
    assert fresh.count() == 1 and again.count() == len(documents) + 1 and rows(again.where("doc_id < 9")) == rows(found.where("doc_id < 9"))
    stale = new.withColumn("scanned", F.filter("scanned", lambda r: r != "hex:1")).withColumn("found", F.filter("found", lambda s: s["kind"] != "hex"))
    redone, rescanned = secret_scan.scan_versions(table, ["doc_id"], stale)
    assert rescanned.select("scanned").distinct().collect()[0].scanned == ["hex:1"] and rows(redone) == rows(found)
    assert secret_scan.scan_versions(table.limit(0), ["doc_id"])[0].isEmpty()


def test_tokens_are_the_tokenizers_own():
    own = WordTokens(queries.tokenizer_file())
    for text in ["", " ", "It's O'Neil's “x” 12½ é́ ÀÉ<|endoftext|> we'll ''s !'t", "a\xa0b\x85c a\x1cb", "Ünïcode wörds, ÄÖÜß: 123 4-5!!", "ﬁ İ Σας", LONG[:5000]]:
        assert own.packed(text) == own._whole(text)


def test_tokens_of_texts_that_hold_special_tokens(spark):
    plain = Tokenizer.from_file(queries.tokenizer_file())
    own = WordTokens(queries.tokenizer_file())
    documents = list(enumerate(["see <|endoftext|> here", "a<|startoftext|>b", "<|endoftext|><|endoftext|>", "<|ENDOFTEXT|> x", "é “q” <|endoftext|>", "<|end oftext|>", "word <|endoftext|> " * 2000, LONG[:3000]]))
    for _, text in documents:
        assert np.frombuffer(own.packed(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(own.packed(documents[0][1]), "<u4").tolist() == [862, 49407, 763]
    got = packing.pack_documents(spark.createDataFrame(documents, TEXT), queries.tokenizer_file())
    assert rows(got, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(brute.token_pieces(documents, plain), key=repr)


def test_packing(spark):
    tokenizer = queries.tokenizer_file()
    documents = [(1, None), (2, ""), (3, "one two three"), (3, "one two three"), (None, "one"), (4, LONG), *[(10 + i, "same words again " * (i % 40)) for i in range(200)]]
    table = spark.createDataFrame([(*d, 1, "x") for d in documents], TEXT + ", piece int, offset string")
    got = packing.pack_documents(table, tokenizer, keep_ids=True).collect()
    assert sorted((repr(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(
        (repr(d), *rest) for d, *rest in brute.token_pieces(documents, WordTokens(tokenizer).tokenizer))
    assert all(len(r.ids) == r.length and (r.length == 2048 or r.ids[-1] == 0) for r in got)
    small = packing.Capacity(tokens=2048, documents=3, attention=2048 * 2048)
    for capacity, most in ((packing.Capacity(), 2048), (small, 3)):
        held = {}
        for r in sorted(packing.pack_documents(table, tokenizer, capacity).collect(), key=lambda r: (r.sequence_id, r.offset)):
            held.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert all(sum(n for _, n in s) <= 2048 and len(s) <= most and [o for o, _ in s] == [sum(n for _, n in s[:k]) for k in range(len(s))] for s in held.values())
    assert packing.pack_documents(table.limit(0), tokenizer).isEmpty()
    with pytest.raises(ValueError):
        packing.plan({100: 1}, packing.Capacity(attention=9999))


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 300)] + [(500, k) for k in range(501, 900)] + [(7, 7), (None, 3), (1000, 1001), (1001, 1000)]
    got = dict(rows(common.components(spark.createDataFrame(edges, "a long, b long"))))
    assert all(got[i] == 1 for i in range(1, 301)) and all(got[k] == 500 for k in range(500, 900)) and got[1001] == 1000 and 7 in got
    assert common.components(spark.createDataFrame([], StructType.fromDDL("a long, b long"))).isEmpty()
