"""Filling in the middle, the filter audit and page extraction: edges, and plain Python to agree with."""

import hashlib
import html
import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import connect, difference
from gridfill.llm import filter_audit, html_text, infill, oracle, queries
from tests.llm import brute

SF = "/root/testdata/sf0.001"
ODD = ["", "a", "é", "😀", "aé😀ß" * 50, "x" * 5000 + "😀" * 3000 + "é" * 7000, "".join(random.Random(1).choice("aé€😀") for _ in range(40_000)), None]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# -- filling in the middle --------------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [64, 1000, 1 << 20])
def test_rank_index_is_exact(monkeypatch, block):
    monkeypatch.setattr(infill, "BLOCK", block)
    raw = [(t or "").encode() for t in ODD]
    data = np.frombuffer(b"".join(raw), np.uint8)
    want = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    index = infill.rank_index(data, np.cumsum([0, *map(len, raw)])[:-1])
    ranks = np.arange(len(want))
    assert (index.offsets(ranks) == want).all()
    assert np.abs(index.predict(ranks) - want).max() <= infill.ERROR
    assert index.rest.dtype == np.int8 and (np.diff(index.first) > 0).all()
    if block > len(data):
        assert len(index.first) < len(want) / 50  # few segments for many offsets


def infilled(doc_id, text, seed="1"):
    text = text or ""
    h = [int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * i: 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_infill(spark):
    texts = [*ODD, "holds <S> itself", "<P", "P><S", "<<P>", "tail <", "a\0b"]
    data = [(i, t, 5, "clash") for i, t in enumerate(texts * 6)] + [(None, "no id", 1, "x"), (3, "again 😀", 2, "y"), (3, "again 😀", 2, "y")]
    df = spark.createDataFrame(data, "doc_id long, text string, n int, `form` string").withColumn("odd name", F.lit(1))
    got = infill.fill_in_middle(df)
    assert rows(got, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output") == sorted((infilled(d, t) for d, t, *_ in data), key=repr)
    assert got.columns == ["doc_id", "text", "odd name", "n", "form", "prefix_chars", "middle_chars", "output"]
    back = got.select(F.coalesce("text", F.lit("")).alias("text"), infill.restored(F.col("output"), F.col("form")).alias("back"))
    assert back.where("NOT text <=> back").isEmpty()
    assert {r.form for r in got.select("form").distinct().collect()} == {"plain", "psm", "spm"}
    assert rows(infill.fill_in_middle(df, seed="2"), "output") != rows(got, "output")
    assert infill.fill_in_middle(df.limit(0)).isEmpty()


def test_infill_of_documents(spark):
    documents = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*infilled(d, t)[:5], brute.sha(infilled(d, t)[5]), brute.sha(t or "")) for d, t in documents]
    assert rows(queries.op11_infill(spark, SF), "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256") == sorted(want, key=repr)


# -- the filter audit -------------------------------------------------------------------------------------------


def fails(documents):
    first = {}
    for doc, text, _ in documents:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)
    out = []
    for doc, text, _ in documents:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        out.append((len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                    bool(re.search(r"[#$%&*|]", text)), doc is not None and doc > first[text]))
    return out


def audited(documents, labels):
    good, toxic = ({d for d, *v in labels if d is not None and v[i] == w} for i, w in ((0, 1), (1, 1)))
    flags, out = fails(documents), []
    for part in {p or "" for *_, p in documents}:
        own = [(d, f) for (d, _, p), f in zip(documents, flags, strict=True) if (p or "") == part]
        shapley, steps = dict.fromkeys(range(5), 0), []
        for order in permutations(range(5)):
            left = own
            for step, i in enumerate(order, 1):
                gone = [x for x in left if x[1][i]]
                redundant = sum(f[i] for _, f in own) - len(gone)
                left = [x for x in left if not x[1][i]]
                shapley[i] += len(gone)
                steps.append((i, (part, "".join("ABCDE"[j] for j in order), step, len(left), len(gone), redundant, sum(f[i] and sum(f) == 1 for _, f in own),
                                  sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone))))
        out += [(*s, shapley[i]) for i, s in steps]
    return out


COUNTS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_audit(spark):
    pick = random.Random(3)
    long = " ".join(f"w{i}" for i in range(300))
    texts = [None, "", "few words", long, long + " #", "UP " * 250, "same " * 250, long.upper(), "few words", "é" * 10 + " x\x0by", " ".join(f"v{i % 9000}" for i in range(30_000))]
    documents = [(i // 2 if i % 5 == 0 else i, pick.choice(texts), pick.choice([None, "", "s1", "s2"])) for i in range(200)]
    documents += [(None, long, "s1"), (None, long, "s1"), (7, long, "s1"), (7, long, "s1"), (7, long, "s3")]
    labels = [(i, pick.choice([0, 1, None]), pick.choice([0, 1, None])) for i in range(0, 200, 2)] + [(None, 1, 1), (4, 1, 1), (4, 0, 0)]
    left = spark.createDataFrame([(*d, "m", 1) for d in documents], "doc_id long, text string, source string, mask string, words int")
    right = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(left, right)
    assert rows(got, *COUNTS) == sorted(audited(documents, labels), key=repr)
    assert filter_audit.audit(left.limit(0), right).isEmpty()
    assert {r.good_lost for r in filter_audit.audit(left, right.limit(0)).collect()} == {0}

    marks = filter_audit.text_marks(left)
    tables = filter_audit.failing_tables(marks)
    want = {r[1:3]: r[3:6] for r in audited(documents, labels) if r[0] == "s1"}
    own = marks.where("part = 's1'")
    for order in ("ABCDE", "EDCBA", "CAEDB"):
        for step in (1, 3, 5):
            before, name = order[: step - 1], order[step - 1]
            n = [filter_audit.survivors(own, tables, before + name).count(), filter_audit.removals(own, tables, before, name).count(),
                 filter_audit.redundancies(own, tables, before, name).count()]
            assert tuple(n) == want[order, step]


def test_audit_with_other_filters(spark):
    left = spark.createDataFrame([(1, "a b", "x"), (2, "a", "x"), (3, None, None)], "doc_id long, text string, source string")
    right = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    got = filter_audit.audit(left, right, conditions={"S": "size(words) < 2", "Q": "text LIKE '%b%'"}, copies=None)
    assert rows(got.where("part = 'x'"), *COUNTS) == [("x", "QS", 1, 1, 1, 0, 1, 1, 0, 2), ("x", "QS", 2, 0, 1, 0, 1, 0, 0, 2),
                                                     ("x", "SQ", 1, 1, 1, 0, 1, 0, 0, 2), ("x", "SQ", 2, 0, 1, 0, 1, 1, 0, 2)]
    with pytest.raises(ValueError, match="too many orders"):
        filter_audit.audit(left, right, conditions={c: "true" for c in "ABCDEFG"})


@pytest.mark.parametrize("name", ["op11_infill", "op12_filter_audit"])
def test_sql_on_more_rows(spark, name):
    con = connect("/root/testdata/sf0.01")
    assert difference(queries.QUERIES[name](spark, "/root/testdata/sf0.01"), con, oracle.ORACLE[name]) is None
    con.close()


# -- page extraction --------------------------------------------------------------------------------------------

PROSE = "The ferry crossed the sound at dawn, slowly, while gulls circled above the wake and the crew drank coffee on deck."


def paragraphs(*texts):
    return "".join(f"<p>{t}</p>" for t in texts)


PAGES = {
    "parts of a page": (f"""<!DOCTYPE html><html><head><title>T, t</title><style>p{{}}</style><script>if (a<b) x("</p>")</script></head><body class="has-sidebar">
        <header><h1>Site</h1><p>{PROSE}</p></header><nav><a href=/>Home</a></nav><div id="cookie-notice">We use cookies, {PROSE}</div>
        <main><h1>Title &amp; more</h1><article><header><h2>Head&eacute;r</h2></header><p>{PROSE}</p><aside>{PROSE}</aside><form><p>{PROSE}</p></form><p>Short</p>
        <footer>{PROSE}</footer></article></main><section id="comments"><article class="comment"><p>{PROSE} {PROSE} {PROSE}</p></article></section>
        <div class="sidebar"><p>{PROSE}</p></div><div class="ad-slot">{PROSE}</div><footer>&copy;</footer></body></html>""",
                        ["Title & more", "Headér", PROSE, "Short"]),
    "no article": (f"""<body><div class="top"><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div><div class=x1>{paragraphs("A first one.", PROSE, "Third, last", PROSE + "!")}
        <ul><li>an item</li><li>another</li></ul><ul><li><a href=1>menu one</a></li><li><a href=2>menu two</a></li></ul></div>
        <div class=x2><a href=c>About us</a> | <a href=d>Imprint</a></div></body>""", ["A first one.", PROSE, "Third, last", PROSE + "!", "an item", "another"]),
    "sections": ("<body><div id=w><section><h2>One</h2>" + paragraphs(PROSE, PROSE + "2") + "</section><section><h2>Two</h2>" + paragraphs(PROSE + "3") + "</section><section><p>Tiny.</p></section></div></body>",
                 ["One", PROSE, PROSE + "2", "Two", PROSE + "3", "Tiny."]),
    "unclosed": ("<body><nav><ul><li><a href=x>x</a><article><h1>Title<p><b>Bold.<br>Line <i>two<p>Next &lt;p&gt; &#65;&#x42; &am<p>a <a href=1>link</a>.",
                 ["Title", "Bold. Line two", "Next <p> AB &am", "a link."]),
    "quoted marks": ("""<body><article data-x="a>b" title='<p>'><p title=it's>One > two < three<p>four<!-- <p>five</p> --> five<![CDATA[x]]></article>""", ["One > two < three", "four five"]),
    "comments by heading": (f"<body><div class=c>{paragraphs(PROSE, PROSE)}<h3>3 Comments</h3><div><p>{PROSE} {PROSE}</p></div></div></body>", [PROSE, PROSE]),
    "hidden": (f"<article><p>{PROSE}</p><div hidden>no</div><p style='color:red; display: none'>no</p><p>yes <span aria-hidden=true>no</span><button>no</button> end</p></article>", [PROSE, "yes end"]),
    "table": ("<article><table><caption>C</caption><tr><td>a<td>b<tr><td>c</table><pre> x\n  y </pre><hr>bare &nbsp; text<div>in div</div>after</article>", ["C", "a b", "c", "x y", "bare text", "in div", "after"]),
    "siblings": (f"<body><h1>Over it</h1><div class=txt>{paragraphs(PROSE, PROSE)}</div><p>{PROSE}</p><p>no sentence here</p><div class=txt><p>{PROSE}</p></div></body>", ["Over it", PROSE, PROSE, PROSE, PROSE]),
    "plain": ("just text", ["just text"]), "one word": ("<article><h1>x</h1><p>x</article>", ["x", "x"]), "heading only": ("<body><nav>n</nav><h1>only</h1></body>", ["only"]),
    "nothing": ("<nav>n</nav><footer>f</footer>", []), "empty": ("", []), "null": (None, []), "open script": ("<p>a</p><script>b", ["a"]), "cut tag": ("<article><p>a<p class='x", ["a"]),
}


@pytest.mark.parametrize("name", PAGES)
def test_page(name):
    source, want = PAGES[name]
    assert html_text.main_text(source) == "\n\n".join(want)


def test_long_pages():
    many = [f"Paragraph {i}, with a comma." for i in range(20_000)]
    assert html_text.main_text(f"<body><div>{paragraphs(*many)}</div><footer>f</footer>") == "\n\n".join(many)
    assert html_text.main_text("<div>" * 20_000 + "deep, text." + "</div>" * 20_000) == "deep, text."
    assert html_text.main_text("<article><p>" + "word " * 500_000) == " ".join(["word"] * 500_000)


def test_extraction(spark):
    data = [(i, "u", source, "old", 3) for i, (source, _) in enumerate(PAGES.values())] * 2
    pages = spark.createDataFrame(data, "page_id long, url string, html string, text string, n_chars int")
    want = [(i, "u", "\n\n".join(blocks), len("\n\n".join(blocks))) for i, (_, blocks) in enumerate(PAGES.values())] * 2
    assert rows(html_text.extract_text(pages), "page_id", "url", "text", "n_chars") == sorted(want, key=repr)
    assert html_text.extract_text(pages.limit(0)).isEmpty()


def test_extraction_of_pages(spark):
    """The test pages hold their articles in one element: another way to the same text."""
    want = []
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        blocks = re.split(r"</?(?:p|h1)>", re.search("<article>(.*)</article>", r.html, re.S)[1])
        plain = [" ".join(html.unescape(re.sub("</?b>", "", b.replace("<br>", " "))).split()) for b in blocks]
        text = "\n\n".join(b for b in plain if b)
        want.append((r.page_id, r.url, text, len(text)))
    assert rows(queries.op13_html_text(spark, "/root/testdata/sf0.01"), "page_id", "url", "text", "n_chars") == sorted(want, key=repr)
