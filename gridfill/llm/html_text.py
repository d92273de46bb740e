"""Main text of web pages: paragraphs score the containers around them, and the best container is the article."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gridfill.llm.common import map_batches, texts

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
RAW = frozenset("script style title textarea iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = HEADINGS | frozenset("""
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    head header hgroup html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul
""".split())
"""Elements that begin a block of their own; all others stand inside a line."""

DROPPED = frozenset("""
    aside audio button canvas datalist dialog fieldset footer form head map math menu meter nav noscript object
    progress search select svg template video
""".split())
"""Elements that are no part of an article wherever they stand."""

ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search tablist toolbar tooltip".split())
COMMENTS = frozenset("comment comments commentlist commenters disqus respond reply replies discussion guestbook".split())
BOILERPLATE = COMMENTS | frozenset("""
    ad ads adsbygoogle adsense adslot advert adverts advertisement advertisements advertising alert aside banner
    breadcrumb breadcrumbs consent cookie cookies copyright dropdown footer footnav gdpr hidden legal login masthead megamenu menu
    menus modal nav navbar navigation newsletter notice notices notification outbrain overlay pager pagination paywall popup
    promo promos promoted promotion rail recommendations recommended related share sharing sidebar sidenav signin signup skip social
    sponsor sponsored sponsors subscribe subscription taboola teaser teasers toolbar topbar topnav widget widgets
""".split())
"""Words in class and id that name what is left out."""

HEADER = frozenset(("header", "pageheader", "siteheader"))
ARTICLE_PARTS = frozenset("article body content entry main post story text".split())
NOT_SAID = frozenset("has is layout no with without".split())
"""Beside these a name tells of a page's layout, not of the element: "has-sidebar"."""

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
_COMMENTS_HEADING = re.compile(r"\W*(?:\d+\W+)?(?:(?:reader|user|your|leave a|post a)\s+)?(?:comments?|kommentare?|commentaires?|comentarios?|responses?)\W*(?:\d+\W*)?", re.I)
_COMMA = re.compile("[,،、，]")
_SENTENCE = re.compile(r"[.!?。](?:\s|$)")

# which open element an element ends, and the elements that it doesn't look beyond
_ENDS = {"li": (("li",), ("ul", "ol", "menu", "dir", "table")), "dd": (("dd", "dt"), ("dl", "table")), "dt": (("dd", "dt"), ("dl", "table")),
         "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tr": (("tr",), ("table",)),
         **{t: (("thead", "tbody", "tfoot"), ("table",)) for t in ("thead", "tbody", "tfoot")}}
_SCOPE = frozenset(("table", "td", "th", "caption"))

ARTICLE, HEAD, NAMED, REMARK, GOOD = 1, 2, 4, 8, 16


@lru_cache(maxsize=1 << 14)
def _judge(tag: str, attributes: str) -> int:
    """What a start tag says of its element: the article itself, a page's head, left out, readers' remarks, a good name."""
    flags = (ARTICLE if tag in ("article", "main") else 0) | (HEAD if tag == "header" else 0) | (NAMED if tag in DROPPED else 0)
    if not attributes:
        return flags
    values: dict[str, str] = {}
    for name, *quoted in _ATTRIBUTE.findall(attributes):
        values.setdefault(name.lower(), html.unescape("".join(quoted)))
    role = values.get("role", "").strip().lower()
    if role in ("main", "article") and tag not in ("html", "body"):
        flags |= ARTICLE
    if role in ROLES or "hidden" in values or values.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(values.get("style", "")):
        flags |= NAMED
    for name in f"{values.get('class', '')} {values.get('id', '')}".split():
        parts = {p.lower() for p in _NAME_PART.findall(name)} | {re.sub(r"[\W_\d]+", "", name.lower())}
        if parts & NOT_SAID:
            continue
        if parts & COMMENTS:
            flags |= REMARK
        if parts & BOILERPLATE:
            flags |= NAMED
        elif parts & HEADER and not parts & ARTICLE_PARTS:
            flags |= HEAD
        elif parts & ARTICLE_PARTS:
            flags |= GOOD
    if tag in ("html", "body") or (flags & ARTICLE and not flags & REMARK):
        flags &= ~(NAMED | HEAD | REMARK)
    return flags


@dataclass
class Page:
    """Elements in the order of their start tags, and the blocks of text that they hold."""

    tag: list[str] = field(default_factory=lambda: ["#page"])
    parent: list[int] = field(default_factory=lambda: [-1])
    flags: list[int] = field(default_factory=lambda: [0])
    unclosed: set[int] = field(default_factory=set)
    names: list[str] = field(default_factory=lambda: [""])
    owner: list[int] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)


def parse(source: str) -> Page:
    """The tree of a page, mended as browsers do: blocks end paragraphs, items end items, end tags end what is open inside."""
    page = Page()
    stack, opened = [0], Counter()
    inline: list[tuple[str, int, bool, bool]] = []  # tag, depth, link, left out
    pieces: list[str] = []
    links = mute = link_chars = 0

    def flush() -> None:
        nonlocal link_chars
        text = " ".join("".join(pieces).split())
        if text:
            page.owner.append(stack[-1])
            page.text.append(text)
            page.linked.append(min(link_chars, len(text)))
        pieces.clear()
        link_chars = 0

    def pop_inline(to: int) -> None:
        nonlocal links, mute
        while len(inline) > to:
            _, _, link, out = inline.pop()
            links -= link
            mute -= out

    def close(depth: int, by_end_tag: bool) -> None:
        while len(stack) > depth:
            if page.tag[stack[-1]] in ("td", "th"):
                pieces.append(" ")  # a row is one block
            else:
                flush()
            node = stack.pop()
            opened[page.tag[node]] -= 1
            if len(stack) > depth or not by_end_tag:
                page.unclosed.add(node)
        n = len(inline)
        while n and inline[n - 1][1] > len(stack):
            n -= 1
        pop_inline(n)

    def find(tags: tuple[str, ...], limits) -> int:
        """The depth of the innermost open element of ``tags`` inside ``limits``; 0 if there is none."""
        if any(opened[t] for t in tags):
            for depth in range(len(stack) - 1, 0, -1):
                tag = page.tag[stack[depth]]
                if tag in tags:
                    return depth
                if tag in limits:
                    break
        return 0

    def say(chunk: str) -> None:
        nonlocal link_chars
        if chunk and not mute:
            chunk = html.unescape(chunk) if "&" in chunk else chunk
            pieces.append(chunk)
            if links:
                link_chars += len(chunk)

    at = 0
    while token := _TOKEN.search(source, at):
        say(source[at:token.start()])
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if token[1]:
            if tag in BLOCKS:
                if tag in ("body", "html"):
                    continue  # what follows still belongs to the page
                tags = tuple(HEADINGS) if tag in HEADINGS else (tag,)
                if depth := find(tags, () if tag in _SCOPE else _SCOPE):
                    close(depth, True)
            else:
                n = next((i for i in range(len(inline) - 1, -1, -1) if inline[i][0] == tag), -1)
                if n >= 0 and (tag == "a" or inline[n][1] == len(stack)):
                    gone = inline.pop(n)
                    links -= gone[2]
                    mute -= gone[3]
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(source, at)
            at = end.start() if end else len(source)
            continue
        if tag == "br":
            say(" ")
        elif tag == "hr":
            flush()
        if tag in VOID:
            continue
        attributes = token[3]
        if tag not in BLOCKS:
            if attributes.endswith("/") and tag in ("svg", "object", "canvas"):
                continue
            if tag == "a":
                n = next((i for i in range(len(inline) - 1, -1, -1) if inline[i][0] == "a"), -1)
                if n >= 0:
                    links -= inline[n][2]
                    mute -= inline.pop(n)[3]
            out = bool(_judge(tag, attributes) & NAMED) if attributes or tag in DROPPED else False
            link = tag == "a" and "href" in attributes.lower()
            inline.append((tag, len(stack), link, out))
            links += link
            mute += out
            continue
        if tag in ("html", "body") and opened[tag]:
            continue
        if page.tag[stack[-1]] == "p":
            close(len(stack) - 1, False)
        if tag in _ENDS:
            tags, limits = _ENDS[tag]
            if depth := find(tags, limits):
                close(depth, False)
        elif tag in HEADINGS and page.tag[stack[-1]] in HEADINGS:
            close(len(stack) - 1, False)
        elif tag == "body" and (depth := find(("head",), ())):
            close(depth, False)
        if tag not in ("td", "th"):
            flush()
        node = len(page.tag)
        page.tag.append(tag)
        page.parent.append(stack[-1])
        page.flags.append(_judge(tag, attributes))
        page.names.append(attributes if "class" in attributes else "")
        stack.append(node)
        opened[tag] += 1
    say(source[at:])
    close(0, False)
    return page


def _left_out(page: Page) -> list[bool]:
    """Per element, whether it or one around it is no part of an article."""
    n = len(page.tag)
    holds_article = [False] * n
    for i in range(n - 1, 0, -1):
        if page.flags[i] & ARTICLE or holds_article[i]:
            holds_article[page.parent[i]] = True
    inside = [False] * n  # of an article or a main element
    out = [False] * n
    for i in range(1, n):
        up, flags = page.parent[i], page.flags[i]
        inside[i] = inside[up] or bool(flags & ARTICLE)
        gone = flags & REMARK or flags & NAMED or (flags & HEAD and not inside[i])
        if gone and holds_article[i] and not flags & REMARK and (i in page.unclosed or page.tag[i] not in DROPPED | {"header"}):
            gone = False  # a frame around the article, or never closed
        out[i] = out[up] or bool(gone)
    heads = {}
    for owner, text in zip(page.owner, page.text, strict=True):
        if page.tag[owner] in HEADINGS and len(text) < 60 and _COMMENTS_HEADING.fullmatch(text):
            heads.setdefault(page.parent[owner], owner)
    if heads:  # remarks under a heading of their own
        for i in range(1, n):
            first = heads.get(page.parent[i])
            out[i] = out[i] or out[page.parent[i]] or (first is not None and i >= first)
    return out


def main_blocks(page: Page) -> list[str]:
    """The blocks of the best container and of those beside it that belong to it."""
    n, out = len(page.tag), _left_out(page)
    alive = [k for k, o in enumerate(page.owner) if not out[o]]
    if not alive:
        return []
    has_children = [False] * n
    for i in range(1, n):
        has_children[page.parent[i]] = True
    points, length, linked, n_links = [0.0] * n, [0] * n, [0] * n, [0] * n
    for k in alive:
        owner, size = page.owner[k], len(page.text[k])
        length[owner] += size
        linked[owner] += page.linked[k]
        n_links[owner] += page.linked[k] > 0
        if page.tag[owner] in HEADINGS:
            continue
        gain = 1 + len(_COMMA.findall(page.text[k])) + size / 100
        up = owner if has_children[owner] or not owner else page.parent[owner]
        for share in (1.0, 0.5, 1 / 6, 1 / 9, 1 / 12):
            points[up] += gain * share
            up = page.parent[up]
            if up < 0:
                break
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        length[up] += length[i]
        linked[up] += linked[i]
        n_links[up] += n_links[i]

    def density(i: int) -> float:
        return linked[i] / length[i] if length[i] else 0.0

    weight = {"div": 5, "article": 5, "main": 5, "section": 5, "blockquote": 3, "pre": 3, "td": 3, "ul": -3, "ol": -3, "dl": -3, "li": -3}
    score = [(p + weight.get(page.tag[i], 0) + (25 if page.flags[i] & GOOD else 0)) * (1 - density(i)) if p else 0.0 for i, p in enumerate(points)]
    best = max(range(n), key=lambda i: (score[i], -i))
    if not score[best]:  # headings only
        best = 0
    up, frame = best, -1
    while up > 0:
        if page.flags[up] & ARTICLE and (frame < 0 or page.tag[up] != "main"):
            frame = up  # the outermost article, or main where there is none
        up = page.parent[up]
    if frame >= 0:
        best = frame
    else:
        while page.parent[best] > 0 and page.tag[best] not in ("body", "html"):
            up = page.parent[best]
            if page.tag[up] in ("body", "html") or (length[up] > length[best] and score[up] <= score[best]):
                break
            best = up
    kept = _with_siblings(page, best, frame >= 0, alive, out, score, density)

    shown = [False] * n
    for i in range(n):
        menu = page.tag[i] in ("ul", "ol", "dl", "div", "section", "table", "span") and i != best and length[i] and density(i) > 0.5
        shown[i] = i in kept or (i > 0 and shown[page.parent[i]] and not menu)
    loose = {-k for k in kept if k < 0}
    return [page.text[k] for k in alive if shown[page.owner[k]] or k + 1 in loose]


def _with_siblings(page: Page, best: int, named: bool, alive: list[int], out: list[bool], score: list[float], density) -> set[int]:
    """``best`` and what stands beside it and belongs to it: elements by number, blocks of bare text by -1 - number."""
    kept = {best}
    up = page.parent[best]
    if up < 0:
        return kept
    beside = [i for i in range(up + 1, len(page.tag)) if page.parent[i] == up and not out[i]]
    said: dict[int, list[int]] = {}
    for k in alive:
        said.setdefault(page.owner[k], []).append(k)

    def sentence(k: int) -> bool:
        share = page.linked[k] / len(page.text[k])
        return share < 0.25 if len(page.text[k]) > 80 else share == 0 and bool(_SENTENCE.search(page.text[k]))

    limit = max(10.0, 0.2 * score[best])
    framed = page.tag[up] not in ("body", "html", "#page")
    for i in beside:
        alike = page.tag[i] == page.tag[best] != "article" and page.names[i] == page.names[best] and (page.names[i] != "" or framed)
        strong = (alike or score[i] >= limit) and density(i) < 0.5 and (not named or page.tag[i] in ("article", "section"))
        if i != best and (strong or page.tag[i] == "p" and any(sentence(k) for k in said.get(i, ()))):
            kept.add(i)
    for before, after in reversed(list(zip(beside, beside[1:], strict=False))):
        if page.tag[before] in HEADINGS and after in kept:
            kept.add(before)  # a heading belongs to what it stands over
    if not named:
        kept |= {-1 - k for k in said.get(up, ()) if sentence(k)}
    return kept


def main_text(source: str | None) -> str:
    """The article of a page, its blocks two line ends apart; empty if there is none."""
    return "\n\n".join(main_blocks(parse(source))) if source else ""


def extract_text(pages: DataFrame, page_html: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (replaced if there): the main text of the column ``page_html``, which is left out.

    Paragraphs pass points for their length and commas to the elements around them, less the further out; an element's
    score is discounted by the share of its text in links. The best one is kept, with the article or main element around
    it where there is one, and those beside it that score well. Left out before are elements that by kind, role, name or
    style are menus, headers, footers, sidebars, notices, adverts, forms, hidden, or readers' comments, and lists that are
    mostly links. Character references are decoded, white space in a block becomes one space; nothing is cut.

    Null and empty pages and those without an article give the empty string and 0. Repeated rows get the same text. An empty
    table gives no rows. Rows stay where they are, each is read by itself; memory follows the longest page.
    """
    kept = [c for c in pages.columns if c not in ("text", "n_chars", page_html)]
    rows = pages.select(*kept, F.col(page_html).alias("text"))
    schema = StructType([*rows.schema.fields, StructField("n_chars", LongType())])

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [main_text(page) for page in texts(batch.column(len(kept)))]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())], schema.names)

    return map_batches(rows, one, schema)
