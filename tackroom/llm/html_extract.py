"""Main text of web pages by equivalence-class template deduction (operator 6).

1. A pass over the pages counts every structural token (an element's path of
   container names) per page. Tokens of a host whose counts over its pages are
   the same form an equivalence class; the vectors themselves are never built,
   only an order-free digest of (page, count), which pre-aggregates.
2. The class of the page's root, tokens found exactly once on each of its pages,
   is the outer template. Its tokens nest; the slot of the article is its
   <article> or <main>, or else the deepest token outside of which no text but
   links varies from page to page. Classes nested in it that are link lists,
   constant text or carry the name of a menu, notice, advert and so on are
   template too.
3. A second pass extracts what remains in the article's slot, block by block.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tackroom.llm.storage import materialize

SUPPORT = 0.2     # share of a host's pages on which a token of the template must be found
LINKS = 0.6       # share of link text from which a slot is a menu
BLOCK = 0.1       # share of a page's longest block from which a block counts for telling pages apart
MOST = 2 / 3      # share of the text outside links from which an element is the page's content, whatever its name
TEXTS = 3         # different articles that must agree for their common text to be template

# Element names of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var".split())
LEAF = frozenset("p li dt dd h1 h2 h3 h4 h5 h6 td th tr caption pre blockquote figcaption address option".split())
NEVER = frozenset("script style noscript template head title nav footer aside button select textarea iframe object "
                  "svg canvas audio video dialog menu datalist input map math".split())
FORM = frozenset(["form", "fieldset"])   # left out as elements with such a name are
CLOSED_BY = {  # an open element (key) ends where one of these begins
    "p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hgroup hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
}
ARTICLE = frozenset(["article", "main"])
# Words in classes, ids and roles that name what is not the article.
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar aside menu nav "
    "navbar navigation breadcrumb breadcrumbs footer masthead topbar comment comments disqus respond replies reply cookie "
    "cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login "
    "search share sharing social related recommended recommendations widget toolbar pager pagination form contentinfo "
    "complementary skip".split())
NOISE_STEM = re.compile("comment|cookie|sidebar|advert|newsletter|footer|breadcrumb|disqus|sponsor|popup|subscri")
HEADER_WORDS = frozenset(["header", "banner"])
# words that say nothing of the content: inside an article, a name counts only if it has no others beside the above
NEUTRAL_WORDS = frozenset(
    "area articles bar block blocks body box button buttons card container content count feed footer frame group header holder "
    "icon icons inner item items label link links list main media module outer panel post posts row section slot stories story "
    "text thread title top unit user users wrap wrapper".split())
_DEPTH = 64      # containers that a path spells out; one below them ends in a digest of all that is above it
# the only ones that count in classes of headings, paragraphs, cells, list items and inline elements
ADVERT_WORDS = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
                    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
# one attribute after the other, so that nothing inside a value is taken for a name
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_READ = frozenset(["class", "id", "role", "hidden", "style", "aria-hidden"])
_OPENED = ("<!--", "<![CDATA[")
_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_DIGITS = re.compile(r"\d+")
_NAMED = re.compile(r"(article|main)(?![^#.])")   # last part of the path of an <article> or <main>


@dataclass
class Named:
    """An element whose name says that it is not the article."""
    above: Named | None  # the one around it
    article: bool        # inside <article> or <main>
    chars: int = 0       # of text outside links
    main: int = 0        # of these in an <article> or <main> within it
    free: int = 0        # of these in no other such element
    out: bool = True


@dataclass
class Node:
    name: str
    path: str            # of containers, the template's token
    noise: bool          # inside something that is never the article
    article: bool        # inside <article> or <main>
    link: bool
    named: Named | None = None


class Page:
    """Streams the elements and texts of one page to the two handlers, with the stack of open elements."""

    def __init__(self, html: str):
        self.html = html

    def events(self) -> list[tuple[str, Node, str]]:
        """('open', node, name), ('text', node, raw text), ('break', node, '').

        A name does not leave out an element that has the <article> or <main> in it (if none with text stands outside
        of such elements), or MOST of the text of the article, or of a page that has none.
        """
        found = list(self._read())
        total = main = free = 0
        for kind, node, text in found:
            if node.noise:
                continue
            if kind == "text" and not node.link and not text.isspace():
                n = len(text.strip())
                total += n
                main += n * node.article
                at, inner = node.named, None   # inner: the innermost around the article
                while at is not None:
                    at.chars += n
                    if node.article and not at.article:
                        at.main += n
                        inner = inner or at
                    at = at.above
                if inner is not None:
                    inner.free += n
                else:
                    free += n * node.article
        self._settle(found, total, main, free)
        return found

    @staticmethod
    def _settle(found: list[tuple[str, Node, str]], total: int, main: int, free: int) -> None:
        settled: set[int] = set()
        for _, node, _ in found:
            chain = []
            at = node.named
            while at is not None and id(at) not in settled:
                chain.append(at)
                at = at.above
            for x in reversed(chain):
                settled.add(id(x))
                if x.above is not None and x.above.out:
                    x.out = True
                elif x.article:
                    x.out = x.chars < MOST * main or not x.chars
                elif main:
                    beside, at = free, x.above
                    while at is not None:
                        beside += at.free
                        at = at.above
                    x.out = not x.main or beside > 0
                else:
                    x.out = x.chars < MOST * total or not x.chars
        for _, node, _ in found:
            node.noise = node.noise or (node.named is not None and node.named.out)

    def _read(self) -> Iterator[tuple[str, Node, str]]:
        html, at = self.html, 0
        last = html.rfind(">") + 1      # no tag ends behind it, so none is looked for there
        stack = [Node("", "", False, False, False)]
        while True:
            m = _TOKEN.search(html, at, last) if at < last else None
            stop = m.start() if m else min((x for x in (html.find(o, at) for o in _OPENED) if x >= 0), default=len(html))
            if stop > at:
                yield "text", stack[-1], html[at:stop]
            if not m:
                return
            at = m.end()
            if at == last and m[0].startswith(_OPENED) and not m[0].endswith(("-->", "]]>")):
                return  # a comment that is never closed
            tag = m[2] or m[5]
            if tag is None:
                continue
            tag, closing, attrs = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
            if closing:
                self._close(stack, tag)
                if tag not in INLINE:
                    yield "break", stack[-1], ""
                continue
            if tag in RAW:
                end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
                at = end.end() if end else len(html)
                if tag not in INLINE:
                    yield "break", stack[-1], ""
                continue
            if tag not in INLINE:
                for i in range(len(stack) - 1, 0, -1):
                    if tag in CLOSED_BY.get(stack[i].name, ()):
                        del stack[i:]
                        break
                    if stack[i].name not in INLINE and stack[i].name not in LEAF:
                        break
                yield "break", stack[-1], ""
            if tag in VOID:
                continue
            parent = stack[-1]
            node = self._node(parent, tag, attrs)
            stack.append(node)
            if node.path != parent.path:
                yield "open", node, tag

    @staticmethod
    def _close(stack: list[Node], tag: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name == tag:
                del stack[i:]
                return
            if tag in INLINE and stack[i].name not in INLINE:
                return  # an inline end tag does not close blocks

    @staticmethod
    def _only_noise(name: str) -> bool:
        """Whether a class or id inside an article names something beside it and nothing else: related-posts, not related-work."""
        words = [w.lower() for w in _WORD.findall(name)]
        return all(w in NOISE_WORDS or w in NEUTRAL_WORDS or w in HEADER_WORDS or NOISE_STEM.search(w) for w in words)

    @staticmethod
    def _node(parent: Node, tag: str, attrs: str) -> Node:
        found: dict[str, str] = {}
        if attrs and ("=" in attrs or "hidden" in attrs):
            for a, v in _ATTR.findall(attrs):
                if a.lower() in _READ:
                    found.setdefault(a.lower(), v.strip("\"'"))
        article = parent.article or tag in ARTICLE
        noise = (parent.noise or tag in NEVER or "hidden" in found or found.get("aria-hidden") == "true"
                 or "display:none" in found.get("style", "").replace(" ", "").lower())
        named = parent.named
        if not noise and tag not in ("html", "body") and tag not in ARTICLE:
            small = tag in INLINE or tag in LEAF
            names = " ".join(found[k] for k in (("class",) if small else ("class", "id")) if k in found)
            if article and names and not small:
                names = " ".join(t for t in names.split() if Page._only_noise(t))
            words = {w.lower() for w in _WORD.findall(names)} if names else frozenset()
            role = {w.lower() for w in _WORD.findall(found["role"])} if "role" in found else frozenset()
            if small:
                is_named = bool(words & ADVERT_WORDS or role & NOISE_WORDS)
            else:
                is_named = (tag in FORM or bool((words | role) & NOISE_WORDS)
                            or (bool(names) and NOISE_STEM.search(names.lower()) is not None)
                            or (not article and (tag == "header" or bool((words | role) & HEADER_WORDS))))
            if is_named:
                named = Named(parent.named, article)
        path = parent.path
        if tag not in INLINE and tag not in LEAF:
            label = "".join(sign + found[k] for sign, k in (("#", "id"), (".", "class")) if found.get(k))
            path = f"{parent.path}/{tag}{_DIGITS.sub('0', label)}"
            if path.count("/") > _DEPTH:
                top = path.split("/", _DEPTH)
                path = "/".join(top[:_DEPTH]) + "/~" + blake2b(path.encode(), digest_size=8).hexdigest()
        return Node(tag, path, noise, article, parent.link or tag == "a", named)


def _ancestors(path: str) -> Iterator[str]:
    at = len(path)
    while at > 0:
        yield path[:at]
        at = path.rfind("/", 0, at)


def page_tokens(html: str) -> dict[str, list]:
    """Per structural token, without noise: occurrences, characters of text, of link text, a digest of the text, and
    the characters and a digest of the text outside links that lies in no container within it."""
    stats: dict[str, list] = defaultdict(lambda: [0, 0, 0, blake2b(digest_size=8), 0, blake2b(digest_size=8)])
    own: dict[str, bool] = {}
    for kind, node, text in Page(html).events():
        if kind == "open":
            stats[node.path][0] += 1
            own[node.path] = node.noise
        elif kind == "text" and not node.noise and not text.isspace():
            value = " ".join(unescape(text).split())
            for path in _ancestors(node.path):
                s = stats[path]
                s[1] += len(value)
                s[2] += len(value) * node.link
                s[3].update(value.encode("utf-8", "surrogatepass"))
            if not node.link:
                s = stats[node.path]
                s[4] += len(value)
                s[5].update(value.encode("utf-8", "surrogatepass"))
    return {p: [x if isinstance(x, int) else int.from_bytes(x.digest(), "big", signed=True) for x in s]
            for p, s in stats.items() if s[0] and not own.get(p, False)}


def page_text(tokens: dict[str, list]) -> int:
    """A key that copies of an article share: of the texts of the page's larger blocks, in its <article> or <main> if it has one."""
    blocks = {p: s for p, s in tokens.items() if s[4]}
    named = {p: s for p, s in blocks.items() if any(_NAMED.match(part) for part in p.split("/"))}
    least = BLOCK * max((s[4] for s in blocks.values()), default=0)
    if any(s[4] >= least for s in named.values()):
        blocks, least = named, BLOCK * max(s[4] for s in named.values())
    key = blake2b(digest_size=8)
    for p in sorted(blocks):
        if blocks[p][4] >= least:
            key.update(blocks[p][5].to_bytes(8, "big", signed=True))
    return int.from_bytes(key.digest(), "big", signed=True)


def extract_text(html: str, slot: str | None, template: frozenset[str], lists: frozenset[str] = frozenset()) -> str:
    """Blocks in the article's slot that belong to no template token, joined by one space.

    ``slot`` is the path of the host's article; a page without it uses its
    <article> or <main>, or the whole body. Tokens in ``lists`` are left out if
    they are link lists on this page.
    """
    if lists:
        stats = page_tokens(html)
        template = template | {p for p in lists if p in stats and _is_list(stats[p][1], stats[p][2])}
    inside: list[str] = []
    article: list[str] = []
    body: list[str] = []
    outs = (inside, article, body)
    buffers: tuple[list[str], ...] = ([], [], [])
    found_slot = found_article = False
    under: dict[str, tuple[bool, bool]] = {}   # path -> in the slot, in a template token

    def flush() -> None:
        for out, buffer in zip(outs, buffers, strict=True):
            if buffer:
                block = " ".join("".join(buffer).split())
                if block:
                    out.append(block)
                buffer.clear()

    for kind, node, text in Page(html).events():
        if kind == "break":
            flush()
            continue
        place = under.get(node.path)
        if place is None:
            chain = set(_ancestors(node.path))
            place = under[node.path] = (slot is not None and slot in chain, not template.isdisjoint(chain))
        found_slot = found_slot or place[0]
        found_article = found_article or (node.article and not node.noise)
        if kind == "text" and not node.noise and not place[1]:
            value = unescape(text)
            buffers[2].append(value)
            if node.article:
                buffers[1].append(value)
            if place[0]:
                buffers[0].append(value)
    flush()
    return " ".join(inside if found_slot else article if found_article else body)


def _is_list(chars: int, links: int) -> bool:
    return chars > 0 and links >= LINKS * chars


def host_of(url: Column) -> Column:
    """Host part of an address, lower-case; the empty text if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


@dataclass
class _Token:
    path: str
    pages: int
    total: int
    chars: int
    links: int
    constant: bool
    own: int             # characters outside links and nested containers
    own_constant: bool
    sig: int
    texts: int           # different articles among its pages
    lists: int           # pages on which it is a link list


def host_template(tokens: list[_Token]) -> tuple[str | None, list[str], list[str]]:
    """(article's slot, template tokens in it to leave out, tokens in it to leave out where they are link lists) from a
    host's frequent tokens. Text is constant if different articles have it; copies of one article tell nothing."""
    if not tokens:
        return None, [], []
    classes: dict[tuple, list[_Token]] = defaultdict(list)
    for t in tokens:
        classes[t.pages, t.total, t.sig].append(t)
    # the outer template: of the classes with one occurrence a page, that on most pages (the largest of these)
    single = [(k[0], len(v), v) for k, v in classes.items() if k[0] == k[1]]
    if not single:
        return None, [], []
    outer = {t.path: t for t in max(single, key=lambda x: (x[0], x[1], min(t.path for t in x[2])))[2]}
    known = {t.path: t for t in tokens}
    nested: dict[str, list[str]] = defaultdict(list)   # tokens directly within a token
    for p in known:
        above = next((a for a in _ancestors(p) if a != p and a in known), None)
        if above is not None:
            nested[above].append(p)

    def varying(t: _Token) -> int:
        return (t.chars - t.links) * (not t.constant or t.texts < TEXTS)

    def alone(p: str, step: str) -> bool:
        """No text that varies, but for links, stands in ``p`` outside ``step``; that of rare tokens counts as varying."""
        t = known[p]
        rare = t.chars - t.links - t.own - sum(known[c].chars - known[c].links for c in nested[p])
        return rare <= 0 and (t.own == 0 or (t.own_constant and t.texts >= TEXTS)) and not any(
            varying(known[c]) for c in nested[p] if c != step)

    roots = [p for p in outer if not any(a in outer for a in _ancestors(p) if a != p)]
    slot = max(roots, key=lambda p: (varying(outer[p]), p))
    named = [p for p, t in outer.items() if _NAMED.match(p.rsplit("/", 1)[-1]) and t.chars > 0 and (not t.constant or t.texts < TEXTS)]
    if named:
        slot = max(named, key=lambda p: (varying(outer[p]), outer[p].chars, -len(p), p))
    else:
        while True:
            step = max((c for c in nested[slot] if c in outer), key=lambda p: (varying(outer[p]), p), default=None)
            if step is None or varying(outer[step]) <= 0 or not alone(slot, step):
                break
            slot = step
    inside = [t for t in tokens if t.path.startswith(slot + "/") and t.chars > 0]
    drop = {t.path for t in inside if t.texts >= TEXTS and t.constant and t.pages == t.total}
    # outside <article> and <main> a link list is a menu, however few pages have it
    lists = {t.path for t in inside if 2 * t.lists > t.pages and (t.texts >= TEXTS or not named)} - drop

    def left(p: str) -> int:
        """Characters of a token outside of what is left out."""
        return 0 if p in drop or p in lists else known[p].chars - sum(known[c].chars - left(c) for c in nested[p])

    while left(slot) <= 0 and (drop or lists):   # what holds the slot's only text is the article
        gone = lists or drop
        gone.remove(max(gone, key=lambda p: (known[p].chars, -len(p), p)))
    return slot, sorted(drop), sorted(lists)


_TOKENS = "host string, path string, page long, n long, chars long, links long, digest long, own long, own_digest long, text long"


def templates(pages: DataFrame) -> DataFrame:
    """(host, slot, template, lists) for the rows (host, page, html)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in range(10)]
            for host, page, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                tokens = page_tokens(html)
                text = page_text(tokens)
                for path, stats in tokens.items():
                    for column, value in zip(rows, (host, path, page, *stats, text), strict=True):
                        column.append(value)
            types = (pa.string(), pa.string(), *[pa.int64()] * 8)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)],
                                             names=["host", "path", "page", "n", "chars", "links", "digest", "own", "own_digest", "text"])

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        slot, drop, lists = host_template([_Token(r.path, r.pages, r.total, r.chars, r.links, r.constant, r.own, r.own_constant,
                                                  r.sig, r.texts, r.lists) for r in pdf.itertuples()])
        return pd.DataFrame({"host": [pdf.host.iloc[0]], "slot": [slot], "template": ["\n".join(drop)],
                             "lists": ["\n".join(lists)]})

    tokens = pages.select("host", "page", "html").mapInArrow(run, _TOKENS)
    # copies of an article become one row first; then one row for each host and token: the digest of the occurrence
    # vector needs no order
    by_text = tokens.groupBy("host", "path", "text").agg(
        F.count("*").alias("pages"), F.sum("n").alias("total"), F.sum("chars").alias("chars"), F.sum("links").alias("links"),
        F.sum("own").alias("own"), *(f(c).alias(f"{f.__name__}_{c}") for c in ("digest", "own_digest") for f in (F.min, F.max)),
        F.bit_xor(F.xxhash64("page", "n")).alias("sig"),
        F.count_if((F.col("chars") > 0) & (F.col("links") >= LINKS * F.col("chars"))).alias("lists"))
    vectors = materialize(by_text.groupBy("host", "path").agg(
        *(F.sum(c).alias(c) for c in ("pages", "total", "chars", "links", "own", "lists")),
        *((F.min(f"min_{c}") == F.max(f"max_{c}")).alias(name) for c, name in (("digest", "constant"), ("own_digest", "own_constant"))),
        F.bit_xor("sig").alias("sig"), F.count("*").alias("texts")), "page-tokens")
    most = vectors.groupBy("host").agg(F.max("pages").alias("most"))
    # a share of 1 / SUPPORT of the tokens of an average page, at most, is left per host
    frequent = vectors.join(most, "host").where(F.col("pages") >= F.col("most") * SUPPORT).drop("most")
    return frequent.groupBy("host").applyInPandas(decide, "host string, slot string, template string, lists string")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: ``id_col``, ``url_col``, text, n_chars (code points).

    Left out are menus, headers, footers, sidebars, notices, adverts, forms,
    scripts, styles, comments of readers and of the source, and markup. Character
    references are decoded, white space within a block is one space, blocks are
    joined by one space. Null and empty pages give the empty text, as do pages
    without an article. Pages without a host share one template; a host with few
    pages has the template of those. Repeated rows are extracted alike; a row
    without an id still counts for its host. Other columns are ignored.
    """
    page = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"),
                        F.coalesce(html_col, F.lit("")).alias("html"))
    found = materialize(templates(page.select("host", F.xxhash64("id", "url").alias("page"), "html")), "templates")
    known = page.join(found, "host", "left").select("id", "url", "html", "slot", "template", "lists")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract_text(html, slot, *(frozenset(t.split("\n")) if t else frozenset() for t in (drop, lists)))
                     for html, slot, drop, lists in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["id", "url", "text", "n_chars"])

    kind = dict(pages.dtypes)
    return (known.mapInArrow(run, f"id {kind[id_col]}, url string, text string, n_chars long")
            .withColumnsRenamed({"id": id_col, "url": url_col}))
