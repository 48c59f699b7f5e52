"""HTML main text with site template removal.

A page is parsed into elements (implied end tags, stray and missing ones included).  Every
element with text is hashed with all that it holds; Spark counts per host on how many
different pages (by heading, title and text, so copies of an article count once) each hash occurs, and
per section (first folder of the address).  A subtree on many pages of its host or section is template
and goes, together with elements that their tag, role or class marks as menu, header, footer, sidebar,
notice, advert, form, script, style or reader comments.  What is left of the main element or the articles (or, where
over twice their paragraph text lies beside them, of the body) is cut into blocks.  An element that a class, an id or the form tag marks stays if it holds what the
page is about: its main element, or most of its paragraph text while no article shows any.

Inside the article a wrapper (div, section ...) or an element of links goes like one outside,
unless it holds half of the article.  A plain paragraph, list or table must recur on nearly all pages of a
large host: passages that articles share are not template.

Rules: null or empty html gives an empty text; a null or odd url is a host of its own; a page that
ends early counts as closed there; character references are decoded, unknown ones
stay; white space in a block is one space, blocks are joined by a blank line; repeated rows
give equal rows; extra columns are ignored; nothing is cut to a length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, staged, table_bytes

#: A template outside the article, or a wrapper inside: on this many different pages and this share of its host's or section's.
OUTER_PAGES, OUTER_SHARE = 3, 0.3
#: Plain paragraphs inside the article.
INNER_PAGES, INNER_SHARE = 20, 0.9
#: Hosts' template lists up to this stored size are broadcast, larger ones joined by a shuffle.
BROADCAST_BYTES = 16 << 20

# Names of HTML elements by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROP = frozenset(
    "head script style nav footer aside form button select textarea iframe noscript template svg math "
    "menu dialog object embed audio video canvas map datalist fieldset title xmp noembed noframes".split()
)
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table caption "
    "thead tbody tfoot tr ul".split()
)
#: Boxes; paragraphs, headings, lists and tables can be text that articles share.
WRAPPERS = frozenset("address center details div figure header hgroup section".split())
CLOSES_P = BLOCK - {"html", "body", "caption", "thead", "tbody", "tfoot", "tr", "figcaption", "summary"}
IMPLIED = {
    "li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "tr": ("tr td th", {"table"}),
    "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}), "option": ("option", {"select"}),
}
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie "
    "cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription "
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar side aside footer foot masthead share sharing "
    "social comments comment commentlist reply replies respond disqus related recommended recommendations widget "
    "widgets login signup signin search searchbox pagination pager toolbar skip copyright disclaimer toc".split()
)
#: Words that may stand beside a listed one in a class or id: "cookie-bar", "site-nav", but not "with-sidebar".
BESIDE = frozenset(
    "box bar block wrapper wrap container section area list link links button buttons icon icons item items slot unit inner "
    "outer top bottom left right primary secondary main global site page post".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
_ATTR = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORDS = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Node:
    """An element: its children are elements and texts."""

    __slots__ = ("chars", "children", "dropped", "hash", "linked", "site", "soft", "tag")

    def __init__(self, tag: str, dropped: bool = False, site: bool = False, soft: bool = False):
        self.tag, self.dropped, self.site, self.soft = tag, dropped, site, soft
        self.children: list[Node | str] = []
        self.hash = self.chars = self.linked = 0  # characters of text, and of text in links


def attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in _ATTR.findall(text):
        out.setdefault(name.lower(), unescape(value.strip("\"'")) if "&" in value else value.strip("\"'"))
    return out


def is_boilerplate(tag: str, attrs: dict[str, str]) -> bool:
    """Marked as boilerplate by tag, role or as hidden."""
    if tag in DROP and tag != "form":
        return True
    if not attrs or tag in ("html", "body", "main"):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in ROLES:
        return True
    if _HIDDEN.search(attrs.get("style", "").lower()):
        return True
    return False


def is_named_boilerplate(tag: str, attrs: dict[str, str]) -> bool:
    """A form, or marked by class or id: a name of listed words and words that may stand beside them."""
    if tag == "form":
        return True
    if not attrs or tag in ("html", "body", "main"):
        return False
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split():
        words = _WORDS.findall(name)
        if not BOILERPLATE.isdisjoint(words) and all(w in BOILERPLATE or w in BESIDE for w in words):
            return True
    return False


def parse(html: str) -> Node:
    """The page as a tree; never fails."""
    root = Node("#root")
    stack, at, n, marked = [root], 0, len(html), False
    while at < n:
        m = _TAG.search(html, at)
        if m is None:
            stack[-1].children.append(html[at:])
            break
        if m.start() > at:
            stack[-1].children.append(html[at : m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):
            _close(stack, tag)
            continue
        _imply(stack, tag)
        attrs = attributes(m.group(3)) if m.group(3).strip(" /") else {}
        hard = is_boilerplate(tag, attrs)
        soft = not hard and is_named_boilerplate(tag, attrs)
        marked = marked or soft
        node = Node(tag, hard or soft, tag == "header", soft)
        stack[-1].children.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[^>]*(?:>|\Z)", re.I).search(html, at)
            node.children.append(html[at : end.start() if end else n])
            at = end.end() if end else n
            continue
        if m.group(3).endswith("/") and tag not in BLOCK:
            continue
        stack.append(node)
    if marked:
        spare(root)
    return root


def _prose(root: Node, paragraphs: bool) -> tuple[dict[int, int], int]:
    """Characters of text (in paragraphs or all, without links) below each outermost marked element (by id), and
    of the text in articles that shows.  Elements dropped by tag, role or as hidden do not count."""
    sums: dict[int, int] = {}
    shown = 0
    todo: list[tuple] = [(root, None, not paragraphs, False)]
    while todo:
        node, marked, counted, inside = todo.pop()
        if node.dropped and not node.soft or node.tag == "a":
            continue
        if marked is None and node.dropped:
            marked = node
            sums[id(node)] = 0
        counted = counted or node.tag == "p"
        inside = inside or node.tag in ("article", "main")
        for c in node.children:
            if not isinstance(c, str):
                todo.append((c, marked, counted, inside))
            elif counted and (size := len("".join(c.split()))):
                if marked is not None:
                    sums[id(marked)] += size
                else:
                    sums[0] = sums.get(0, 0) + size
                    shown += size * inside
    return sums, shown


def _outermost(root: Node) -> list[Node]:
    """The outermost elements below a root that class, id or form tag marks."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.dropped and node.soft:
            found.append(node)
        elif not node.dropped:
            todo.extend(c for c in reversed(node.children) if not isinstance(c, str))
    return found


def _holds(node: Node, tag: str) -> bool:
    todo = [node]
    while todo:
        x = todo.pop()
        if x.tag == tag and not x.dropped:
            return True
        if x is node or not x.dropped or x.soft:
            todo.extend(c for c in x.children if not isinstance(c, str))
    return False


def spare(root: Node) -> None:
    """Keep marked elements that hold the page's main element, or most of its text while no article shows any."""
    at = root
    while True:
        marked = _outermost(at)
        kept = next((x for x in marked if _holds(x, "main")), None)
        if kept is None and marked:
            texts, shown = _prose(at, False)
            paragraphs, seen = _prose(at, True)
            most = lambda x, sums: 2 * sums.get(id(x), 0) > sum(sums.values())
            if any(paragraphs.values()):
                found = [x for x in marked if not seen and most(x, paragraphs) and most(x, texts)]
            else:
                found = [x for x in marked if not shown and most(x, texts) and _holds(x, "article")]
            kept = found[0] if found else None
        if kept is None:
            return
        kept.dropped = False
        at = kept


def _close(stack: list[Node], tag: str) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag == tag:
            del stack[k:]
            return
        if stack[k].tag in ("article", "main", "body") and tag not in ("article", "main", "body", "html"):
            return  # a stray end tag does not close the page's frame


def _imply(stack: list[Node], tag: str) -> None:
    """Close what the start of ``tag`` closes: an open paragraph, list item, cell ..."""
    if tag in CLOSES_P:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == "p":
                del stack[k:]
                break
            if stack[k].tag in BLOCK or stack[k].tag in ("td", "th", "button"):
                break
    if tag in IMPLIED:
        own, scope = IMPLIED[tag]
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in scope:
                break
            if stack[k].tag in own.split():
                del stack[k:]
                break


_NONE: frozenset[int] = frozenset()


def own_text(node: Node) -> str:
    """All text below a node, white space as one space."""
    parts: list[str] = []
    todo: list[Node | str] = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            parts.append(x)
        else:
            todo.extend(reversed(x.children))
    return " ".join(unescape(" ".join(parts)).split())


def hash_tree(root: Node) -> None:
    """Hash every element from its tag and its children's hashes and texts; 0 without text.  Sums up its characters."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(c for c in node.children if not isinstance(c, str))
    for node in reversed(order):
        parts = []
        for c in node.children:
            if isinstance(c, str):
                if text := " ".join(c.split()):
                    parts.append(text)
                    node.chars += len(text)
            elif c.hash:
                parts.append(f"\x00{c.hash:x}")
                node.chars += c.chars
                node.linked += c.linked
        if node.tag == "a":
            node.linked = node.chars
        node.hash = xxhash.xxh64_intdigest("\x01".join([node.tag, *parts]).encode("utf-8", "replace")) if parts else 0


def walk(root: Node) -> Iterator[tuple[Node, bool]]:
    """(element, inside an article) in page order."""
    todo = [(root, False)]
    while todo:
        node, inside = todo.pop()
        yield node, inside
        inside = inside or node.tag in ("article", "main")
        todo.extend((c, inside) for c in reversed(node.children) if not isinstance(c, str))


def page_subtrees(html: str) -> tuple[set[int], str]:
    """Hashes of the elements that can be template, and what tells the page: heading, title and text; empty without any."""
    root = parse(html)
    hash_tree(root)
    found, names = set(), {}
    for node, _ in walk(root):
        if node.tag in ("h1", "title") and node.tag not in names:
            names[node.tag] = own_text(node)
        if node.hash and node.tag not in ("#root", "html", "body", "head", "title", "article", "main"):
            found.add(node.hash)
    text = "\n".join(blocks_of(article_roots(root), _NONE, _NONE))
    return found, "\x00".join([names.get("h1", ""), names.get("title", ""), text]).strip("\x00")


def is_wrapper(node: Node, whole: int) -> bool:
    """A box or an element of links inside an article of ``whole`` characters, and less than half of it."""
    return 2 * node.chars < whole and (node.tag in WRAPPERS or 2 * node.linked > node.chars)


def blocks_of(roots: list[Node], outer: frozenset[int], inner: frozenset[int]) -> list[str]:
    """Texts of the blocks below some elements, without what goes."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        if text := " ".join(unescape("".join(held)).split()):
            out.append(text)
        held.clear()

    todo: list[tuple] = [(r, False, 0) for r in reversed(roots)]  # whole: characters of the article around it
    while todo:
        x, inside, whole = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            held.append(x)
        elif x.tag in ("br", "td", "th", "wbr"):
            held.append("" if x.tag == "wbr" else " ")
            todo.extend((c, inside, whole) for c in reversed(x.children))
        elif not (x.dropped or x.hash in (inner if inside and not is_wrapper(x, whole) else outer) or (x.site and not inside)):
            block = x.tag in BLOCK
            if block:
                flush()
                todo.append((None, inside, whole))
            if x.tag in ("article", "main"):
                inside, whole = True, whole or x.chars
            todo.extend((c, inside, whole) for c in reversed(x.children))
    flush()
    return out


def outermost(root: Node, *tags: str) -> list[Node]:
    """The outermost elements of some tags that are not boilerplate and have text."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag in tags and not node.dropped:
            if own_text(node):
                found.append(node)
        elif not node.dropped:
            todo.extend(c for c in reversed(node.children) if not isinstance(c, str))
    return found


def paragraph_chars(root: Node, frames: list[Node], outer: frozenset[int]) -> tuple[int, int]:
    """Characters of paragraph text, links aside, that is kept inside some elements and outside them."""
    within = {id(f) for f in frames}
    sums = [0, 0]
    todo = [(root, False, False)]
    while todo:
        node, inside, counted = todo.pop()
        inside = inside or id(node) in within
        if node.dropped or node.tag == "a" or not inside and (node.site or node.hash and node.hash in outer):
            continue
        counted = counted or node.tag == "p"
        for c in node.children:
            if not isinstance(c, str):
                todo.append((c, inside, counted))
            elif counted:
                sums[not inside] += len("".join(c.split()))
    return sums[0], sums[1]


def article_roots(root: Node, outer: frozenset[int] = frozenset()) -> list[Node]:
    """The elements that hold the story: those of the page's ``main`` elements, its articles, both, and the whole page that
    come first and hold at least half as much paragraph text as is kept beside them.

    A ``main`` element is taken whole: headings and paragraphs beside its articles belong to the story.
    """
    for tags in (("main",), ("article",), ("main", "article")):
        frames = outermost(root, *tags)
        if frames:
            inside, beside = paragraph_chars(root, frames, outer)
            if 2 * inside >= beside:
                return frames
    return [root]


def main_text(html: str | None, outer: frozenset[int] = _NONE, inner: frozenset[int] = _NONE) -> str:
    """The article's blocks, joined by a blank line."""
    if not html:
        return ""
    root = parse(html)
    if outer or inner:
        hash_tree(root)
    return "\n\n".join(blocks_of(article_roots(root, outer), outer, inner))


def host_of(url: str) -> Column:
    """The host of an address column, lower-cased; empty where there is none."""
    host = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(host, F.lit("")))


def section_of(url: str) -> Column:
    """The first folder of an address column's path; null where there is none."""
    folder = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^/?#]+)/", 1)
    return F.when(folder != "", folder)


# --- Spark ------------------------------------------------------------------------------------


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def subtree_counts(pages: DataFrame) -> DataFrame:
    """host, section, hash, context for every page and element with text: once for the host (null), once for its section."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, sections, hashes, contexts = [], [], [], []
            for host, section, url, html in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if html:
                    found, name = page_subtrees(html)
                    name = _signed(xxhash.xxh64_intdigest((name or f"\x00{url}").encode("utf-8", "replace")))
                    for part in (None,) if section is None else (None, section):
                        hosts += [host] * (len(found) + 1)
                        sections += [part] * (len(found) + 1)
                        hashes += [0, *map(_signed, found)]  # 0 stands for the page itself
                        contexts += [name] * (len(found) + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(sections, pa.string()), pa.array(hashes, pa.int64()),
                 pa.array(contexts, pa.int64())],
                ["host", "section", "hash", "context"],
            )

    rows = pages.select(host_of("url").alias("host"), section_of("url").alias("section"), "url", "html")
    return rows.mapInArrow(run, "host string, section string, hash long, context long")


def host_templates(pages: DataFrame, *, outer_pages: int = OUTER_PAGES, outer_share: float = OUTER_SHARE,
                   inner_pages: int = INNER_PAGES, inner_share: float = INNER_SHARE) -> DataFrame:
    """host, section, outer, inner: the template hashes of each host (section null) and section (each bounded by one over
    the share, per page)."""
    seen = subtree_counts(pages).distinct().groupBy("host", "section", "hash").agg(F.count("*").alias("n"))
    seen = staged(seen.filter(f"hash = 0 or n >= {min(outer_pages, inner_pages)}"), "subtrees")
    parts = seen.filter("hash = 0").select(F.col("host").alias("h"), F.col("section").alias("s"), F.col("n").alias("pages"))
    same = (F.col("host") == F.col("h")) & F.col("section").eqNullSafe(F.col("s"))
    found = seen.filter("hash <> 0").join(parts, same)
    loose = (F.col("n") >= outer_pages) & (F.col("n") >= outer_share * F.col("pages"))
    strict = (F.col("n") >= inner_pages) & (F.col("n") >= inner_share * F.col("pages"))
    return found.filter(loose | strict).groupBy("host", "section").agg(
        F.collect_set(F.when(loose, F.col("hash"))).alias("outer"),
        F.collect_set(F.when(strict & F.col("section").isNull(), F.col("hash"))).alias("inner"),
    )


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            **thresholds) -> DataFrame:
    """page_id, url, text for every row; ``thresholds``: from how many pages, and which share of its host's or section's, a
    subtree is template (``outer_pages``, ``outer_share``; ``inner_pages``, ``inner_share`` for plain blocks in an article)."""
    pages = pick(pages, page_id=id_col, url=url_col, html=html_col)
    templates = staged(host_templates(pages, **thresholds), "templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple, tuple[frozenset, frozenset]] = {}
        for batch in batches:
            texts = []
            keys = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            for key, html, outer, inner, more in zip(keys, *(batch.column(i) for i in range(4, 8))):
                if key not in kept:
                    if len(kept) >= 1000:
                        kept.clear()
                    outer, inner, more = (frozenset(v & (2**64 - 1) for v in x.as_py() or ()) for x in (outer, inner, more))
                    kept[key] = outer | more, inner
                texts.append(main_text(html.as_py(), *kept[key]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    hosts = templates.filter("section is null").select("host", "outer", "inner")
    sections = templates.filter("section is not null").select("host", "section", F.col("outer").alias("more"))
    if table_bytes(templates) <= BROADCAST_BYTES:
        hosts, sections = F.broadcast(hosts), F.broadcast(sections)
    joined = pages.withColumn("host", host_of("url")).withColumn("section", section_of("url"))
    joined = joined.join(hosts, "host", "left").join(sections, ["host", "section"], "left").select(
        "page_id", "url", "host", "section", "html", "outer", "inner", "more"
    )
    schema = pages.select("page_id", "url", F.col("html").alias("text")).schema
    return joined.mapInArrow(run, schema)
