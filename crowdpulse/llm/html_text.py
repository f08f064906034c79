"""Main text of web pages; templates of a site are found by counting element subtrees per host.

Every element's subtree (tags and text) is hashed. A subtree that stands on a
set share of the different pages of one host is the site's template, not the
page's content, and is deleted before the text is taken.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import blake2b
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.frames import cut, picked, rows_of

LEAST_PAGES = 5
SHARE = 0.5
OWN_SHARE = 0.9
SALTS = 32
# Pages of one host that meet in a task: this many, or this part of all pages.
HOST_ROWS, HOST_PARTS = 64, 10_000

# Fixed values of HTML: elements without content, without shown text, and inline ones.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_HIDDEN = frozenset(
    "head title script style noscript template iframe object svg math canvas audio video map".split()
)
_CHROME = frozenset(
    "nav header footer aside form button select textarea input label fieldset dialog menu".split()
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
# Content of its own, which other pages may quote: inside an article a template only on nearly all pages.
_TEXT = frozenset(
    "p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tfoot tr td th caption "
    "figure figcaption address hr".split()
) | _INLINE
# Never a template by themselves inside an article.
_PARTS = frozenset("li dt dd thead tbody tfoot tr td th caption figcaption".split()) | _INLINE
# Inline elements below these are parts of sentences.
_SENTENCES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th caption figcaption address".split())
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
    "toolbar tablist".split()
)
# Class and id names, each a whole one, that stand for something other than the article.
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsors sponsored promo promos "
    "promotion banner cookie cookies cookie-banner cookie-bar cookie-consent cookie-notice consent gdpr notice "
    "popup modal overlay newsletter newsletter-signup subscribe signup comment comments comment-list "
    "commentlist comment-form comment-respond post-comments replies disqus disqus_thread respond nav navbar "
    "nav-menu main-nav site-nav navigation main-navigation site-navigation menu main-menu breadcrumb "
    "breadcrumbs sidebar side-bar sidebar-left sidebar-right left-sidebar right-sidebar widget widgets "
    "widget-area footer site-footer page-footer site-header masthead topbar top-bar share sharing "
    "share-buttons share-links social social-links social-share social-icons related related-posts "
    "related-articles related-links recommended pagination pager skip-link toolbar login".split()
)
# Of these, the ones whose articles are other people's or other pages'.
_OTHERS = frozenset(
    "comment comments comment-list commentlist comment-respond post-comments replies disqus disqus_thread "
    "respond related related-posts related-articles related-links recommended".split()
)
# Those around an article that is not the page's own if there is another.
_ASIDE = _OTHERS | frozenset(
    "sidebar side-bar sidebar-left sidebar-right left-sidebar right-sidebar widget widgets widget-area".split()
)
# Some pages stand in a form as a whole.
_WRAPPERS = frozenset("form fieldset".split())
_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li table blockquote pre article main".split())
_KEPT_NAMES = frozenset("article main body html".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An open tag of the key closes these, up to the nearest of the ones after.
_ITEM_SCOPE = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr"}),
    "th": ({"td", "th"}, {"tr"}),
    "option": ({"option"}, {"select"}),
}
_SPACE = re.compile(r"\s+")
_OPEN_END = re.compile(r"<(?:[a-zA-Z/][^<>]*|!(?:--(?:(?!-->).)*|[^<>]*))?$", re.DOTALL)


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "key", "size", "articles", "blocks", "wraps")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.key = 0
        self.size = 0  # signs of shown text
        self.articles = self.blocks = self.wraps = False  # whether it holds any; holds the page


class _Builder(HTMLParser):
    """A tree of the page; unclosed elements end where their parent does."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#page", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag not in _INLINE and tag not in _VOID:
            self._close_paragraph(tag)
        if tag in _ITEM_SCOPE:
            closes, scope = _ITEM_SCOPE[tag]
            node = self.at
            while node.parent is not None and node.tag not in scope:
                if node.tag in closes:
                    self.at = node.parent
                node = node.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def _close_paragraph(self, tag: str) -> None:
        node = self.at
        while node.parent is not None and (node.tag in _INLINE or node.tag == "p"):
            if node.tag == "p":
                self.at = node.parent
                return
            node = node.parent

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if self.at.tag == tag and tag not in _VOID and tag in ("svg", "path"):
            self.at = self.at.parent

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            # An inline end tag does not close blocks around it.
            if tag in _INLINE and node.tag not in _INLINE:
                return
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(page: str | None) -> Node:
    """The tree of a page. A tag or comment cut off by the page's end is dropped."""
    page = page or ""
    tail = page[-4096:]
    cut_off = _OPEN_END.search(tail)
    if cut_off:
        page = page[: len(page) - len(tail) + cut_off.start()]
    builder = _Builder()
    builder.feed(page)
    builder.close()
    _hash(builder.root)
    return builder.root


def _hash(root: Node) -> None:
    """The key of each subtree from tags and text, and what it holds, children first, without recursion."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(child for child in node.children if isinstance(child, Node))
    for node in reversed(order):
        parts = [node.tag]
        for child in node.children:
            if isinstance(child, Node):
                parts.append(f"<{child.key}>")
                _tell(child, node)
            elif not child.isspace():
                parts.append(_SPACE.sub(" ", child).strip())
                node.size += len(parts[-1])
        digest = blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=8).digest()
        node.key = int.from_bytes(digest, "little", signed=True)
    for node in order:
        node.wraps = node.blocks or node.size > 0 and 2 * node.size >= root.size


def _tell(child: Node, node: Node) -> None:
    """Adds up what an element holds from its child."""
    if child.tag in _HIDDEN:
        return
    node.size += child.size
    own = child.tag in ("article", "main") or child.attrs.get("role") == "main"
    node.articles = node.articles or own or child.articles
    if child.size and (child.tag not in _CHROME or child.tag in _WRAPPERS):
        node.blocks = node.blocks or child.tag in _BLOCKS or child.blocks


def _names(node: Node) -> set[str]:
    if not node.attrs:
        return set()
    return set(f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}".lower().split())


def _named(node: Node) -> bool:
    return not _names(node).isdisjoint(_NAMES)


def _is_put_away(node: Node) -> bool:
    """Furniture by its role, or hidden by an attribute."""
    attrs = node.attrs
    if node.tag in _KEPT_NAMES:
        return False
    role = attrs.get("role", "").strip().lower()
    if role in _ROLES and not (role == "form" and node.wraps) or "hidden" in attrs:
        return True
    return attrs.get("aria-hidden", "").lower() == "true"


def _is_chrome(node: Node, around: frozenset[str] = _NAMES) -> bool:
    """Page furniture; what holds an article goes only for names in `around`."""
    if node.tag in _WRAPPERS:
        if not node.wraps:
            return True
    elif node.tag in _HIDDEN or node.tag in _CHROME:
        return True
    if node.tag in _KEPT_NAMES:
        return False
    if _is_put_away(node):
        return True
    if node.tag in _INLINE or node.tag in _WRAPPERS:
        return False
    return not _names(node).isdisjoint(around if node.articles else _NAMES)


def _is_aside(node: Node) -> bool:
    """What holds only articles that are not the page's own."""
    if node.tag in _HIDDEN or node.tag in _CHROME and node.tag not in _WRAPPERS or _is_put_away(node):
        return True
    return node.tag not in _KEPT_NAMES and not _names(node).isdisjoint(_ASIDE)


def _is_main(node: Node) -> bool:
    return node.tag == "main" or node.attrs.get("role") == "main"


def _outermost(root: Node, passed: Callable[[Node], bool]) -> list[Node]:
    """The outermost article and main elements that hold text, none below elements that are passed over."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.tag == "article" or _is_main(node):
            if node.size:
                found.append(node)
            continue
        if node.articles and (node is root or not passed(node)):
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return found


def _shows(root: Node) -> bool:
    """Whether any text stands outside page furniture."""
    stack = [root]
    while stack:
        for child in stack.pop().children:
            if isinstance(child, str):
                if child and not child.isspace():
                    return True
            elif child.size and not _is_chrome(child, _OTHERS):
                stack.append(child)
    return False


def _main(root: Node) -> list[Node]:
    """The main elements or the articles outside them, whichever hold more text; else the page.

    A main element is taken whole, with its articles and what stands between
    them. If the page shows nothing, articles count wherever they stand. Names of the elements around an
    article say nothing about it, but for comments, sidebars and links to other pages.
    """
    found = _outermost(root, _is_aside)
    if not found and not _shows(root):
        found = _outermost(root, lambda node: node.tag in _HIDDEN)
    mains = [node for node in found if _is_main(node)]
    articles = [node for node in found if not _is_main(node)]
    held = [sum(node.size for node in nodes) for nodes in (mains, articles)]
    return (mains if held[0] > held[1] else articles) or [root]


def _around(top: Node) -> frozenset[str]:
    """The names by which what holds an article is furniture, in a page, a main element or an article."""
    return _NAMES if top.tag == "article" else _ASIDE if _is_main(top) else _OTHERS


def _headings(header: Node) -> list[Node]:
    """The outermost headings of an article's own header; the rest of it are bylines, dates and menus."""
    found, stack = [], [header]
    while stack:
        node = stack.pop()
        if node.tag in _HEADINGS:
            found.append(node)
        elif node is header or not _is_chrome(node):
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return found


def _candidates(root: Node) -> Iterator[tuple[Node, int]]:
    """Elements that may be templates, each with its key, which is odd for text blocks inside the article.

    So these count apart, and a paragraph that stands in the frame of some
    pages and in the article of others is judged for each by itself. Elements
    without text (a line break, an empty paragraph) are none, nor are parts of
    sentences and, in the article, of lists and tables: deleting those would
    change text around them.
    """
    inside = {id(node) for node in _main(root) if node is not root}
    stack = [(root, False, False)]
    while stack:
        node, own, sentence = stack.pop()
        own = own or id(node) in inside
        if node.tag in _HIDDEN or not node.size:
            continue
        if node.tag not in ("#page", "html", "body") and id(node) not in inside:
            if own and node.tag in _TEXT:
                if node.tag not in _PARTS:
                    yield node, node.key | 1
            elif not (sentence and node.tag in _INLINE):
                yield node, node.key & ~1
        sentence = sentence and node.tag in _INLINE or node.tag in _SENTENCES
        stack.extend((c, own, sentence) for c in node.children if isinstance(c, Node))


def template_keys(page: str | None) -> set[int]:
    return {key for _, key in _candidates(parse(page))}


def main_text(page: str | None, templates: frozenset[int] = frozenset()) -> str:
    """Text blocks of the article, joined by line feeds, without templates and page furniture."""
    root = parse(page)
    removed = {id(n) for n, key in _candidates(root) if key in templates} if templates else set()
    blocks: list[str] = []
    open_: list[str] = []

    def end_block() -> None:
        block = _SPACE.sub(" ", "".join(open_)).strip()
        if block:
            blocks.append(block)
        open_.clear()

    for top in _main(root):
        around = _around(top)
        stack: list[Node | str | None] = [top]
        while stack:
            item = stack.pop()
            if item is None:
                end_block()
            elif isinstance(item, str):
                open_.append(item)
            elif item.tag == "header" and top is not root and id(item) not in removed:
                end_block()
                stack.extend(reversed([] if _is_put_away(item) or _named(item) else _headings(item)))
            elif id(item) in removed or item is not top and _is_chrome(item, around):
                if item.tag not in _INLINE:
                    end_block()
            elif item.tag == "br":
                open_.append(" ")
            else:
                if item.tag not in _INLINE:
                    end_block()
                    stack.append(None)
                stack.extend(reversed(item.children))
        end_block()
    return "\n".join(blocks)


def _sign(root: Node) -> int:
    """Names what the page has to say, so that copies with another date or menu around it are one page."""
    keys = ",".join(str(node.key) for node in _main(root))
    return int.from_bytes(blake2b(keys.encode(), digest_size=8).digest(), "little", signed=True)


def _page_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import numpy as np

    for batch in batches:
        signs, keys = [], []
        for page in batch.column("html"):
            root = parse(page.as_py())
            keys.append(np.array(sorted({key for _, key in _candidates(root)}), dtype=np.int64))
            signs.append(_sign(root))
        columns = [batch.column("site"), pa.array(signs, pa.int64()), rows_of(keys, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["site", "sign", "keys"])


def _packed(salts: dict[int, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pages compressed one by one for the shuffle to come, those of large hosts salted; null stays null."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            pages = [p.as_buffer() if p.is_valid else None for p in batch.column("html")]
            small = [None if page is None else press.compress(page) for page in pages]
            named = zip(batch.column("row").to_pylist(), batch.column("site").to_pylist())
            # Pages without a host have no templates and are dealt like any rows.
            salt = [row if site is None else row % salts.get(site, 1) for row, site in named]
            columns = [batch.column(name) for name in ("page_id", "url", "site")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(salt, pa.int64()), pa.array(small, pa.binary())],
                names=["page_id", "url", "site", "salt", "page"],
            )

    return pack


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    opened = zstandard.ZstdDecompressor()
    for batch in batches:
        texts = []
        for page, keys in zip(*[batch.column(n).to_pylist() for n in ("page", "keys")]):
            html = None if page is None else opened.decompress(page).decode("utf-8")
            texts.append(main_text(html, frozenset(keys or ())))
        sizes = pa.array([len(text) for text in texts], pa.int64())
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(
            [*columns, sizes], names=["page_id", "url", "text", "n_chars"]
        )


def host_of(url: F.Column) -> F.Column:
    """Lower-cased host of a URL; empty if there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?//([^/?#:]*)", 1)
    return F.lower(host)


def extract(
    pages: DataFrame,
    least_pages: int = LEAST_PAGES,
    share: float = SHARE,
    own_share: float = OWN_SHARE,
) -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of `pages`.

    A subtree is a template if it stands on at least `least_pages` pages of
    its host and on at least `share` of them; pages with the same article (or
    without one the same whole) count once. Inside an article, paragraphs,
    headings, lists and tables are templates only if they stand in the
    articles of `own_share` of them. A null page counts as empty, an empty one has empty text. Pages
    without a host share the empty one, where nothing is a template. Repeated
    rows and null page ids are read like others. Only page_id, url and html
    take part.
    """
    rows = picked(pages, page_id="long", url="string", html="string")
    rows = rows.withColumn("row", F.xxhash64("page_id", "url", "html"))
    host = host_of(F.col("url"))
    rows = rows.withColumn("site", F.when(host != "", F.xxhash64(host)))
    found = rows.where("site IS NOT NULL").select("site", "html")
    found = cut(found.mapInArrow(_page_keys, "site long, sign long, keys array<long>"))
    sites = found.groupBy("site").agg(
        F.count_distinct("sign").alias("different"), F.count("*").alias("copies")
    )
    sites = cut(sites)
    total = sites.agg(F.sum("copies")).first()[0] or 0
    # Large hosts are salted, each by its size; at most HOST_PARTS of them are.
    room = max(HOST_ROWS, -(-total // HOST_PARTS))
    sites = sites.withColumn("salts", F.ceil(F.col("copies") / room))
    large = {r.site: r.salts for r in sites.where("salts > 1").select("site", "salts").collect()}
    # Every subtree counts, wherever it stands.
    keys = found.select("site", "sign", F.explode("keys").alias("key")).distinct()
    often = keys.groupBy("site", "key").agg(F.count("*").alias("pages"))
    often = often.where(F.col("pages") >= least_pages)
    often = often.withColumn("part", F.pmod("key", F.lit(SALTS)).cast("int"))
    parts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("part")
    known = sites.where(F.col("different") >= least_pages).select("*", parts)
    often = often.join(known, ["site", "part"])
    odd = F.col("key").bitwiseAND(F.lit(1)) == 1
    often = often.where(F.col("pages") >= F.when(odd, own_share).otherwise(share) * F.col("different"))
    # As each stands on that share, a host has no more of them than a few pages have elements.
    templates = often.groupBy("site", "salts").agg(F.collect_list("key").alias("keys"))
    salt = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt")
    templates = cut(templates.select("site", salt, "keys"))
    packed = rows.select("page_id", "url", "row", "site", "html").mapInArrow(
        _packed(large), "page_id long, url string, site long, salt long, page binary"
    )
    marked = packed.join(templates.hint("shuffle_hash"), ["site", "salt"], "left")
    return marked.select("page_id", "url", "page", "keys").mapInArrow(
        _texts, "page_id long, url string, text string, n_chars long"
    )
