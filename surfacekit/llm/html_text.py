"""HTML extraction by tree scoring.

A page becomes a tree (with the usual implied ends of tags). Paragraphs pass points for their
length and commas to their parent and, halved, to its parent; a container's points are
discounted by its share of link text. The best container is kept whole, with the article or
main element around it, or else with the lowest element that holds all containers with little
link text; beside it, text with little link text is kept, in whatever elements it is. Menus, headers, footers, sidebars,
notices, adverts, forms, comments, scripts and styles are cut out by their tags, roles and
class or id words before scoring and inside the kept part. Words of the layout (has-sidebar,
no-comments) cut nothing; a box named like such a part stays where it is large and a wrapper:
by another word, by an article inside, or because hardly any text is left without it.

Null or empty html, and a page without text, give an empty text. White space inside a block
becomes one blank, blocks are joined by one LF in page order. Unclosed and crossed tags are
closed as browsers do in the common cases; an unfinished tag at the end is dropped. Repeated
rows are extracted each. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard by their use here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe noembed noframes xmp textarea title svg object annotation annotation-xml".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead "
                  "tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEAF_BLOCKS = frozenset("p pre td th li dd dt blockquote figcaption h1 h2 h3 h4 h5 h6".split())
PARTS = frozenset("tr tbody thead tfoot table ul ol dl".split())  # what holds a list or table is the container
DROPPED = frozenset("head nav aside footer form fieldset dialog menu button select input option label audio video canvas".split()) | RAW
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar "
                          "toolbar tooltip status".split())
ENDS_BEFORE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
               "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"),
               "tfoot": ("tbody", "tr", "td", "th")}
FENCES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",)}
HEAD_PARTS = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
MOST_LINKS = 0.25  # share of link text in text that is no menu
DEEPEST = 200  # elements nested deeper stand beside each other at this depth

# Words of class and id attributes that mark parts outside the article.
UNWANTED = frozenset(
    "ad ads adbox adsbygoogle adsense advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup login sidebar sidebars menu menus nav navbar "
    "navigation breadcrumb breadcrumbs pagination pager masthead header footer foot comment comments disqus respond reply replies "
    "share sharing social related recommended recommendations widget widgets toolbar skip copyright outbrain taboola".split())
HEADER_MARKS = frozenset("header masthead".split())  # inside an article these hold its own title
# Words that say nothing of a part's use: a class of these and unwanted words alone marks a paragraph as unwanted.
NEUTRAL = frozenset("bar block box button buttons icon icons inner item items label line link links list message row text title wrap wrapper".split())
WANTED = frozenset("article body content entry main post story text page".split())
SITE_ENTRIES = frozenset(("home", "start", "news", "about", "about us", "contact", "contact us", "imprint", "privacy", "privacy policy",
                          "sitemap", "site map", "login", "log in", "sign in", "sign up", "register", "search", "faq", "help"))  # a menu's labels
LAYOUT = frozenset("wrapper wrap container layout outer inner site row col column columns grid".split())  # wrappers, without points
_STATE = re.compile(r"(?:has|have|no|not|with|without|is|hide|show|open|closed)[-_]+\S*|\S*[-_](?:open|opened|closed|hidden|disabled|off)")

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_RAW_END = {tag: re.compile(f"</{tag}", re.I) for tag in RAW}
_CUT_END = re.compile(r"<[a-zA-Z/!][^>]*\Z")


class Node:
    __slots__ = ("tag", "attrs", "parent", "items", "score", "depth")

    def __init__(self, tag: str, attrs: str, parent: Node | None) -> None:
        self.tag, self.attrs, self.parent, self.score = tag, attrs, parent, 0.0
        self.depth = parent.depth + 1 if parent else 0
        self.items: list[Node | str] = []


def parse(html: str) -> Node:
    """The tree of a page. Raw elements are skipped up to their end tag, without children."""
    root = node = Node("html", "", None)
    at, deeper = 0, []
    while True:
        m = _TOKEN.search(html, at)
        text = html[at : m.start()] if m else html[at:]
        if text:
            if node.tag == "head" and text.strip():
                node = node.parent
            node.items.append(unescape(_CUT_END.sub("", text) if not m else text))
        if not m:
            return root
        at = m.end()
        tag = m[2]
        if not tag:
            continue
        if not m[4]:  # an unfinished tag
            return root
        tag = tag.lower()
        if node.tag == "head" and tag not in HEAD_PARTS and (not m[1] or tag in ("body", "html")):
            node = node.parent  # </head> may be left out
        if m[1]:
            if tag in deeper:
                del deeper[len(deeper) - 1 - deeper[::-1].index(tag) :]
            else:
                node = _closed(node, tag)
            continue
        if tag in ("html", "body") and node.parent is None:
            node.attrs += m[3]
            continue
        if tag in RAW:
            if not m[3].endswith("/") or tag not in ("svg", "annotation", "annotation-xml"):
                end = _RAW_END[tag].search(html, at)
                at = end.start() if end else len(html)
            continue
        if not deeper:
            node = _opened(node, tag)
        child = Node(tag, m[3], node)
        node.items.append(child)
        if tag not in VOID:
            if child.depth < DEEPEST:
                node = child
            else:
                deeper.append(tag)


def _opened(node: Node, tag: str) -> Node:
    """Where a new ``tag`` goes: after the elements that it ends by starting."""
    if tag in BLOCK:
        up = node
        while up and up.tag not in ("td", "th", "table", "button", "body", "html"):
            if up.tag == "p" or up.tag in HEADINGS and tag in HEADINGS:
                node = up.parent
                break
            up = up.parent
    for ended in ENDS_BEFORE.get(tag, ()):
        fences, up = FENCES.get(tag, ("table",)), node
        while up and up.tag not in fences:
            if up.tag == ended:
                node = up.parent
                break
            up = up.parent
    return node


def _closed(node: Node, tag: str) -> Node:
    up = node
    while up and up.parent:
        if up.tag == tag:
            return up.parent
        if up.tag in ("td", "th", "table") and tag not in BLOCK:
            break
        up = up.parent
    return node


def _attributes(node: Node) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(node.attrs)} if node.attrs.strip(" /") else {}


def _names(attrs: dict[str, str]) -> list[set[str]]:
    """The words of each class and id, but not of a class that tells the state of the layout."""
    both = re.sub(r"([a-z])([A-Z])", r"\1-\2", f"{attrs.get('class', '')} {attrs.get('id', '')}").lower()
    return [set(re.split(r"[^a-z]+", name)) for name in both.split() if not _STATE.fullmatch(name)]


def _marks(attrs: dict[str, str]) -> set[str]:
    return set().union(*_names(attrs))


def _unwanted(node: Node, attrs: dict[str, str], in_article: bool, in_text: bool) -> set[str]:
    """The words of class and id that mark a part outside the article. Inline elements of a text
    (marked-up code, words of a sentence) have none; a paragraph of an article has them where a
    whole name says so, not one word of a name of others; headings are no page headers."""
    if in_text and node.tag not in BLOCK:
        return set()
    if in_article and node.tag in LEAF_BLOCKS:
        marks = set().union(*(n & UNWANTED for n in _names(attrs) if n and n - {""} <= UNWANTED | NEUTRAL))
    else:
        marks = _marks(attrs) & UNWANTED
    return marks - HEADER_MARKS if in_article or node.tag in HEADINGS else marks


def _prune(node: Node, spare: int = 0, in_article: bool = False, in_wanted: bool = False, in_text: bool = False) -> int:
    """Takes out the parts that are no article text and gives each node its class points. The
    size of the largest box cut out by its words alone; ``spare`` such boxes, one inside the
    other, are kept if they are large."""
    keep: list[Node | str] = []
    cut, total = 0, None
    for x in node.items:
        if isinstance(x, str):
            keep.append(x)
            continue
        attrs = _attributes(x)
        marks, unwanted = _marks(attrs), _unwanted(x, attrs, in_article, in_text)
        style = attrs.get("style", "").replace(" ", "").lower()
        role = attrs.get("role", "").lower()
        whole = x.tag in ("article", "main", "body")
        inner, drop = spare, (
            x.tag in DROPPED or x.tag == "header" and not (in_article or _is_title(node, x)) or role in DROPPED_ROLES or "hidden" in attrs
            or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style)
        if not drop and unwanted and not whole:
            total = _size(node) if total is None else total
            if x.tag not in ("section", "div") or 2 * _size(x) <= total:  # a mere notice
                drop = True
            elif not marks & WANTED and not (not in_article and _is_wrapper(node, x, in_wanted)):
                if spare:
                    inner -= 1
                else:
                    drop, cut = True, max(cut, _size(x))
        if drop:
            keep.append(" " if x.tag not in BLOCK else "\n")
            continue
        x.score = 25.0 * (whole or role in ("main", "article")) + 10.0 * bool(marks & WANTED)
        cut = max(cut, _prune(x, inner, in_article or x.tag in ("article", "main"), in_wanted or bool(marks & WANTED),
                              in_text or x.tag in LEAF_BLOCKS or x.tag == "code"))
        keep.append(x)
    node.items = keep
    return cut


def _is_title(parent: Node, node: Node) -> bool:
    """A section's header that holds its heading, and no menu."""
    inside = [x for x in node.items if not isinstance(x, str)]
    return parent.tag == "section" and any(x.tag in HEADINGS or x.tag == "hgroup" for x in inside) and not _links(node)


def _size(node: Node) -> int:
    """Characters, without those of parts that go by their tags."""
    return sum(len(x.strip()) if isinstance(x, str) else 0 if x.tag in DROPPED or x.tag == "header" else _size(x) for x in node.items)


def _is_wrapper(parent: Node, node: Node, in_wanted: bool) -> bool:
    """A box that is called a wrapper or holds an article, while nothing beside it does."""
    called = any(n & LAYOUT and not n & UNWANTED for n in _names(_attributes(node)))
    return (called and not in_wanted or _holds_article(node, in_wanted)) and not any(
        _is_article(x, in_wanted) or _holds_article(x, in_wanted) for x in parent.items
        if x is not node and not isinstance(x, str) and x.tag not in DROPPED and not _marks(_attributes(x)) & UNWANTED)


def _is_article(node: Node, only_tags: bool = False) -> bool:
    """Whether an element is an article, or by its words a box for one."""
    marks = _marks(_attributes(node))
    return not marks & UNWANTED and (node.tag in ("article", "main") or not only_tags and node.tag in ("section", "div") and bool(marks & WANTED))


def _holds_article(node: Node, only_tags: bool = False) -> bool:
    return any(_is_article(x, only_tags) or not _marks(_attributes(x)) & UNWANTED and _holds_article(x, only_tags)
               for x in node.items if not isinstance(x, str) and x.tag not in DROPPED)


def _is_bare(root: Node, cut: int) -> bool:
    """Nothing but scraps is left beside a box of ``cut`` characters, and no article."""
    left = _size(root)
    return cut > 0 and (left == 0 or 10 * left < cut and not _holds_article(root))


def _article_tree(html: str) -> Node:
    """The page without the parts that are no article text. Where hardly anything is left, the
    largest boxes were the page's wrappers: more levels of them are kept each time."""
    spare, root = 0, parse(html)
    while _is_bare(root, _prune(root, spare)) and spare < DEEPEST:
        spare, root = max(1, 2 * spare), parse(html)
    return root


def _text_and_links(node: Node) -> tuple[str, int]:
    out, links = [], 0
    for x in node.items:
        if isinstance(x, str):
            out.append(x)
        else:
            text, inside = _text_and_links(x)
            out.append(text)
            links += len(text.strip()) if x.tag == "a" else inside
    return "".join(out), links


def _score(node: Node, found: list[Node]) -> None:
    """Adds the points of every paragraph below ``node`` to its ancestors; lists those."""
    inner = [x for x in node.items if not isinstance(x, str)]
    blocks = any(x.tag in BLOCK for x in inner)
    if node.tag in LEAF_BLOCKS and not blocks or node.tag in ("div", "section", "article", "main", "body") and not blocks:
        text = " ".join(_text_and_links(node)[0].split())
        if text and node.tag not in HEADINGS:
            points = 1 + text.count(",") + min(len(text) / 100, 3.0)
            holder = node.parent if node.tag in LEAF_BLOCKS else node
            for share in (1.0, 0.5):
                while holder and holder.tag in PARTS and holder.parent:
                    holder = holder.parent
                if holder:
                    holder.score += points * share
                    found.append(holder)
                    holder = holder.parent
        return
    for x in inner:
        _score(x, found)


def _links(node: Node) -> int:
    return sum((x.tag == "a") + _links(x) for x in node.items if not isinstance(x, str))


def _is_menu(node: Node) -> bool:
    """A list or box of three links or more and little else."""
    if node.tag not in ("ul", "ol", "dl", "div", "section", "table") or _links(node) < 3:
        return False
    text, links = _text_and_links(node)
    return links > 0.75 * len("".join(text.split()))


def _labels(node: Node) -> list[str]:
    """The texts of the links below a node."""
    return [" ".join(_text_and_links(x)[0].lower().split()) if x.tag == "a" else y
            for x in node.items if not isinstance(x, str) for y in ([""] if x.tag == "a" else _labels(x))]


def _is_site_menu(node: Node) -> bool:
    """A menu whose entries are for the most part those of any site."""
    labels = _labels(node)
    return 2 * sum(x in SITE_ENTRIES for x in labels) > len(labels)


def _blocks(items: list[Node | str], out: list[list[str]], in_article: bool = False) -> None:
    """The blocks of what is kept. A list of links that neither marks nor labels tell as a menu is text
    inside an article; elsewhere it is a menu."""
    for x in items:
        if isinstance(x, str):
            out[-1].append(x)
        elif _is_menu(x) and (not in_article or _is_site_menu(x)):
            out.append([])
        elif x.tag == "br":
            out[-1].append(" ")
        elif x.tag in BLOCK:
            out.append([])
            _blocks(x.items, out, in_article or x.tag in ("article", "main"))
            out.append([])
        else:
            _blocks(x.items, out, in_article)


def _around(best: Node, plain: list[Node]) -> Node:
    """The outermost article or main element with ``best``, or the lowest one with ``best`` and
    all of ``plain``, from which parts with much link text and none of those are taken."""
    line = [best]
    while line[-1].parent:
        line.append(line[-1].parent)
    whole = [x for x in line if x.tag in ("article", "main") or _attributes(x).get("role", "").lower() in ("main", "article")]
    if whole:
        return whole[-1]
    at, high, used = {id(x): k for k, x in enumerate(line)}, 0, set()
    for x in plain:
        while id(x) not in at:
            used.add(id(x))
            x = x.parent
        high = max(high, at[id(x)])
    if high:
        used.add(id(line[high - 1]))
        runs = _runs(line[high].items)
        line[high].items = [x for run in runs if id(run[0]) in used or _is_plain(run) for x in run]
    return line[high]


def _runs(items: list[Node | str]) -> list[list[Node | str]]:
    """Each block on its own, and the runs of text and inline elements between blocks."""
    out: list[list[Node | str]] = []
    open_run = False
    for x in items:
        inline = isinstance(x, str) or x.tag not in BLOCK
        if inline and open_run:
            out[-1].append(x)
        else:
            out.append([x])
        open_run = inline
    return out


def _is_plain(run: list[Node | str]) -> bool:
    """A heading, or text of which few characters are links'."""
    holder = Node("", "", None)
    holder.items = run
    text, links = _text_and_links(holder)
    heading = not isinstance(run[0], str) and run[0].tag in HEADINGS
    return heading or any(map(str.isalnum, text)) and links <= MOST_LINKS * len(text.strip())


def main_text(html: str | None) -> str:
    """The article text of a page."""
    root = _article_tree(html or "")
    found: list[Node] = []
    _score(root, found)
    top, kept = root, [[root]]
    if found:
        value, plain = {}, []
        for x in found:
            if id(x) not in value:
                text, links = _text_and_links(x)
                value[id(x)] = x.score * (1 - links / max(1, len(text.strip())))
                if links <= MOST_LINKS * len(text):
                    plain.append(x)
        top = _around(max(found, key=lambda x: value[id(x)]), plain)
        if top.parent:
            kept = [run for run in _runs(top.parent.items) if run[0] is top or _is_plain(run)]
    out: list[list[str]] = [[]]
    for run in kept:
        out.append([])
        for x in run:
            _blocks(x.items if x is top else [x], out, x is top and x.tag in ("article", "main"))
        out.append([])
    lines = (" ".join("".join(b).split()) for b in out)
    return "\n".join(x for x in lines if x)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [main_text(h) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
