"""Main text of web pages by tree scoring.

A page's tags make a tree of elements with blocks of text. Every paragraph passes points for its
length and commas to the elements around it, less with each step outwards; an element's points are
discounted by the share of its text that is links. The best element is the container, and siblings of
it that score well enough, or are paragraphs or headings beside it, are kept with it. Menus, headers,
footers, sidebars, notices, adverts, forms and reader comments are known by tag, role or name and give
neither points nor text. Pages are independent: one pass over a table, no shuffle.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tabulith.llm import chunks
from tabulith.llm.work import prepare

# Fixed values of HTML: elements by how they stand in the text.
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption search".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup.
RAW = set("script style textarea title iframe noembed noframes noscript xmp template svg math canvas object audio video".split())
#: Neither text nor points.
OUT = set("head nav footer aside form button select option label input dialog menu search".split()) | RAW
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: An opening tag ends these, up to the nearest of the elements after the bar.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}
# Words in the class and id of an element.
ALWAYS_OUT = set("ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promoted banner cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login menu menus nav navbar navigation breadcrumb breadcrumbs sidebar sidebars aside footer comment comments disqus reply replies respond related recommended recommendations share sharing social pagination pager toolbar masthead topbar copyright outbrain taboola trending".split())
OUT_UNLESS_TEXT = set("header widget widgets tags tools search meta byline popular skip legal disclaimer".split())
TEXT = set("article content main body post entry story text".split())
OUT_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())

TAG = re.compile(r"<(?:(?P<c>!--)|(?P<b>[!?]|/(?![A-Za-z]))|(?P<e>/?)(?P<n>[A-Za-z][^\s/>]*))")
#: What follows a tag's name; a quoted value may hold the sign that ends tags.
REST = re.compile(r"""(?:[^>=]|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+>""")
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
COMMAS = re.compile("[,،、，﹐]")
#: Elements nest no deeper, as in browsers: those further in stand beside one another.
DEEPEST = 512
#: Elements that are paragraphs themselves; the element around them has their points whole.
PARAGRAPHS = set("p pre li td th dd dt blockquote".split())
#: Elements that are menus when most of their text is links.
BOXES = set("ul ol div section table".split())


class Element:
    __slots__ = ("tag", "parent", "children", "out", "base", "passed", "size", "link_size", "holds_main", "kept")

    def __init__(self, tag: str, parent: Element | None, out: bool, base: float):
        self.tag, self.parent, self.out, self.base = tag, parent, out, base
        #: elements, and texts with whether they stand in a link
        self.children: list[Element | tuple[str, bool]] = []
        self.passed, self.size, self.link_size = 0.0, 0, 0
        self.holds_main = self.kept = False


def _tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, value, attributes): text, start and end. Every character is looked at a bounded number of times."""
    at = 0
    while found := TAG.search(page, at):
        if found.start() > at:
            yield "text", page[at : found.start()], ""
        if found["c"] or found["b"]:
            to = page.find("-->" if found["c"] else ">", found.end() - (2 if found["c"] else 0))
            at = len(page) if to < 0 else to + (3 if found["c"] else 1)
            continue
        rest = REST.match(page, found.end())
        if rest is None:  # the page ends within a tag
            return
        name, at = found["n"].lower(), rest.end()
        if found["e"]:
            yield "end", name, ""
            continue
        yield "start", name, rest[0][:-1]
        if name in RAW:
            close = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
            if close is None:  # as browsers do, but a page cut short keeps its text where the element isn't raw text
                return
            at = close.start()
    if at < len(page):
        yield "text", page[at:], ""


def _by_name(tag: str, rest: str, in_main: bool) -> tuple[bool, float]:
    """Whether an element is left out for its role or name, and the points that its name gives."""
    named: dict[str, str] = {}
    for a in ATTRIBUTE.finditer(rest):
        named.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
    if "hidden" in named or named.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", named.get("style", "")):
        return True, 0.0
    words = {w.lower() for w in NAME_WORDS.findall(named.get("class", "") + " " + named.get("id", ""))}
    bad = bool(words & ALWAYS_OUT) or named.get("role", "").lower() in OUT_ROLES or bool(words & OUT_UNLESS_TEXT) and not words & TEXT and not in_main
    return bad and tag not in ("html", "body", "article", "main"), 15.0 * bool(words & TEXT)


def tree(page: str) -> Element:
    """The page's elements under a root; inline elements are no nodes, a link marks its text."""
    root = now = Element("", None, False, 0.0)
    links, mains, depth = 0, 0, 0

    def leave(upto: Element) -> None:
        nonlocal now, mains, depth
        while now is not upto:
            mains -= now.tag in ("article", "main")
            depth -= 1
            now = now.parent

    def close(tags: set[str], stop: set[str]) -> None:
        e = now
        while e.parent is not None and e.tag not in stop:
            up = e.parent
            if e.tag in tags:
                leave(up)
            e = up

    for kind, value, rest in _tokens(page):
        if kind == "text":
            now.children.append((value, links > 0))
        elif kind == "start":
            if value == "a":
                links = 1  # links don't nest
            if value == "br":
                now.children.append((" ", False))
            if value not in BLOCKS and value not in OUT:
                continue
            if value in BLOCKS:
                links = 0 if value != "a" and now.tag == "p" else links
                if now.tag == "p":
                    leave(now.parent)
            if value in ENDS:
                close(*ENDS[value])
            if value in VOID:
                now.children.append(Element(value, now, True, 0.0))
                continue
            out, base = _by_name(value, rest, mains > 0)
            # a header within the article holds its title
            out = out or value in OUT or value == "header" and not mains
            if value in ("article", "main"):
                base += 25.0
                e = now
                while e is not None and not e.holds_main:
                    e.holds_main = True
                    e = e.parent
            if depth == DEEPEST:
                leave(now.parent)
            e = Element(value, now, out, base)
            now.children.append(e)
            now, depth = e, depth + 1
            mains += value in ("article", "main")
        elif value == "a":
            links = 0
        elif value in BLOCKS or value in OUT:
            e = now
            while e.parent is not None and e.tag != value:
                e = e.parent
            if e.parent is not None:
                leave(e.parent)
    return root


def blocks(root: Element, strict: bool) -> Iterator[tuple[Element, str | None, int]]:
    """(element, text, length of its links) for each block of text in page order; white space is one space. An element
    comes once without a text before all that is in it."""
    todo: list[tuple[Element, Iterator]] = []
    run: list[tuple[str, bool]] = []

    def cut(of: Element) -> Iterator[tuple[Element, str, int]]:
        text = " ".join(html.unescape("".join(t for t, _ in run)).split())
        if text:
            yield of, text, len(" ".join(html.unescape("".join(t for t, link in run if link)).split()))
        run.clear()

    child: Element | tuple | None = root
    while True:
        if child is None:
            yield from cut(todo[-1][0])
            todo.pop()
        elif isinstance(child, tuple):
            run.append(child)
        elif child.out and not (child.holds_main and child.tag not in RAW) and (strict or child.tag in OUT):
            if child.tag in BLOCKS:
                yield from cut(child.parent)
        else:
            if todo:
                yield from cut(child.parent)
            yield child, None, 0
            todo.append((child, iter(child.children)))
        if not todo:
            return
        child = next(todo[-1][1], None)


def _density(e: Element) -> float:
    return e.link_size / e.size if e.size else 0.0


def _kept(root: Element, strict: bool) -> list[str]:
    """Texts of the best container and its kept siblings; none if no block has text."""
    elements: list[Element] = []
    for e, text, links in blocks(root, strict):
        if text is None:
            elements.append(e)
            continue
        e.size += len(text)
        e.link_size += links
        if e.tag not in HEADINGS:
            points = 1.0 + len(COMMAS.findall(text)) + min(len(text) / 100.0, 3.0)
            # a box's own text counts for the box; that of a paragraph twice what it passes on, for the element around it
            e.passed += 2 * points if e.tag in PARAGRAPHS else points
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.size += e.size
            e.parent.link_size += e.link_size
            e.parent.passed += e.passed / 2
    scored = [e for e in elements if e.size]
    if not scored:
        return []
    points = {id(e): (e.passed + e.base) * (1.0 - _density(e)) for e in scored}
    whole = [e for e in scored if e.tag not in PARAGRAPHS and e.tag not in HEADINGS] or scored
    best = max(whole, key=lambda e: points[id(e)])
    best.kept, enough = True, max(10.0, 0.2 * points[id(best)])
    for s in best.parent.children if best.parent is not None else ():
        if isinstance(s, Element) and id(s) in points:
            paragraph = s.tag == "p" and _density(s) < (0.25 if s.size > 80 else 1e-9)
            s.kept |= points[id(s)] >= enough or paragraph or s.tag in HEADINGS
    for e in elements:
        # a list or box that is mostly links is a menu without a name
        e.kept |= e.parent is not None and e.parent.kept and not (e.tag in BOXES and _density(e) > 0.5)
    return [text for e, text, _ in blocks(root, strict) if text is not None and e.kept]


def main_text(page: str) -> str:
    """Blocks of the article, a line end between them; where names leave nothing, only tags count."""
    root = tree(page.replace("\0", ""))
    return "\n".join(_kept(root, True) or _kept(root, False))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks.pieces(batches, "html"):
        found = [main_text(h or "") for h in part.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of pages: page_id, url, text (empty if none), n_chars (its code points).

    Null html is empty; rows alike count each; null ids and urls stay; other columns are ignored. A tag that the
    page's end cuts is dropped, an element that it cuts is whole. An empty table gives no rows."""
    prepare(pages.sparkSession)
    frame = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    kind = frame.schema["page_id"].dataType.simpleString()
    return frame.mapInArrow(_texts, f"page_id {kind}, url string, text string, n_chars long")


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
