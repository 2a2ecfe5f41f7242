"""Main text of pages by consensus paths of their host.

Each page's containers are scored by the running text right below them; the best one votes for its
path of tags and classes, numbers left out.  Votes are summed per host in Spark, and every page of the
host is read again along the winning path.  A page without that path keeps its own best container.
The article or main element around it is taken whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import arrow_batches, same
from tillroll.session import materialize

#: Elements whose text is never part of the article.
SKIPPED = frozenset(
    "head title script style noscript template iframe object svg math canvas nav menu footer aside form button "
    "select option textarea input label fieldset dialog".split()
)
#: Their content is raw text, up to their own end tag.
_RAW = "script|style|noscript|template|iframe|textarea|title|svg|math"
#: Words in a class, id or role that mark menus, headers, footers, sidebars, notices, adverts and comments.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar "
    "navigation breadcrumb breadcrumbs header masthead footer sidebar sidebars aside rail widget widgets notice "
    "notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup login "
    "comment comments disqus reply replies respond share sharing social related recommended pagination pager "
    "complementary contentinfo search".split()
)
#: Longer words that begin so are marks too, as in ``cookiebar`` or ``sidebarleft``.
_MARK_STARTS = ("cookie", "advert", "sidebar", "newsletter", "breadcrumb", "sponsor", "navbar", "commentlist", "commentform")
#: Words that say where or how something stands; a mark beside any other word names something else, such as
#: ``market-share`` or ``related-work``.
_NEUTRAL = frozenset(
    "a b c d js l m td tl u wp x amp app area article author bar block blog body bottom box btn button buttons card "
    "center col column container content cta desc divider entry facebook fb fixed form global google group heading "
    "holder icon icons image images inline inner item items js label large layout left link links list main media "
    "message meta middle mini mobile more my news outer page pane panel policy post posts primary reader reading right "
    "row secondary section single site slot small stories story sub submit text title toggle top twitter unit user "
    "view web wide wrap wrapper zone".split()
)
#: With these a header is the article's own.
_OWN_HEADER = frozenset("article content entry post section story title".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_HEADER_MARKS = frozenset("header masthead banner".split())
_QUOTED = re.compile(r"""=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']++)""")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s/]|$)", re.I)
_UNSEEN = re.compile(r"""(?<![\w-])style\s*+=\s*+(?:"[^"]*?|'[^']*?|[^\s>"']*?)display\s*+:\s*+none""", re.I)
#: A class that begins so tells of something elsewhere on the page.
_ABOUT = frozenset("has with no without hide show is".split())
_ARTICLE = ("article", "main")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that do not break a line of text.
_INLINE = frozenset(
    "a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img".split()
)
#: Elements that hold running text of the container around them.
_LEAF = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 li dd dt td th figcaption caption".split())
#: Those of them that are no parts of lists and tables.
_RUNNING = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6".split())
#: A start tag ends an open element of these kinds.
_ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
#: Elements that an implied end tag does not reach beyond.
_SCOPE = frozenset("table ul ol dl div article section main body select".split())
_CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
    "pre section table ul".split()
)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:svg|math)(?=[\s/])[^>]*/>|<(?P<raw>{_RAW})(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<more>(?:=\s*+(?:"[^"]*+"|'[^']*+')?+|[^<>=]++)*+)>|<[!?/][^>]*+>""",
    re.S | re.I,
)
_HINT = re.compile(r"""(?<![\w-])(class|id|role)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"']++)""", re.I)
_DIGITS = re.compile(r"[0-9]+")
_CUT_OFF = re.compile(r"<[a-zA-Z/!]")
_PARTS = re.compile(r"[^a-z]+")


@dataclass
class Page:
    """Elements in page order, and the text between their tags."""

    names: list[str] = field(default_factory=lambda: ["body"])
    paths: list[str] = field(default_factory=lambda: ["body"])
    parents: list[int] = field(default_factory=lambda: [-1])
    skipped: list[bool] = field(default_factory=lambda: [False])
    #: Whether the element is an article or lies in one.
    inside: list[bool] = field(default_factory=lambda: [False])
    #: Whether a mark took anything out.
    marked: bool = False
    #: ``(element, text)``; no text means a break.
    chunks: list[tuple[int, str | None]] = field(default_factory=list)


def _is_mark(word: str, tag: str = "div") -> bool:
    """Whether a class or id names what is left out.

    A mark counts only with words that say nothing else: ``has-sidebar``, ``no-ads``, ``search-engines`` or
    ``entry-header`` are none, and neither is ``header-title`` on a heading.
    """
    parts = [p for p in _PARTS.split(word) if p]
    marks = {p for p in parts if p in MARKS or p.startswith(_MARK_STARTS)}
    if not marks or parts[0] in _ABOUT or not marks.union(_NEUTRAL).issuperset(parts):
        return False
    return not (marks <= _HEADER_MARKS and (tag in _HEADINGS or _OWN_HEADER.intersection(parts)))


def _is_hidden(more: str) -> bool:
    """Whether a start tag says that its element isn't shown."""
    low = more.lower()
    if "hidden" in low and _HIDDEN.search(_QUOTED.sub("", more)):
        return True
    return "none" in low and bool(_UNSEEN.search(more))


def _hints(more: str, tag: str = "div") -> tuple[str, bool]:
    """Generalised classes of a start tag, and whether it is hidden or a mark is among class, id and role."""
    classes, marked = "", _is_hidden(more)
    for name, value in _HINT.findall(more):
        value = value.strip("\"'").lower()
        marked = marked or any(_is_mark(word, tag) for word in value.split())
        if name.lower() == "class":
            classes = ".".join(sorted({_DIGITS.sub("", c) for c in value.split()} - {""}))
    return classes, marked


def parse(source: str | None) -> Page:
    """Read a page leniently: ends may be missing, and tags cut off at the end of the page are dropped.

    If marks would leave no text at all, such as one on the frame of the whole page, they are ignored.
    """
    page = _read(source, True)
    if page.marked and not any(t and not t.isspace() and not page.skipped[e] for e, t in page.chunks):
        return _read(source, False)
    return page


def _read(source: str | None, use_marks: bool) -> Page:
    page, stack, at = Page(), [0], 0
    source = source or ""
    for m in _TOKEN.finditer(source):
        if m.start() > at:
            page.chunks.append((stack[-1], source[at : m.start()]))
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag or tag in ("html", "body"):
            if not m["raw"] and tag:
                page.chunks.append((stack[-1], None))
            continue
        if tag not in _INLINE:
            page.chunks.append((stack[-1], None))
        if m["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if page.names[stack[k]] == tag:
                    del stack[k:]
                    break
            continue
        ends = _ENDS.get(tag, set()) | ({"p"} if tag in _CLOSES_P else set())
        if ends:
            for k in range(len(stack) - 1, 0, -1):
                name = page.names[stack[k]]
                if name in ends:
                    del stack[k:]
                    break
                if name in _SCOPE:
                    break
        if tag in _VOID:
            continue
        parent = stack[-1]
        classes, marked = _hints(m["more"], tag) if m["more"] else ("", False)
        marked = marked and use_marks
        inside = page.inside[parent]
        own_skip = tag in SKIPPED or (marked and (inside or tag not in _ARTICLE)) or (tag == "header" and not inside)
        page.marked = page.marked or (own_skip and tag not in SKIPPED)
        page.inside.append(inside or tag in _ARTICLE)
        page.names.append(tag)
        page.parents.append(parent)
        page.skipped.append(page.skipped[parent] or own_skip)
        path = page.paths[parent]
        page.paths.append(path if tag in _INLINE else f"{path}>{tag}" + f".{classes}" * bool(classes))
        if not m["more"].endswith("/"):
            stack.append(len(page.names) - 1)
    rest = source[at:]
    open_tag = _CUT_OFF.search(rest, rest.rfind(">") + 1)
    if open_tag:
        rest = rest[: open_tag.start()]
    if rest:
        page.chunks.append((stack[-1], rest))
    return page


def _block(page: Page, element: int) -> tuple[int, bool]:
    """The nearest element that breaks lines, and whether a link lies between."""
    linked = False
    while element and page.names[element] in _INLINE:
        linked = linked or page.names[element] == "a"
        element = page.parents[element]
    return element, linked


def best_container(page: Page) -> int | None:
    """The element with the most running text right below it; what its children hold counts half."""
    scores: dict[int, float] = {}
    for element, text in page.chunks:
        if text is None or page.skipped[element] or text.isspace():
            continue
        block, linked = _block(page, element)
        n = len(text) * (0.1 if linked else 1.0)
        if page.names[block] in _LEAF:
            block = max(page.parents[block], 0)
        scores[block] = scores.get(block, 0.0) + n
        above = page.parents[block]
        if above >= 0:
            scores[above] = scores.get(above, 0.0) + n / 2
    return max(scores, key=lambda e: (scores[e], -e)) if scores else None


def text_of(page: Page, roots: set[int]) -> str:
    """Text below the given elements, blocks joined by one blank."""
    held = [False] * len(page.names)
    for e, parent in enumerate(page.parents):
        held[e] = (e in roots or (parent >= 0 and held[parent])) and not page.skipped[e]
    parts = []
    for element, text in page.chunks:
        if text is None:
            parts.append(" ")
        elif held[element]:
            parts.append(html.unescape(text) if "&" in text else text)
    return " ".join("".join(parts).split())


def _whole(page: Page, roots: set[int]) -> set[int]:
    """The roots with the rest of their article.

    That is the outermost ``article`` around a root, else the nearest ``main``.  A root in neither is
    joined by the headings and paragraphs right below the elements around it, the body aside.
    """
    out, around = set(), set()
    for root in roots:
        above = [root]
        while page.parents[above[-1]] > 0:
            above.append(page.parents[above[-1]])
        articles = [e for e in above if page.names[e] == "article"]
        mains = [e for e in above if page.names[e] == "main"]
        out.add(articles[-1] if articles else mains[0] if mains else root)
        if not articles and not mains:
            around.update(e for e in above[1:])
    return out | {e for e, p in enumerate(page.parents) if p in around and page.names[e] in _RUNNING}


def extract(source: str | None, path: str | None) -> str:
    """Main text along ``path``; along the page's own best container if the page hasn't got it.

    What stands beside it in the same article comes with it.
    """
    page = parse(source)
    roots = {e for e, p in enumerate(page.paths) if p == path and not page.skipped[e] and page.names[e] not in _INLINE}
    if not roots:
        own = best_container(page)
        roots = set() if own is None else {own}
    return text_of(page, _whole(page, roots))


def host_paths(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """``(host, path, votes)``: the path that most pages of the host vote for, ties by the path.

    A null or odd address belongs to the host with the empty name.
    """
    arrow_batches(pages.sparkSession)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = []
            for text in b.column(1).to_pylist():
                page = parse(text)
                best = best_container(page)
                paths.append(None if best is None else page.paths[best])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(paths, pa.string())], names=["host", "path"])

    votes = (
        pages.select(host_of(url).alias("host"), F.col(source).cast("string").alias("html"))
        .mapInArrow(vote, "host string, path string")
        .filter("path is not null")
        .groupBy("host", "path")
        .agg(F.count(F.lit(1)).alias("votes"))
    )
    most = F.min(F.struct((-F.col("votes")).alias("fewer"), "path")).alias("best")
    return votes.groupBy("host").agg(most).select("host", "best.path", (-F.col("best.fewer")).alias("votes"))


def host_of(url: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def main_texts(pages: DataFrame, id_column: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row per page row: ``(id, url, host, path, text)``; no text or null html gives an empty text."""
    paths = materialize(host_paths(pages, url, source))
    own = pages.select(
        F.col(id_column).alias("id"), F.col(url).alias("url"), host_of(url).alias("host"), F.col(source).cast("string").alias("html")
    )
    # One short row per host: broadcast while small, else a join whose hot hosts Spark splits.
    with_path = own.join(paths.select(F.col("host").alias("of"), "path"), same(F.col("host"), F.col("of")), "left")
    with_path = with_path.select("id", "url", "host", "path", "html")
    kinds = ", ".join(f"{c} {with_path.schema[c].dataType.simpleString()}" for c in ("id", "url", "host", "path"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(t, p) for t, p in zip(b.column(4).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(texts, pa.string())], names=["id", "url", "host", "path", "text"])

    return with_path.mapInArrow(read, kinds + ", text string").withColumnsRenamed({"id": id_column, "url": url})
