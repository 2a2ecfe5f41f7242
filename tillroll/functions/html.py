"""Elements of saved pages as columns.

One Arrow UDF walks a page and keeps only the elements that named selectors match, with their
texts; all record logic is column expressions over these short arrays, so a record is extracted
where its page lies, without a shuffle.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A matched element.  ``up`` holds the positions of its ancestors, ``top`` tells that no ancestor
#: matched the same selector, ``texts`` are the texts below it in document order.
ELEMENTS = T.ArrayType(
    T.StructType(
        [
            T.StructField("pos", T.IntegerType()),
            T.StructField("up", T.ArrayType(T.IntegerType())),
            T.StructField("top", T.BooleanType()),
            T.StructField("classes", T.ArrayType(T.StringType())),
            T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
            T.StructField("texts", T.ArrayType(T.StringType())),
        ]
    )
)
_ARROW = pa.list_(
    pa.struct(
        [
            ("pos", pa.int32()),
            ("up", pa.list_(pa.int32())),
            ("top", pa.bool_()),
            ("classes", pa.list_(pa.string())),
            ("attrs", pa.map_(pa.string(), pa.string())),
            ("texts", pa.list_(pa.string())),
        ]
    )
)
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr"}
SELF_CLOSING = {"p", "li", "tr", "td", "th", "dt", "dd", "option"}
CONTAINERS = {"ul", "ol", "table", "dl", "select", "div", "nav", "article", "body"}


def _step(simple: str) -> tuple[str, str, str]:
    """Tag, class and id of ``tag``, ``.class``, ``tag.class`` or ``#id``; empty means any."""
    if simple.startswith("#"):
        return "", "", simple[1:]
    tag, _, name = simple.partition(".")
    return tag, name, ""


class _Walk(HTMLParser):
    """Collect the elements matched by the selectors of one page."""

    def __init__(self, selectors: dict[str, list[tuple[str, str, str]]]) -> None:
        super().__init__(convert_charrefs=True)
        self.selectors = selectors
        self.by_last: dict[str, list] = {}
        for name, steps in selectors.items():
            tag, cls, id_ = steps[-1]
            key = f"#{id_}" if id_ else f".{cls}" if cls else tag
            self.by_last.setdefault(key, []).append((name, steps))
        self.found: dict[str, list[dict]] = {name: [] for name in selectors}
        self.open: list[tuple[str, int, set[str], str, list]] = []
        self.count = 0

    @staticmethod
    def _fits(step, tag, classes, id_) -> bool:
        return (not step[0] or step[0] == tag) and (not step[1] or step[1] in classes) and (
            not step[2] or step[2] == id_
        )

    def _matches(self, steps, tag, classes, id_) -> bool:
        if not self._fits(steps[-1], tag, classes, id_):
            return False
        wanted = 0
        for node in self.open:
            if wanted < len(steps) - 1 and self._fits(steps[wanted], node[0], node[2], node[3]):
                wanted += 1
        return wanted == len(steps) - 1

    def _start(self, tag, attrs, stays: bool) -> None:
        values = {k: v or "" for k, v in attrs}
        classes, id_ = set(values.get("class", "").split()), values.get("id", "")
        pos, mine = self.count, []
        self.count += 1
        near = [c for k in (tag, f"#{id_}", *(f".{c}" for c in classes)) for c in self.by_last.get(k, ())]
        for name, steps in near:
            if self._matches(steps, tag, classes, id_):
                nested = any(n == name for node in self.open for n, _ in node[4])
                element = {
                    "pos": pos,
                    "up": [node[1] for node in self.open],
                    "top": not nested,
                    "classes": sorted(classes),
                    "attrs": list(values.items()),
                    "texts": [],
                }
                self.found[name].append(element)
                mine.append((name, element))
        if stays:
            self.open.append((tag, pos, classes, id_, mine))

    def handle_starttag(self, tag, attrs):
        if tag in SELF_CLOSING:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] in CONTAINERS:
                    break
                if self.open[i][0] == tag:
                    del self.open[i:]
                    break
        self._start(tag, attrs, tag not in VOID)

    def handle_startendtag(self, tag, attrs):
        self._start(tag, attrs, False)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        for node in self.open:
            for _, element in node[4]:
                element["texts"].append(data)


def find(page: Column, selectors: dict[str, tuple[str, ...]]) -> Column:
    """Struct with one array of matched elements per named selector.

    A selector is a path of steps; each step matches an element below the one before.
    """
    steps = {name: [_step(s) for s in path] for name, path in selectors.items()}
    schema = T.StructType([T.StructField(name, ELEMENTS) for name in selectors])

    @F.arrow_udf(schema)
    def walk(pages: pa.Array) -> pa.Array:
        rows = []
        for text in pages.to_pylist():
            walker = _Walk(steps)
            if text is not None:
                walker.feed(text)
                walker.close()
            rows.append(walker.found)
        return pa.array(rows, pa.struct([(name, _ARROW) for name in steps]))

    return walk(page)


def all_texts(elements: Column) -> Column:
    """Texts below any of the elements, each once, in document order."""
    outer = F.filter(elements, lambda e: e["top"])
    return F.flatten(F.transform(outer, lambda e: e["texts"]))


def first_text(elements: Column) -> Column:
    return F.get(all_texts(elements), 0)


def last_text(elements: Column) -> Column:
    return F.try_element_at(all_texts(elements), F.lit(-1))


def joined(element: Column, separator: str = "") -> Column:
    return F.array_join(element["texts"], separator)


def inside(elements: Column, parent: Column) -> Column:
    """Those of the elements that lie below the parent."""
    return F.filter(elements, lambda e: F.array_contains(e["up"], parent["pos"]))


def text_inside(elements: Column, parent: Column) -> Column:
    """First text of the elements below the parent."""
    return F.get(F.flatten(F.transform(inside(elements, parent), lambda e: e["texts"])), 0)


def attribute(element: Column, name: str) -> Column:
    return element["attrs"][name]
