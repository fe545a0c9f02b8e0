"""Stored web pages as arrays of elements, and selectors over them.

One Arrow function turns the markup into two flat arrays per page; everything
after that (selecting, reading text, walking siblings) is a Spark expression on
those arrays, so no shuffle is needed and a page never leaves its row.

``element``: ``node, last, parent, tag, id, classes, href, content`` where the
nodes ``node + 1 … last`` lie inside the element.  It is number ``place`` of the
elements, and the next ``inside`` ones lie below it, as do ``text_count`` texts
from number ``text_place`` on.  ``text``: ``at, parent, text``.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import SPACE, _c, collapse_space, let, strip

_ELEMENT = (
    T.StructType()
    .add("node", "integer")
    .add("last", "integer")
    .add("parent", "integer")
    .add("tag", "string")
    .add("id", "string")
    .add("classes", T.ArrayType(T.StringType()))
    .add("href", "string")
    .add("content", "string")
    .add("property", "string")
    .add("place", "integer")
    .add("inside", "integer")
    .add("text_place", "integer")
    .add("text_count", "integer")
)
_TEXT = T.StructType().add("at", "integer").add("parent", "integer").add("text", "string")
PAGE_TYPE = T.StructType().add("elements", T.ArrayType(_ELEMENT)).add("texts", T.ArrayType(_TEXT))
# Elements without an end tag.
VOID = "area base br col embed hr img input link meta param source track wbr".split()
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "strong", "b")


#: Characters of markup whose elements are held as Python objects at a time.
HELD = 1 << 20


class _Outline(HTMLParser):
    """Elements and texts of pages in document order, one flat list a field; ``end_page`` ends a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.clear()

    def clear(self):
        self.elements = {f.name: [] for f in _ELEMENT}
        self.texts = {f.name: [] for f in _TEXT}
        self.element_ends, self.text_ends = [0], [0]
        self.begin_page()

    def begin_page(self):
        self.reset()
        # of the open elements: tag, node and place in the lists
        self.open, self.count = [], 0

    def end_page(self):
        self.close()
        self.leave(0)
        self.element_ends.append(len(self.elements["node"]))
        self.text_ends.append(len(self.texts["at"]))
        self.begin_page()

    def leave(self, depth):
        columns = self.elements
        elements, texts = len(columns["node"]), len(self.texts["at"]) - self.text_ends[-1]
        for _, _, i in self.open[depth:]:
            columns["last"][i] = self.count
            columns["inside"][i] = elements - i - 1
            columns["text_count"][i] = texts + 1 - columns["text_place"][i]
        del self.open[depth:]

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        self.count += 1
        columns = self.elements
        columns["node"].append(self.count)
        columns["last"].append(self.count)
        columns["parent"].append(self.open[-1][1] if self.open else 0)
        columns["tag"].append(tag)
        columns["classes"].append((attrs.get("class") or "").split())
        for name in ("id", "href", "content", "property"):
            columns[name].append(attrs.get(name))
        columns["place"].append(len(columns["node"]) - self.element_ends[-1])
        columns["inside"].append(0)
        columns["text_place"].append(len(self.texts["at"]) - self.text_ends[-1] + 1)
        columns["text_count"].append(0)
        if tag not in VOID:
            self.open.append((tag, self.count, len(columns["node"]) - 1))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.leave(len(self.open) - 1)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                return self.leave(depth)

    def handle_data(self, data):
        tag, parent, _ = self.open[-1] if self.open else ("", 0, 0)
        at, owner, text = self.texts["at"], self.texts["parent"], self.texts["text"]
        if len(at) > self.text_ends[-1] and at[-1] == self.count and owner[-1] == parent:
            text[-1] += data
            return
        self.count += 1
        if tag not in ("script", "style", "template"):
            at.append(self.count)
            owner.append(parent)
            text.append(data)

    def handle_comment(self, data):
        self.count += 1

    def arrays(self) -> pa.StructArray:
        """The pages ended since the last call, as Arrow columns."""

        def listed(columns, ends, kind):
            fields = [pa.field(f.name, _ARROW[f.dataType.simpleString()]) for f in kind]
            items = pa.StructArray.from_arrays([pa.array(columns[f.name], f.type) for f in fields], fields=fields)
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)

        pages = [listed(self.elements, self.element_ends, _ELEMENT), listed(self.texts, self.text_ends, _TEXT)]
        self.clear()
        return pa.StructArray.from_arrays(pages, names=PAGE_TYPE.names)


_ARROW = {"int": pa.int32(), "string": pa.string(), "array<string>": pa.list_(pa.string())}


def outlines(html: pa.Array) -> pa.Array:
    """Parsed pages.  Elements become Arrow columns after each ``HELD`` characters, so a batch is never held as objects."""
    outline, done, held = _Outline(), [], 0
    for value in html:
        markup = value.as_py() or ""
        outline.feed(markup)
        outline.end_page()
        held += len(markup)
        if held >= HELD:
            done.append(outline.arrays())
            held = 0
    return pa.concat_arrays([*done, outline.arrays()])


# Not deterministic for the optimiser alone: it copies other calls into filters, below the step that deals the pages to
# tasks, where a page would be parsed a second time and all of them by one task.
_parse = F.arrow_udf(outlines, PAGE_TYPE).asNondeterministic()


def parse_page(html: Column | str) -> Column:
    return _parse(_c(html))


class Page:
    """Selector expressions over a parsed page column.

    An element may be given as an expression: it is evaluated once, not for every text or element it is compared with.
    """

    def __init__(self, page: Column | str):
        page = _c(page)
        self.elements, self.texts = page["elements"], page["texts"]

    # --- selecting -----------------------------------------------------------------------------------------------

    @staticmethod
    def matches(selector: str) -> Callable[[Column], Column]:
        """Condition for ``tag``, ``.class``, ``#id``, ``[href]`` combinations, or several joined by commas."""

        def one(simple: str) -> Callable[[Column], Column]:
            tag = re.match(r"^[a-z0-9]*", simple).group()
            classes = re.findall(r"\.([\w-]+)", simple)
            ids = re.findall(r"#([\w-]+)", simple)

            def condition(e: Column) -> Column:
                parts = [e["tag"] == tag] if tag else []
                parts += [F.array_contains(e["classes"], c) for c in classes]
                parts += [e["id"] == i for i in ids]
                parts += [e["href"].isNotNull()] if "[href]" in simple else []
                return reduce(lambda a, b: a & b, parts)

            return condition

        conditions = [one(s.strip()) for s in selector.split(",")]
        return lambda e: reduce(lambda a, b: a | b, [F.coalesce(c(e), F.lit(False)) for c in conditions])

    def find(self, *path: str, inside: Column | None = None) -> Column:
        """Elements matching the last selector that lie below matches of the ones before it."""
        first = self.matches(path[0])
        found = F.filter(self.elements if inside is None else self.elements_below(inside), first)
        for selector in path[1:]:
            found = self._inside(found, self.matches(selector))
        return found

    def _inside(self, ancestors: Column, condition: Callable[[Column], Column]) -> Column:
        return let(
            ancestors,
            lambda above: F.filter(
                self.elements, lambda e: condition(e) & F.exists(above, lambda a: self.below(e, a))
            ),
        )

    def elements_below(self, ancestor: Column) -> Column:
        below = F.slice(self.elements, ancestor["place"] + 1, ancestor["inside"])
        return F.coalesce(below, F.slice(self.elements, 1, 0))

    def texts_below(self, e: Column) -> Column:
        return F.slice(self.texts, e["text_place"], e["text_count"])

    @staticmethod
    def below(e: Column, ancestor: Column) -> Column:
        return (e["node"] > ancestor["node"]) & (e["node"] <= ancestor["last"])

    @staticmethod
    def first(found: Column) -> Column:
        return F.get(found, F.lit(0))

    # --- reading -------------------------------------------------------------------------------------------------

    def raw_text(self, e: Column) -> Column:
        """All text below the element, as it stands."""

        def read(e: Column) -> Column:
            return F.when(e.isNotNull(), F.array_join(F.transform(self.texts_below(e), lambda t: t["text"]), ""))

        return let(e, read)

    def text(self, e: Column, separator: str = " ", collapse: bool = True) -> Column:
        """Text pieces below the element, trimmed and joined; white space collapses unless told otherwise."""

        def read(e: Column) -> Column:
            stripped = F.transform(self.texts_below(e), lambda t: strip(t["text"]))
            pieces = F.array_join(F.array_remove(stripped, ""), separator)
            return F.when(e.isNotNull(), collapse_space(pieces) if collapse else pieces)

        return let(e, read)

    def all_text(self) -> Column:
        pieces = F.array_remove(F.transform(self.texts, lambda t: strip(t["text"])), "")
        return collapse_space(F.array_join(pieces, " "))

    def first_text(
        self, *path: str, inside: Column | None = None, separator: str = " ", collapse: bool = True
    ) -> Column:
        return let(self.first(self.find(*path, inside=inside)), lambda e: self.text(e, separator, collapse))

    # --- siblings ------------------------------------------------------------------------------------------------

    def siblings_after(self, e: Column) -> Column:
        return let(
            e, lambda e: F.filter(self.elements, lambda s: (s["parent"] == e["parent"]) & (s["node"] > e["last"]))
        )

    def next_node(self, e: Column) -> Column:
        """The element that follows at once, with no text in between."""
        return let(
            e,
            lambda e: self.first(
                F.filter(self.elements, lambda s: (s["parent"] == e["parent"]) & (s["node"] == e["last"] + 1))
            ),
        )

    def parent_of(self, e: Column) -> Column:
        return let(e, lambda e: self.first(F.filter(self.elements, lambda p: p["node"] == e["parent"])))


def plain_text(html: Column | str) -> Column:
    """Text of a page without building its elements: markup removed, white space collapsed."""
    text = F.regexp_replace(_c(html), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", " ")
    for entity, char in {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&copy;": "©", "&middot;": "·", "&nbsp;": " ", "&amp;": "&"}.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return collapse_space(text)


def absolute_url(href: Column, host: str) -> Column:
    """Links relative to the site get its address in front."""
    href = strip(href)
    return (
        F.when(F.startswith(href, F.lit("/")), F.concat(F.lit(host), href))
        .when(F.startswith(href, F.lit("http")), href)
        .otherwise(F.concat(F.lit(host.rstrip("/") + "/"), F.regexp_replace(href, "^/+", "")))
    )


def link_pairs(html: Column | str, pattern: str) -> Column:
    """``array<struct<href,title>>`` of anchors whose address matches, straight from the markup."""
    anchor = F.lit(r'(?is)<a\b[^>]*?\bhref="([^"]*)"[^>]*>(.*?)</a>')
    html = _c(html)
    hrefs = F.regexp_extract_all(html, anchor, F.lit(1))
    titles = F.regexp_extract_all(html, anchor, F.lit(2))
    pairs = F.zip_with(
        hrefs, titles, lambda h, t: F.struct(strip(h).alias("href"), strip(F.regexp_replace(t, "<[^>]*>", "")).alias("title"))
    )
    return F.filter(pairs, lambda p: p["href"].rlike(pattern))


def set_query_parameter(url: Column | str, name: str, value: Column | str) -> Column:
    """Replace the value of a query parameter, or add the parameter."""
    url = _c(url)
    value = F.lit(value) if isinstance(value, str) else value
    has = url.rlike(rf"[?&]{name}=")
    base, fragment = F.regexp_extract(url, "^([^#]*)", 1), F.regexp_extract(url, "(#.*)$", 1)
    replaced = F.regexp_replace(base, F.lit(rf"([?&]{name}=)[^&]*"), F.concat(F.lit("$1"), value))
    added = F.concat(base, F.when(F.contains(base, F.lit("?")), "&").otherwise("?"), F.lit(f"{name}="), value)
    return F.concat(F.when(has, replaced).otherwise(added), fragment)


def url_path(url: Column | str) -> Column:
    return F.coalesce(F.try_parse_url(_c(url), F.lit("PATH")), F.lit(""))


def reported_total(html: Column | str) -> Column:
    """The total a listing reports, ``(1.234 việc)``, or -1."""
    number = F.regexp_extract(_c(html), rf"(?iu)\(([0-9.,]+)[{SPACE}]*việc\)", 1)
    return F.coalesce(F.regexp_replace(number, "[.,]", "").try_cast("bigint"), F.lit(-1))
