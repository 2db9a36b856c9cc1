"""Page elements: the only step that runs Python code per page.

One Arrow pass, straight into Arrow columns, turns HTML into the text of the page plus a flat list of its
nodes. A node stores where its text begins and ends, so nested elements do not
repeat text. Everything after this step is Spark expressions over that list.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

NODE_TYPE = T.StructType(
    [
        T.StructField("pos", T.IntegerType()),
        T.StructField("up", T.ArrayType(T.IntegerType())),
        T.StructField("tag", T.StringType()),
        T.StructField("classes", T.ArrayType(T.StringType())),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("begin", T.IntegerType()),
        T.StructField("finish", T.IntegerType()),
        # the last descendant (the node itself if it has none), the number among
        # all siblings and among those of the same tag
        T.StructField("last", T.IntegerType()),
        T.StructField("nth", T.IntegerType()),
        T.StructField("nth_of_type", T.IntegerType()),
    ]
)
DOM_TYPE = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("nodes", T.ArrayType(NODE_TYPE)),
    ]
)

# Fixed values of HTML: tags without content, and tags that close an open one.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
CLOSED_BY_SAME = frozenset("li p dt dd tr td th option".split())


class _Nodes(HTMLParser):
    """Collects nodes in document order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []
        self.open: list[int] = []
        self.children: list[Counter] = [Counter()]  # of the page and of every open node, by tag
        self.parts: list[str] = []
        self.length = 0

    def handle_starttag(self, tag, attrs):
        if tag in CLOSED_BY_SAME and self.open and self.nodes[self.open[-1]]["tag"] == tag:
            self._close(len(self.open) - 1)
        named: dict[str, str] = {}
        for key, value in attrs:
            named.setdefault(key, value or "")
        pos = len(self.nodes)
        siblings = self.children[-1]
        siblings[tag] += 1
        siblings[None] += 1
        self.nodes.append(
            {
                "pos": pos,
                "up": list(self.open),
                "tag": tag,
                "classes": named.get("class", "").split(),
                "attrs": named,
                "begin": self.length,
                "finish": self.length,
                "last": pos,
                "nth": siblings[None],
                "nth_of_type": siblings[tag],
            }
        )
        if tag not in VOID_TAGS:
            self.open.append(pos)
            self.children.append(Counter())

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.nodes[self.open[depth]]["tag"] == tag:
                self._close(depth)
                return

    def handle_data(self, data):
        self.parts.append(data)
        self.length += len(data)

    def parse_marked_section(self, i, report=1):
        # "<![...>" is a comment up to the next ">", whatever it holds
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def _close(self, depth: int) -> None:
        for pos in self.open[depth:]:
            self.nodes[pos]["finish"] = self.length
            self.nodes[pos]["last"] = len(self.nodes) - 1
        del self.open[depth:]
        del self.children[depth + 1 :]

    def finished(self) -> dict:
        self.close()
        self._close(0)
        return {"text": "".join(self.parts), "nodes": self.nodes}


def dom_of_text(html: str | None) -> dict | None:
    if html is None:
        return None
    builder = _Nodes()
    builder.feed(html)
    return builder.finished()


# Markup that is read without the parser: its reading is the same, and whatever
# looks otherwise leaves the page to the parser.
_BLANK = r"[ \t\n\r\f]"
_BARE = r"[\w.:?#%+,;~!@()|*&/-]"
_VALUE = rf"""(?:"[^"]*+"|'[^']*+'|{_BARE}(?:{_BARE}|=)*+(?=[ \t\n\r\f>]))"""
# what a raw element holds is read with its tag, and dropped if nothing ends it;
# what needs the parser takes the rest of the page with it
_TOKENS = re.compile(
    rf"""([^<]*+)
        (?:<(?:(?:((?i:{"|".join(HTMLParser.CDATA_CONTENT_ELEMENTS)}))(?![a-zA-Z0-9:_.-])|([a-zA-Z][a-zA-Z0-9:_.-]*+))
              ((?:{_BLANK}++[a-zA-Z_:@][a-zA-Z0-9_:.@-]*+(?:{_BLANK}*+={_BLANK}*+{_VALUE})?+)*+){_BLANK}*+(/)?+>
              (?(2)(?(5)|(?:((?:[^<]++|<(?!/(?u:\s*+)(?i:\2)(?u:\s*+)>))*+)(?=<)|.*+)))
            |/([a-zA-Z][a-zA-Z0-9:_.-]*+){_BLANK}*+>
            |!--.*?--\s*>|!(?!--)[^>]*+>|\?[^>]*+>)
          |(<(?![a-zA-Z/!?])|<.++)
          |\Z)""",
    re.S | re.X | re.A,
)
# end tags with letters that the parser takes for ASCII ones where it looks for the end of a raw element
_FOLDED = re.compile(r"</\s*+[a-zA-Z]*+[\u0130\u0131\u017f\u212a]")
_ATTRIBUTE = re.compile(rf"""([a-zA-Z_:@][a-zA-Z0-9_:.@-]*+)(?:{_BLANK}*+={_BLANK}*+(?:"([^"]*+)"|'([^']*+)'|([^ \t\n\r\f"'>]++)))?+""")
# characters of pages whose nodes are held at a time
CHUNK = 1_000_000


def attributes(rest: str) -> dict[str, str]:
    """Attributes of a tag by name; of one that repeats, the first."""
    named: dict[str, str] = {}
    for key, double, single, bare in _ATTRIBUTE.findall(rest):
        value = double or single or bare
        named.setdefault(key.lower(), unescape(value) if "&" in value else value)
    return named


def outline(html: str) -> tuple | None:
    """The text of a page and, for its nodes in document order: tag, text of the
    attributes, place of the parent (-1 without one), begin, finish, and place of
    the last descendant. None where the parser is needed."""
    if not html.isascii() and _FOLDED.search(html):
        return None
    tags: list[str] = []
    rests: list[str] = []
    parents: list[int] = []
    begin: list[int] = []
    finish: list[int] = []
    last: list[int] = []
    parts: list[str] = []
    opened, names = [-1], [None]  # the open elements, and their tags
    length = count = 0
    for part, raw, name, rest, closed, held, end, other in _TOKENS.findall(html):
        if part:
            if "&" in part:
                part = unescape(part)
            parts.append(part)
            length += len(part)
        if name or raw:
            tag = (name or raw).lower()
            if names[-1] == tag and tag in CLOSED_BY_SAME:
                names.pop()
                p = opened.pop()
                finish[p] = length
                last[p] = count - 1
            tags.append(tag)
            rests.append(rest)
            parents.append(opened[-1])
            begin.append(length)
            finish.append(length)
            last.append(count)
            if not closed and tag not in VOID_TAGS:
                opened.append(count)
                names.append(tag)
            count += 1
            if held:
                parts.append(held)
                length += len(held)
        elif end:
            tag = end.lower()
            if names[-1] == tag:
                names.pop()
                p = opened.pop()
                finish[p] = length
                last[p] = count - 1
            elif tag in names:
                depth = len(names) - 1 - names[::-1].index(tag)
                for p in opened[depth:]:
                    finish[p] = length
                    last[p] = count - 1
                del opened[depth:], names[depth:]
        elif other:
            if other != "<":
                return None
            parts.append(other)
            length += 1
    for p in opened[1:]:
        finish[p] = length
        last[p] = count - 1
    return "".join(parts), tags, rests, parents, begin, finish, last


class _Columns:
    """Nodes of pages, a list per field, until they become one Arrow array."""

    def __init__(self) -> None:
        self.texts: list[str | None] = []
        self.ends: list[int | None] = []  # nodes up to and with a page; NULL without HTML
        self.pos: list[int] = []
        self.ups: list[int] = []
        self.up_ends: list[int] = []
        self.tags: list[str] = []
        self.classes: list[str] = []
        self.class_ends: list[int] = []
        self.keys: list[str] = []
        self.values: list[str] = []
        self.attr_ends: list[int] = []
        self.begin: list[int] = []
        self.finish: list[int] = []
        self.last: list[int] = []
        self.nth: list[int] = []
        self.nth_of_type: list[int] = []

    def add(self, html: str | None) -> None:
        if html is None:
            self.texts.append(None)
            self.ends.append(None)
            return
        marks = [len(held) for held in self._held()]
        text = self._read(html)
        if text is None:
            for held, mark in zip(self._held(), marks):
                del held[mark:]
            text = self._parsed(html)
        self.texts.append(text)
        self.ends.append(len(self.pos))

    def _held(self) -> list[list]:
        return [
            self.pos, self.ups, self.up_ends, self.tags, self.classes, self.class_ends, self.keys, self.values,
            self.attr_ends, self.begin, self.finish, self.last, self.nth, self.nth_of_type,
        ]

    def _parsed(self, html: str) -> str:
        page = dom_of_text(html)
        for n in page["nodes"]:
            self.ups += n["up"]
            self.classes += n["classes"]
            self.keys += n["attrs"]
            self.values += n["attrs"].values()
            for ends, held in ((self.up_ends, self.ups), (self.class_ends, self.classes), (self.attr_ends, self.keys)):
                ends.append(len(held))
            for name, held in (("pos", self.pos), ("tag", self.tags), ("begin", self.begin), ("finish", self.finish),
                               ("last", self.last), ("nth", self.nth), ("nth_of_type", self.nth_of_type)):
                held.append(n[name])
        return page["text"]

    def _read(self, html: str) -> str | None:
        """Add the page's nodes and return its text; None where the parser is needed."""
        page = outline(html)
        if page is None:
            return None
        text, tags, rests, parents, begin, finish, last = page
        around: list[int] = []  # the node before and what it is in
        counts: list[dict] = [{}]  # children of the page and of every node around, by tag
        for pos, (tag, rest, parent) in enumerate(zip(tags, rests, parents)):
            while around and around[-1] != parent:
                around.pop()
                counts.pop()
            siblings = counts[-1]
            siblings[tag] = nth_of_type = siblings.get(tag, 0) + 1
            siblings[None] = nth = siblings.get(None, 0) + 1
            if rest:
                named = attributes(rest)
                self.keys += named
                self.values += named.values()
                if "class" in named:
                    self.classes += named["class"].split()
            self.ups += around
            self.up_ends.append(len(self.ups))
            self.class_ends.append(len(self.classes))
            self.attr_ends.append(len(self.keys))
            self.nth.append(nth)
            self.nth_of_type.append(nth_of_type)
            around.append(pos)
            counts.append({})
        self.pos += range(len(tags))
        self.tags += tags
        self.begin += begin
        self.finish += finish
        self.last += last
        return text

    def array(self) -> pa.StructArray:
        def ints(values: list) -> pa.Array:
            return pa.array(values, pa.int32())

        def offsets(ends: list) -> pa.Array:
            return ints([0, *ends])

        def strings(values: list) -> pa.Array:
            return pa.array(values, pa.string())

        attrs = pa.MapArray.from_arrays(offsets(self.attr_ends), strings(self.keys), strings(self.values))
        ups = pa.ListArray.from_arrays(offsets(self.up_ends), ints(self.ups))
        classes = pa.ListArray.from_arrays(offsets(self.class_ends), strings(self.classes))
        fields = [
            ints(self.pos), ups, strings(self.tags), classes, attrs, ints(self.begin), ints(self.finish),
            ints(self.last), ints(self.nth), ints(self.nth_of_type),
        ]
        rows = pa.StructArray.from_arrays(fields, NODE_TYPE.names)
        # a list that starts at NULL is NULL, and starts where the one before it ended
        known = [e is not None for e in self.ends] + [True]
        starts = list(accumulate(self.ends, lambda before, e: before if e is None else e, initial=0))
        nodes = pa.ListArray.from_arrays(ints([s if k else None for s, k in zip(starts, known)]), rows)
        return pa.StructArray.from_arrays([strings(self.texts), nodes], DOM_TYPE.names)


def _dom_chunks(html: pa.Array) -> Iterator[pa.Array]:
    chars, columns = 0, _Columns()
    for value in html:
        text = value.as_py()
        columns.add(text)
        chars += len(text or "")
        if chars >= CHUNK:
            yield columns.array()
            chars, columns = 0, _Columns()
    yield columns.array()


def _dom_batch(html: pa.Array) -> pa.Array:
    return pa.concat_arrays([*_dom_chunks(html)])


def _dom_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Nodes leave the worker chunk by chunk, however many pages a batch holds."""
    for html in batches:
        yield from filter(len, _dom_chunks(html))


# Workers receive this module by value, so it needs no install on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def page_dom(html: Column) -> Column:
    """HTML -> ``struct<text, nodes>``; NULL text and nodes for NULL input.

    The call is marked non-deterministic so that the optimizer neither repeats
    it nor moves it into the lambda functions that read its result.
    """
    return F.arrow_udf(_dom_batches, DOM_TYPE).asNondeterministic()(html)


def page_elements(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per element: page columns (without the HTML) plus ``pos``,
    ``parent``, ``tag``, ``classes``, ``attrs`` and ``text``."""
    keep = [c for c in pages.columns if c != html]
    dom = pages.select(*keep, page_dom(F.col(html)).alias("_dom"))
    rows = dom.select(*keep, F.col("_dom.text").alias("_text"), F.explode("_dom.nodes").alias("_n"))
    return rows.select(
        *keep,
        F.col("_n.pos").alias("pos"),
        F.try_element_at("_n.up", F.lit(-1)).alias("parent"),
        F.col("_n.tag").alias("tag"),
        F.col("_n.classes").alias("classes"),
        F.col("_n.attrs").alias("attrs"),
        span(F.col("_text"), F.col("_n")).alias("text"),
    )


# -- expressions over a DOM column -------------------------------------------


def span(text: Column, node: Column) -> Column:
    return F.substring(text, node["begin"] + 1, node["finish"] - node["begin"])


def text_of(dom: Column, node: Column) -> Column:
    """Text content of a node."""
    return span(dom["text"], node)


def attr(node: Column, name: str) -> Column:
    return F.try_element_at(node["attrs"], F.lit(name))


def has_class(node: Column, name: str) -> Column:
    return F.array_contains(node["classes"], name)


def inside(dom: Column, node: Column, test) -> Column:
    """Does some ancestor of the node pass the test?"""
    return F.exists(node["up"], lambda i: test(F.get(dom["nodes"], i)))


def nodes_where(dom: Column, test) -> Column:
    """Nodes passing the test, in document order."""
    return F.coalesce(F.filter(dom["nodes"], test), F.array().cast(T.ArrayType(NODE_TYPE)))


def first_node(dom: Column, test) -> Column:
    return F.try_element_at(F.filter(dom["nodes"], test), F.lit(1))


def texts_where(dom: Column, test) -> Column:
    """Text contents of the matching nodes."""
    return F.transform(nodes_where(dom, test), lambda n: text_of(dom, n))
