"""Selectors: where something stands on a page, stated as text, run as expressions.

A selector such as ``div.box > a[href^="/p/"]`` is compiled on the driver to
rows, a step per compound. Pages are never searched by Python code: one generic
expression walks the steps over the node list of :func:`page_dom`, so a plan has
the same size for one rule and for a thousand, and rules can come from a table.

A node knows its place (``pos``), the place of its last descendant (``last``)
and its number among its siblings. "Inside" is a comparison of two numbers, and
so are "child of" and "next to".

Supported: tags, ``*``, ``#id``, ``.class``, ``[a]``, ``[a=v]`` and ``^= $= *=
~=``, ``:nth-child(n)``, ``:first-child``, ``:last-child``, ``:nth-of-type(n)``,
``:first-of-type``, ``:text("part")``, ``:text-is("whole")``, ``:not(test)``,
``:has(compound)``, ``:has(> compound)``; the combinators blank, ``>``, ``+`` and
``~``; ``..`` for the parent; ``:scope`` at the start for the node the search
begins at.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from offerloom.functions.text import squash, trim_text
from offerloom.operators.elements import text_of

TEST = "struct<kind: string, name: string, value: string, no: boolean>"
STEP = f"struct<axis: string, tests: array<{TEST}>, inner: array<struct<axis: string, tests: array<{TEST}>, no: boolean>>>"
PATH = f"array<{STEP}>"
#: A place that a search begins at or has reached.
PLACE = "struct<pos: int, last: int, up: int, nth: int>"

_QUOTED = r""""[^"]*"|'[^']*'"""
_SIMPLE = re.compile(
    rf"""(?P<tag>\*|[a-zA-Z][\w-]*)
       | \#(?P<id>[\w-]+)
       | \.(?P<cls>[\w-]+)
       | \[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[\^$*~]?=)\s*(?P<value>{_QUOTED}|[^\]\s]+)\s*)?\]
       | :(?P<nth>nth-child|nth-of-type)\(\s*(?P<n>\d+)\s*\)
       | :(?P<edge>first-child|first-of-type|last-child)
       | :(?P<text>text-is|text)\(\s*(?P<words>{_QUOTED})\s*\)""",
    re.X,
)
_NESTED = re.compile(rf""":(?P<how>not|has)\((?P<body>(?:{_QUOTED}|[^()"']|\((?:{_QUOTED}|[^()"'])*\))*)\)""")
_AXIS = re.compile(r"\s*([>+~])\s*|\s+")
_KINDS = {None: "has", "=": "is", "^=": "starts", "$=": "ends", "*=": "holds", "~=": "word"}


def _plain(value: str) -> str:
    return value[1:-1] if value[:1] in "\"'" else value


def _test(m: re.Match) -> tuple | None:
    """A simple test as a row; None for ``*``, which every node passes."""
    g = m.groupdict()
    if g["tag"]:
        return None if g["tag"] == "*" else ("tag", None, g["tag"].lower(), False)
    if g["id"]:
        return ("is", "id", g["id"], False)
    if g["cls"]:
        return ("class", None, g["cls"], False)
    if g["attr"]:
        return (_KINDS[g["op"]], g["attr"].lower(), None if g["op"] is None else _plain(g["value"]), False)
    if g["nth"]:
        return (g["nth"], None, str(int(g["n"])), False)
    if g["edge"]:
        kind = {"first-child": "nth-child", "first-of-type": "nth-of-type", "last-child": "last-child"}[g["edge"]]
        return (kind, None, "1", False)
    words = _plain(g["words"])
    return (g["text"], None, words.lower() if g["text"] == "text" else words, False)


def _compound(text: str, at: int) -> tuple[list, list, int]:
    """Tests and ``:has`` parts from ``at`` on, and where they end."""
    tests, inner, start = [], [], at
    while at < len(text):
        if m := _NESTED.match(text, at):
            body = m["body"].strip()
            if m["how"] == "not":
                own, more, end = _compound(body, 0)
                if end != len(body) or len(own) + len(more) != 1:
                    raise ValueError(f":not() takes one test: {text!r}")
                tests += [(*t[:3], not t[3]) for t in own]
                inner += [(a, t, not no) for a, t, no in more]
            else:
                axis = ">" if body.startswith(">") else " "
                body = body.lstrip("> ")
                own, more, end = _compound(body, 0)
                if end != len(body) or more:
                    raise ValueError(f":has() takes one compound: {text!r}")
                inner.append((axis, own, False))
        elif m := _SIMPLE.match(text, at):
            if m["tag"] and at > start:
                break
            if test := _test(m):
                tests.append(test)
        else:
            break
        at = m.end()
    if at == start:
        raise ValueError(f"cannot read selector {text!r} at {at}")
    return tests, inner, at


def compile_selector(text: str) -> list[tuple]:
    """A selector as rows of ``PATH``."""
    text = text.strip()
    steps, at, axis = [], 0, " "
    if text.startswith(":scope"):
        at = len(":scope")
        if at == len(text):
            return []
        m = _AXIS.match(text, at)
        if not m:
            raise ValueError(f":scope stands alone: {text!r}")
        axis, at = m[1] or " ", m.end()
    while True:
        if text.startswith("..", at):
            tests, inner, axis, at = [], [], "..", at + 2
        else:
            tests, inner, at = _compound(text, at)
        steps.append((axis, tests, inner))
        if at == len(text):
            return steps
        m = _AXIS.match(text, at)
        if not m:
            raise ValueError(f"cannot read selector {text!r} at {at}")
        axis, at = m[1] or " ", m.end()


# -- expressions -------------------------------------------------------------------


def _up(n: Column) -> Column:
    return F.coalesce(F.try_element_at(n["up"], F.lit(-1)), F.lit(-1))


def _passes(dom: Column, n: Column, t: Column) -> Column:
    kind, value = t["kind"], t["value"]
    held = F.try_element_at(n["attrs"], F.coalesce(t["name"], F.lit("")))
    # the last descendant of a parent is in its last child
    last = F.when(
        F.size(n["up"]) > 0, n["last"] == F.get(dom["nodes"], F.try_element_at(n["up"], F.lit(-1)))["last"]
    ).otherwise(n["last"] == F.size(dom["nodes"]) - 1)
    ok = (
        F.when(kind == "class", F.array_contains(n["classes"], F.coalesce(value, F.lit(""))))
        .when(kind == "tag", n["tag"] == value)
        .when(kind == "is", held == value)
        .when(kind == "has", held.isNotNull())
        .when(kind == "starts", F.startswith(held, value))
        .when(kind == "ends", F.endswith(held, value))
        .when(kind == "holds", F.contains(held, value))
        .when(kind == "word", F.array_contains(F.split(held, r"\s+"), F.coalesce(value, F.lit(""))))
        .when(kind == "nth-child", n["nth"].cast("string") == value)
        .when(kind == "nth-of-type", n["nth_of_type"].cast("string") == value)
        .when(kind == "last-child", last)
        .when(kind == "text", F.contains(F.lower(squash(text_of(dom, n))), value))
        .when(kind == "text-is", trim_text(text_of(dom, n)) == value)
    )
    return F.coalesce(ok, F.lit(False)) != t["no"]


def _all(dom: Column, n: Column, tests: Column) -> Column:
    return F.forall(tests, lambda t: _passes(dom, n, t))


def _related(axis: Column, c: Column, n: Column) -> Column:
    beside = _up(n) == c["up"]
    return (
        F.when(axis == " ", (n["pos"] > c["pos"]) & (n["pos"] <= c["last"]))
        .when(axis == ">", _up(n) == c["pos"])
        .when(axis == "+", beside & (n["nth"] == c["nth"] + 1))
        .when(axis == "~", beside & (n["nth"] > c["nth"]))
        .otherwise(n["pos"] == c["up"])
    )


def place(n: Column) -> Column:
    return F.struct(n["pos"].alias("pos"), n["last"].alias("last"), _up(n).alias("up"), n["nth"].alias("nth"))


def page_place() -> Column:
    """The whole page, as the place a search begins at."""
    return F.struct(F.lit(-1).alias("pos"), F.lit(2**31 - 1).alias("last"), F.lit(-2).alias("up"), F.lit(0).alias("nth"))


def select(dom: Column, path: Column, start: Column | None = None) -> Column:
    """Nodes that a compiled selector finds below ``start``, in document order."""
    begin = page_place() if start is None else start

    def reach(places: Column, axis: Column) -> Column:
        """The nodes that a step can arrive at: what is below the places, if it goes down."""
        first = F.array_min(F.transform(places, lambda c: c["pos"]))
        end = F.array_max(F.transform(places, lambda c: c["last"]))
        below = F.slice(dom["nodes"], first + 2, F.least(end, F.size(dom["nodes"]) - 1) - first)
        return F.when(axis.isin(" ", ">"), below).otherwise(dom["nodes"])

    def step(places: Column, s: Column) -> Column:
        found = F.filter(
            reach(places, s["axis"]),
            lambda n: _all(dom, n, s["tests"])
            & F.exists(places, lambda c: _related(s["axis"], c, n))
            & F.forall(
                s["inner"],
                lambda i: F.exists(
                    dom["nodes"],
                    lambda m: F.when(i["axis"] == ">", _up(m) == n["pos"]).otherwise(
                        (m["pos"] > n["pos"]) & (m["pos"] <= n["last"])
                    )
                    & _all(dom, m, i["tests"]),
                )
                != i["no"],
            ),
        )
        # where a step finds nothing, the ones behind it look for nothing
        return F.when(F.size(places) == 0, places).otherwise(F.transform(found, place))

    places = F.aggregate(path, F.array(begin).cast(f"array<{PLACE}>"), step)
    return F.transform(F.filter(places, lambda p: p["pos"] >= 0), lambda p: F.get(dom["nodes"], p["pos"]))


def select_text(dom: Column, selector: str, start: Column | None = None) -> Column:
    """Nodes that a selector stated in the program finds."""
    return select(dom, _literal(compile_selector(selector)), start)


def _literal(steps: list[tuple]) -> Column:
    def text(v: str | None) -> Column:
        return F.lit(v).cast("string")

    def tests(rows: list) -> Column:
        made = [F.struct(text(k).alias("kind"), text(n).alias("name"), text(v).alias("value"), F.lit(no).alias("no")) for k, n, v, no in rows]
        return F.array(*made).cast(f"array<{TEST}>")

    made = [
        F.struct(
            F.lit(axis).alias("axis"),
            tests(own).alias("tests"),
            F.array(*[F.struct(F.lit(a).alias("axis"), tests(t).alias("tests"), F.lit(no).alias("no")) for a, t, no in inner])
            .cast(f"array<struct<axis: string, tests: array<{TEST}>, no: boolean>>")
            .alias("inner"),
        )
        for axis, own, inner in steps
    ]
    return F.array(*made).cast(PATH)
