"""Rules read off a page: the third step that runs Python code per page.

Where only what the rules find is wanted of a page, its nodes need not leave the
worker: one Arrow pass reads the page as :func:`page_dom` does, walks the
selectors of the page's shop and returns the values found. The outcome is that
of :func:`rule_fields` and :func:`rule_records` over the page's nodes; tests
compare the two. A node's attributes are read when a rule looks at them.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

from offerloom.operators.elements import attributes, dom_of_text, outline

FOUND = "struct<fields: map<string, string>, records: array<struct<record: string, rows: array<map<string, string>>>>>"
#: Per domain the rows of its rules and those of its records.
Rules = dict[str, tuple[list[tuple], list[tuple]]]


# -- text, as the functions of the same names in ``functions.text`` treat it ----------

_WS = " \t\n\x0b\f\r\xa0"
_BLANKS = re.compile(f"[{_WS}]+")
_ASCII_BLANKS = re.compile("[ \t\n\x0b\f\r]+")
_LINE_ENDS = ("\x85", "\u2028", "\u2029")  # the pattern's "$" stands before them, too


def _trim(text: str) -> str:
    out = text.lstrip(_WS)
    if out.endswith(_LINE_ENDS):
        return out[:-1].rstrip(_WS) + out[-1]
    return out.rstrip(_WS)


def _squash(text: str) -> str:
    return _BLANKS.sub(" ", _trim(text))


def _after_colon(text: str) -> str | None:
    parts = text.split(":", 2)
    return _trim(parts[1]) if len(parts) > 1 else None


CLEANUPS: dict[str, Callable[[str], str | None]] = {
    "trim": _trim,
    "squash": _squash,
    "cut_query": lambda text: text.split("?", 1)[0],
    "after_colon": _after_colon,
    "first_line": lambda text: _trim(_trim(text).split("\n", 1)[0]),
    "last_segment": lambda text: text.rsplit("/", 1)[-1],
}


# -- pages ----------------------------------------------------------------------------


class _Page:
    """A page's nodes by place; attributes and numbers among siblings when asked for."""

    __slots__ = ("text", "tags", "rests", "parents", "begin", "finish", "last", "named", "_numbers")

    def __init__(self, html: str) -> None:
        read = outline(html)
        if read is not None:
            self.text, self.tags, self.rests, self.parents, self.begin, self.finish, self.last = read
            self.named: list[dict | None] = [None] * len(self.tags)
        else:
            page = dom_of_text(html)
            nodes = page["nodes"]
            self.text = page["text"]
            self.tags, self.named, self.begin, self.finish, self.last = (
                [n[k] for n in nodes] for k in ("tag", "attrs", "begin", "finish", "last")
            )
            self.rests = [""] * len(nodes)
            self.parents = [n["up"][-1] if n["up"] else -1 for n in nodes]
        self._numbers = None

    def attrs(self, n: int) -> dict[str, str]:
        named = self.named[n]
        if named is None:
            named = self.named[n] = attributes(self.rests[n]) if self.rests[n] else {}
        return named

    def text_of(self, n: int) -> str:
        return self.text[self.begin[n] : self.finish[n]]

    def numbers(self) -> tuple[list[int], list[int]]:
        """A node's number among its siblings, and among those of its tag."""
        if self._numbers is None:
            siblings, same = Counter(), Counter()
            nth, nth_of_type = [], []
            for parent, tag in zip(self.parents, self.tags):
                siblings[parent] += 1
                same[parent, tag] += 1
                nth.append(siblings[parent])
                nth_of_type.append(same[parent, tag])
            self._numbers = nth, nth_of_type
        return self._numbers


# -- selectors: the tests and steps of ``selectors.select`` -----------------------------

Test = Callable[[_Page, int], bool]


def _class(value: str) -> Test:
    def test(page: _Page, n: int) -> bool:
        named = page.named[n]
        if named is None:
            # what is not in the text of the attributes is in none of them
            rest = page.rests[n]
            if value not in rest and "&" not in rest:
                return False
            named = page.attrs(n)
        return "class" in named and value in named["class"].split()

    return test


def _attr(holds: Callable[[str, str], bool], name: str, value: str) -> Test:
    def test(page: _Page, n: int) -> bool:
        held = page.attrs(n).get(name)
        return held is not None and holds(held, value)

    return test


_HOLDS: dict[str, Callable[[str, str], bool]] = {
    "is": str.__eq__,
    "starts": str.startswith,
    "ends": str.endswith,
    "holds": str.__contains__,
    "word": lambda held, value: value in _ASCII_BLANKS.split(held),
}


def _of_kind(kind: str, name: str | None, value: str | None) -> Test:
    if kind == "has":
        return lambda page, n: name in page.attrs(n)
    if value is None:
        return lambda page, n: False
    if kind == "class":
        return _class(value)
    if kind in _HOLDS:
        return _attr(_HOLDS[kind], name or "", value)
    if kind == "tag":
        return lambda page, n: page.tags[n] == value
    if kind == "nth-child":
        return lambda page, n: str(page.numbers()[0][n]) == value
    if kind == "nth-of-type":
        return lambda page, n: str(page.numbers()[1][n]) == value
    if kind == "last-child":
        # the last descendant of a parent is in its last child

        def is_last(page: _Page, n: int) -> bool:
            parent = page.parents[n]
            return page.last[n] == (page.last[parent] if parent >= 0 else len(page.tags) - 1)

        return is_last
    if kind == "text":
        return lambda page, n: value in _squash(page.text_of(n)).lower()
    if kind == "text-is":
        return lambda page, n: _trim(page.text_of(n)) == value
    return lambda page, n: False


def _test(row: tuple) -> Test:
    kind, name, value, no = row
    test = _of_kind(kind, name, value)
    return (lambda page, n: not test(page, n)) if no else test


def _inner(row: tuple) -> Test:
    """Whether a node has a descendant, or a child, that passes the tests."""
    axis, rows, no = row
    tests = [_test(t) for t in rows]

    def test(page: _Page, n: int) -> bool:
        parents = page.parents
        return no != any(
            (axis != ">" or parents[m] == n) and all(t(page, m) for t in tests) for m in range(n + 1, page.last[n] + 1)
        )

    return test


def _step(row: tuple) -> Callable[[_Page, list[int], bool], list[int]]:
    """The nodes that a step finds from places, or the first one only; both in
    document order. The page is place -1."""
    axis, rows, inner = row
    own = next((t for t in rows if t[0] == "tag" and t[2] is not None and not t[3]), None)
    tag = own and own[2]
    tests = [_test(t) for t in rows if t is not own] + [_inner(i) for i in inner]

    def passing(page: _Page, candidates, one: bool) -> list[int]:
        if tag is not None:
            tags = page.tags
            candidates = [n for n in candidates if tags[n] == tag]
        out = []
        for n in candidates:
            for test in tests:
                if not test(page, n):
                    break
            else:
                out.append(n)
                if one:
                    break
        return out

    def reach(page: _Page, places: list[int]) -> range | list[int]:
        last = page.last
        if len(places) == 1:
            p = places[0]
            return range(p + 1, last[p] + 1) if p >= 0 else range(len(last))
        out, at = [], 0
        for p in places:  # one may be inside another
            if last[p] >= at:
                out += range(max(p + 1, at), last[p] + 1)
                at = last[p] + 1
        return out

    def below(page: _Page, places: list[int], one: bool) -> list[int]:
        return passing(page, reach(page, places), one)

    def children(page: _Page, places: list[int], one: bool) -> list[int]:
        of, parents = set(places), page.parents
        return passing(page, [n for n in reach(page, places) if parents[n] in of], one)

    def next_to(page: _Page, places: list[int], one: bool) -> list[int]:
        parents, nth = page.parents, page.numbers()[0]
        found = {(parents[p], nth[p] + 1) for p in places if p >= 0}
        return passing(page, [n for n, at in enumerate(zip(parents, nth)) if at in found], one)

    def behind(page: _Page, places: list[int], one: bool) -> list[int]:
        parents, nth = page.parents, page.numbers()[0]
        first: dict[int, int] = {}
        for p in places:
            if p >= 0:
                first.setdefault(parents[p], nth[p])
        return passing(page, [n for n, p in enumerate(parents) if p in first and nth[n] > first[p]], one)

    def above(page: _Page, places: list[int], one: bool) -> list[int]:
        return passing(page, sorted({page.parents[p] for p in places if p >= 0} - {-1}), one)

    return {" ": below, ">": children, "+": next_to, "~": behind}.get(axis, above)


def _selector(path: list[tuple]) -> Callable[[_Page, int, bool], list[int]]:
    if not path:
        return lambda page, start, one: [start] if start >= 0 else []
    *steps, last = [_step(s) for s in path]

    def select(page: _Page, start: int, one: bool) -> list[int]:
        places = [start]
        for step in steps:
            places = step(page, places, False)
            if not places:
                return places
        return last(page, places, one)

    return select


# -- rules --------------------------------------------------------------------------------


def _value(row: tuple) -> Callable[[_Page, int], str | None]:
    _, _, path, take, cleanup, _ = row
    select, clean = _selector(path), CLEANUPS.get(cleanup)

    def value(page: _Page, start: int) -> str | None:
        found = select(page, start, True)
        if not found:
            return None
        raw = page.text_of(found[0]) if take is None else page.attrs(found[0]).get(take)
        if raw and clean:
            raw = clean(raw)
        return raw or None

    return value


def _fields(rows: list[tuple]) -> Callable[[_Page, int], dict[str, str]]:
    """Fields in order of their names. Of the rules of the least rank that give any value, the least value counts."""
    ranked: dict[tuple, list] = {}
    for r in sorted(rows, key=lambda r: r[:2]):
        ranked.setdefault(r[:2], []).append(_value(r))
    tried = [(field, values[0] if len(values) == 1 else _least(values)) for (field, _), values in ranked.items()]

    def fields(page: _Page, start: int) -> dict[str, str]:
        out: dict[str, str] = {}
        for field, value in tried:
            if field not in out and (found := value(page, start)) is not None:
                out[field] = found
        return out

    return fields


def _least(values: list) -> Callable[[_Page, int], str | None]:
    return lambda page, start: min((v for value in values if (v := value(page, start)) is not None), default=None)


def _record(row: tuple) -> Callable[[_Page], list[dict[str, str]]]:
    _, path, skip, rows = row
    select, fields = _selector(path), _fields(rows)
    required = {r[0] for r in rows if r[5]}

    def record(page: _Page) -> list[dict[str, str]]:
        scopes = select(page, -1, False)[max(skip, 0) :]
        return [f for n in scopes if required <= (f := fields(page, n)).keys()]

    return record


def _shop(rules: list[tuple], records: list[tuple]):
    return _fields(rules), [(r[0], _record(r)) for r in records]


class _Maps:
    """Maps of texts, until they become one Arrow array."""

    def __init__(self) -> None:
        self.ends: list[int] = [0]
        self.keys: list[str] = []
        self.values: list[str] = []

    def add(self, one: dict[str, str]) -> None:
        self.keys += one
        self.values += one.values()
        self.ends.append(len(self.keys))

    def array(self) -> pa.MapArray:
        return pa.MapArray.from_arrays(
            pa.array(self.ends, pa.int32()), pa.array(self.keys, pa.string()), pa.array(self.values, pa.string())
        )


def _lists(ends: list[int], values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _found(html: pa.Array, domains: pa.Array, shops: dict) -> pa.StructArray:
    missing, fields, rows = [], _Maps(), _Maps()
    names: list[str] = []
    row_ends, record_ends = [0], [0]
    for value, domain in zip(html, domains.to_pylist()):
        shop, text = shops.get(domain), value.as_py()
        missing.append(shop is None or text is None)
        if missing[-1]:
            fields.add({})
        else:
            own, records = shop
            page = _Page(text)
            fields.add(own(page, -1))
            for name, record in records:
                for one in record(page):
                    rows.add(one)
                names.append(name)
                row_ends.append(len(rows.ends) - 1)
        record_ends.append(len(names))
    records = pa.StructArray.from_arrays([pa.array(names, pa.string()), _lists(row_ends, rows.array())], ["record", "rows"])
    return pa.StructArray.from_arrays(
        [fields.array(), _lists(record_ends, records)], ["fields", "records"], mask=pa.array(missing, pa.bool_())
    )


# Workers receive this module by value, so it needs no install on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def page_rules(html: Column, domain: Column, rules: Rules) -> Column:
    """HTML -> ``struct<fields, records>`` by the rules of the page's ``domain``;
    NULL without HTML and for a domain without rules.

    Marked non-deterministic for the same reason as :func:`page_dom`.
    """

    def batches(pages: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        shops = {name: _shop(*rows) for name, rows in rules.items()}
        for texts, domains in pages:
            yield _found(texts, domains, shops)

    return F.arrow_udf(batches, FOUND).asNondeterministic()(html, domain)
