"""Anchors of a page: the second step that runs Python code per page.

One Arrow pass reads tags as a browser does: quoted values may hold ``>``, what
comments, scripts, styles, text areas and the like hold is no markup, elements
nest, and what is inside a ``template`` is not on the page. Far less is kept
than :func:`page_dom` keeps: the link targets in document order, each with
whether it stands inside a header, a navigation or a footer.
"""

from __future__ import annotations

import re
import sys
from html import unescape
from html.entities import html5

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

ANCHORS = "array<struct<href: string, section: boolean>>"

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
# an end tag does not reach across these
BARRIERS = frozenset("html table td th caption marquee object template".split())
TABLE_PARTS = frozenset("table caption colgroup tbody td tfoot th thead tr".split())
TABLE_BARRIERS = frozenset("html table template".split())
# elements that an end tag of an ordinary element does not close
SPECIAL = frozenset(
    """address article aside blockquote body button caption center col colgroup dd details dir div dl dt
    fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html li main menu nav
    ol p pre section summary table tbody td tfoot th thead tr ul object marquee template""".split()
)
SECTIONS = frozenset(("header", "nav", "footer"))

_REST = r"""(?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?+)*+"""
# names in either case of A-Z alone; what a raw element holds is read with its tag
_CASED = {name: "".join(f"[{c}{c.upper()}]" for c in name) for name in sorted(RAW)}
_RAW = "|".join(_CASED.values())
_HELD = "|".join(rf"{cased}(?=[\s/>]){_REST}(?:\Z|>(?:.*?(?=(?i:</{name})[\s/>])|.*))" for name, cased in _CASED.items())
_TAGS = re.compile(
    rf"""<(?:(?!(?:{_RAW})[\s/>])(/?)([a-zA-Z][^\s/>]*+)({_REST})(>|\Z)
         |(?=({_RAW})[\s/>])(?:{_HELD})
         |!--(?:-?>|.*?(?:--!?>|\Z))
         |[!?][^>]*+>?
         |/[^a-zA-Z][^>]*+>?)""",
    re.S | re.X,
)
_ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?+""")
# an ordinary target, behind ordinary attributes of other names
_QUICK_HREF = re.compile(r"""(?:\s++(?!href[\s=])[a-z-]++="[^"]*+")*+\s++href="([^"&]*+)\"""").match
_REFERENCE = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*)(;?)(=?)")


def _plain(value: str) -> str:
    """A value without character references. One without its semicolon stays
    where it could be the name of a parameter."""

    def one(m: re.Match) -> str:
        text = m[0][: len(m[0]) - len(m[2])]
        if text[1] != "#" and (text[1:] not in html5 or (not m[1] and m[2])):
            return m[0]
        return unescape(text) + m[2]

    return _REFERENCE.sub(one, value) if "&" in value else value


def _href(rest: str) -> str | None:
    """The first ``href`` of a tag; empty if it has no value, None without one."""
    for m in _ATTRIBUTE.finditer(rest):
        if m[1].lower() == "href":
            return _plain(next((v for v in m.group(2, 3, 4) if v is not None), ""))
    return None


def _closed(names: list[str], name: str) -> list[str]:
    """Take what an end tag closes off the open elements. There is one of that name."""
    barriers = TABLE_BARRIERS if name in TABLE_PARTS else BARRIERS
    for i in range(len(names) - 1, -1, -1):
        at = names[i]
        if at == name:
            # a formatting element ends alone, others with all that they hold
            stop = i + 1 if name in FORMATTING else len(names)
            gone = names[i:stop]
            del names[i:stop]
            return gone
        if at in barriers or (at in SPECIAL and name not in SPECIAL and name not in FORMATTING):
            break
    return []


def anchors_of_text(html: str) -> tuple[list[str], list[bool]]:
    """Targets in document order, and whether each is inside a section."""
    targets: list[str] = []
    sections: list[bool] = []
    names: list[str] = []  # the open elements
    count = dict.fromkeys(("template", *SECTIONS), 0)  # how many of a name are open
    inside = 0
    # what a raw element holds is read with its tag, so one call finds all tags
    for end, name, rest, whole, raw in _TAGS.findall(html):
        if raw:  # its end tag, if any, comes next
            name = raw.lower()
        elif not whole:  # a comment, or cut off by the end of the text
            continue
        elif not name.islower():
            name = name.lower()
        if end:
            if names and names[-1] == name:
                names.pop()
                count[name] -= 1
                if name in SECTIONS:
                    inside -= 1
            elif count.get(name):  # else no open element answers it
                for g in _closed(names, name):
                    count[g] -= 1
                    inside -= g in SECTIONS
        elif name == "a":
            if not count["template"]:
                quick = _QUICK_HREF(rest)
                href = quick[1] if quick else _href(rest)
                if href is not None:
                    targets.append(href)
                    sections.append(inside > 0)
            names.append(name)
            count[name] = count.get(name, 0) + 1
        elif not raw and name not in VOID:
            names.append(name)
            if name in count:
                count[name] += 1
                if name in SECTIONS:
                    inside += 1
            else:
                count[name] = 1
    return targets, sections


def _batch(html: pa.Array) -> pa.Array:
    sizes, targets, sections = [], [], []
    for text in html.to_pylist():
        if text is None:
            sizes.append(None)
            continue
        own, inside = anchors_of_text(text)
        targets += own
        sections += inside
        sizes.append(len(own))
    held = pa.array(sizes, pa.int32())
    ends = pc.cumulative_sum(pc.fill_null(held, 0))
    starts = pa.concat_arrays([pa.array([0], pa.int32()), ends])
    # a list that starts at NULL is NULL
    known = pa.concat_arrays([pc.is_valid(held), pa.array([True])])
    offsets = pc.if_else(known, starts, pa.scalar(None, pa.int32()))
    rows = pa.StructArray.from_arrays([pa.array(targets, pa.string()), pa.array(sections, pa.bool_())], ["href", "section"])
    return pa.ListArray.from_arrays(offsets, rows)


# Workers receive this module by value, so it needs no install on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def page_anchors(html: Column | str) -> Column:
    """HTML -> ``array<struct<href, section>>`` in document order; NULL for NULL.

    Marked non-deterministic for the same reason as :func:`page_dom`.
    """
    return F.arrow_udf(_batch, ANCHORS).asNondeterministic()(html)


def without_repeats(anchors: Column) -> Column:
    """Anchors but those with the target of the one right before them."""
    return F.filter(
        anchors, lambda a, i: (i == 0) | (a["href"] != F.get(anchors, i - 1)["href"])
    )
