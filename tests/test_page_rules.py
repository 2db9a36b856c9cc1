"""Rules read off a page against the same rules as expressions over its nodes."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from offerloom.operators import elements as el, fields as fd, listings as ls, page_rules as pr
from offerloom.operators.profiles import Profile, Record, Registry, Rule, default_registry
from test_elements import PIECES
from test_selectors import FOUND, HTML
from workload.shops import LAYOUTS

TEXTS = ["", " ", "\xa0", "a", " a  b\t\xa0c ", "k: v : w", ":", "k:", "one \n two", "\n x\ny ", "/a/b?c=1?d", "a/", "?", "a  ", " \x85", "a\r\n", "a \x85 ",
         "  a  ", "a   ", "\x1ca\x1f", "a\xa0\n ", "a \u2028", " \u2029", " a \u2028 ", "Éİ x"]


def test_cleanups_treat_text_as_the_expressions_do(spark):
    assert pr.CLEANUPS.keys() == fd.CLEANUPS.keys()
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string").orderBy("i")
    for name, clean in fd.CLEANUPS.items():
        assert [r.v for r in rows.select(clean(F.col("t")).alias("v")).collect()] == [pr.CLEANUPS[name](t) for t in TEXTS], name


def _both(spark, registry, html, cards):
    """What the rules of every shop find on every page, read in Python and as expressions."""
    rules = registry.rule_rows(cards)
    pages = spark.createDataFrame([*enumerate(html)], "page int, html string").crossJoin(
        spark.createDataFrame([(d,) for d in [*rules, "unknown.se"]], "domain string")
    )
    read = pages.select("page", "domain", pr.page_rules(F.col("html"), F.col("domain"), rules).alias("f")).select("page", "domain", "f.*")
    dom = F.col("dom")
    nodes = pages.select("page", "domain", el.page_dom(F.col("html")).alias("dom")).join(registry.rules_frame(spark, cards), "domain")
    known = dom["nodes"].isNotNull()
    over = nodes.select(
        "page",
        "domain",
        F.when(known, fd.rule_fields(dom, F.col("rules"))).alias("fields"),
        F.when(known, fd.rule_records(dom, F.col("records"))).alias("records"),
    )
    found = [{(r.page, r.domain): (r.fields, r.records) for r in rows.collect()} for rows in (read, over)]
    assert all(found[0].pop((page, "unknown.se")) == (None, None) for page in range(len(html)))
    return found


def test_rules_of_the_known_shops_find_the_same(spark):
    rnd = random.Random(5)
    html = [None, "", HTML, *(x[1] for x in LAYOUTS)]
    html += ["".join(rnd.choices(LAYOUTS, k=2)[0][1] + "".join(rnd.choices(PIECES, k=2)) for _ in range(2)) for _ in range(10)]
    for cards in (False, True):
        read, over = _both(spark, default_registry(), html, cards)
        assert read == over
        assert sum(bool(f) or any(r["rows"] for r in rs or ()) for f, rs in read.values()) > 20


SELECTORS = [*FOUND, "li", "*", "..", "p ..", "li ~ *", "li + *", "* > *", "div li > *", "p:not(:has(b)) b", "div:has(> p) ~ p", "b:last-child", "p:nth-child(2)",
             "a[href='']", "a[href]:not([href^='/x'])", "p:text('')", "p:text('A')", "[class~='x']", "[class*='x']", "b .. > p", "li:nth-of-type(2) ~ li", "div div p"]
MARKS = ["<div>", "</div>", "<p>", "</p>", "<li>", "<li class='x y'>", "<b>", "</b>", "<a href='/p/1'>", "<a href>", "</a>", "<p class=x>", "a", " B ", "&amp;", "<a href='&#47;x'>", "<ul>", "</ul>", "<i/>", "<p class='&#120;'>", "<P CLASS=q a='1'b>"]


def test_selectors_find_the_same_from_the_page_and_within_scopes(spark):
    rnd = random.Random(7)
    html = ["".join(rnd.choices(MARKS, k=rnd.randint(1, 30))) for _ in range(40)] + [HTML]
    registry = Registry()
    for k, s in enumerate(SELECTORS):
        within = (Rule("t", ":scope"), Rule("n", f":scope > {s}" if s != ".." else ".."), Rule("c", ":scope", take="class"))
        registry.register_profile(
            Profile(f"s{k}.se", rules=(Rule("v", s, cleanup="squash"), Rule("w", s, take="href", cleanup=None)), records=(Record("r", s, within, k % 2),))
        )
    read, over = _both(spark, registry, html, False)
    assert read == over
    assert sum(bool(f) for f, _ in read.values()) > 300


def test_ranks_values_and_required_fields(spark):
    registry = Registry()
    rules = (Rule("a", "i", rank=1), Rule("a", "b"), Rule("a", "u"), Rule("z", "s"), Rule("m", "s", required=True))
    registry.register_profile(Profile("a.se", rules=rules, records=(Record("r", "p", (Rule("k", "b", required=True), Rule("v", "i"))),)))
    html = ["<b>2</b><u>1</u><i>0</i>", "<i>0</i><s> </s>", "<p><b>k</b><i>v</i><p><i>v</i><p><b>l</b>", "<p><b> </b>"]
    read, over = _both(spark, registry, html, False)
    assert read == over
    assert [read[k, "a.se"][0] for k in range(4)] == [{"a": "1"}, {"a": "0"}, {"a": "k"}, {}]
    assert read[2, "a.se"][1][0]["rows"] == [{"k": "k", "v": "v"}, {"k": "l"}]


def test_an_attribute_that_no_rule_looks_at_is_not_read(monkeypatch):
    seen = []
    monkeypatch.setattr(pr, "attributes", lambda rest: seen.append(rest) or el.attributes(rest))
    registry = Registry()
    registry.register_profile(Profile("a.se", rules=(Rule("a", "div.x a", take="href"),)))
    shops = {d: pr._shop(*rows) for d, rows in registry.rule_rows().items()}
    html = '<p class="y"><div class="x"><b id=1></b><a href="/1"></a><a href="/2"></a></div><div id="2"></div>'
    found = pr._found(pa.array([html, None]), pa.array(["a.se", "a.se"]), shops).to_pylist()
    assert found == [{"fields": [("a", "/1")], "records": []}, None]
    assert seen == [' class="x"', ' href="/1"']


def test_listings_of_category_pages_take_no_nodes_out_of_the_workers(spark):
    """What leaves Python is what the rules found, and no expression walks nodes (F1, F2)."""
    cards = "".join(f'<li class="product-item"><b class="product-item-name"><a href="/p/{k}">N{k}</a></b></li>' for k in range(3))
    page = f'<div class="breadcrumbs"><ul><li><a href="/">H</a></li><li><a href="/c/">All</a></li><li><strong>Own</strong></li></ul></div><li class="product-item">ad</li>{cards}'
    rows = [("https://www.gardenstore.se/c/1?p=2", page), ("https://gardenstore.se/c", None), ("https://x.se/c", page), (None, page), ("no address", page)]
    found = ls.rule_listings(spark.createDataFrame(rows, "url string, html string"), default_registry())
    assert sorted((r.position, r.url, r.name, len(r.popularity_category)) for r in found.collect()) == [
        (k + 2, f"https://www.gardenstore.se/p/{k}", f"N{k}", 2) for k in range(3)
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "nodes" not in plan and "Join" not in plan


@pytest.mark.parametrize(
    "html, text",
    [("<script>a</ſcript>b</script>c", None), ("<script>a</SCRİPT>b", None), ("<script>a<b></ script >c", None), ("<style>a</scrıpts>b</style >c", None), ("<script>a", ""),
     ("<script/>a<scripts>b", "ab"), ("<STYLE x=a/>a<b</style>c", "a<bc"), ("<script></script>x", "x"), ("ı<b>ſ</b>", "ıſ")],
)
def test_raw_elements_are_read_as_the_parser_reads_them(html, text):
    columns = el._Columns()
    columns.add(html)
    assert columns.texts == [el.dom_of_text(html)["text"]] and (text is None or columns.texts == [text])
    assert columns.tags == [n["tag"] for n in el.dom_of_text(html)["nodes"]]


def test_unended_markup_takes_time_in_proportion_to_its_length():
    import time

    start = time.perf_counter()
    for piece in ("<!--", "<a b='", "<script>", "<? ", "< ", "</p", "<p "):
        el.outline(piece * 50_000)
    assert time.perf_counter() - start < 5
