"""Anchors as a browser sees them."""

import time

import duckdb
import pytest

from offerloom.operators import anchors, links as lk
from offerloom.operators.anchors import anchors_of_text


def hrefs(html):
    return anchors_of_text(html)[0]


def outside(html):
    return [a for a, section in zip(*anchors_of_text(html)) if not section]


@pytest.mark.parametrize(
    "html, found",
    [
        ("<a onclick=\"go('x', href='/fake')\" href=\"/real\">", ["/real"]),
        ('<a title="5 > 3" href="/gt">', ["/gt"]),
        ('<a href="/&aring;&#229;?a=1&amp;b&copy=3&lang&notx;">', ["/åå?a=1&b&copy=3&lang&notx;"]),
        ("<template><a href=/no><template></template></template><a href=/y>", ["/y"]),
        ("<a href=1 href=2><A\nHREF = '3' ><a/href=4><a href><a name=x><abbr href=5>", ["1", "3", "4", ""]),
        ("<p <a href=x><a href=y>", ["y"]),
        ("<!-- <a href=1> --><!--><a href=2><!doctype html><?x <a href=3>?><a href=4></ <a href=5><a href=6>", ["2", "4", "6"]),
        ("<script><a href=1></scripty></script ><style><a href=2></STYLE><noscript><a href=3></noscript><a href=4>", ["4"]),
        ("<script><a href=1>", []),
        ('<a href="/cut', []),
        ("<a href='/cut><a href=2>", []),
        ("", []),
    ],
)
def test_targets(html, found):
    assert hrefs(html) == found


@pytest.mark.parametrize(
    "html, found",
    [
        ("<nav><nav><a href=1></nav><a href=2></nav><a href=3>", ["3"]),
        ("<div><nav><div><a href=1><div></a></div></div><a href=2></nav><a href=3></div>", ["3"]),
        ("<header><p><a href=1></header><a href=2><footer><a href=3>", ["2"]),
        ("<nav><span></div><a href=1></span></nav><a href=2>", ["2"]),
        ("<div><nav><table><tr><td></div></nav><a href=1></table></nav><a href=2>", ["2"]),
        ("</nav></nav><a href=1><nav-bar><a href=2></nav-bar>", ["1", "2"]),
        ("<nav><br></br><img></img><a href=1></nav><a href=2>", ["2"]),
    ],
)
def test_sections(html, found):
    assert outside(html) == found


def test_broken_text_takes_time_in_proportion_to_its_length():
    start = time.perf_counter()
    for piece in ('<a href="', "<a href='x", "<a = ", "<div", "<!--", "<a b=c ", "<script>", "</a", "< "):
        anchors_of_text(piece * 50_000)
    anchors_of_text("<div>" * 20_000 + "<a href=1>" * 20_000)
    assert time.perf_counter() - start < 10


def test_rows_in_order_without_a_shuffle(spark):
    html = "<header><a href='/h'></a></header><a href='/a'></a><a href='#'></a><a href='/a'></a><a href='/b'></a><a href='/a'></a><a href='/b'></a><a href='/b'></a>"
    df = spark.createDataFrame([(1, html), (2, None), (3, "<p>"), (1, html)], "page_id int, html string")
    found = lk.homepage_links(df, drop_repeats=True)
    assert sorted(tuple(r) for r in found.collect()) == sorted([(1, 0, "/a"), (1, 3, "/b"), (1, 4, "/a"), (1, 5, "/b")] * 2)
    none = lk.page_anchors("html")
    rows = df.select("page_id", none.alias("a")).collect()
    assert [r.a if r.a is None else len(r.a) for r in rows] == [8, None, 0, 8]
    for frame in (found, lk.links(df, [("^/[a-z]", "X")], drop_repeats=True)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan and plan.count("EvalPython") == 1


def test_ordinary_targets_are_read_without_walking_attributes(monkeypatch):
    monkeypatch.setattr(anchors, "_href", None)
    html = """<nav><a href="/n">n</a></nav><script>x = "<a href='/no'>"</SCRIPT><STYLE/><a href="/no"></style >
      <a class="c" data-x="a > b" href="/p">p</a><a href="">e</a>"""
    assert anchors_of_text(html) == (["/n", "/p", ""], [True, False, False])


def test_raw_text_ends_at_its_own_end_tag():
    html = '<textarea><a href="/1"></title></textareas></TextArea x><a href="/2"><title/><a href="/3"></title><scripts><a href="/4"><xmp><a href="/5">'
    assert anchors_of_text(html)[0] == ["/2", "/4"]


def test_links_per_domain_counts_repeated_links(spark, tmp_path):
    """A link right behind one with the same target is a link like others, and so are pages that come twice."""
    from compare import compare
    from workload.queries import ORACLES, QUERIES

    def page(*hrefs):
        return "".join(f'<a href="{h}">x</a>' for h in hrefs)

    rows = [
        (1, "https://www.a.se/c/", page("/p/1", "/p/1", "/p/2", "/p/1")),
        (1, "https://www.a.se/c/", page("/p/1", "/p/1", "/p/2", "/p/1")),
        (2, "https://b.se/c/", page("/q", "/q", "/q")),
        (None, "https://b.se/d/", page("/q", "/r")),
    ]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    name = "links_per_domain"
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], str(tmp_path)) == ""
    found = {r.domain: (r.n_links, r.n_distinct) for r in QUERIES[name](spark, str(tmp_path)).collect()}
    assert found == {"a.se": (8, 2), "b.se": (5, 2)}
