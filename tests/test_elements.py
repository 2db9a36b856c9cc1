"""Pages read straight into Arrow columns against the parser's reading."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from offerloom.operators import elements as el
from offerloom.operators.selectors import select_text

PIECES = """<div>|<DIV class="a b">|</div>|<p>|</p>|<p/>|<li>|<li class=x>|</li>|<br>|<br/>|<IMG SRC="a&amp;b.jpg" alt>|<a href=/x/>|
<a href='x'/>|text|a & b|&amp;|&lt|&copy=3|<|< |<3|<!-- c -->|<!--|-->|<!doctype html>|<![CDATA[x]]>|<!x|>|<?php a ?>|</|</>|</ p>|</p x>|
<script>|<script src=a>|</SCRIPT >|<script/>|<style>|</style>|if (a<b) "<p>"|<a b = c d= e>|<a b="1"c="2">|<a b==c>|<a b=c=d>|<a b="x|<a b|
<td>|<tr>|</tr>|</table>|<o:p>|å|\U0001f600|\x0b|<p\x0bclass="q">|<a B=1 b=2>|<a x=`y`>|<a é=1>|<a b=é>|<a x=y/>|\x00""".replace("\n", "").split("|")


def rows_of(html):
    found = el._dom_batch(pa.array(html, pa.string())).to_pylist()
    for page in found:
        for node in page["nodes"] or ():
            node["attrs"] = dict(node["attrs"])
    return found


def test_columns_hold_what_the_parser_reads(monkeypatch):
    monkeypatch.setattr(el, "CHUNK", 300)  # many chunks in a batch
    rnd = random.Random(3)
    html = ["".join(rnd.choices(PIECES, k=rnd.randint(0, 9))) for _ in range(4000)] + [a + b for a in PIECES for b in PIECES]
    html[5:5] = [None, "", None]
    nothing = {"text": None, "nodes": None}
    assert rows_of(html) == [el.dom_of_text(h) or nothing for h in html]


def test_ordinary_markup_needs_no_parser(monkeypatch):
    html = """<!DOCTYPE html><html><head><script type="a/b">if (a < b && c) x = "<p>";</script><!-- c --></head><body class="x y">
      <a href="/p?a=1&amp;b=2" data-x='{"k": 1}' hidden>1 &lt; 2</a><br/><IMG src=/i.png alt=""><ul><li>a<li>b</ul> a < b</body></html>"""
    expected = el.dom_of_text(html)
    monkeypatch.setattr(el, "_Nodes", None)
    assert rows_of([html]) == [expected]


def test_nodes_leave_the_worker_chunk_by_chunk(spark, monkeypatch):
    monkeypatch.setattr(el, "CHUNK", 100)
    html = [None, "<p>0</p>", "", "<b>" * 80, *(f"<i>{k}</i>" for k in range(40)), None]
    sent = [*el._dom_batches(iter([pa.array([], pa.string()), pa.array(html, pa.string())]))]
    assert len(sent) > 4 and max(map(len, sent)) < 15
    assert pa.concat_arrays(sent).to_pylist() == el._dom_batch(pa.array(html, pa.string())).to_pylist()
    pages = spark.createDataFrame([*enumerate(html)], "k int, h string").coalesce(1).select("k", "h", el.page_dom(F.col("h")).alias("d"))
    rows = {r["k"]: r["d"] for r in pages.collect()}
    assert [rows[k]["text"] for k in range(len(html))] == [(el.dom_of_text(h) or {"text": None})["text"] for h in html]


@pytest.mark.parametrize(
    "selector, texts",
    [("b ~ i", ["2", "4"]), ("b + i", ["2", "4"]), ("u b", ["3"]), ("i ..", ["1234", "34"]), ("s u > b ~ i", ["4"]), ("q b", []), ("q ~ b", []), ("q ..", [])],
)
def test_steps_go_on_from_all_places(spark, selector, texts):
    page = spark.createDataFrame([("<s><b>1</b><i>2</i><u><b>3</b><i>4</i></u></s>",)], "h string")
    dom = page.select(el.page_dom(F.col("h")).alias("d"))
    found = F.transform(select_text(F.col("d"), selector), lambda n: el.text_of(F.col("d"), n))
    assert dom.select(found).first()[0] == texts


def test_category_pages_are_dealt_once_over_a_stated_number_of_tasks(spark, tmp_path):
    from workload.shops import category_pages

    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_discount double"
    lines = [(1, 7, 3, 2, 1.0, 0.0), (1, 5, 3, 1, 1.0, 0.0), (2, 5, 3, 1, 1.0, 0.0), (None, 5, None, 1, 1.0, 0.0), (1, None, 3, 3, 1.0, 0.0)]
    spark.createDataFrame(lines, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    pages = category_pages(spark, str(tmp_path))
    rows = {(r["run"], r["page_number"]): r["html"] for r in pages.collect() if r["html"] is not None}
    assert sorted(rows) == [(3, 1), (3, 2)]
    assert [p.split('"')[0] for p in rows[3, 1].split("/p/")[1:]] == ["5", "7"]
    plan = pages._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange ") == plan.count("REPARTITION_BY_NUM") == 1
