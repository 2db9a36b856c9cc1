"""Selectors against a search written out in Python, and rules over the cascade."""

import pytest
from pyspark.sql import functions as F

from offerloom import plans
from offerloom.operators import elements as el, listings as ls
from offerloom.operators.profiles import Profile, Record, Registry, Rule, default_registry
from offerloom.operators.selectors import compile_selector, select_text

HTML = """<body><div id="main" class="a box"><ul class="l"><li>One</li><li class="x y"><a href="/p/1">Two</a><a href="/q">Q</a></li>
<li><a href="/p/2" data-k="u-v">three  Words</a></li></ul><h3>About us</h3><div class="body"><p>first</p><p class="hid">sec</p></div>
<dl><dt>k1</dt><dd>v1</dd><dt>k2</dt><dd>v2</dd></dl></div><div class="b"><a href="/p/9"><img src="i.png"></a></div></body>"""

FOUND = {
    "li a": ["Two", "Q", "three  Words"],
    "ul > li:nth-child(2) > a": ["Two", "Q"],
    'a[href^="/p/"]': ["Two", "three  Words", ""],
    "a[href$='q']": ["Q"],
    "a[data-k*=-]": ["three  Words"],
    "li + li > a:first-child": ["Two", "three  Words"],
    "li ~ li.x a": ["Two", "Q"],
    "#main > h3:text('about') + .body p": ["first", "sec"],
    "p:not(.hid)": ["first"],
    "p:not([class])": ["first"],
    "dl:has(dt:text-is('k2')) dd:nth-of-type(2)": ["v2"],
    "ul:has(> dt)": [],
    "ul:not(:has(> dt)) > li:first-child": ["One"],
    "img ..": [""],
    "li:last-child a": ["three  Words"],
    "*.x.y > a:last-child": ["Q"],
    "li:text-is('One')": ["One"],
    "dt:first-of-type + dd": ["v1"],
    "div.body > *": ["first", "sec"],
    "body > div:last-child > a": [""],
    ".nope a": [],
    "div[class~=box] > dl > dd": ["v1", "v2"],
}


def test_selectors(spark):
    df = spark.createDataFrame([(HTML,)], "html string").select(el.page_dom(F.col("html")).alias("d"))
    texts = [F.transform(select_text(F.col("d"), s), lambda n: F.trim(el.text_of(F.col("d"), n))) for s in FOUND]
    assert dict(zip(FOUND, df.select(*texts).first())) == FOUND


@pytest.mark.parametrize("bad", ["", "a,b", "a:hover", "p:not(a b)", "x:has(a b)", "a >", ":scopex"])
def test_unreadable_selectors_are_refused(bad):
    with pytest.raises(ValueError):
        compile_selector(bad)


def test_every_known_shop_has_readable_rows(spark):
    registry = default_registry()
    for cards in (False, True):
        frame = registry.rules_frame(spark, cards=cards)
        assert frame.count() >= 20
    assert len({p.domain for p in registry.profiles.values() if p.rules or p.records}) >= 30


def _details(spark, registry, rows):
    pages = spark.createDataFrame([(u, u, h, 200) for u, h in rows], "request_url string, url string, html string, status int")
    requests = spark.createDataFrame([(u,) for u, _ in rows], "request_url string")
    return plans.scrape_details(requests, pages.withColumn("fetched_at", F.lit("2024-01-01").cast("timestamp")), registry)


def test_rules_win_over_the_cascade_and_leave_the_rest_to_it(spark):
    jsonld = '<script type="application/ld+json">{"@type":"Product","name":"N","gtin13":"4006381333931","offers":{"price":5,"priceCurrency":"SEK"}}</script>'
    registry = Registry()
    registry.register_profile(Profile("a.se", "SEK", rules=(Rule("price_text", "b.p", required=True), Rule("brand", "i"))))
    rows = [
        ("https://a.se/1", f"{jsonld}<b class='p'>7</b><i>B</i>"),
        ("https://a.se/2", jsonld),
        ("https://a.se/3", "<p>nothing</p>"),
        ("https://b.se/4", jsonld),
        ("https://a.se/5", None),
    ]
    got = _details(spark, registry, rows)
    offers = {r.url[-1]: r for r in got.offers.collect()}
    assert {k: (r.price, r.name, r.brand, r.strategy) for k, r in offers.items()} == {
        "1": (700, "N", "B", "rules"),
        "2": (500, "N", None, "schema-json"),
        "4": (500, "N", None, "schema-json"),
    }
    reasons = {r.url[-1]: r.reject_reason for r in got.rejected.collect()}
    assert reasons["3"] == "Cannot extract price_text" and reasons["5"] and set(reasons) == {"3", "5"}


def test_rules_and_cascade_share_one_pass(spark):
    """One scan and one Python step for the pages of all shops; one more pass for all extractors."""
    registry = default_registry()

    def fn(frames):
        yield from frames

    for k in range(3):
        registry.register_extractor(f"own{k}.se", fn, "url string, html string")
    pages = spark.createDataFrame([("https://a.se", "<p>")], "url string, html string")
    for some, passes in ((default_registry(), (1, 0)), (registry, (1, 1))):
        plan = plans.jobs.extract_by_shop(pages, some)._jdf.queryExecution().optimizedPlan().toString()
        assert (plan.count("ArrowEvalPython"), plan.count("MapInPandas")) == passes
        assert plan.count("LogicalRDD") - plan.count("[domain#") <= sum(passes)


def test_a_stored_job_reads_its_pages_once(spark, tmp_path):
    jsonld = '<script type="application/ld+json">{"@type":"Product","name":"N","offers":{"price":5,"priceCurrency":"SEK"}}</script>'
    pages = spark.createDataFrame([(f"https://a.se/{i}", f"https://a.se/{i}", jsonld if i % 2 else "<p>", 200) for i in range(6)], "request_url string, url string, html string, status int")
    pages = pages.withColumn("fetched_at", F.lit("2024-01-01").cast("timestamp"))
    requests = spark.createDataFrame([(f"https://a.se/{i}",) for i in range(6)], "request_url string")
    plain, stored = plans.scrape_details(requests, pages), plans.scrape_details(requests, pages, store=str(tmp_path / "judged"))
    for name in ("offers", "rejected", "coverage"):
        a, b = getattr(plain, name), getattr(stored, name)
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
        plan = b._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "html" not in plan


def test_extractors_with_clashing_columns_are_refused(spark):
    registry = Registry()
    registry.register_extractor("a.se", lambda f: f, "x int")
    registry.register_extractor("b.se", lambda f: f, "x string")
    with pytest.raises(ValueError, match="differs in type"):
        registry.extract_all_custom(spark.createDataFrame([("a.se",)], "domain string"))


def test_category_page_to_listing_records(spark):
    """The record of a category page, field by field."""
    html = """<div class="breadcrumbs"><ul><li><a href="/">Hem</a></li><li><a href="/varumarken/">Märken</a></li><li><strong> Nord </strong></li></ul></div>
    <ol><li class="item product-item"><strong class="product-item-name"><a href="/stol?x=1#y"> Stol  Ek </a></strong></li>
    <li class="product-item"><b>advert</b></li>
    <li class="product-item"><strong class="product-item-name"><a href="https://www.gardenstore.se/bord">Bord</a></strong></li>
    <li class="product-item"><strong class="product-item-name"><a href="/stol?x=1#y">Stol igen</a></strong></li></ol>"""
    url = "https://www.gardenstore.se/varumarken/nord"
    pages = spark.createDataFrame([("j", 1, url + "?p=1", html), ("j", 1, "https://unknown.se/c", html)], "run string, page_number int, url string, html string")
    got = sorted(map(lambda r: r.asDict(recursive=True), plans.explore_category_pages(pages).collect()), key=lambda r: r["popularity_index"])
    path = [{"name": "Märken", "url": "https://www.gardenstore.se/varumarken"}, {"name": "Nord", "url": url}]
    common = {"run": "j", "page_number": 1, "category_url": url + "?p=1", "popularity_category": path, "brand": None, "price": None, "retailer_domain": "gardenstore.se"}
    first, second = got
    assert first.pop("url").startswith("https://www.gardenstore.se/stol")
    assert first == common | {"name": "Stol  Ek", "position": 1, "popularity_index": 1}
    assert second == common | {"name": "Bord", "position": 3, "popularity_index": 2, "url": "https://www.gardenstore.se/bord"}


def test_records_keep_order_and_drop_items_without_a_required_field(spark):
    registry = Registry()
    rows = Record("reviews", "li", (Rule("content", "p", required=True), Rule("score_text", "b")))
    empty = Record("reviews", "section", (Rule("content", ":scope"),))
    registry.register_profile(Profile("a.se", records=(empty, rows)))
    pages = spark.createDataFrame([("https://a.se/", "<ul><li><p>x</p><b>4,5/5</b></li><li><b>1</b></li><li><p>y</p></li></ul>")], "url string, html string")
    from offerloom.operators.fields import record_reviews, rule_extract

    found = rule_extract(pages, registry.rules_frame(spark)).select(record_reviews(F.col("records")).alias("r")).first().r
    assert [(r.score, r.content) for r in found] == [(4.0, "x"), (None, "y")] or [(r.score, r.content) for r in found] == [(4.5, "x"), (None, "y")]
    assert ls.rule_listings(pages, registry).count() == 0
