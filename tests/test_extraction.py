import json

import pytest
from pyspark.sql import functions as F

from offerloom.operators import elements as el, structured as st
from offerloom.operators.cascade import auto_extract, is_comparison_site
from offerloom.operators.markup import microdata_bag


def ld(*bodies):
    scripts = "".join(
        f'<script type="application/ld+json">{b if isinstance(b, str) else json.dumps(b)}</script>'
        for b in bodies
    )
    return f"<html><head>{scripts}</head><body>x</body></html>"


def run(spark, pages, **kw):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "id int, url string, html string")
    return [r.asDict() for r in auto_extract(df, **kw).orderBy("id").collect()]


URL = "https://www.shop.se/lamp?variant=2"


def product(**kw):
    return {"@type": "Product", "name": "Lamp", **kw}


JSONLD_CASES = [
    # plain object, number price
    (ld(product(offers={"price": 10.5, "priceCurrency": "SEK", "availability": "https://schema.org/InStock"})),
     dict(name="Lamp", price=10.5, currency="SEK", availability="in_stock", strategy="schema-json")),
    # text price with exactly three decimals stays a decimal
    (ld(product(Offers={"Price": "2.456"})), dict(price=2.456)),
    # list of blocks, @graph, type suffix
    (ld([{"@type": "Thing"}, {"@type": "http://schema.org/Product", "name": "N", "offers": {"price": "5"}}]), dict(name="N", price=5.0)),
    (ld({"@graph": [{"@type": "WebPage"}, product(offers=[{"price": 7}])]}), dict(price=7.0)),
    # best offer by URL
    (ld(product(offers=[{"url": "https://www.shop.se/lamp", "price": 1}, {"url": "https://www.shop.se/lamp?variant=2", "price": 2}, {"url": "/lamp?variant=3", "price": 3}])), dict(price=2.0)),
    # by identifier in the URL
    (ld(product(offers=[{"price": 1}, {"price": 4, "itemOffered": {"sku": "LAMP"}}])), dict(price=4.0)),
    # aggregate -> first inner offer
    (ld(product(offers={"@type": "AggregateOffer", "lowPrice": 1, "offers": [{"price": 8, "gtin13": "1234567890123"}]})), dict(price=8.0, gtin="1234567890123")),
    # priceSpecification first; gtin of the product when the offer has none
    (ld(product(gtin8="12345678", mpn="M1", offers={"price": 3, "priceSpecification": {"price": "9,90", "priceCurrency": "EUR"}})),
     dict(price=9.9, currency="EUR", gtin="12345678", mpn="M1")),
    # comments, CDATA, newlines, lenient JSON, broken blocks
    (ld("{bad", '/* c */{"@type":"Product",\n"name":"A","offers":{"price":"6"}}'), dict(name="A", price=6.0)),
    (ld("{'@type':'Product', name:'Q', offers:{price:6}}"), dict(name="Q", price=6.0)),
    # no price at all
    (ld(product(offers={"price": 0})), dict(price=None, reject_reason="PriceLiteUnavailableError")),
    ("<html>nothing</html>", dict(price=None, reject_reason="PriceLiteUnavailableError")),
]


def test_jsonld(spark):
    rows = run(spark, [(URL, h) for h, _ in JSONLD_CASES])
    for row, (_, want) in zip(rows, JSONLD_CASES):
        assert {k: row[k] for k in want} == want


MICRO = (
    '<div itemscope itemtype="https://schema.org/Product"><h1 itemprop="name">Desk</h1>'
    '<span itemprop="price" {content}>1 299,50 kr</span>{extra}</div>'
)
MARKUP_CASES = [
    (MICRO.format(content='content="12.5"', extra='<meta itemprop="priceCurrency" content="SEK"><link itemprop="availability" href="http://schema.org/OutOfStock">'),
     dict(name="Desk", price=12.5, currency="SEK", availability="out_of_stock", strategy="schema-attributes")),
    # price and currency from the text
    (MICRO.format(content="", extra=""), dict(price=1299.5, currency="kr")),
    # two names: no name
    (MICRO.format(content='content="3"', extra='<b itemprop="name">x</b>'), dict(name=None, price=3.0)),
    ('<meta property="og:title" content="Sofa &amp; Co"><meta content="2 499.00 SEK" property="g:price">',
     dict(name="Sofa & Co", price=2499.0, currency="SEK", strategy="opengraph")),
    ('<meta property="product:price:amount" content="45.50"><meta property="og:price:currency" content="EUR"><meta property="og:availability" content="InStock">',
     dict(price=45.5, currency="EUR", availability="in_stock")),
    ('<div class="x price-wrapper"><p><span aria-hidden="true"><span class="woocommerce-Price-amount">9</span></span>'
     '<span class="woocommerce-Price-amount">1.250,00<span class="woocommerce-Price-currencySymbol">kr</span></span></p></div>'
     '<p class="stock in-stock">yes</p><div class="woocommerce-product-gallery__wrapper"><a><img src="/a.jpg"></a><img></div>',
     dict(price=1250.0, currency="SEK", availability="in_stock", images=["/a.jpg"], strategy="woocommerce")),
]


def test_markup(spark):
    rows = run(spark, [(URL, h) for h, _ in MARKUP_CASES])
    for row, (_, want) in zip(rows, MARKUP_CASES):
        assert {k: row[k] for k in want} == want


def test_disabled_strategy(spark):
    html = ld(product(offers={"price": 5})) + '<meta property="og:price:amount" content="6">'
    rows = run(spark, [("https://kontorlige.nu/a", html), ("https://www.trouva.com/a", html), ("https://shop.se/a", html)])
    assert [r["strategy"] for r in rows] == ["opengraph", "opengraph", "schema-json"]


def test_comparison_site(value):
    assert value(is_comparison_site(F.col("d")), d="prisjakt.nu") is True
    assert value(is_comparison_site(F.col("d")), d="shop.se") is False


def test_elements(spark):
    html = "<ul class='a b'><li>One<li>Two <b>x</b></ul><br><p>T&ouml;</p><script>var a='<p>';</script>"
    df = spark.createDataFrame([(1, html)], "id int, html string")
    rows = el.page_elements(df).orderBy("pos").collect()
    assert [(r.tag, r.text) for r in rows] == [
        ("ul", "OneTwo x"), ("li", "One"), ("li", "Two x"), ("b", "x"), ("br", ""), ("p", "Tö"), ("script", "var a='<p>';"),
    ]
    assert rows[0].classes == ["a", "b"] and rows[3].parent == 2 and rows[0].parent is None


def test_microdata_bag(spark):
    html = '<div itemtype="http://schema.org/Product"><a itemprop="sku">1</a><a itemprop="sku" content="2">x</a><i itemprop="name">N</i></div><i itemprop="out">o</i>'
    df = spark.createDataFrame([(html,), (None,)], "html string").select(el.page_dom(F.col("html")).alias("d"))
    bags = [r[0] for r in df.select(microdata_bag(F.col("d"))).collect()]
    assert bags[0] == {"sku": "2", "name": "N"}


def test_breadcrumbs_and_static_offer(spark):
    crumbs = {"@context": "https://schema.org", "@type": "BreadcrumbList", "itemListElement": [
        {"item": {"@id": "https://s.se/", "name": "Home"}}, {"item": {"@id": "https://s.se/a", "name": "A"}}]}
    html = ld(product(brand={"name": "B"}, mpn="7", gtin="123"), crumbs)
    df = spark.createDataFrame([("https://s.se/a/x", html)], "url string, html string")
    row = st.static_offer(df).first()
    assert (row.name, row.brand, row.sku, row.price, row.currency) == ("Lamp", "B", "7", 0.0, "SEK")
    assert [(c.name, c.url) for c in row.category_tree] == [("A", "https://s.se/a")]


def test_malformed_html_never_fails():
    import random

    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("<>/!?[]-='\"& abp\n") for _ in range(rng.randint(1, 25)))
        dom = el.dom_of_text(text)
        for n in dom["nodes"]:
            assert 0 <= n["begin"] <= n["finish"] <= len(dom["text"])
    dom = el.dom_of_text("<p>a<![CDATA[x]]>b<![foo bar>c</p>")
    assert dom["text"] == "abc"


def test_parts_are_dealt_over_several_tasks_per_core(spark, tmp_path):
    from workload.views import spec_pages

    columns = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    rows = [(k, "a b", "B", "T", k, 1.5) for k in (1, 2, 2, 7)] + [(None, None, None, None, None, None)]
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/part.parquet")
    pages = spec_pages(spark, str(tmp_path))
    assert pages.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    assert sorted((r["page_id"] or 0, r["html"] is None) for r in pages.collect()) == [(0, True), (1, False), (2, False), (2, False), (7, False)]
