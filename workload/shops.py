"""Pages in the layouts of the known shops, and the records their rules must find.

A page's text is a shop's layout with a part's values set in. What the SQL
expects follows from the part and from which fields that layout holds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom import plans
from offerloom.operators import elements as el, fields as fd, listings as ls, selectors as sel
from offerloom.operators.profiles import default_registry
from workload.registry import query
from workload.views import numbered_lines, parts, spec_pages

c = F.col

#: domain, layout, then what it holds: name, brand, price, original price, availability, breadcrumbs, size among the specifications, currency.
LAYOUTS = (
    ("amazon.de", """<div id="wayfinding-breadcrumbs_container"><ul><li><a href="/x">%T</a></li></ul></div><h1 id="title"><span> %N </span></h1><div id="buybox"><span id="price_inside_buybox">€%P.00</span><input id="add-to-cart-button" value="Add"></div><div id="prodDetails"><table id="productDetails_techSpec_section_1"><tr><th>Size</th><td> %S </td></tr></table></div>""", 1, 0, 1, 0, "in_stock", "T", 1, "EUR"),
    ("andlight.dk", """<a class="BreadCrumbLink" href="/h">Home</a><a class="BreadCrumbLink" href="/x/">%T</a><h1 itemprop="name">%N</h1><a id="manufacturer-details-link" href="/b">%B</a><span class="main-price-padding">%P,00 kr.</span><div class="price-before"><span class="line-through">%O kr</span></div><link itemprop="availability" href="https://schema.org/InStock"><div class="row productdetails-flex-row"><div>Size</div><div>%S</div></div>""", 1, 1, 1, 1, "in_stock", "HT", 1, None),
    ("baldai1.lt", """<div class="ty-breadcrumbs"><a href="/">Home</a><a href="/x">%T</a></div><h1 class="pdp-buySection-title">%N</h1><div class="pdp-buySection"><i class="ty-price"><b class="ty-price-num">%P</b></i></div><div id="product_tab_features"><div><span class="ty-product-feature_label">Size</span><em class="ty-product-feature_value">%S</em></div></div>""", 1, 0, 1, 0, None, "T", 1, "EUR"),
    ("bernomobler.se", """<div class="product-grid__content"><h2 class="product-single__title">%N</h2></div><div class="product-block--price"><p><span>%P kr</span><span>1 kr</span></p></div>""", 1, 0, 1, 0, None, None, 0, "SEK"),
    ("bygghemma.se", """<a class="PMDfl" href="/h">Home</a><a class="PMDfl" href="/x">%T</a><h1 class="mpzBU"><i class="ftHHn">%N</i></h1><div class="gZqc6"><div><span>%P kr</span><span>%O kr</span></div><div><span>7</span></div></div><div class="OeTqb"><table><tr><th>Size</th><td>%S</td></tr></table></div>""", 1, 0, 1, 1, None, "HT", 1, "SEK"),
    ("chilli.se", """<main><nav><span><a href="/">Home</a></span><span><a href="/x">%T</a></span></nav><button data-test-id="add-to-cart-button"></button><div class="a ac"><span>Specifikationer</span><table><tr><td>Size</td><td>%S</td></tr></table></div></main>""", 0, 0, 0, 0, "in_stock", "T", 1, "SEK"),
    ("connox.dk", """<section class="breadcrumb"><ul id="breadcrumb"><li><a href="/">Home</a></li><li><a href="/x">%T</a></li></ul></section><div class="product-details"><h1>%N</h1><a class="product-manufacturer-link" title="%B" href="/b">logo</a><div class="product-price"><span class="price-value" data-price-value="%P">x<s>UVP %O,00 DKK</s></span></div></div><section id="product-properties"><div class="accordion__item"><table><tr><td>Size</td><td>cm</td><td>%S</td></tr></table></div></section>""", 1, 1, 1, 1, None, "T", 1, "DKK"),
    ("ebuy24.dk", """<div class="m-breadcrumb"><a href="/">Home</a><a href="/x">%T</a></div><h1 class="m-product-title">%N</h1><b class="m-product-price">%P DKK</b><s class="m-product-price-before-discount">Før %O DKK</s><link itemprop="availability" href="OutOfStock"><div class="m-product-customdata"><table><tr><td class="m-product-customdata-title">Size</td><td class="m-product-customdata-data">%S</td></tr></table></div>""", 1, 0, 1, 1, "out_of_stock", "T", 1, None),
    ("ellos.se", """<ul class="navigation-breadcrumb-items"><li><a href="/x/">%T</a></li><li><a>here</a></li></ul><div class="product-desc"><h1>%N</h1><a class="brand" href="/b">%B</a><strong class="offer"><span>nu</span><span>%P SEK</span><s>%O SEK</s></strong></div>""", 1, 1, 1, 1, None, "T", 0, "SEK"),
    ("finnishdesignshop.fi", """<ol class="breadcrumb"><li><a href="/">Home</a></li><li><a href="/x">%T</a></li></ol><h1 itemprop="name">%N</h1><div class="product-info-col"><h2><a href="/b">%B</a></h2></div><div class="price-container"><span class="price-localized"><span>%P,00</span><span>EUR</span></span></div><span class="sku-availability bg-checkmark">ok</span><dl class="product-features-list"><dt>Size</dt><dd>%S</dd></dl>""", 1, 1, 1, 0, "in_stock", "T", 1, None),
    ("gardenstore.se", """<div class="breadcrumbs"><ul><li><a href="/">Home</a></li><li><a href="/x">%T</a></li></ul></div><h1 class="page-title">%N</h1><div class="product-info-price"><div class="price-final_price"><span class="price">%P kr</span></div><span data-price-type="oldPrice">%O kr</span></div><p class="stock unavailable">no</p>""", 1, 0, 1, 1, "out_of_stock", "T", 0, "SEK"),
    ("gigameubel.nl", """<div class="breadcrumbs"><ul><li><a href="/">Home</a></li><li><a href="/x">%T</a></li></ul></div><h1 class="page-title">%N</h1><div class="sidebar-lg-sticky"><h4>%B</h4></div><div class="product-info-main"><span data-price-type="finalPrice">%P,00</span></div>""", 1, 1, 1, 0, None, "T", 0, "EUR"),
    ("hm.com", """<nav aria-label="Breadcrumb"><ul><li><a href="/x">%T</a></li></ul></nav><h2><a href="/b">%B</a></h2><div id="section-descriptionAccordion"><p>d</p><dl><dt>Size</dt><dd>%S</dd></dl></div>""", 0, 1, 0, 0, None, "T", 1, None),
    ("homeroom.se", """<ul class="breadcrumbs"><li><a href="/x">%T</a></li></ul><h2 class="long-description-title"><a href="/">a</a><a href="/b">%B</a></h2><p class="original-price">%O kr</p><div class="price"><p>%P kr</p></div><button><span>Handla</span></button>""", 0, 1, 1, 1, "in_stock", "T", 0, "SEK"),
    ("jardindeco.com", """<div class="breadcrumbprod hidden-md"><a href="/x">%T</a></div><div class="product_info"><p class="name">%N</p><div id="fprixttc">%P €</div><div class="fiche__prices"><del>%O €</del></div><div class="tags_wrapper"><div>Neuf</div><div> Disponible </div></div></div><div class="tab_collection_area"><div class="tbl_caracs_tr"><div>Size</div><div>%S</div></div></div>""", 1, 0, 1, 1, "in_stock", "T", 1, "EUR"),
    ("jensen-company.dk", """<div class="breadcrumbs"><ul><li><a href="/">Home</a></li><li><a href="/x">%T</a></li></ul></div><div class="product-info-main"><h1 class="page-title">%N</h1><span data-price-type="finalPrice">%P,00</span></div><div class="product-brand">%B</div>""", 1, 1, 1, 0, None, "T", 0, "DKK"),
    ("k-rauta.se", """<div class="product-page__breadcrumbs"><a href="/x">%T</a></div><div class="product-page__top-info"><a class="product-heading__brand-name">%B</a><h1 class="product-heading__product-name">%N</h1><s class="price-view__before-discount">%O kr</s><b class="price-view__sale-price-container">%P kr/ st</b></div><dl><dt>Size</dt><dd>%S</dd></dl>""", 1, 1, 1, 1, "in_stock", "T", 1, "SEK"),
    ("macys.com", """<nav class="breadcrumbs"><a class="p-menuitem-link" href="/x"><span>%T</span></a></nav><label itemprop="brand"><a class="link" href="/b">%B</a></label>""", 0, 1, 0, 0, None, "T", 0, None),
    ("nordlyliving.dk", """<div class="product__title" style="display:none"><h1>no</h1></div><div class="product__title"><h1>%N</h1></div><p class="product__text caption-with-letter-spacing"><a title="x">%B</a></p><div class="price__sale"><s class="price-item--regular">%O kr</s><span class="price-item--sale">%P kr</span></div><div class="inventory-text green">x</div>""", 1, 1, 1, 1, "in_stock", None, 0, "DKK"),
    ("norliving.dk", """<div class="product"><h1 class="product-info__title">%N</h1><sale-price>%P,00 kr</sale-price><compare-at-price>%O,00 kr</compare-at-price></div>""", 1, 0, 1, 1, None, None, 0, "DKK"),
    ("trademax.se", """<main><nav><span><a href="/">Home</a></span><span><a href="/x">%T</a></span></nav><div><h3><span>Specifikationer</span></h3><table><tr><td>Size</td><td>%S</td></tr></table></div></main>""", 0, 0, 0, 0, "out_of_stock", "T", 1, "SEK"),
    ("trendrum.se", """<div id="navBreadCrumb"><a href="/">Home</a><a href="/x">%T</a></div><div class="infodisplay_headerbox"><h1>%N</h1></div><div class="productPrices"><span class="currentprice">%P kr</span></div><div class="FactsBox"><table><tr><td class="attribName">Size</td><td class="attribValue">%S</td></tr></table></div>""", 1, 0, 1, 0, None, "T", 1, "SEK"),
    ("unoliving.com", """<div class="breadcrumbs"><ul><li><a href="/">Home</a></li><li><a href="/x">%T</a></li></ul></div><div class="product-info-main"><h2 class="pdp__brand__title">%B</h2><span data-price-type="finalPrice" data-price-amount="%P">x</span><span data-price-type="oldPrice" data-price-amount="%O">x</span></div>""", 0, 1, 1, 1, None, "T", 0, "DKK"),
    ("venturedesign.se", """<div class="breadcrumb-container"><a href="/">Home</a><a href="/x">%T</a></div><div class="article-detail-text"><h1>%N</h1></div><div class="container"><div class="label">MER INFORMATION</div><div class="content"><table><tr><td>Size</td><td>%S</td></tr></table></div></div>""", 1, 0, 0, 0, None, "T", 1, "SEK"),
    ("wayfair.de", """<div class="PdpLayoutResponsive-breadcrumbWrap"><nav><ul><li><a href="/x">%T</a></li><li>SKU</li></ul></nav></div><div data-enzyme-id="PdpLayout-infoBlock"><header><h1>%N</h1></header><a data-enzyme-id="pdp-title-block-manufacturer-name">%B</a><div data-enzyme-id="PriceBlock"><span>%P,00 €</span><s>%O,00 €</s></div></div><div class="ProductOverviewItem"><dl><dt>Size</dt><dd>%S</dd></dl></div>""", 1, 1, 1, 1, "in_stock", "T", 1, None),
)


def _lit(value) -> str:
    return "NULL" if value is None else f"'{value}'"


_WHOLE = "CAST(floor(p_retailprice) AS BIGINT)"
_SHOPS_SQL = ", ".join(
    f"({i}, '{d}', {name}, {brand}, {price}, {old}, {_lit(stock)}, {_lit(crumbs)}, {specs}, {_lit(currency)})"
    for i, (d, _, name, brand, price, old, stock, crumbs, specs, currency) in enumerate(LAYOUTS)
)
_FOUND_SQL = f"""
    SELECT p_partkey AS page_id, domain, CASE WHEN name = 1 THEN p_name END AS name, CASE WHEN brand = 1 THEN p_brand END AS brand,
           CASE WHEN price = 1 THEN CAST({_WHOLE} AS DOUBLE) END AS price, CASE WHEN old = 1 THEN CAST({_WHOLE} + 100 AS DOUBLE) END AS original_price,
           currency, stock AS availability, CASE crumbs WHEN 'T' THEN p_type WHEN 'HT' THEN 'Home>' || p_type END AS crumbs,
           CASE WHEN specs = 1 THEN CAST(p_size AS STRING) END AS size
    FROM part JOIN (VALUES {_SHOPS_SQL}) AS s(i, domain, name, brand, price, old, stock, crumbs, specs, currency)
    ON p_partkey % {len(LAYOUTS)} = i"""


def shop_pages(spark, sf_dir):
    """``page_id, url, html``: a part's page in the layout of one of the shops."""
    i = F.pmod(c("p_partkey"), F.lit(len(LAYOUTS))).cast("int")
    html = F.get(F.array(*[F.lit(f"<html><body>{x[1]}</body></html>") for x in LAYOUTS]), i)
    whole = F.expr(_WHOLE)
    values = {"%N": c("p_name"), "%B": c("p_brand"), "%T": c("p_type"), "%S": c("p_size"), "%P": whole, "%O": whole + 100}
    for mark, value in values.items():
        html = F.replace(html, F.lit(mark), value.cast("string"))
    domain = F.get(F.array(*[F.lit(x[0]) for x in LAYOUTS]), i)
    return parts(spark, sf_dir).select(
        c("p_partkey").alias("page_id"),
        F.concat(F.lit("https://www."), domain, F.lit("/p/"), c("p_partkey").cast("string")).alias("url"),
        html.alias("html"),
        domain.alias("shop"),
        "p_name",
        "p_size",
    )


@query("ext17_profiles", _FOUND_SQL)
def profiles(spark, sf_dir):
    """Records of the shops' layouts by rules alone."""
    rows = fd.rule_offers(shop_pages(spark, sf_dir), default_registry())
    size = F.get(F.filter("specifications", lambda s: s["key"] == "Size"), 0)["value"]
    return rows.select(
        "page_id", "domain", "name", "brand", c("price").cast("double").alias("price"), c("original_price").cast("double").alias("original_price"),
        "currency", "availability",
        F.array_join(F.transform("category_tree", lambda x: x["name"]), ">").alias("crumbs"), size.alias("size"),
    )


_SELECTORS = {
    "crumb": ("div.crumbs > a:nth-child(2)", "p_type"),
    "dead": ("div.crumbs a:not([href])", "'dead'"),
    "spec": ("td.k:text-is('Size') + td", "CAST(p_size AS STRING)"),
    "row": ("table.spec tr:nth-of-type(2) > td:last-child", "p_brand"),
    "last": ("table.spec tr:last-child .v", "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE '7' || lpad(CAST(p_partkey AS STRING), 12, '0') END"),
    "after": ("div.sec:has(h3:text('about')) .body", "'A ' || p_type || ' one'"),
    "later": ("h1.title ~ h2", "p_brand"),
    "holds": ("span[class*='ell']", "CASE p_size % 4 WHEN 2 THEN 'x' END"),
    "image": ("img[src^='//i.'][src$='w=90'] ..", "''"),
}


@query(
    "ext17_selectors",
    "SELECT p_partkey AS page_id, " + ", ".join(f"{sql} AS {n}" for n, (_, sql) in _SELECTORS.items()) + " FROM part",
)
def selectors(spark, sf_dir):
    """Child, sibling, number, attribute, text and parent tests."""
    rows = spec_pages(spark, sf_dir).select("page_id", el.page_dom(c("html")).alias("dom"))

    def first(selector):
        found = sel.select_text(c("dom"), selector)
        return F.get(F.transform(found, lambda n: F.trim(el.text_of(c("dom"), n))), 0)

    return rows.select("page_id", *[first(s).alias(n) for n, (s, _) in _SELECTORS.items()])


@query(
    "ext17_records",
    """SELECT p_partkey AS page_id, CAST(i AS BIGINT) AS position, CASE i WHEN 0 THEN 'Size' WHEN 1 THEN 'Brand' ELSE 'EAN' END AS key,
       CASE i WHEN 0 THEN CAST(p_size AS STRING) WHEN 1 THEN p_brand
       ELSE CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE '7' || lpad(CAST(p_partkey AS STRING), 12, '0') END END AS value
       FROM part, (SELECT unnest([0, 1, 2]) AS i)""",
)
def records(spark, sf_dir):
    """Nested rules: a scope per table row, two fields within each."""
    from offerloom.operators.profiles import Profile, Record, Registry, Rule

    registry = Registry()
    for k in range(7):
        for tld in ("se", "dk", "de", "nl", "com"):
            rows = Record("specs", "table.spec tr", (Rule("key", "td.k", required=True), Rule("value", ":scope > td.v")))
            registry.register_profile(Profile(f"shop{k}.{tld}", records=(rows,)))
    found = fd.rule_extract(spec_pages(spark, sf_dir), registry.rules_frame(spark))
    return found.select("page_id", F.posexplode(fd.record_rows(c("records"), "specs")).alias("position", "m")).select(
        "page_id", c("position").cast("bigint").alias("position"),
        F.try_element_at("m", F.lit("key")).alias("key"), F.try_element_at("m", F.lit("value")).alias("value"),
    )


# Pages of ruled shops whose rules miss something that the page's JSON-LD has.
_MERGE_SHOP = "CASE p_size % 3 WHEN 0 THEN 'norliving.dk' WHEN 1 THEN 'trendrum.se' ELSE 'k-rauta.se' END"
_JSONLD_PRICE = "CAST(floor(p_retailprice) + 7 AS BIGINT)"


@query(
    "job_scrape_details_merge",
    f"""SELECT p_partkey, p_name AS name, CASE p_size % 3 WHEN 1 THEN {_WHOLE} ELSE {_JSONLD_PRICE} END * 100 AS price,
        CASE p_size % 3 WHEN 0 THEN 'EUR' ELSE 'SEK' END AS currency,
        CASE p_size % 3 WHEN 1 THEN 'rules' ELSE 'schema-json' END AS strategy, CASE p_size % 3 WHEN 1 THEN p_type END AS crumbs
        FROM part WHERE p_size % 3 <> 2 OR p_size % 2 = 0""",
)
def scrape_details_merge(spark, sf_dir):
    """Rules over the cascade: a shop whose rules miss everything, one whose
    rules find all but the name, and one whose pages lack the required name."""
    jsonld = (
        "'<script type=\"application/ld+json\">{\"@type\":\"Product\",' || CASE WHEN p_size % 3 = 2 AND p_size % 2 = 1 THEN '' ELSE '\"name\":\"' || p_name || '\",' END ||"
        f" '\"offers\":{{\"price\":' || CAST({_JSONLD_PRICE} AS STRING) || ',\"priceCurrency\":\"' || CASE p_size % 3 WHEN 0 THEN 'EUR' ELSE 'SEK' END || '\"}}}}</script>'"
    )
    body = f"""CASE p_size % 3 WHEN 1 THEN '<div id="navBreadCrumb"><a href="/">Home</a><a href="/x">' || p_type ||
        '</a></div><div class="productPrices"><span class="currentprice">' || CAST({_WHOLE} AS STRING) || ' kr</span></div>' ELSE '<p>x</p>' END"""
    rows = parts(spark, sf_dir)
    asked = f"'https://www.' || {_MERGE_SHOP} || '/p/' || CAST(p_partkey AS STRING)"
    captured = rows.selectExpr(
        f"{asked} AS request_url", f"{asked} AS url", f"{jsonld} || {body} AS html", "200 AS status", "timestamp'2024-01-01' AS fetched_at"
    )
    found = plans.scrape_details(rows.selectExpr(f"{asked} AS request_url", "p_partkey"), captured).offers
    crumbs = F.array_join(F.transform("category_tree", lambda x: x["name"]), ">")
    return found.select("p_partkey", "name", "price", "currency", "strategy", crumbs.alias("crumbs"))


# -- category pages ------------------------------------------------------------------

_CARD = "'/p/' || CAST(l_partkey AS STRING)"
_CATEGORY = "'https://www.gardenstore.se/c/' || CAST(l_suppkey AS STRING)"


def category_pages(spark, sf_dir):
    """``run, page_number, url, html``: an order is a page of a supplier's
    category, a line is a card, and every page has one card without a link."""
    # narrow rows, heavy work behind them: as many tasks as the session shuffles into. Dealt
    # before the grouping, which needs no other shuffle; behind it, the optimizer would drop
    # the step and merge partitions until there are no more than cores.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = numbered_lines(spark, sf_dir).select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    pages = lines.repartition(tasks, "l_suppkey", "l_orderkey").groupBy("l_suppkey", "l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("cards")  # a few lines per order
    )

    def card(x):
        return F.concat(
            F.lit('<li class="item product-item"><strong class="product-item-name"> <a href="/p/'), x["l_partkey"].cast("string"),
            F.lit('">Part '), x["l_partkey"].cast("string"), F.lit("</a></strong></li>"),
        )

    head = F.concat(
        F.lit('<div class="breadcrumbs"><ul><li><a href="/">Home</a></li><li><a href="/c/">All</a></li><li><strong>Supplier '),
        c("l_suppkey").cast("string"), F.lit('</strong></li></ul></div><ol><li class="product-item">ad</li>'),
    )
    body = F.array_join(F.transform("cards", card), "")
    return pages.select(
        c("l_suppkey").alias("run"),
        c("l_orderkey").alias("page_number"),
        F.concat(F.lit("https://www.gardenstore.se/c/"), c("l_suppkey").cast("string"), F.lit("?p="), c("l_orderkey").cast("string")).alias("url"),
        F.concat(head, body, F.lit("</ol>")).alias("html"),
    )


_CARDS_SQL = f"""
    SELECT l_suppkey AS run, l_orderkey AS page_number, 'https://www.gardenstore.se' || {_CARD} AS url, 'Part ' || CAST(l_partkey AS STRING) AS name,
           CAST(1 + row_number() OVER (PARTITION BY l_suppkey, l_orderkey ORDER BY l_linenumber, l_partkey) AS INTEGER) AS position,
           {_CATEGORY} || '?p=' || CAST(l_orderkey AS STRING) AS category_url, 'All>Supplier ' || CAST(l_suppkey AS STRING) AS path
    FROM lineitem"""


@query("lst1_rule_listings", _CARDS_SQL)
def rule_listings(spark, sf_dir):
    """Cards of category pages by the shop's nested rules."""
    path = F.array_join(F.transform("popularity_category", lambda x: x["name"]), ">")
    rows = ls.rule_listings(category_pages(spark, sf_dir), default_registry())
    return rows.select("run", "page_number", "url", "name", "position", "category_url", path.alias("path"))


@query(
    "job_explore_category_pages",
    f"""SELECT run, url, name, category_url, path, 'gardenstore.se' AS retailer_domain,
        row_number() OVER (PARTITION BY run ORDER BY page_number, position, url) AS popularity_index
        FROM (SELECT *, row_number() OVER (PARTITION BY run, url ORDER BY page_number, position) AS n FROM ({_CARDS_SQL})) WHERE n = 1""",
)
def explore_category_pages(spark, sf_dir):
    """Category pages to ranked listings."""
    path = F.array_join(F.transform("popularity_category", lambda x: x["name"]), ">")
    return plans.explore_category_pages(category_pages(spark, sf_dir)).select(
        "run", "url", "name", "category_url", path.alias("path"), "retailer_domain", "popularity_index"
    )
