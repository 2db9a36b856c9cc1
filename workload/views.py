"""Table readers and stand-in views. SQL fragments here are valid in both
engines, so a query and its twin can share an input definition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from offerloom.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- shop URLs per part ---------------------------------------------------------

TLD = (
    "CASE p_partkey % 5 WHEN 0 THEN 'se' WHEN 1 THEN 'dk' WHEN 2 THEN 'de'"
    " WHEN 3 THEN 'nl' ELSE 'com' END"
)
CURRENCY = (
    "CASE p_partkey % 5 WHEN 0 THEN 'SEK' WHEN 1 THEN 'DKK' WHEN 2 THEN 'EUR'"
    " WHEN 3 THEN 'EUR' ELSE 'USD' END"
)
DOMAIN = f"'shop' || CAST(p_partkey % 7 AS STRING) || '.' || {TLD}"
SLUG = "replace(p_name, ' ', '-')"
URL = (
    f"'https://www.' || {DOMAIN} || '/' || {SLUG} || '-p' || CAST(p_partkey AS STRING)"
)
GTIN = "'7' || lpad(CAST(p_partkey AS STRING), 12, '0')"
AVAILABILITY = (
    "CASE p_size % 3 WHEN 0 THEN 'InStock' WHEN 1 THEN 'OutOfStock' ELSE 'PreOrder' END"
)
AVAILABILITY_SNAKE = (
    "CASE p_size % 3 WHEN 0 THEN 'in_stock' WHEN 1 THEN 'out_of_stock' ELSE 'pre_order' END"
)


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with the URL, domain, currency and codes of their shop page.

    A part is a few bytes in its file and a whole page behind it."""
    return spread(table(spark, sf_dir, "part"), waves=4).selectExpr(
        "*",
        f"{URL} AS url",
        f"{DOMAIN} AS domain",
        f"{TLD} AS tld",
        f"{CURRENCY} AS currency",
        f"{GTIN} AS gtin",
        f"{AVAILABILITY} AS availability",
    )


# -- product pages with JSON-LD ---------------------------------------------------

# Which parts lack a usable page, and how (both engines).
BROKEN = "p_partkey % 11 = 3"
NO_PRICE = "p_partkey % 13 = 5"
BAD_GTIN = "p_partkey % 17 = 4"
HAS_OFFER = f"NOT ({BROKEN}) AND NOT ({NO_PRICE})"


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, url, html``: JSON-LD product pages of parts.

    The offer is an object, a list or an aggregate by ``p_partkey % 3``; the
    product sits in a graph for every fifth part; the price is a number, a
    decimal text or a localised text.
    """
    price = (
        "CASE p_partkey % 4 WHEN 0 THEN CAST(p_retailprice AS STRING)"
        " WHEN 1 THEN '\"' || replace(CAST(p_retailprice AS STRING), '.', ',') || ' kr\"'"
        " WHEN 2 THEN '\"' || CAST(p_retailprice AS STRING) || '\"'"
        " ELSE '\"' || CAST(p_retailprice AS STRING) || '00\"' END"
    )
    gtin = f"CASE WHEN {BAD_GTIN} THEN '12A' ELSE gtin END"
    body = (
        f"""'"price":' || CASE WHEN {NO_PRICE} THEN 'null' ELSE {price} END ||
        ',"priceCurrency":"' || lower(currency) || '","availability":"https://schema.org/' ||
        availability || '"'"""
    )
    offer = f"""
        CASE p_partkey % 3
          WHEN 0 THEN '{{"@type":"Offer",' || {body} || '}}'
          WHEN 1 THEN '[{{"url":"' || url || '-blue","price":1}},{{"url":"' || url || '",' || {body} || '}}]'
          ELSE '{{"@type":"AggregateOffer","lowPrice":1,"offers":[{{' || {body} || '}},{{"price":2}}]}}'
        END"""
    product = f"""
        '{{"@context":"https://schema.org","@type":"Product","name":"' || p_name ||
        '","mpn":"M' || CAST(p_size AS STRING) || '-' || CAST(p_partkey AS STRING) ||
        '","gtin13":"' || {gtin} || '","brand":{{"name":"' || p_brand || '"}},"description":"A ' ||
        p_type || ' one","offers":' || {offer} || CASE WHEN p_partkey % 13 = 4 THEN ' , }}' ELSE '}}' END"""
    block = f"""
        CASE WHEN {BROKEN} THEN '{{"@type":"Product","name":"' || p_name
             WHEN p_partkey % 5 = 0 THEN '/* shop */ {{"@graph":[{{"@type":"WebPage"}},' || {product} || ']}}'
             WHEN p_partkey % 5 = 1 THEN '[' || {product} || ']'
             ELSE {product} END"""
    crumbs = """
        '{"@context":"https://schema.org","@type":"BreadcrumbList","itemListElement":[' ||
        '{"item":{"@id":"https://www.' || domain || '/","name":"Home"}},' ||
        '{"item":{"@id":"https://www.' || domain || '/' || lower(p_type) || '","name":"' || p_type || '"}},' ||
        '{"item":{"@id":"https://www.' || domain || '/' || lower(p_type) || '/' || CAST(p_size AS STRING) ||
        '","name":"Size ' || CAST(p_size AS STRING) || '"}}]}'"""
    html = f"""
        '<html><head><title>' || p_name || '</title>' || CASE p_partkey % 7
          WHEN 3 THEN '<SCRIPT TYPE="application/LD+JSON">' WHEN 5 THEN '<script type="application/ld&#x2B;json">'
          ELSE '<script type="application/ld+json">' END || {block} ||
        '</script><script type="application/ld+json">' || {crumbs} ||
        '</script></head><body><h1>' || p_name || '</h1></body></html>'"""
    return parts(spark, sf_dir).selectExpr("p_partkey AS page_id", "url", f"{html} AS html")


def meta_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, url, html``: OpenGraph, microdata or plugin markup by
    ``p_partkey % 3``."""
    og = """
        '<html><head><meta property="og:title" content="' || p_name || ' &amp; co"/>' ||
        CASE WHEN p_partkey % 2 = 0
          THEN '<meta content="' || CAST(p_retailprice AS STRING) || ' ' || currency || '" property="g:price">'
          ELSE '<meta property="product:price:amount" content="' || CAST(p_retailprice AS STRING) ||
               '"><meta property="og:price:currency" content="' || currency || '">' END ||
        '<meta property="og:availability" content="' || availability || '"></head><body>x</body></html>'"""
    micro = """
        '<html><body><div itemscope itemtype="https://schema.org/Product"><h1 itemprop="name">' || p_name ||
        '</h1><p itemprop="sku" content="S' || CAST(p_partkey AS STRING) || '">x</p><span itemprop="price" ' ||
        CASE WHEN p_partkey % 2 = 0 THEN 'content="' || CAST(p_retailprice AS STRING) || '"' ELSE '' END ||
        '>' || replace(CAST(p_retailprice AS STRING), '.', ',') || ' ' || currency || '</span>' ||
        CASE WHEN p_partkey % 4 < 2 THEN '<meta itemprop="priceCurrency" content="' || currency || '">' ELSE '' END ||
        '<link itemprop="availability" href="http://schema.org/' || availability || '"></div></body></html>'"""
    plugin = """
        '<html><body><div class="col price-wrapper"><p><span aria-hidden="true"><span class="woocommerce-Price-amount">1</span></span>' ||
        '<span class="woocommerce-Price-amount amount"><bdi>' || replace(CAST(p_retailprice AS STRING), '.', ',') ||
        '<span class="woocommerce-Price-currencySymbol">' ||
        CASE tld WHEN 'com' THEN '$' WHEN 'se' THEN 'kr' WHEN 'dk' THEN 'kr' ELSE '€' END ||
        '</span></bdi></span></p></div>' ||
        CASE WHEN availability = 'InStock' THEN '<p class="stock in-stock">yes</p>' ELSE '<p class="stock">no</p>' END ||
        '<div class="woocommerce-product-gallery__wrapper"><img src="/i/' || CAST(p_partkey AS STRING) ||
        '.jpg"><img src="/i/b.jpg"></div></body></html>'"""
    html = f"CASE p_partkey % 3 WHEN 0 THEN {og} WHEN 1 THEN {micro} ELSE {plugin} END"
    # names of attributes in either case
    html = f"CASE WHEN p_partkey % 7 < 3 THEN replace(replace({html}, 'property=', 'PROPERTY='), 'itemprop=', 'ITEMPROP=') ELSE {html} END"
    return parts(spark, sf_dir).selectExpr("p_partkey AS page_id", "url", f"{html} AS html")


# -- homepages, cards, prices -------------------------------------------------------

HOME = (
    "'https://shop' || CAST(l_suppkey AS STRING) || '.example.se/start/' ||"
    " CAST(l_orderkey AS STRING)"
)
HOME_ORIGIN = "'https://shop' || CAST(l_suppkey AS STRING) || '.example.se'"


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount"
    )


def home_pages(spark: SparkSession, sf_dir: str, distinct: bool = False) -> DataFrame:
    """One small homepage per line, or per ``distinct`` line: links in header, nav and footer, and in the
    main part a product linked ``1 + l_linenumber % 3`` times in a row, a link
    to the page itself, a supplier, and the product again."""
    html = """
        '<html><body><header><nav><a href="/start">Start</a></nav><a href="/login">In</a></header><main>' ||
        repeat('<a class="c" href="/p/' || CAST(l_partkey AS STRING) || '">p</a>', 1 + l_linenumber % 3) ||
        '<a href="#top">up</a><a href="//cdn.example.se/s/' || CAST(l_suppkey AS STRING) || '">s</a>' ||
        '<a href="../p/' || CAST(l_partkey AS STRING) || '">again</a></main>' ||
        '<footer><a href="/about">About</a></footer></body></html>'"""
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    lines = numbered_lines(spark, sf_dir)
    if distinct:
        # a number of partitions of its own: heavy work per row comes behind these narrow rows
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        lines = lines.select(*key).repartition(n, *key).dropDuplicates()
    else:
        lines = spread(lines)
    return lines.selectExpr(*key, f"{HOME} AS url", f"{html} AS html")


CARD_URL = "'https://shop.example.se/p/' || CAST(l_partkey AS STRING)"


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product cards in listing order: run, page, position, URL."""
    return numbered_lines(spark, sf_dir).selectExpr(
        "l_suppkey AS run",
        "l_orderkey AS page_number",
        "CAST(l_linenumber AS BIGINT) AS position",
        f"{CARD_URL} AS url",
    )


# Ranked cards in SQL: first sight per run, ties by URL.
RANKED_SQL = f"""
    SELECT run, url, page_number, position,
           row_number() OVER (PARTITION BY run ORDER BY page_number, position, url) AS popularity_index
    FROM (SELECT l_suppkey AS run, {CARD_URL} AS url,
                 l_orderkey AS page_number, CAST(l_linenumber AS BIGINT) AS position,
                 row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_orderkey, l_linenumber) AS n
          FROM lineitem) WHERE n = 1
"""

CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
STYLE = "(l_orderkey + l_linenumber)"


def price_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of lines with their whole and fractional part as text pieces."""
    return (
        spread(numbered_lines(spark, sf_dir))
        .selectExpr("l_orderkey", "l_linenumber", "l_partkey", f"{CENTS} AS cents", f"{STYLE} AS style")
        .selectExpr(
            "*",
            "CAST(cents div 100 AS STRING) AS whole",
            "format_number(cents div 100, 0) AS grouped",
            "lpad(CAST(cents % 100 AS STRING), 2, '0') AS frac",
        )
    )


def outcomes_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured pages with a status, from events."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        f"{EVENT_URL} AS request_url",
        f"{EVENT_URL} AS url",
        f"CAST({EVENT_STATUS} AS INT) AS status",
        "event_type",
        "user_id",
    )


EVENT_STATUS = (
    "CASE WHEN event_type <> 'error' THEN 200 WHEN event_id % 3 = 0 THEN 404"
    " WHEN event_id % 3 = 1 THEN 429 ELSE 500 END"
)
EVENT_URL = (
    "'https://www.shop' || CAST(user_id % 9 AS STRING) || '.se/p' || CAST(user_id AS STRING)"
)


def spec_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, url, html``: pages with breadcrumbs, a specification table
    (one value short for every seventh part), lines, images, reviews and
    sections."""
    html = """
        '<html><body><div class="crumbs"><a href="/">Home</a><a href="/' || lower(p_type) || '/"> ' || p_type ||
        ' </a><a>dead</a><a href="' || url || '">' || p_name || '</a></div><h1 class="title">' || p_name ||
        '\n second</h1><h2 class="sub"> ' || p_brand || ' </h2><table class="spec"><tr><td class="k"> Size </td><td class="v">' ||
        CAST(p_size AS STRING) || '</td></tr><tr><td class="k">Brand</td><td class="v"> ' || p_brand ||
        '</td></tr><tr><td class="k">EAN</td>' ||
        CASE WHEN p_partkey % 7 = 0 THEN '' ELSE '<td class="v">' || gtin || '</td>' END ||
        '</tr></table><pre class="lines">Type: ' || p_type || '\nno colon\nSize: ' || CAST(p_size AS STRING) ||
        ': cm\n</pre><div class="gallery"><img src="//i.example.se/' || CAST(p_partkey AS STRING) ||
        '.jpg?w=60"><img src="//i.example.se/' || CAST(p_partkey AS STRING) ||
        '.jpg?w=90"><img src="https://i.example.se/b.jpg"></div><img class="set" srcset="https://i.example.se/s' ||
        CAST(p_size AS STRING) || '.jpg 100w, https://i.example.se/l' || CAST(p_size AS STRING) ||
        '.jpg 900w"><div class="rev">' || CASE WHEN p_size % 4 = 0 THEN '' ELSE
        '<span class="avg">' || CAST(p_size % 5 + 1 AS STRING) || '.5/5</span><span class="cnt">(1,' ||
        lpad(CAST(p_size AS STRING), 3, '0') || ' ratings)</span>' END ||
        '</div><div class="sec"><h3>Other</h3><div class="body">no</div></div><div class="sec"><h3> About </h3><div class="body"> A ' ||
        p_type || ' one </div></div><p class="d">' || p_name || '</p><p class="d">Download image</p><p class="d">' || p_name ||
        '</p><p class="d">Soft. Specs: hard</p><span class="inventory ' ||
        CASE p_size % 4 WHEN 0 THEN 'green' WHEN 1 THEN 'red' WHEN 2 THEN 'yellow' ELSE 'blue' END ||
        '">x</span><i class="product__sku">Artikelnummer: ' || CAST(p_partkey AS STRING) || '</i></body></html>'"""
    return parts(spark, sf_dir).selectExpr("p_partkey AS page_id", "url", f"{html} AS html")
