"""Field extraction from pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom.functions import clean_image, parse_price, parse_price_as, url_included
from offerloom.functions.text import trim_text
from offerloom.operators import cascade, elements as el, fields as fd, markup, structured as st
from workload.registry import query
from workload.views import (
    AVAILABILITY,
    AVAILABILITY_SNAKE,
    BAD_GTIN,
    BROKEN,
    CURRENCY,
    DOMAIN,
    GTIN,
    HAS_OFFER,
    NO_PRICE,
    TLD,
    URL,
    meta_pages,
    parts,
    product_pages,
    spec_pages,
    table,
)

c = F.col
def html():
    return c("html")


def page_url():
    return c("url")


def dom():
    return c("dom")


def _has(cls):
    return lambda n: el.has_class(n, cls)


# -- JSON-LD ----------------------------------------------------------------------


@query(
    "ext1_jsonld_blocks",
    """SELECT p_partkey AS page_id, CAST(block_pos AS BIGINT) AS block_pos, block_pos = 1 AS is_breadcrumb
       FROM part, (SELECT unnest([0, 1]) AS block_pos)""",
)
def jsonld_blocks(spark, sf_dir):
    return st.jsonld_blocks(product_pages(spark, sf_dir)).select(
        "page_id",
        c("block_pos").cast("bigint").alias("block_pos"),
        F.contains("block", F.lit("BreadcrumbList")).alias("is_breadcrumb"),
    )


@query(
    "ext2_parse_jsonld",
    f"SELECT p_partkey AS page_id, NOT ({BROKEN}) AS readable FROM part",
)
def parse_jsonld(spark, sf_dir):
    blocks = st.jsonld_blocks(product_pages(spark, sf_dir)).where("block_pos = 0")
    # every other part is written the lenient way, with single quotes
    loose = F.when(c("page_id") % 2 == 1, F.translate("block", '"', "'")).otherwise(c("block"))
    return blocks.select("page_id", st.parse_jsonld(loose).isNotNull().alias("readable"))


@query(
    "ext3_jsonld_products",
    f"""SELECT p_partkey AS page_id, p_name AS name, p_brand AS brand FROM part WHERE NOT ({BROKEN})""",
)
def jsonld_products(spark, sf_dir):
    found = st.jsonld_products(st.jsonld_blocks(product_pages(spark, sf_dir)))
    return found.select(
        "page_id",
        st.get(c("product"), "$.name").alias("name"),
        st.get(c("product"), "$.brand.name").alias("brand"),
    )


def _entry_lists(spark, sf_dir):
    """Entries of a page: by part, the fitting one is found by URL, by an
    identifier in the URL, or not at all."""
    body = """CASE p_partkey % 3
        WHEN 0 THEN '[{"url":"/x","n":1},{"url":"' || url || '","n":2},{"url":"' || substr(url, 1, length(url) - 1) || '","n":3}]'
        WHEN 1 THEN '[{"n":1},{"n":2,"itemOffered":{"sku":"P' || p_partkey || '"}},{"n":3,"itemOffered":{"sku":"zzz"}}]'
        ELSE '[{"n":1},{"n":2,"itemOffered":{"sku":"#"}}]' END"""
    return parts(spark, sf_dir).selectExpr("p_partkey AS page_id", "url", f"{body} AS body")


@query(
    "ext4_best_entry",
    "SELECT p_partkey AS page_id, CASE WHEN p_partkey % 3 = 2 THEN '1' ELSE '2' END AS n FROM part",
)
def best_entry(spark, sf_dir):
    entries = F.try_variant_get(F.parse_json("body"), "$", "array<variant>")
    return _entry_lists(spark, sf_dir).select(
        "page_id", st.get(st.best_entry(entries, page_url()), "$.n").alias("n")
    )


@query(
    "ext5_url_included",
    """SELECT p_partkey AS page_id, true AS is_part, p_size % 2 = 0 AS reordered, p_size % 2 = 1 AS rooted,
       false AS other_page FROM part""",
)
def included(spark, sf_dir):
    rows = parts(spark, sf_dir).selectExpr("*", "url || '?b=2&a=' || (p_size % 2) AS cur")
    return rows.select(
        c("p_partkey").alias("page_id"),
        url_included(c("cur"), c("url")).alias("is_part"),
        url_included(c("cur"), F.expr("url || '?a=0&b=2'")).alias("reordered"),
        url_included(c("cur"), F.expr("substr(url, instr(url, '/p') + 0, 0) || '/' || replace(p_name, ' ', '-') || '-p' || p_partkey || '?a=1'")).alias("rooted"),
        url_included(c("cur"), F.expr("url || '0?a=0'")).alias("other_page"),
    )


@query(
    "ext6_resolve_offer",
    f"""SELECT p_partkey AS page_id, {AVAILABILITY} AS availability FROM part WHERE NOT ({BROKEN})""",
)
def resolve_offer(spark, sf_dir):
    product = F.get(st.products_of(html()), 0)
    offer = st.resolve_offer(c("p"), page_url())
    pages = product_pages(spark, sf_dir).select("page_id", "url", product.alias("p"))
    return pages.where(c("p").isNotNull()).select(
        "page_id", F.substring_index(st.get(offer, "$.availability"), "/", -1).alias("availability")
    )


_OFFER_SQL = f"""
    SELECT p_partkey AS page_id, p_name AS name,
           CASE WHEN {BAD_GTIN} THEN '12A' ELSE {GTIN} END AS gtin,
           'M' || CAST(p_size AS STRING) || '-' || CAST(p_partkey AS STRING) AS mpn,
           p_retailprice AS price, lower({CURRENCY}) AS currency, {{availability}} AS availability
    FROM part WHERE {HAS_OFFER}"""


@query("ext7_offer_fields", _OFFER_SQL.format(availability=AVAILABILITY))
def offer_fields(spark, sf_dir):
    found = st.jsonld_offers(product_pages(spark, sf_dir))
    return found.select("page_id", "name", "gtin", "mpn", "price", "currency", "availability")


# -- markup strategies --------------------------------------------------------------


def _doms(spark, sf_dir, kind):
    pages = meta_pages(spark, sf_dir).where(c("page_id") % 3 == kind)
    return pages.select("page_id", "url", el.page_dom(html()).alias("dom"))


@query(
    "ext8_microdata_offer",
    f"""SELECT p_partkey AS page_id, p_name AS name, p_retailprice AS price, {CURRENCY} AS currency,
        {AVAILABILITY} AS availability FROM part WHERE p_partkey % 3 = 1""",
)
def microdata_offer(spark, sf_dir):
    rows = _doms(spark, sf_dir, 1).select("page_id", markup.microdata_offer(c("dom")).alias("o"))
    return rows.select("page_id", "o.name", "o.price", "o.currency", "o.availability")


@query(
    "ext9_microdata_bag",
    f"""SELECT p_partkey AS page_id, p_name AS name, 'S' || CAST(p_partkey AS STRING) AS sku,
        CASE WHEN p_partkey % 4 < 2 THEN 4 ELSE 3 END + 1 AS n_props FROM part WHERE p_partkey % 3 = 1""",
)
def microdata_bag(spark, sf_dir):
    pages = meta_pages(spark, sf_dir).where(c("page_id") % 3 == 1)
    renamed = F.replace(html(), F.lit('itemtype="https:'), F.lit('itemtype="http:'))
    bags = pages.select("page_id", el.page_dom(renamed).alias("dom")).select(
        "page_id", markup.microdata_bag(c("dom")).alias("bag")
    )
    return bags.select(
        "page_id",
        c("bag")["name"].alias("name"),
        c("bag")["sku"].alias("sku"),
        F.size("bag").alias("n_props"),
    )


@query(
    "ext10_opengraph_offer",
    f"""SELECT p_partkey AS page_id, p_name || ' & co' AS name, p_retailprice AS price, {CURRENCY} AS currency,
        {AVAILABILITY} AS availability FROM part WHERE p_partkey % 3 = 0""",
)
def opengraph_offer(spark, sf_dir):
    rows = _doms(spark, sf_dir, 0).select("page_id", markup.opengraph_offer(c("dom")).alias("o"))
    return rows.select("page_id", "o.name", "o.price", "o.currency", "o.availability")


@query(
    "ext11_plugin_offer",
    f"""SELECT p_partkey AS page_id, p_retailprice AS price, {CURRENCY} AS currency,
        CASE WHEN p_size % 3 = 0 THEN 'in_stock' ELSE 'out_of_stock' END AS availability,
        '/i/' || CAST(p_partkey AS STRING) || '.jpg|/i/b.jpg' AS images FROM part WHERE p_partkey % 3 = 2""",
)
def plugin_offer(spark, sf_dir):
    rows = _doms(spark, sf_dir, 2).select("page_id", markup.plugin_offer(c("dom"), page_url()).alias("o"))
    return rows.select(
        "page_id", "o.price", "o.currency", "o.availability", F.array_join("o.images", "|").alias("images")
    )


@query(
    "ext12_auto_extract",
    f"""
    SELECT p_partkey AS page_id, 'jsonld' AS kind, CASE WHEN {HAS_OFFER} THEN 'schema-json' END AS strategy,
           CASE WHEN {HAS_OFFER} THEN p_name END AS name, CASE WHEN {HAS_OFFER} THEN p_retailprice END AS price,
           CASE WHEN {HAS_OFFER} THEN {AVAILABILITY_SNAKE} END AS availability,
           CASE WHEN NOT ({HAS_OFFER}) THEN 'PriceLiteUnavailableError' END AS reject_reason FROM part
    UNION ALL
    SELECT p_partkey, 'markup',
           CASE p_partkey % 3 WHEN 0 THEN 'opengraph' WHEN 1 THEN 'schema-attributes' ELSE 'woocommerce' END,
           CASE p_partkey % 3 WHEN 0 THEN p_name || ' & co' WHEN 1 THEN p_name END, p_retailprice,
           CASE WHEN p_partkey % 3 < 2 THEN {AVAILABILITY_SNAKE}
                WHEN p_size % 3 = 0 THEN 'in_stock' ELSE 'out_of_stock' END, NULL FROM part""",
)
def auto_extract(spark, sf_dir):
    both = (
        product_pages(spark, sf_dir)
        .withColumn("kind", F.lit("jsonld"))
        .unionByName(meta_pages(spark, sf_dir).withColumn("kind", F.lit("markup")))
    )
    return cascade.auto_extract(both).select(
        "page_id", "kind", "strategy", "name", "price", "availability", "reject_reason"
    )


@query(
    "ext13_winner_availability",
    f"""SELECT p_partkey AS page_id, {AVAILABILITY_SNAKE} AS availability FROM part WHERE {HAS_OFFER}""",
)
def winner_availability(spark, sf_dir):
    rows = cascade.auto_extract(product_pages(spark, sf_dir))
    return rows.where(c("reject_reason").isNull()).select("page_id", "availability")


@query(
    "ext14_is_comparison_site",
    "SELECT p_partkey AS page_id, p_size % 3 = 0 AS waiting FROM part",
)
def comparison_site(spark, sf_dir):
    domain = F.expr("CASE p_size % 3 WHEN 0 THEN 'www.prisjakt.nu' ELSE domain END")
    return parts(spark, sf_dir).select(
        c("p_partkey").alias("page_id"), cascade.is_comparison_site(domain).alias("waiting")
    )


_CRUMBS_SQL = f"""
    'https://www.' || {DOMAIN} || '/' || lower(p_type) || '|' || 'https://www.' || {DOMAIN} || '/' || lower(p_type) ||
    '/' || CAST(p_size AS STRING)"""


@query(
    "ext15_jsonld_breadcrumbs",
    f"""SELECT p_partkey AS page_id, p_type || '|Size ' || CAST(p_size AS STRING) AS names, {_CRUMBS_SQL} AS urls FROM part""",
)
def jsonld_breadcrumbs(spark, sf_dir):
    rows = st.jsonld_breadcrumbs(product_pages(spark, sf_dir))
    return rows.select(
        "page_id",
        F.array_join("category_tree.name", "|").alias("names"),
        F.array_join("category_tree.url", "|").alias("urls"),
    )


@query(
    "ext16_static_offer",
    f"""SELECT p_partkey AS page_id, {URL} AS url, p_name AS name, p_brand AS brand,
        'A ' || p_type || ' one' AS description, 'M' || CAST(p_size AS STRING) || '-' || CAST(p_partkey AS STRING) AS sku,
        0::DOUBLE AS price, 'SEK' AS currency, 'in_stock' AS availability, 2 AS depth
        FROM part WHERE NOT ({BROKEN})""",
)
def static_offer(spark, sf_dir):
    rows = st.static_offer(product_pages(spark, sf_dir))
    return rows.select(
        "page_id", "url", "name", "brand", "description", "sku", "price", "currency", "availability",
        F.size("category_tree").alias("depth"),
    )


# -- elements and rules ---------------------------------------------------------------


@query(
    "pel1_page_elements",
    """SELECT page_id, href, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) AS BIGINT) AS nth, text FROM (
         SELECT page_id, generate_subscripts(hrefs, 1) AS i, unnest(hrefs) AS href, unnest(texts) AS text FROM (
           SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
                  regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS texts FROM pages))""",
)
def page_elements(spark, sf_dir):
    from pyspark.sql import Window

    rows = el.page_elements(table(spark, sf_dir, "pages").select("page_id", "html"))
    nth = F.row_number().over(Window.partitionBy("page_id").orderBy("pos")).cast("bigint")
    return rows.where(c("tag") == "a").select(
        "page_id", c("attrs")["href"].alias("href"), nth.alias("nth"), "text"
    )


@query(
    "ext17_rule_extract",
    """SELECT p_partkey AS page_id, p_name AS title, p_brand AS brand, CAST(p_partkey AS STRING) AS sku,
       p_name AS fallback_title, CASE WHEN p_size % 4 = 0 THEN 'average' ELSE '' END AS missing
       FROM part WHERE p_partkey % 5 = 0""",
)
def rule_extract(spark, sf_dir):
    from offerloom.operators.profiles import Profile, Registry, Rule

    registry = Registry()
    for k in range(7):
        registry.register_profile(
            Profile(
                f"shop{k}.se",
                rules=(
                    Rule("title", tag="h1", cls="title", cleanup="first_line"),
                    Rule("brand", cls="sub", required=True),
                    Rule("sku", cls="product__sku", cleanup="after_colon"),
                    Rule("fallback_title", tag="h6"),
                    Rule("fallback_title", tag="h1", cleanup="first_line", rank=1),
                    Rule("average", cls="avg", under_class="rev", required=True),
                ),
            )
        )
    rows = fd.rule_extract(spec_pages(spark, sf_dir), registry.rules_frame(spark))
    field = lambda name: F.try_element_at("fields", F.lit(name)).alias(name)
    return rows.select(
        "page_id", field("title"), field("brand"), field("sku"), field("fallback_title"),
        F.array_join("missing", ",").alias("missing"),
    )


@query(
    "ext17_rule_offers",
    f"""SELECT p_partkey AS page_id, CASE WHEN p_size % 5 <> 0 THEN p_name END AS name, p_brand AS brand,
        floor(p_retailprice) AS price, CASE WHEN p_size % 2 = 0 THEN floor(p_retailprice) + 100 END AS original_price,
        p_size % 2 = 0 AS is_discounted, 'SEK' AS currency,
        CASE WHEN p_size % 3 = 0 THEN 'out_of_stock' ELSE 'in_stock' END AS availability,
        CASE WHEN p_size % 5 = 0 THEN 'Cannot extract name' END AS reject_reason FROM part""",
)
def rule_offers(spark, sf_dir):
    """Pages of one known shop; every fifth size lacks the name."""
    from offerloom.operators.profiles import default_registry

    body = """
        '<div class="product-page__top-info"><a class="product-heading__brand-name"> ' || p_brand || ' </a>' ||
        CASE WHEN p_size % 5 = 0 THEN '' ELSE '<h1 class="product-heading__product-name">' || p_name || '</h1>' END ||
        CASE WHEN p_size % 2 = 0 THEN '<s class="price-view__before-discount">' || CAST(floor(p_retailprice) + 100 AS STRING) || ' kr</s>' ELSE '' END ||
        '<b class="price-view__sale-price-container">' || CAST(floor(p_retailprice) AS STRING) || ' kr/ st</b></div>' ||
        '<span class="availability__message">' || CASE WHEN p_size % 3 = 0 THEN 'Ej tillgänglig' ELSE 'Finns' END || '</span>'"""
    pages = parts(spark, sf_dir).selectExpr(
        "p_partkey AS page_id", "'https://www.k-rauta.se/produkt/' || p_partkey AS url", f"{body} AS html"
    )
    return fd.rule_offers(pages, default_registry()).select(
        "page_id", "name", "brand", "price", "original_price", "is_discounted", "currency", "availability", "reject_reason"
    )


def _spec_doms(spark, sf_dir):
    return spec_pages(spark, sf_dir).select("page_id", "url", el.page_dom(html()).alias("dom"))


def _crumbs():
    return fd.crumbs_where(dom(), lambda n: (n["tag"] == "a") & el.inside(dom(), n, _has("crumbs")))


@query(
    "ext18_category_tree",
    f"""SELECT p_partkey AS page_id, p_type AS names, '/' || lower(p_type) AS urls,
        p_type || '|' || p_name AS names_with_product FROM part""",
)
def category_tree(spark, sf_dir):
    tree = fd.category_tree(_crumbs(), 1, drop_last=True)
    full = fd.category_tree(_crumbs(), 1)
    rows = _spec_doms(spark, sf_dir).select("page_id", tree.alias("t"), full.alias("f"))
    return rows.select(
        "page_id",
        F.array_join("t.name", "|").alias("names"),
        F.array_join("t.url", "|").alias("urls"),
        F.array_join("f.name", "|").alias("names_with_product"),
    )


@query(
    "ext19_category_tree_of_listing",
    f"""SELECT p_partkey AS page_id, p_type || '|' || p_name || '|' || p_brand AS names,
        '/' || lower(p_type) || '|' || {URL} || '|' || {URL} AS urls,
        '/' || lower(p_type) || '|' || {URL} || '|/first' AS urls_paged FROM part""",
)
def category_tree_of_listing(spark, sf_dir):
    brand = F.get(el.texts_where(dom(), _has("sub")), 0)
    page = F.concat(page_url(), F.lit("?page=3"))
    tree = fd.category_tree_of_listing(_crumbs(), brand, page, 1)
    paged = fd.category_tree_of_listing(_crumbs(), brand, page, 1, F.lit("/first"))
    rows = _spec_doms(spark, sf_dir).select("page_id", tree.alias("t"), paged.alias("p"))
    return rows.select(
        "page_id",
        F.array_join("t.name", "|").alias("names"),
        F.array_join("t.url", "|").alias("urls"),
        F.array_join("p.url", "|").alias("urls_paged"),
    )


def _keys():
    return el.texts_where(dom(), _has("k"))


def _values():
    return el.texts_where(dom(), _has("v"))


@query(
    "ext20_spec_table",
    f"""SELECT p_partkey AS page_id,
        CASE WHEN p_partkey % 7 = 0 THEN '' ELSE 'Size=' || CAST(p_size AS STRING) || '|Brand=' || p_brand || '|EAN=' || {GTIN} END AS specs,
        p_partkey % 7 = 0 AS rejected FROM part""",
)
def spec_table(spark, sf_dir):
    loose, strict = fd.spec_table(_keys(), _values()), fd.spec_table(_keys(), _values(), strict=True)
    rows = _spec_doms(spark, sf_dir).select("page_id", loose.alias("s"), strict.isNull().alias("rejected"))
    return rows.select(
        "page_id",
        F.array_join(F.transform("s", lambda x: F.concat(x["key"], F.lit("="), x["value"])), "|").alias("specs"),
        "rejected",
    )


_JOIN = lambda s: F.array_join(F.transform(s, lambda x: F.concat(x["key"], F.lit("="), x["value"])), "|")


@query(
    "ext21_spec_lines",
    """SELECT p_partkey AS page_id, 'Type=' || p_type || '|Size=' || CAST(p_size AS STRING) AS dropped,
       'Type=' || p_type || '|no colon=|Size=' || CAST(p_size AS STRING) || '|=' AS as_key,
       '=Type: ' || p_type || '|=no colon|=Size: ' || CAST(p_size AS STRING) || ': cm' AS as_value,
       'Type' AS key_without_colon FROM part""",
)
def spec_lines(spark, sf_dir):
    text = F.get(el.texts_where(dom(), _has("lines")), 0)
    rows = _spec_doms(spark, sf_dir).select("page_id", text.alias("t"))
    colon = F.array(F.struct(F.lit("Type:").alias("key"), F.lit("x").alias("value")))
    return rows.select(
        "page_id",
        _JOIN(fd.spec_lines(c("t"), "drop")).alias("dropped"),
        _JOIN(fd.spec_lines(c("t"), "key")).alias("as_key"),
        _JOIN(fd.spec_lines(c("t"), "value")).alias("as_value"),
        F.get(fd.cut_key_colon(colon), 0)["key"].alias("key_without_colon"),
    )


@query(
    "ext22_spec_value",
    f"""SELECT p_partkey AS page_id, CASE WHEN p_partkey % 7 <> 0 THEN {GTIN} END AS exact,
        CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS any_case, CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS STRING) END AS part_of_key FROM part""",
)
def spec_value(spark, sf_dir):
    rows = _spec_doms(spark, sf_dir).select("page_id", fd.spec_table(_keys(), _values()).alias("s"))
    return rows.select(
        "page_id",
        fd.spec_value(c("s"), "EAN").alias("exact"),
        fd.spec_value(c("s"), "bRAND", "ignore_case").alias("any_case"),
        fd.spec_value(c("s"), "iz", "contains").alias("part_of_key"),
    )


@query(
    "ext23_images",
    """SELECT p_partkey AS page_id, 'https://i.example.se/' || CAST(p_partkey AS STRING) || '.jpg|https://i.example.se/b.jpg' AS gallery,
       'https://i.example.se/s' || CAST(p_size AS STRING) || '.jpg' AS first_of_set,
       'https://i.example.se/l' || CAST(p_size AS STRING) || '.jpg' AS last_of_set, 'main.jpg' AS fallback FROM part""",
)
def images(spark, sf_dir):
    shown = el.nodes_where(dom(), lambda n: (n["tag"] == "img") & el.inside(dom(), n, _has("gallery")))
    srcset = el.attr(el.first_node(dom(), _has("set")), "srcset")
    none = F.array().cast("array<string>")
    return _spec_doms(spark, sf_dir).select(
        "page_id",
        F.array_join(fd.images(F.transform(shown, lambda n: el.attr(n, "src"))), "|").alias("gallery"),
        fd.srcset_image(srcset, "first").alias("first_of_set"),
        fd.srcset_image(srcset, "last").alias("last_of_set"),
        F.array_join(fd.images(none, F.array(F.lit("main.jpg"))), "|").alias("fallback"),
    )


@query(
    "ext24_reviews",
    """SELECT p_partkey AS page_id, CASE WHEN p_size % 4 <> 0 THEN CAST(1000 + p_size AS BIGINT) END AS review_count,
       CASE WHEN p_size % 4 <> 0 THEN p_size % 5 + 1.5::DOUBLE END AS average_review, p_size + 0.5::DOUBLE AS star_average FROM part""",
)
def reviews(spark, sf_dir):
    count = fd.review_count(F.get(el.texts_where(dom(), _has("cnt")), 0))
    average = fd.review_average(F.get(el.texts_where(dom(), _has("avg")), 0))
    size = F.get(_values(), 0).cast("int")
    rows = _spec_doms(spark, sf_dir).select(
        "page_id", fd.reviews(count, average).alias("r"), fd.star_average(size, F.lit(1)).alias("star_average")
    )
    return rows.select("page_id", "r.review_count", "r.average_review", "star_average")


@query(
    "ext25_discount",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
       l_discount > 0.05 AS from_original, l_extendedprice * 0.5 AS lower_price, l_extendedprice AS higher_price,
       l_discount > 0.05 AS from_texts, l_discount > 0.02 AS by_sale_text,
       CASE WHEN l_discount > 0.08 THEN 'Cannot extract price' END AS reject_reason FROM lineitem""",
)
def discount(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    price, less = c("l_extendedprice"), c("l_extendedprice") * 0.5
    text = c("l_extendedprice").cast("string")
    other = F.when(c("l_discount") > 0.05, F.concat(F.lit("1"), text)).otherwise(text)
    pair = fd.discount_from_list(F.array(price, less))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        fd.discount_from_original(price, F.when(c("l_discount") > 0.05, price * 2))["is_discounted"].alias("from_original"),
        pair["price"].alias("lower_price"),
        pair["original_price"].alias("higher_price"),
        fd.discount_from_texts(text, other, parse_price)["is_discounted"].alias("from_texts"),
        fd.discount_with_sale_text(
            price, F.lit(None).cast("double"), F.when(c("l_discount") > 0.02, F.lit("Im Angebot!")), "Im Angebot"
        )["is_discounted"].alias("by_sale_text"),
        fd.discount_from_choice(
            F.when(c("l_discount") <= 0.05, price), F.when(c("l_discount") <= 0.08, less), price
        )["reject_reason"].alias("reject_reason"),
    )


@query(
    "ext26_availability_rule",
    """SELECT p_partkey AS page_id, CASE p_size % 3 WHEN 0 THEN 'in_stock' ELSE 'out_of_stock' END AS mark,
       CASE WHEN p_size % 2 = 0 OR p_size % 3 = 0 THEN 'in_stock' ELSE 'out_of_stock' END AS defaulted,
       CASE WHEN p_size % 2 = 0 THEN 'in_stock' ELSE 'out_of_stock' END AS button,
       CASE WHEN p_size % 3 = 1 THEN 'in_stock' ELSE 'out_of_stock' END AS tags,
       CASE WHEN p_size % 2 = 0 THEN 'out_of_stock' ELSE 'in_stock' END AS message,
       CASE p_size % 4 WHEN 0 THEN 'in_stock' WHEN 1 THEN 'out_of_stock' WHEN 2 THEN 'back_order' END AS colour FROM part""",
)
def availability_rule(spark, sf_dir):
    size = F.get(_values(), 0).cast("int")
    stock = F.element_at(F.array(*map(F.lit, ("http://schema.org/InStock", "x", "OutOfStock"))), size % 3 + 1)
    even = size % 2 == 0
    rows = _spec_doms(spark, sf_dir)
    return rows.select(
        "page_id",
        fd.availability_rule("in_stock_mark", stock).alias("mark"),
        fd.availability_rule("in_stock_default", F.when(~even, stock)).alias("defaulted"),
        fd.availability_rule("text_and_button", F.lit("Order now"), F.when(even, F.lit("Add"))).alias("button"),
        fd.availability_rule("tags", F.array(F.lit("x"), F.when(size % 3 == 1, F.lit(" Disponible ")))).alias("tags"),
        fd.availability_rule("not_available", F.when(even, F.lit("Ej tillgänglig nu")).otherwise(F.lit("I lager"))).alias("message"),
        fd.availability_rule("colour", el.attr(el.first_node(dom(), _has("inventory")), "class")).alias("colour"),
    )


@query(
    "ext27_transpose_specs",
    """SELECT p_partkey AS page_id, CAST(v AS BIGINT) AS variant, 'Size=' || CAST(p_size + v AS STRING) || '|Type=' || p_type || CAST(v AS STRING) AS specs
       FROM part, (SELECT unnest([0, 1, 2]) AS v) WHERE p_partkey % 6 <> 0""",
)
def transpose_specs(spark, sf_dir):
    rows = parts(spark, sf_dir).select(
        c("p_partkey").alias("page_id"),
        F.array(F.lit("Size"), F.lit(" Type ")).alias("k"),
        # row by row: all sizes, then all types; every sixth page is one short
        F.expr(
            "slice(array('' || p_size, '' || (p_size + 1), '' || (p_size + 2), p_type || 0, p_type || 1, p_type || 2), 1,"
            " CASE WHEN p_partkey % 6 = 0 THEN 5 ELSE 6 END)"
        ).alias("v"),
    )
    lists = fd.transpose_specs(c("k"), c("v"), F.lit(3))
    return rows.select("page_id", F.posexplode(lists).alias("variant", "s")).select(
        "page_id", c("variant").cast("bigint").alias("variant"), _JOIN(c("s")).alias("specs")
    )


@query(
    "ext28_pick_by_sku",
    """SELECT p_partkey AS page_id, CASE WHEN p_size % 3 = 0 THEN 1 ELSE 0 END AS n,
       CASE WHEN p_size % 3 = 0 THEN 1 END AS n_strict FROM part""",
)
def pick_by_sku(spark, sf_dir):
    records = F.array(
        F.struct(F.lit("a").alias("sku"), F.lit(0).alias("n")),
        F.struct(c("p_partkey").cast("string").alias("sku"), F.lit(1).alias("n")),
    )
    sku = F.when(c("p_size") % 3 == 0, c("p_partkey").cast("string")).otherwise(F.lit("none"))
    return parts(spark, sf_dir).select(
        c("p_partkey").alias("page_id"),
        fd.pick_by_sku(records, sku)["n"].alias("n"),
        fd.pick_by_sku(records, sku, or_first=False)["n"].alias("n_strict"),
    )


@query(
    "ext29_description",
    """SELECT p_partkey AS page_id, 'A ' || p_type || ' one' AS section,
       concat_ws(chr(10), p_name, 'Download image', p_name, 'Soft. Specs: hard') AS joined,
       concat_ws(chr(10) || chr(10), p_name, 'Download image', 'Soft. Specs: hard') AS uniq,
       p_name || ' ' || p_name || ' Soft. Specs: hard' AS filtered, 'Soft. ' AS cut FROM part""",
)
def description(spark, sf_dir):
    texts = el.texts_where(dom(), lambda n: (n["tag"] == "p") & el.has_class(n, "d"))
    return _spec_doms(spark, sf_dir).select(
        "page_id",
        fd.section_text(dom(), "h3", "About", "body").alias("section"),
        fd.description(texts, "join").alias("joined"),
        fd.description(texts, "unique").alias("uniq"),
        fd.description(texts, "without", "Download").alias("filtered"),
        fd.description(F.slice(texts, 4, 1), "cut", "Specs:").alias("cut"),
    )


@query(
    "ext30_product_name",
    "SELECT p_partkey AS page_id, p_name || ' ' || p_brand AS joined, p_name AS first_line FROM part",
)
def product_name(spark, sf_dir):
    heading = F.get(el.texts_where(dom(), _has("title")), 0)
    sub = F.get(el.texts_where(dom(), _has("sub")), 0)
    return _spec_doms(spark, sf_dir).select(
        "page_id",
        fd.product_name(F.array(F.substring_index(heading, "\n", 1), F.lit(" "), sub)).alias("joined"),
        fd.product_name(F.array(heading), "first_line").alias("first_line"),
    )


@query(
    "ext31_price_or_default",
    """SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN value WHEN event_type = 'error' THEN 0 END AS price,
       CASE WHEN event_id % 3 = 0 AND event_type <> 'error' THEN 'Cannot extract price' END AS reject_reason,
       CASE WHEN event_type <> 'error' THEN value END AS price_or_null FROM events""",
)
def price_or_default(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    price = F.when(c("event_id") % 3 != 0, c("value"))
    stock = F.when(c("event_type") == "error", F.lit("out_of_stock")).otherwise(F.lit("in_stock"))
    text = F.when(c("event_type") == "error", F.lit("Slutsåld!")).otherwise(c("value").cast("string"))
    zero = fd.price_or_default(price, stock, "zero")
    return rows.select(
        "event_id",
        zero["price"].alias("price"),
        zero["reject_reason"].alias("reject_reason"),
        fd.price_or_default(c("value"), stock, "null", text)["price"].alias("price_or_null"),
    )
