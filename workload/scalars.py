"""Scalar functions over table columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom import functions as fn
from workload.registry import query
from workload.views import (
    AVAILABILITY,
    AVAILABILITY_SNAKE,
    CENTS,
    CURRENCY,
    DOMAIN,
    STYLE,
    TLD,
    URL,
    numbered_lines,
    parts,
    price_texts,
    table,
)

c = F.col

_KEYS = "l_orderkey, l_linenumber, l_partkey"
_PRICE_SQL = "SELECT " + _KEYS + ", {value} AS price FROM lineitem"


@query(
    "scl1_parse_price",
    _PRICE_SQL.format(
        value=f"CASE WHEN {STYLE} % 6 >= 4 THEN CAST({CENTS} // 100 AS DOUBLE) ELSE {CENTS} / 100.0::DOUBLE END"
    ),
)
def parse_price(spark, sf_dir):
    text = """CASE style % 6
        WHEN 0 THEN grouped || '.' || frac || ' EUR'
        WHEN 1 THEN translate(grouped, ',', '.') || ',' || frac || ' kr.'
        WHEN 2 THEN translate(grouped, ',', ' ') || ',' || frac || ' kr'
        WHEN 3 THEN '$ ' || whole || '.' || frac
        WHEN 4 THEN 'SEK ' || whole
        ELSE translate(grouped, ',', '.') || ' :-' END"""
    return price_texts(spark, sf_dir).selectExpr(*_KEYS.split(", "), f"{text} AS t").select(
        *_KEYS.split(", "), fn.parse_price(c("t")).alias("price")
    )


@query(
    "scl2_parse_price_safe",
    _PRICE_SQL.format(value=f"{CENTS} / 100.0::DOUBLE"),
)
def parse_price_safe(spark, sf_dir):
    text = """CASE style % 3 WHEN 0 THEN whole || '.' || frac || '0'
        WHEN 1 THEN whole || '.' || frac ELSE grouped || '.' || frac || ' SEK' END"""
    return price_texts(spark, sf_dir).selectExpr(*_KEYS.split(", "), f"{text} AS t").select(
        *_KEYS.split(", "), fn.parse_price_safe(c("t")).alias("price")
    )


_STYLE_TEXTS = {
    "dot_thousands": "translate(grouped, ',', '.') || ',' || frac || ' kr.'",
    "dot_thousands_whole": "'Før ' || translate(grouped, ',', '.') || ',' || frac || ' DKK'",
    "single_number": "whole || ',' || frac || ' kr/ par'",
    "blank_thousands_kr": "translate(grouped, ',', ' ') || ' kr'",
    "blank_thousands_whole": "'fr.' || translate(grouped, ',', ' ') || ' kr'",
    "euro_blank": "translate(grouped, ',', ' ') || ',' || frac || ' €'",
    "listed_price": "'UVP ' || translate(grouped, ',', '.') || ',' || frac || ' DKK'",
    "digits": "translate(grouped, ',', ' ') || ' kr'",
    "before_comma": "translate(grouped, ',', '.') || ',' || frac",
    "amount_and_symbol": "translate(grouped, ',', '.') || ',' || frac || ' €'",
}
_WHOLE = ("dot_thousands_whole", "blank_thousands_kr", "blank_thousands_whole", "digits", "before_comma")
_WHOLE_AT = ", ".join(str(i) for i, s in enumerate(_STYLE_TEXTS) if s in _WHOLE)


@query(
    "scl3_parse_price_as",
    _PRICE_SQL.format(
        value=f"CASE WHEN {STYLE} % 10 IN ({_WHOLE_AT}) THEN CAST({CENTS} // 100 AS DOUBLE) ELSE {CENTS} / 100.0::DOUBLE END"
    ),
)
def parse_price_as(spark, sf_dir):
    texts = price_texts(spark, sf_dir)
    price = F.lit(None).cast("double")
    for i, (style, text) in enumerate(_STYLE_TEXTS.items()):
        price = F.when(c("style") % 10 == i, fn.parse_price_as(F.expr(text), style)).otherwise(price)
    return texts.select(*_KEYS.split(", "), price.alias("price"))


_HOST = "regexp_extract(url, '^https?://([^/?#]+)', 1)"


@query(
    "scl4_domain_of",
    f"SELECT page_id, regexp_replace(regexp_replace({_HOST}, '^www\\.', ''), '^www2\\.', '') AS domain FROM pages",
)
def domain_of(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", fn.domain_of(c("url")).alias("domain"))


@query(
    "scl5_country_of",
    f"SELECT p_partkey, {DOMAIN} AS domain, nullif({TLD}, 'com') AS country FROM part",
)
def country_of(spark, sf_dir):
    return parts(spark, sf_dir).select(
        "p_partkey",
        fn.domain_of(c("url")).alias("domain"),
        fn.country_of(fn.domain_of(c("url"))).alias("country"),
    )


@query(
    "scl6_first_number",
    "SELECT event_id, CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS k FROM events",
)
def first_number(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", fn.first_number(c("props")).alias("k"))


@query(
    "scl7_currency_iso",
    f"SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'GBP' ELSE nullif({CURRENCY}, 'USD') END AS currency FROM part",
)
def currency_iso(spark, sf_dir):
    symbol = F.expr("CASE p_size % 4 WHEN 0 THEN '€' WHEN 1 THEN '£' ELSE 'kr' END")
    return parts(spark, sf_dir).select(
        "p_partkey", fn.currency_iso(symbol, fn.country_of(c("domain"))).alias("currency")
    )


@query(
    "scl8_currency_token",
    f"""SELECT p_partkey, {CURRENCY} AS rest,
        CASE p_size % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN {CURRENCY} ELSE 'kr' END AS first_word,
        CASE p_size % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN {CURRENCY} ELSE '' END AS capitals,
        CASE p_size % 3 WHEN 2 THEN {CURRENCY} WHEN 0 THEN 'EUR' ELSE {CURRENCY} END AS with_fallback
        FROM part""",
)
def currency_token(spark, sf_dir):
    mixed = F.expr(
        "CAST(p_retailprice AS STRING) || ' ' || CASE p_size % 3 WHEN 0 THEN '€' WHEN 1 THEN currency ELSE 'kr' END"
    )
    rows = parts(spark, sf_dir).withColumn("t", mixed)
    word = fn.currency_token(c("t"), "first_word")
    return rows.select(
        "p_partkey",
        fn.currency_token(F.expr("CAST(p_retailprice AS STRING) || ' ' || currency")).alias("rest"),
        word.alias("first_word"),
        fn.currency_token(c("t"), "capitals").alias("capitals"),
        fn.currency_or(word, c("currency")).alias("with_fallback"),
    )


_SNAKE = "lower(substr({s}, 1, 1) || regexp_replace(substr({s}, 2), '([A-Z])', '_\\1', 'g'))"


@query(
    "scl9_snake",
    f"""SELECT p_partkey, {_SNAKE.format(s="p_type || 'Lamp' || p_brand")} AS snake,
        {AVAILABILITY_SNAKE} AS availability FROM part""",
)
def snake(spark, sf_dir):
    return parts(spark, sf_dir).select(
        "p_partkey",
        fn.snake(F.concat("p_type", F.lit("Lamp"), "p_brand")).alias("snake"),
        fn.availability_of(F.concat(F.lit("https://schema.org/"), "availability")).alias("availability"),
    )


@query(
    "scl10_is_availability",
    f"SELECT p_partkey, p_size % 4 <> 3 AS allowed FROM part",
)
def is_availability(spark, sf_dir):
    value = F.expr(
        "CASE p_size % 4 WHEN 0 THEN 'in_stock' WHEN 1 THEN 'back_order' WHEN 2 THEN 'pre_sale' ELSE 'discontinued' END"
    )
    return parts(spark, sf_dir).select("p_partkey", fn.is_availability(value).alias("allowed"))


# Links of the pages table, resolved: every one is root-relative.
ANCHORS_SQL = """
    SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href,
           generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) - 1 AS pos
    FROM pages"""
ENCODED = """array_to_string(list_transform(regexp_extract_all({u}, '(?s).'),
    lambda ch: CASE WHEN regexp_matches(ch, '[^\\x21-\\x7e]|["<>`{{}}]') THEN url_encode(ch) ELSE ch END), '')"""


@query(
    "scl11_normalise_url",
    f"""SELECT page_id, CAST(pos AS BIGINT) AS pos,
        {ENCODED.format(u="regexp_extract(url, '^(https?://[^/?#]+)', 1) || href")} AS link
        FROM ({ANCHORS_SQL})""",
)
def normalise_url(spark, sf_dir):
    from offerloom.operators.links import links

    return links(table(spark, sf_dir, "pages")).select(
        "page_id", c("pos").cast("bigint").alias("pos"), fn.normalise_url(c("href"), c("url")).alias("link")
    )


@query(
    "scl12_comparable_url",
    f"""SELECT page_id, CAST(pos AS BIGINT) AS pos,
        regexp_replace(regexp_extract(url, '^(https?://[^/?#]+)', 1) || href, '/+$', '') AS link
        FROM ({ANCHORS_SQL})""",
)
def comparable_url(spark, sf_dir):
    """Encoding a link and decoding it again gives the link back."""
    from offerloom.operators.links import links

    return links(table(spark, sf_dir, "pages")).select(
        "page_id",
        c("pos").cast("bigint").alias("pos"),
        fn.comparable_url(fn.normalise_url(c("href"), c("url"))).alias("link"),
    )


@query(
    "scl13_is_product_url",
    "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_product FROM part",
)
def is_product_url(spark, sf_dir):
    domain = F.expr("CASE p_size % 3 WHEN 0 THEN 'chilli.se' WHEN 1 THEN 'bygghemma.se' ELSE 'other.se' END")
    # "-p12" is a product URL of the first domain; the second wants "p-12"
    return parts(spark, sf_dir).select("p_partkey", fn.is_product_url(c("url"), domain).alias("is_product"))


@query(
    "scl14_product_id",
    """SELECT p_partkey, 'B' || CAST(p_partkey AS STRING) AS asin, CAST(p_partkey AS STRING) AS page_number,
       CAST(p_partkey AS STRING) || ',' || CAST(p_size AS STRING) AS piid, CAST(p_size AS STRING) AS suffix FROM part""",
)
def product_id(spark, sf_dir):
    u = {
        "asin": "'https://www.amazon.de/-/en/' || replace(p_name, ' ', '-') || '/dp/B' || p_partkey || '/ref=s?k=1'",
        "page": "'https://www2.hm.com/de_de/productpage.' || p_partkey || '.html'",
        "piid": "'https://www.wayfair.de/pdp/x.html?a=1&piid=' || p_partkey || '%2C' || p_size",
        "suffix": "'https://www.louispoulsen.com/x?v-' || p_size || '&a=1'",
    }
    return parts(spark, sf_dir).select(
        "p_partkey",
        fn.product_id(F.expr(u["asin"]), "asin").alias("asin"),
        fn.product_id(F.expr(u["page"]), "productpage").alias("page_number"),
        fn.product_id(F.expr(u["piid"]), "piid").alias("piid"),
        fn.product_id(F.expr(u["suffix"]), "query_suffix").alias("suffix"),
    )


@query(
    "scl15_sku_of",
    """SELECT p_partkey, CAST(p_partkey AS STRING) AS article, CAST(p_size AS STRING) || '-' || CAST(p_partkey AS STRING) AS colon,
       CASE WHEN p_size % 2 = 0 THEN 'GR' || CAST(p_partkey AS STRING) || '-x' END AS dash,
       lpad(CAST(p_partkey AS STRING), 13, '0') AS cut, CAST(p_partkey AS STRING) AS label FROM part""",
)
def sku_of(spark, sf_dir):
    return parts(spark, sf_dir).select(
        "p_partkey",
        fn.sku_of(F.expr("'A ' || p_name || '\nArtikelnummer: ' || p_partkey || ' \nmore'"), "after_article_label").alias("article"),
        fn.sku_of(F.expr("'Artikelnummer: ' || p_size || '-' || p_partkey"), "after_colon").alias("colon"),
        fn.sku_of(F.expr("CASE WHEN p_size % 2 = 0 THEN ' 60-GR' || p_partkey || '-x' ELSE 'GR' END"), "after_first_dash").alias("dash"),
        fn.sku_of(F.expr("lpad(p_partkey, 13, '0') || 'USA'"), "cut_country").alias("cut"),
        fn.sku_of(F.expr("'Artikelnummer: ' || p_partkey"), "drop_label").alias("label"),
    )


@query(
    "scl16_mpn_of",
    """SELECT p_partkey, CAST(p_partkey AS STRING) AS same, CAST(p_partkey AS STRING) AS drop_two,
       CASE WHEN p_size % 2 = 0 THEN CAST(p_partkey AS STRING) || '-' || CAST(p_size AS STRING) END AS drop_vd,
       'GR' || CAST(p_partkey AS STRING) AS drop_m FROM part""",
)
def mpn_of(spark, sf_dir):
    return parts(spark, sf_dir).select(
        "p_partkey",
        fn.mpn_of(c("p_partkey").cast("string"), "same").alias("same"),
        fn.mpn_of(F.expr("'AB' || p_partkey"), "drop_two").alias("drop_two"),
        fn.mpn_of(F.expr("CASE WHEN p_size % 2 = 0 THEN 'VD' ELSE 'X' END || p_partkey || '-' || p_size || '-340x240-cm'"), "drop_vd").alias("drop_vd"),
        fn.mpn_of(F.expr("'M' || p_size || '-GR' || p_partkey"), "drop_m_prefix").alias("drop_m"),
    )


@query("scl17_clean_brand", "SELECT p_partkey, p_brand AS brand FROM part")
def clean_brand(spark, sf_dir):
    text = F.expr(
        "CASE p_size % 4 WHEN 0 THEN 'Eget lager - ' || p_brand WHEN 1 THEN p_brand || ' EGET  LAGER'"
        " WHEN 2 THEN p_brand || ' - eget lager' ELSE p_brand END"
    )
    return parts(spark, sf_dir).select("p_partkey", fn.clean_brand(text).alias("brand"))


@query(
    "scl18_clean_image",
    """SELECT p_partkey, 'https://i.se/' || CAST(p_partkey AS STRING) || '.jpg' AS query_cut,
       'https://i.se/' || CAST(p_partkey AS STRING) || '.jpg' AS with_scheme,
       'https://i.se/shop/' || CAST(p_partkey AS STRING) || '.jpg' AS full_size FROM part""",
)
def clean_image(spark, sf_dir):
    return parts(spark, sf_dir).select(
        "p_partkey",
        fn.clean_image(F.expr("'https://i.se/' || p_partkey || '.jpg?w=' || p_size"), "query").alias("query_cut"),
        fn.clean_image(F.expr("'//i.se/' || p_partkey || '.jpg?w=1'"), "scheme").alias("with_scheme"),
        fn.clean_image(F.expr("'https://i.se/shop/_thumbs/' || p_partkey || '.w60.h60.crop.jpg'"), "thumbnail").alias("full_size"),
    )


@query(
    "scl19_squash",
    "SELECT doc_id, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS squashed FROM documents",
)
def squash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(fn.squash(c("text"))).alias("squashed"))


_CAMEL = ("fetchedAt", "categoryTree", "variantGroupUrl", "url")


@query(
    "scl20_snake_name",
    "SELECT p_partkey AS url, p_size AS fetched_at, p_name AS category_tree, p_brand AS variant_group_url FROM part",
)
def snake_name(spark, sf_dir):
    rows = parts(spark, sf_dir).select(
        c("p_size").alias("fetchedAt"),
        c("p_name").alias("categoryTree"),
        c("p_brand").alias("variantGroupUrl"),
        c("p_partkey").alias("url"),
    )
    return rows.toDF(*[fn.snake_name(n) for n in _CAMEL])


@query(
    "scl21_simple",
    """SELECT p_partkey, '{"key":"Size","value":"' || CAST(p_size AS STRING) || '"}' AS spec,
       '{"key":"Brand","value":"' || p_brand || '"}|{"key":"Size","value":"' || CAST(p_size AS STRING) || '"}' AS specs
       FROM part""",
)
def simple(spark, sf_dir):
    rows = parts(spark, sf_dir).select(
        "p_partkey",
        F.struct(F.lit("Size").alias("key"), c("p_size").cast("string").alias("value")).alias("spec"),
        F.struct(F.lit("Brand").alias("key"), c("p_brand").alias("value")).alias("brand"),
    ).withColumn("specs", F.array("brand", "spec"))
    types = {f.name: f.dataType for f in rows.schema.fields}
    return rows.select(
        "p_partkey",
        fn.simple(c("spec"), types["spec"]).alias("spec"),
        F.array_join(fn.simple(c("specs"), types["specs"]), "|").alias("specs"),
    )


@query(
    "scl22_stars",
    "SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL ELSE CAST(p_size * 2 AS DOUBLE) / 100 * 5 END AS score FROM part",
)
def stars(spark, sf_dir):
    style = F.expr("CASE WHEN p_size % 5 = 0 THEN 'height:1px' ELSE 'width:' || (p_size * 2) || '%;' END")
    return parts(spark, sf_dir).select("p_partkey", fn.stars(style).alias("score"))


@query(
    "scl23_strip_query",
    "SELECT page_id, regexp_extract(url, '^([^?]*)', 1) AS bare, contains(url, '/brand') AS is_brand FROM pages",
)
def strip_query(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", fn.strip_query(c("url")).alias("bare"), fn.is_brand_url(c("url")).alias("is_brand")
    )
