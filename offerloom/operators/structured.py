"""Offers from JSON-LD blocks.

Blocks are parsed to VARIANT once and stay in the row as an array, so choosing
a product and an offer needs no shuffle: a page is one row from start to end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from offerloom.functions.missing import blank_to_null
from offerloom.functions.prices import parse_price_safe
from offerloom.functions.urls import (
    _query_pairs,
    comparable_url,
    let,
    normalise_url,
    url_included,
)

OFFER_TYPE = (
    "struct<strategy: string, found: boolean, name: string, gtin: string, mpn: string,"
    " price: double, currency: string, availability: string, images: array<string>,"
    " metadata: string>"
)
_BLOCK = (
    r"(?is)<script[^>]*?type\s*=\s*[\"']?\s*application(?:/|&#x0*2f;|&#0*47;|&sol;)ld(?:\+|&#x0*2b;|&#0*43;|&plus;)json"
    r"[^>]*>(.*?)</script\s*>"
)
_RELAXED = {
    "allowSingleQuotes": "true",
    "allowUnquotedFieldNames": "true",
    "allowUnquotedControlChars": "true",
    "allowBackslashEscapingAnyCharacter": "true",
    "allowNumericLeadingZeros": "true",
}


def jsonld_bodies(html: Column) -> Column:
    """All JSON-LD script bodies of a page, in order."""
    found = F.regexp_extract_all(html, F.lit(_BLOCK), F.lit(1))
    return F.coalesce(found, F.array().cast("array<string>"))


def jsonld_blocks(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per JSON-LD block with its position; the HTML is dropped."""
    keep = [c for c in pages.columns if c != html]
    return pages.select(
        *keep, F.posexplode(jsonld_bodies(F.col(html))).alias("block_pos", "block")
    )


def parse_jsonld(body: Column) -> Column:
    """Block text -> VARIANT; strict JSON first, then a lenient reading, then
    one without trailing commas, and NULL for a block that is beyond repair."""
    clean = F.regexp_replace(body, r"(?s)/\*.*?\*/", "")
    clean = F.regexp_replace(clean, r"(?s)<!\[CDATA\[.*?\]\]>", "")
    clean = F.regexp_replace(clean, r"\n", " ")
    return let(
        clean,
        lambda t: F.coalesce(
            F.try_parse_json(t),
            F.from_json(t, "variant", _RELAXED),
            F.from_json(F.regexp_replace(t, r",(\s*[}\]])", "$1"), "variant", _RELAXED),
        ),
    )


def get(v: Column, path: str) -> Column:
    """Text at a path of a VARIANT, NULL when absent."""
    return F.try_variant_get(v, path, "string")


def _is_product(v: Column) -> Column:
    return F.coalesce(F.endswith(get(v, '$["@type"]'), F.lit("Product")), F.lit(False))


def _products_in(block: Column) -> Column:
    none = F.array().cast("array<variant>")
    listed = F.try_variant_get(block, "$", "array<variant>")
    graph = F.try_variant_get(block, '$["@graph"]', "array<variant>")
    return F.coalesce(
        F.when(listed.isNotNull(), F.filter(listed, _is_product))
        .when(_is_product(block), F.array(block))
        .otherwise(F.filter(graph, _is_product)),
        none,
    )


def products_of(html: Column) -> Column:
    """All product entries of a page as ``array<variant>``."""
    return F.flatten(
        F.transform(jsonld_bodies(html), lambda b: let(parse_jsonld(b), _products_in))
    )


def jsonld_products(blocks: DataFrame, block: str = "block") -> DataFrame:
    """One row per product entry found in the blocks."""
    keep = [c for c in blocks.columns if c != block]
    parsed = blocks.withColumn("_v", parse_jsonld(F.col(block)))
    return parsed.select(
        *keep, F.posexplode(_products_in(F.col("_v"))).alias("product_pos", "product")
    )


# Identifier fields of an offered item.
_ITEM_IDS = ("productID", "sku", "gtin13", "gtin", "mpn", "serialNumber", "identifier")


def _url_tokens(url: Column) -> Column:
    word = F.lit(r"(\w+)")
    path = F.regexp_extract(normalise_url(url), r"^[^:]+://[^/]+([^?#]*)", 1)
    values = F.transform(
        _query_pairs(url), lambda p: F.regexp_extract_all(p["v"], word, F.lit(1))
    )
    tokens = F.concat(F.regexp_extract_all(path, word, F.lit(1)), F.flatten(values))
    return F.transform(tokens, lambda t: F.lower(t))


def best_entry(entries: Column, url: Column) -> Column:
    """The entry that fits the page URL best.

    Longest entry URL included in the page URL; else the first entry whose
    item identifiers share a token with the page URL; else the first.
    """

    def choose(e: Column) -> Column:
        scored = F.transform(
            e,
            lambda v, i: F.struct(
                F.when(
                    url_included(url, get(v, "$.url")), F.length(get(v, "$.url"))
                ).alias("size"),
                (-i).alias("back"),
            ),
        )
        longest = F.array_max(F.filter(scored, lambda s: s["size"] > 0))

        def by_identifier(tokens: Column) -> Column:
            def hit(v: Column) -> Column:
                ids = F.filter(
                    F.array(*[F.lower(get(v, f"$.itemOffered.{k}")) for k in _ITEM_IDS]),
                    lambda i: i.isNotNull() & (i != ""),
                )
                return F.exists(
                    ids,
                    lambda i: F.exists(
                        tokens, lambda t: F.contains(i, t) | F.contains(t, i)
                    ),
                )

            return F.array_position(F.transform(e, hit), F.lit(True))

        position = (
            F.when(F.size(e) <= 1, F.lit(1))
            .when(longest.isNotNull(), 1 - longest["back"])
            .otherwise(
                F.greatest(let(_url_tokens(url), by_identifier), F.lit(1))
            )
        )
        return F.try_element_at(e, position.cast("int"))

    return let(entries, choose)


def resolve_offer(product: Column, url: Column) -> Column:
    """The offer of a product: of a list the best entry, of an aggregate the
    first individual offer."""

    def truthy(path: str) -> Column:
        return F.when(
            ~F.coalesce(get(product, path), F.lit("")).isin("", "false", "0"),
            F.try_variant_get(product, path, "variant"),
        )

    def one(offers: Column) -> Column:
        listed = F.try_variant_get(offers, "$", "array<variant>")
        return F.when(listed.isNotNull(), best_entry(listed, url)).otherwise(offers)

    def unwrap(offer: Column) -> Column:
        aggregate = F.endswith(get(offer, '$["@type"]'), F.lit("AggregateOffer"))
        return F.when(
            F.coalesce(aggregate, F.lit(False)),
            F.try_variant_get(offer, "$.offers[0]", "variant"),
        ).otherwise(offer)

    chosen = F.coalesce(truthy("$.offers"), truthy("$.Offers"))
    return let(let(chosen, one), unwrap)


# Where identifiers, price, currency and availability may stand,
# in order of preference.
GTIN_FIELDS = ("gtin", "gtin14", "gtin13", "gtin12", "gtin8")
PRICE_PATHS = (
    "$.priceSpecification.price",
    "$.PriceSpecification.Price",
    "$.price",
    "$.Price",
)
CURRENCY_PATHS = (
    "$.priceSpecification.priceCurrency",
    "$.PriceSpecification.PriceCurrency",
    "$.priceCurrency",
    "$.PriceCurrency",
)
AVAILABILITY_PATHS = ("$.availability", "$.Availability")


def _first_text(*candidates: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in candidates])


def _price(offer: Column) -> Column:
    """Price of an offer: the first stated value that is neither the number 0
    nor empty text, read as a number."""

    def stated(v: Column) -> Column:
        text = F.try_variant_get(v, "$", "string")
        blank = (text == "") | (
            (F.schema_of_variant(v) != "STRING") & (F.try_variant_get(v, "$", "double") == 0)
        )
        return F.when(~F.coalesce(blank, text.isNull()), v)

    def read(v: Column) -> Column:
        return F.when(
            F.schema_of_variant(v) == "STRING",
            let(F.try_variant_get(v, "$", "string"), parse_price_safe),
        ).otherwise(F.try_variant_get(v, "$", "double"))

    values = F.array(*[F.try_variant_get(offer, p, "variant") for p in PRICE_PATHS])
    return let(F.get(F.filter(F.transform(values, stated), lambda v: v.isNotNull()), 0), read)


def offer_fields(product: Column, offer: Column) -> Column:
    """Offer struct from a product and its offer, by priority lists."""
    gtin = _first_text(
        *[get(offer, f"$.{k}") for k in GTIN_FIELDS],
        *[get(product, f"$.{k}") for k in GTIN_FIELDS],
    )
    availability = _first_text(
        *[F.substring_index(get(offer, p), "/", -1) for p in AVAILABILITY_PATHS]
    )
    build = lambda price: F.struct(
        F.lit("schema-json").alias("strategy"),
        F.coalesce(price != 0, F.lit(False)).alias("found"),
        get(product, "$.name").alias("name"),
        gtin.alias("gtin"),
        _first_text(get(offer, "$.mpn"), get(product, "$.mpn")).alias("mpn"),
        price.alias("price"),
        _first_text(*[get(offer, p) for p in CURRENCY_PATHS]).alias("currency"),
        availability.alias("availability"),
        F.array().cast("array<string>").alias("images"),
        F.to_json(product).alias("metadata"),
    )
    return let(_price(offer), build)


def jsonld_offer(html: Column, url: Column) -> Column:
    """Offer struct of a page from its JSON-LD; NULL without a product."""
    current = comparable_url(url)

    def from_product(product: Column) -> Column:
        return F.when(
            product.isNotNull(),
            let(resolve_offer(product, current), lambda o: offer_fields(product, o)),
        )

    def from_products(products: Column) -> Column:
        return F.when(
            F.size(products) > 0, let(best_entry(products, current), from_product)
        )

    return let(products_of(html), from_products)


def jsonld_offers(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """One row per page with a priced JSON-LD offer: page columns without the
    HTML plus the offer fields. The generator keeps the optimizer from
    evaluating the offer once per field."""
    keep = [c for c in pages.columns if c not in (html, url)]
    offer = jsonld_offer(F.col(html), F.col(url))
    priced = F.filter(F.array(offer), lambda o: o["found"])
    return pages.select(*keep, url, F.inline(priced))


def breadcrumbs_of(html: Column) -> Column:
    """Category path of the first breadcrumb block, without its first crumb."""
    blocks = F.filter(
        jsonld_bodies(html),
        lambda b: F.contains(b, F.lit("schema.org"))
        & F.contains(b, F.lit("BreadcrumbList")),
    )
    items = F.try_variant_get(
        parse_jsonld(F.try_element_at(blocks, F.lit(1))), "$.itemListElement", "array<variant>"
    )
    crumbs = F.transform(
        items,
        lambda i: F.struct(
            get(i, "$.item.name").alias("name"), get(i, '$.item["@id"]').alias("url")
        ),
    )
    return F.slice(crumbs, F.lit(2), F.greatest(F.size(crumbs), F.lit(1)))


def jsonld_breadcrumbs(pages: DataFrame, html: str = "html") -> DataFrame:
    keep = [c for c in pages.columns if c != html]
    return pages.select(*keep, breadcrumbs_of(F.col(html)).alias("category_tree"))


def static_offer(
    pages: DataFrame, html: str = "html", url: str = "url", currency: str = "SEK"
) -> DataFrame:
    """Offer of a static page whose JSON-LD carries no price: the domain
    defaults (price 0, in stock, not discounted) fill the gaps."""
    keep = [c for c in pages.columns if c not in (html, url)]
    product = F.try_element_at(products_of(F.col(html)), F.lit(1))
    fields = let(
        product,
        lambda p: F.struct(
            get(p, "$.name").alias("name"),
            get(p, "$.brand.name").alias("brand"),
            get(p, "$.description").alias("description"),
            get(p, "$.gtin").alias("gtin"),
            get(p, "$.mpn").alias("sku"),
            breadcrumbs_of(F.col(html)).alias("category_tree"),
            F.to_json(p).alias("metadata"),
            p.isNotNull().alias("found"),
        ),
    )
    return (
        pages.select(
            *keep,
            F.col(url).alias("url"),
            F.inline(F.filter(F.array(fields), lambda f: f["found"])),
        )
        .select(
            *keep,
            "url",
            "name",
            "brand",
            "description",
            "gtin",
            "sku",
            "category_tree",
            F.array().cast("array<string>").alias("images"),
            F.lit(0.0).alias("price"),
            F.lit(currency).alias("currency"),
            F.lit(False).alias("is_discounted"),
            F.lit("in_stock").alias("availability"),
            F.array().cast("array<struct<key: string, value: string>>").alias("specifications"),
            "metadata",
        )
    )
