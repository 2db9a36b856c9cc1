"""Offers from page markup: microdata, OpenGraph and shop-plugin pages.

All three read the node list of :mod:`offerloom.operators.elements`.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from offerloom.functions.missing import blank_to_null
from offerloom.functions.prices import (
    currency_iso,
    currency_token,
    parse_price,
    parse_price_safe,
)
from offerloom.functions.text import trim_text
from offerloom.functions.urls import country_of, domain_of, let
from offerloom.operators.elements import (
    attr,
    first_node,
    has_class,
    inside,
    nodes_where,
    text_of,
)

# OpenGraph properties in order of preference.
OG_NAME = ("og:title",)
OG_PRICE_WITH_CURRENCY = ("g:sale_price", "g:price")
OG_PRICE = (
    "og:sale_price:amount",
    "og:price:amount",
    "product:sale_price:amount",
    "product:price:amount",
)
OG_CURRENCY = (
    "og:sale_price:currency",
    "og:price:currency",
    "product:sale_price:currency",
    "product:price:currency",
)
OG_AVAILABILITY = ("g:availability", "og:availability", "product:availability")


def _offer(strategy: str, **fields: Column) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(
        F.lit(strategy).alias("strategy"),
        F.coalesce(fields["found"], F.lit(False)).alias("found"),
        fields.get("name", none).alias("name"),
        none.alias("gtin"),
        none.alias("mpn"),
        fields["price"].alias("price"),
        fields.get("currency", none).alias("currency"),
        fields.get("availability", none).alias("availability"),
        fields.get("images", F.array().cast("array<string>")).alias("images"),
        none.alias("metadata"),
    )


def _prop(name: str):
    return lambda n: attr(n, "itemprop") == name


def microdata_offer(dom: Column) -> Column:
    """Offer struct from ``itemprop`` attributes."""
    product_type = "https://schema.org/Product"
    names = nodes_where(
        dom,
        lambda n: (attr(n, "itemprop") == "name")
        & inside(dom, n, lambda a: attr(a, "itemtype") == product_type),
    )
    name = F.when(
        F.size(names) == 1,
        let(
            F.element_at(names, 1),
            lambda n: F.coalesce(blank_to_null(attr(n, "content")), text_of(dom, n)),
        ),
    )

    def with_price(node: Column) -> Column:
        texts = F.filter(
            F.array(attr(node, "content"), text_of(dom, node)), lambda t: t.isNotNull()
        )
        price = F.when(node.isNotNull(), parse_price_safe(F.get(texts, 0)))
        stated = let(
            first_node(dom, _prop("priceCurrency")),
            lambda n: F.coalesce(
                blank_to_null(attr(n, "content")), blank_to_null(text_of(dom, n))
            ),
        )
        embedded = F.coalesce(
            currency_token(F.get(texts, 0), "first_word"),
            currency_token(F.get(texts, 1), "first_word"),
        )
        availability = F.substring_index(
            attr(first_node(dom, _prop("availability")), "href"), "/", -1
        )
        return _offer(
            "schema-attributes",
            found=price.isNotNull(),
            name=name,
            price=price,
            currency=F.coalesce(stated, F.when(price != 0, embedded)),
            availability=blank_to_null(availability),
        )

    return let(first_node(dom, _prop("price")), with_price)


def microdata_bag(dom: Column) -> Column:
    """All properties of the page's product scope as a map; the last value of
    a property wins."""
    product_type = "http://schema.org/Product"
    props = F.transform(
        nodes_where(
            dom,
            lambda n: attr(n, "itemprop").isNotNull()
            & inside(dom, n, lambda a: attr(a, "itemtype") == product_type),
        ),
        lambda n: F.struct(
            attr(n, "itemprop").alias("k"),
            F.coalesce(blank_to_null(attr(n, "content")), text_of(dom, n)).alias("v"),
        ),
    )

    def last_of_each(p: Column) -> Column:
        keys = F.array_distinct(F.transform(p, lambda x: x["k"]))
        return F.map_from_arrays(
            keys,
            F.transform(
                keys,
                lambda k: F.element_at(F.filter(p, lambda x: x["k"] == k), -1)["v"],
            ),
        )

    return let(props, last_of_each)


def opengraph_offer(dom: Column) -> Column:
    """Offer struct from ``<meta property=...>`` tags."""
    metas = F.transform(
        nodes_where(
            dom, lambda n: (n["tag"] == "meta") & attr(n, "property").isNotNull()
        ),
        lambda n: F.struct(
            attr(n, "property").alias("k"), blank_to_null(attr(n, "content")).alias("v")
        ),
    )

    def from_tags(tags: Column) -> Column:
        def content(name: str) -> Column:
            # only the first tag of a property counts, even when it is empty
            return F.get(F.filter(tags, lambda t: t["k"] == name), 0)["v"]

        def first(names: tuple[str, ...]) -> Column:
            return F.coalesce(*[content(n) for n in names])

        def with_prices(c: Column) -> Column:
            price = F.when(c["both"] != 0, c["both"]).otherwise(
                F.coalesce(c["single"], c["both"])
            )
            return _offer(
                "opengraph",
                found=price.isNotNull(),
                name=first(OG_NAME),
                price=price,
                currency=F.coalesce(c["currency"], first(OG_CURRENCY)),
                availability=first(OG_AVAILABILITY),
            )

        def parse(c: Column) -> Column:
            return F.struct(
                let(c["both"], parse_price).alias("both"),
                let(c["single"], parse_price).alias("single"),
                blank_to_null(currency_token(c["both"])).alias("currency"),
            )

        texts = F.struct(
            first(OG_PRICE_WITH_CURRENCY).alias("both"), first(OG_PRICE).alias("single")
        )
        return let(let(texts, parse), with_prices)

    return let(metas, from_tags)


def plugin_offer(dom: Column, url: Column) -> Column:
    """Offer struct from the markup of a common shop plugin. A missing or
    unknown currency symbol voids the offer."""

    def class_has(n: Column, part: str) -> Column:
        return F.contains(attr(n, "class"), F.lit(part))

    price_node = first_node(
        dom,
        lambda n: (n["tag"] == "span")
        & class_has(n, "woocommerce-Price-amount")
        & inside(dom, n, lambda a: (a["tag"] == "div") & class_has(a, "price-wrapper"))
        & ~F.coalesce(
            inside(dom, n, lambda a: attr(a, "aria-hidden") == "true"), F.lit(False)
        ),
    )
    symbol_node = first_node(
        dom, lambda n: has_class(n, "woocommerce-Price-currencySymbol")
    )
    in_stock = F.exists(
        dom["nodes"], lambda n: has_class(n, "stock") & has_class(n, "in-stock")
    )
    images = F.transform(
        nodes_where(
            dom,
            lambda n: (n["tag"] == "img")
            & attr(n, "src").isNotNull()
            & inside(dom, n, lambda a: has_class(a, "woocommerce-product-gallery__wrapper")),
        ),
        lambda n: attr(n, "src"),
    )
    seen = F.struct(
        let(let(price_node, lambda n: trim_text(text_of(dom, n))), parse_price).alias("price"),
        let(symbol_node, lambda n: text_of(dom, n)).alias("symbol"),
        country_of(domain_of(url)).alias("country"),
    )

    def offer(s: Column) -> Column:
        iso = currency_iso(s["symbol"], s["country"])
        # no symbol element leaves the symbol NULL, which voids the offer
        usable = (s["symbol"] == "") | iso.isNotNull()
        return _offer(
            "woocommerce",
            found=(s["price"] != 0) & s["symbol"].isNotNull() & usable,
            price=s["price"],
            currency=iso,
            availability=F.when(in_stock, F.lit("in_stock")).otherwise(
                F.lit("out_of_stock")
            ),
            images=images,
        )

    return let(seen, offer)
