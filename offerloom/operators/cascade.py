"""Strategy cascade: the first strategy that finds a price gives the record."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from offerloom.functions.availability import snake
from offerloom.functions.missing import blank_to_null
from offerloom.functions.urls import domain_of, let
from offerloom.operators.elements import page_dom
from offerloom.operators.markup import microdata_offer, opengraph_offer, plugin_offer
from offerloom.operators.structured import jsonld_offer

# The strategies in order, the domains where some are unreliable,
# and the price-comparison sites a page may still be on.
STRATEGIES = ("schema-json", "schema-attributes", "opengraph", "woocommerce")
DISABLED_STRATEGIES = {
    "shop.mohd.it": ("schema-attributes", "schema-json"),
    "lampen24.nl": ("schema-attributes", "schema-json"),
    "trouva.com": ("schema-attributes", "schema-json"),
    "lamptwist.com": ("schema-attributes", "schema-json"),
    "kontorlige.nu": ("schema-json",),
}
COMPARISON_SITES = ("pricerunner", "prisjakt", "idealo", "google")

# What a page must mention for a markup strategy to have a chance.
_MARKUP_HINT = r"(?i)itemprop|property\s*=|woocommerce-price-amount"


def is_comparison_site(domain: Column) -> Column:
    return domain.rlike("|".join(COMPARISON_SITES))


def _enabled(domain: Column, strategy: str, disabled: dict[str, tuple[str, ...]]) -> Column:
    off = [d for d, names in disabled.items() if strategy in names]
    return ~F.coalesce(domain.isin(*off), F.lit(False)) if off else F.lit(True)


def auto_extract(
    pages: DataFrame,
    disabled: dict[str, tuple[str, ...]] | None = None,
    html: str = "html",
    url: str = "url",
    shop: str | None = None,
    also: Column | None = None,
    extra: Callable[[Column], dict[str, Column]] | None = None,
) -> DataFrame:
    """One row per page: page columns without the HTML, plus the winning
    strategy's fields. ``reject_reason`` is set when no strategy found a price.
    Strategies are switched off by the domain of ``shop`` (``url`` if not given).

    The node list is built only for pages the JSON-LD strategy cannot serve
    and that carry some price markup, and for those that meet ``also``; other
    pages pass NULL to it. ``extra`` makes further columns out of the node list,
    in the same pass over the pages.
    """
    rules = DISABLED_STRATEGIES if disabled is None else disabled
    keep = [c for c in pages.columns if c != html]
    domain = domain_of(F.col(shop or url))
    on = {s: _enabled(domain, s, rules) for s in STRATEGIES}

    first = pages.select(
        *keep,
        html,
        F.when(on["schema-json"], jsonld_offer(F.col(html), F.col(url))).alias("_json"),
    )
    served = F.coalesce(F.col("_json.found"), F.lit(False))
    needed = ~served & F.col(html).rlike(_MARKUP_HINT)
    if also is not None:
        needed = needed | also
    with_dom = first.select(
        *keep,
        "_json",
        page_dom(F.when(needed, F.col(html))).alias("_dom"),
    )

    def winner(offer: Column) -> Column:
        return F.when(offer["found"], offer)

    dom = F.col("_dom")
    made = extra(dom) if extra else {}
    second = with_dom.select(
        *keep,
        *[c.alias(n) for n, c in made.items()],
        "_json",
        F.when(dom["nodes"].isNotNull() & on["schema-attributes"], microdata_offer(dom)).alias("_micro"),
        F.when(dom["nodes"].isNotNull() & on["opengraph"], opengraph_offer(dom)).alias("_og"),
        F.when(dom["nodes"].isNotNull() & on["woocommerce"], plugin_offer(dom, F.col(url))).alias("_plugin"),
    )
    best = F.coalesce(*[winner(F.col(c)) for c in ("_json", "_micro", "_og", "_plugin")])

    def record(o: Column) -> Column:
        return F.struct(
            o["strategy"].alias("strategy"),
            blank_to_null(o["name"]).alias("name"),
            o["gtin"].alias("gtin"),
            o["mpn"].alias("mpn"),
            F.nullif(o["price"], F.lit(0.0)).alias("price"),
            o["currency"].alias("currency"),
            snake(o["availability"]).alias("availability"),
            o["images"].alias("images"),
            o["metadata"].alias("metadata"),
            F.when(o.isNull(), F.lit("PriceLiteUnavailableError")).alias("reject_reason"),
        )

    # one generated row per page: later filters on a field must not make the
    # optimizer evaluate all strategies a second time
    return second.select(*keep, *made, F.inline(F.array(let(best, record))))
