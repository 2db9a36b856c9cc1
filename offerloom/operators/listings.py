"""Listing rows: product cards of category pages and their popularity rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from offerloom.functions.urls import (
    absolute_if_rooted,
    domain_of,
    normalise_url,
    strip_query,
)
from offerloom.operators.elements import attr, has_class, page_dom, text_of
from offerloom.functions.prices import parse_price_safe
from offerloom.operators.fields import CRUMBS, record_crumbs, record_rows
from offerloom.operators.page_rules import page_rules
from offerloom.operators.ranking import first_per_key, number_rows


def listings(
    pages: DataFrame,
    card_class: str,
    name_class: str | None = None,
    html: str = "html",
    url: str = "url",
) -> DataFrame:
    """One row per product card: ``position``, ``url`` (absolute), ``name``
    and ``category_url``; cards without a link are skipped.

    A card is an element with ``card_class``; its URL is its own ``href`` or
    that of the first link inside it.
    """
    keep = [c for c in pages.columns if c not in (html, url)]
    dom = F.col("_dom")

    def within(n: Column, card: Column) -> Column:
        return F.array_contains(n["up"], card["pos"])

    def link(card: Column) -> Column:
        inner = F.filter(
            dom["nodes"],
            lambda n: (n["tag"] == "a") & attr(n, "href").isNotNull() & within(n, card),
        )
        return F.coalesce(attr(card, "href"), attr(F.get(inner, 0), "href"))

    def name(card: Column) -> Column:
        if name_class is None:
            return F.lit(None).cast("string")
        inner = F.filter(dom["nodes"], lambda n: has_class(n, name_class) & within(n, card))
        texts = F.transform(inner, lambda n: F.trim(text_of(dom, n)))
        return F.get(texts, 0)

    cards = F.transform(
        F.filter(dom["nodes"], lambda n: has_class(n, card_class)),
        lambda c: F.struct(link(c).alias("href"), name(c).alias("name")),
    )
    return (
        pages.select(*keep, F.col(url).alias("category_url"), page_dom(F.col(html)).alias("_dom"))
        .withColumn("_cards", cards)
        .drop("_dom")
        .select(*keep, "category_url", F.posexplode("_cards").alias("position", "_c"))
        .select(
            *keep,
            "category_url",
            (F.col("position") + 1).alias("position"),
            normalise_url(F.col("_c.href"), F.col("category_url")).alias("url"),
            F.col("_c.name").alias("name"),
        )
        .where(F.col("url").isNotNull())
    )


def rule_listings(
    pages: DataFrame, registry, html: str = "html", url: str = "url", shop: str | None = None
) -> DataFrame:
    """One row per product card of the category pages whose shop has card rules.

    ``position`` counts all cards of a page, those without a link included, which
    give no row. ``popularity_category`` is the breadcrumb path with the page's
    own category at its end. The shop is the domain of ``shop`` (``url`` if not
    given); pages of other shops give no rows.
    """
    keep = [c for c in pages.columns if c not in (html, url)]
    records = F.col("_records")
    rules = registry.rule_rows(cards=True)
    found = (
        pages.withColumn("_domain", domain_of(F.col(shop or url)))
        .where(F.col("_domain").isin(*rules))
        .select(*keep, F.col(url).alias("category_url"), page_rules(F.col(html), F.col("_domain"), rules).alias("_found"))
        .select(
            *keep,
            "category_url",
            F.try_element_at("_found.fields", F.lit("category")).alias("_name"),
            F.col("_found.records").alias("_records"),
        )
    )
    own = F.array(F.struct(F.col("_name").alias("name"), strip_query(F.col("category_url")).alias("url"))).cast(CRUMBS)
    path = F.coalesce(record_crumbs(records), F.array().cast(CRUMBS))
    path = F.when(F.col("_name").isNotNull(), F.concat(path, own)).otherwise(path)

    def listing(card: Column, i: Column) -> Column:
        def value(name: str) -> Column:
            return F.try_element_at(card, F.lit(name))

        return F.struct(
            (i + 1).alias("position"),
            normalise_url(value("url"), F.col("category_url")).alias("url"),
            value("name").alias("name"),
            value("brand").alias("brand"),
            parse_price_safe(value("price_text")).alias("price"),
        )

    # outer, and the URL made before it: a filter of the optimizer's own, or ours
    # on the URL, would evaluate all rules a second time
    return (
        found.select(*keep, "category_url", path.alias("popularity_category"), record_rows(records, "cards").alias("_cards"))
        .select(*keep, "category_url", "popularity_category", F.transform("_cards", listing).alias("_cards"))
        .select(*keep, "category_url", "popularity_category", F.inline_outer("_cards"))
        .where(F.col("url").isNotNull())
    )


# Page number and position share one BIGINT: 40 bits and 23 bits.
_POSITION_BITS = 23
_PAGE_BITS = 40


def _packed(page: str, position: str) -> Column:
    """Page and position as one number; NULL if one is, an error if out of range."""
    p, i = F.col(page).cast("bigint"), F.col(position).cast("bigint")
    fits = p.between(0, 2**_PAGE_BITS - 1) & i.between(0, 2**_POSITION_BITS - 1)
    return F.when(fits | p.isNull() | i.isNull(), F.shiftleft(p, _POSITION_BITS) + i).otherwise(
        F.raise_error(F.lit("page number or position out of range"))
    )


def first_sight(cards: DataFrame, keys: list[str], page: str, position: str) -> DataFrame:
    """The first card per key, by page and position.

    Cards without further columns are compared by one packed number, which a
    hash aggregation can hold; a value out of range fails the job.
    """
    if set(cards.columns) != {*keys, page, position}:
        return first_per_key(cards, keys, [page, position])
    first = cards.groupBy(*keys).agg(F.min(_packed(page, position)).alias("_at"))
    return first.select(
        *keys,
        F.shiftright("_at", _POSITION_BITS).alias(page),
        F.col("_at").bitwiseAND(2**_POSITION_BITS - 1).alias(position),
    )


def popularity_rank(
    cards: DataFrame,
    run: str = "run",
    page: str = "page_number",
    position: str = "position",
    url: str = "url",
) -> DataFrame:
    """Distinct products per run with ``popularity_index`` 1..n by first sight.

    Repeated cards collapse in a partial aggregation before the shuffle, and
    ranks are built from counts per page, so one run may hold any share of the
    rows.
    """
    first = first_sight(cards, [run, url], page, position)
    # a cut is 4096 places of one page, so that an endless page is cut as well
    ranked = number_rows(
        first.withColumn("_place", _packed(page, position)),
        [run],
        "_place",
        [F.col(page).asc_nulls_last(), F.col(position).asc_nulls_last(), url],
        "popularity_index",
        width_bits=12,
        block_bits=_POSITION_BITS,
    )
    return ranked.drop("_place")


def popularity_by_page(
    cards: DataFrame,
    page_size: int | Column,
    run: str = "run",
    page: str = "page_number",
    position: str = "position",
    url: str = "url",
) -> DataFrame:
    """Distinct products per run ranked by ``(page - 1) * page_size + position``
    of the card seen first."""
    first = first_sight(cards, [run, url], page, position)
    rank = (F.col(page) - 1) * page_size + F.col(position)
    return first.withColumn("popularity_index", rank.cast("bigint"))


def stamp_listing(
    rows: DataFrame, domain: Column | None = None, country: Column | None = None
) -> DataFrame:
    """Retailer domain from the URL, or domain and country of the request."""
    out = rows.withColumn(
        "retailer_domain", domain_of(F.col("url")) if domain is None else domain
    )
    return out if country is None else out.withColumn("country", country)


def clean_listing(rows: DataFrame, canonical=None) -> DataFrame:
    """Root-relative category URLs made absolute and the domain's URL rule
    applied. A row whose URL the rule cannot read keeps its URL."""
    out = rows
    if "category_url" in rows.columns:
        out = out.withColumn(
            "category_url", absolute_if_rooted(F.col("category_url"), F.col("url"))
        )
    if "popularity_category" in rows.columns:
        out = out.withColumn(
            "popularity_category",
            F.transform(
                "popularity_category",
                lambda c: F.struct(
                    c["name"].alias("name"),
                    absolute_if_rooted(c["url"], F.col("url")).alias("url"),
                ),
            ),
        )
    if canonical is not None:
        out = out.withColumn("url", F.coalesce(canonical(F.col("url")), F.col("url")))
    return out


def lookup_category(
    rows: DataFrame,
    dim: DataFrame,
    category_url: str = "category_url",
) -> DataFrame:
    """Category path by category URL without query; unknown URLs get an empty
    path. Statistics and adaptive execution choose the join."""
    side = dim.select(F.col("url").alias("_dim_url"), F.col("category_tree").alias("_tree"))
    side = side.dropDuplicates(["_dim_url"])
    return (
        rows.join(side, strip_query(F.col(category_url)) == F.col("_dim_url"), "left")
        .withColumn("category_tree", F.coalesce("_tree", F.array().cast(CRUMBS)))
        .drop("_dim_url", "_tree")
    )


def category_url(tree: Column, end: str = "last") -> Column:
    """URL of the first or last node of a category path."""
    return F.try_element_at(tree, F.lit(1 if end == "first" else -1))["url"]
