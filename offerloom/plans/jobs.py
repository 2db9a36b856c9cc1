"""The four jobs, each one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from offerloom.functions.urls import domain_of

from offerloom.operators import links as lk
from offerloom.operators.cascade import auto_extract
from offerloom.operators.fields import (
    missing_reason,
    missing_required,
    offer_columns,
    rule_fields,
    rule_records,
)
from offerloom.operators.listings import clean_listing, popularity_rank, rule_listings, stamp_listing
from offerloom.operators.offers import clean_offer, merge_offer, stamp_offer
from offerloom.operators.outcomes import classify_pages
from offerloom.operators.profiles import Registry, default_registry
from offerloom.operators.ranking import first_per_key
from offerloom.operators.reports import coverage


@dataclass
class Details:
    offers: DataFrame
    rejected: DataFrame
    coverage: DataFrame


# What a rule's field is called among an offer's.
_MERGED = {"price_text": "price", "original_price_text": "original_price", "sku_text": "sku", "availability_text": "availability"}


def extract_by_shop(pages: DataFrame, registry: Registry, shop: str = "url") -> DataFrame:
    """Every page by what the registry knows of the domain of ``shop``: its
    custom extractor, or the generic cascade with the domain's rules over it.

    What a rule finds wins over what the cascade finds, field by field, so a
    profile may state as few rules as it likes. A page is rejected if then it
    lacks a price, or a field that its rules require. One pass over the pages
    serves rules and cascade, one more all extractors together.

    An extractor gets the pages' columns and ``domain`` and must return those it
    wants kept, ``shop`` and ``url`` among them; columns that one way lacks are
    NULL. Pages without HTML take the cascade, which rejects them.
    """
    named = pages.withColumn("_domain", domain_of(F.col(shop)))
    own = F.coalesce(F.col("_domain").isin(*registry.extractors), F.lit(False)) & F.col("html").isNotNull()
    generic = named.where(~own) if registry.extractors else named
    out = _ruled_cascade(generic, registry, shop)
    if registry.extractors:
        found = registry.extract_all_custom(named.where(own).withColumnRenamed("_domain", "domain"))
        out = out.unionByName(found.drop("domain"), allowMissingColumns=True)
    return out


def _ruled_cascade(pages: DataFrame, registry: Registry, shop: str) -> DataFrame:
    rules = registry.rules_frame(pages.sparkSession)
    rules = rules.select(F.col("domain").alias("_domain"), F.col("rules").alias("_rules"), F.col("records").alias("_lists"))
    keep = [c for c in pages.columns if c not in ("html", "_domain")]
    known = F.col("_rules").isNotNull()

    def read(dom: Column) -> dict[str, Column]:
        return {
            "_fields": F.when(known & dom["nodes"].isNotNull(), rule_fields(dom, F.col("_rules"))),
            "_records": F.when(known & dom["nodes"].isNotNull(), rule_records(dom, F.col("_lists"))),
        }

    rows = auto_extract(
        pages.join(rules, "_domain", "left"),
        registry.disabled(),
        shop=shop,
        also=F.coalesce(known, F.lit(False)) & F.col("html").isNotNull(),
        extra=read,
    )
    found = offer_columns(registry, F.col("_domain"), F.col("_fields"), F.col("_records"))
    generic = [c for c in rows.columns if c not in (*keep, "reject_reason") and not c.startswith("_")]
    by_rule = F.col("_fields").isNotNull()
    merged = {n: F.coalesce(found[n], F.col(n)) if n in found else F.col(n) for n in generic}
    merged |= {n: c for n, c in found.items() if n not in generic}
    fixed, priced = found["currency"], found["price"].isNotNull()
    merged["currency"] = F.when(priced, F.coalesce(fixed, F.col("currency"))).otherwise(F.coalesce(F.col("currency"), F.when(by_rule, fixed)))
    merged["strategy"] = F.when(priced, F.lit("rules")).otherwise(F.col("strategy"))
    # availability by rule may be a default; then a statement of the page's own data counts
    said = F.map_contains_key("_fields", F.lit("availability_text"))
    merged["availability"] = F.when(said, found["availability"]).otherwise(F.coalesce(F.col("availability"), found["availability"]))
    lists = {n: merged.pop(n) for n in [*merged] if n in ("images",)}
    lists = {n: F.when(F.size(found[n]) > 0, found[n]).otherwise(F.col(n)) for n in lists}
    offers = rows.select(
        *keep, "_rules", "_fields", "reject_reason", *[c.alias(n) for n, c in (merged | lists).items()]
    )

    def lacks(name: Column) -> Column:
        value = F.lit(True)
        for field in (*_MERGED, "name"):
            value = F.when(name == field, F.col(_MERGED.get(field, field)).isNull()).otherwise(value)
        return value

    missing = F.filter(missing_required(F.col("_fields"), F.col("_rules")), lacks)
    reason = F.coalesce(
        F.when(F.col("_fields").isNotNull(), missing_reason(missing)),
        F.when(F.col("price").isNull(), F.col("reject_reason")),
    )
    return offers.withColumn("reject_reason", reason).withColumn(
        "is_discounted", F.when(F.col("_fields").isNotNull(), F.col("original_price").isNotNull())
    ).drop("_rules", "_fields")


def scrape_details(
    requests: DataFrame, pages: DataFrame, registry: Registry | None = None, store: str | None = None
) -> Details:
    """Captured product pages and their requests -> clean offers, rejected
    rows with reasons, and coverage per domain.

    ``pages`` has ``request_url, url, html, status, fetched_at``; ``requests``
    the listing fields per ``request_url``, of which one row counts. The shop is
    the one that was asked, wherever the request ended. The HTML never reaches
    the join: pages are reduced to fields first.

    Each of the three results is a plan of its own that starts at the pages. With
    ``store``, a new folder in shared storage, the judged rows are written there
    at once, accepted and rejected ones apart, and the results read them: the
    pages are then read and parsed a single time.
    """
    registry = registry or default_registry()
    requests = first_per_key(requests, ["request_url"], [])
    judged = classify_pages(pages, registry.outcome_rules, shop="request_url")
    # a failed page goes through without its HTML, so one pass serves all rows
    readable = judged.withColumn("html", F.when(F.col("error").isNull(), F.col("html")))
    extracted = extract_by_shop(readable.drop("status"), registry, shop="request_url")
    reason = F.coalesce("error", "reject_reason")
    extracted = stamp_offer(extracted, F.col("fetched_at")).withColumn("reject_reason", reason)
    merged = merge_offer(extracted.drop("error"), requests, "request_url")
    cleaned = clean_offer(merged, registry)
    if "variant_group_url" not in cleaned.columns:
        cleaned = cleaned.withColumn("variant_group_url", F.lit(None).cast("string"))
    cleaned = cleaned.withColumn("accepted", F.col("reject_reason").isNull())
    if store is not None:
        cleaned.write.partitionBy("accepted").parquet(store)
        # the partition column comes last, as in a plan that is not stored
        cleaned = pages.sparkSession.read.schema(cleaned.schema).parquet(store)
    ok = F.col("accepted")
    offers = cleaned.where(ok).drop("reject_reason", "accepted")
    rejected = cleaned.where(~ok).select("request_url", "url", "reject_reason")
    asked = requests.select(F.col("request_url").alias("url"))
    return Details(offers, rejected, coverage(asked, offers))


def explore_category(cards: DataFrame, registry: Registry | None = None) -> DataFrame:
    """Cards of category pages -> ranked, stamped and cleaned listings."""
    registry = registry or default_registry()
    ranked = stamp_listing(popularity_rank(cards))
    return clean_listing(
        ranked, lambda url: registry.apply_canonical(url, F.col("retailer_domain"))
    )


def explore_category_pages(
    pages: DataFrame, registry: Registry | None = None, run: str = "run", page: str = "page_number"
) -> DataFrame:
    """Category pages -> ranked, stamped and cleaned listings.

    ``pages`` has ``run, page_number, url, html``. A product counts where its run
    sees it first. Where the shop's page size and the page number are known, the
    popularity is the place on that page, else the count of products before it.
    """
    registry = registry or default_registry()
    cards = rule_listings(pages, registry)
    ranked = stamp_listing(popularity_rank(cards, run=run, page=page))
    size = registry.lookup(F.col("retailer_domain"), "page_size")
    at = (F.col(page) - 1) * size + F.col("position")
    ranked = ranked.withColumn("popularity_index", F.coalesce(at.cast("bigint"), F.col("popularity_index")))
    return clean_listing(
        ranked, lambda url: registry.apply_canonical(url, F.col("retailer_domain"))
    )


def extract_categories(pages: DataFrame, known: DataFrame, key: str = "page_id") -> DataFrame:
    """Seed pages -> new leaf category URLs."""
    found = lk.links(pages)
    absolute = found.withColumn("link", lk.resolve_url(F.col("href"), F.col("url")))
    labelled = lk.classify_categories(pages.select(key, "url"), absolute.select(key, "link"), key)
    return lk.new_categories(labelled.where(F.col("label") == "LIST"), known)


def explore_homepage(pages: DataFrame, known: DataFrame, key: str = "page_id") -> DataFrame:
    """Links on a homepage that are known products, repeats of neighbours
    counted once."""
    found = lk.homepage_links(pages, drop_repeats=True)
    absolute = found.withColumn("url", lk.resolve_url(F.col("href"), F.col("url")))
    return lk.known_urls(absolute.select(key, "pos", "url"), known)
