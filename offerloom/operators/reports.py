"""Coverage reports. Counts of several inputs are taken in one aggregation over
their union, so a hot key is reduced before the shuffle and no join is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from offerloom.functions.urls import domain_of
from offerloom.operators.ranking import first_per_key


def _counts(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """Rows per key in every part, as one column per part."""
    tagged = None
    for name, part in parts.items():
        flags = [F.lit(1 if n == name else 0).cast("bigint").alias(n) for n in parts]
        piece = part.select(F.col(key), *flags)
        tagged = piece if tagged is None else tagged.unionByName(piece)
    return tagged.groupBy(key).agg(*[F.sum(n).alias(n) for n in parts])


def uncovered(requests: DataFrame, offers: DataFrame, url: str = "url") -> DataFrame:
    """Requested rows whose URL is neither an offer URL nor a variant-group
    URL of the same domain. One row per request instead of one list per
    domain."""
    found = offers.select(
        domain_of(F.col(url)).alias("domain"),
        F.explode(F.array(F.col(url), F.col("variant_group_url"))).alias(url),
    ).distinct()
    return requests.withColumn("domain", domain_of(F.col(url))).join(
        found, ["domain", url], "left_anti"
    )


def coverage(requests: DataFrame, offers: DataFrame, url: str = "url") -> DataFrame:
    """Requested, found and not-found counts per requested domain."""
    return (
        _counts(
            {
                "n_urls": requests.select(domain_of(F.col(url)).alias("domain")),
                "n_products_found": offers.select(domain_of(F.col(url)).alias("domain")),
                "n_products_not_found": uncovered(requests, offers, url).select("domain"),
            },
            "domain",
        )
        .where(F.col("n_urls") > 0)
    )


def shortfall(listings: DataFrame, offers: DataFrame, category: str = "category_url") -> DataFrame:
    """Expected and actual offers per category, where offers are missing."""
    return (
        _counts({"expected": listings.select(category), "actual": offers.select(category)}, category)
        .withColumn("missing", F.col("expected") - F.col("actual"))
        .where(F.col("missing") > 0)
    )


# A search page that is a product page itself, or lists the first result.
_PRODUCT_PAGE = r"-p\d+"
_FIRST_RESULT = r"\"uri\":\"(\\/[^\"]+)\""


def search_hit(sku: Column, final_url: Column, html: Column, origin: str) -> Column:
    """Product URL a search led to: the page itself when it is a product page,
    else the first result, provided that the page mentions the SKU."""
    mentions = F.contains(html, F.concat(F.lit('sku_id":"'), sku))
    path = F.nullif(F.regexp_extract(html, _FIRST_RESULT, 1), F.lit(""))
    return F.when(final_url.rlike(_PRODUCT_PAGE), final_url).when(
        mentions, F.concat(F.lit(origin), F.replace(path, F.lit("\\/"), F.lit("/")))
    )


def found_missing(
    skus: DataFrame, searches: DataFrame, origin: str, sku: str = "sku"
) -> DataFrame:
    """Every distinct SKU with the URL its search found, or NULL.

    ``searches`` holds ``(sku, final_url, html)``; the HTML is reduced to the
    hit before anything is shuffled.
    """
    hits = searches.select(
        sku,
        search_hit(F.col(sku), F.col("final_url"), F.col("html"), origin).alias("url"),
    ).where(F.col("url").isNotNull())
    # several searches of one SKU: the smallest URL, so that reruns agree
    return skus.select(sku).distinct().join(
        first_per_key(hits, [sku], ["url"]), sku, "left"
    )


def url_overlap(parts: dict[str, DataFrame], url: str = "url") -> DataFrame:
    """Distinct URLs per combination of the given URL sets."""
    per_url = _counts({n: p.select(url) for n, p in parts.items()}, url)
    flags = [(F.col(n) > 0).alias(f"in_{n}") for n in parts]
    return (
        per_url.select(*flags)
        .groupBy(*[f"in_{n}" for n in parts])
        .agg(F.count("*").alias("n_urls"))
    )


def outcomes(pages: DataFrame, offers: DataFrame, key: str = "request_url") -> DataFrame:
    """Request URL, product URL (NULL when nothing was extracted) and status of
    every captured page."""
    side = offers.select(key, F.col("url").alias("product_url"))
    return pages.join(side, key, "left").select(
        *[c for c in pages.columns if c not in ("html", "url")], "product_url"
    )


def repeat_views(views: DataFrame, url: str = "url") -> DataFrame:
    return (
        views.groupBy(url).agg(F.count("*").alias("n_views")).where(F.col("n_views") > 1)
    )


def job_totals(
    listings: DataFrame, new_categories: DataFrame, job: str = "job_id"
) -> DataFrame:
    """Categories, products found and new categories per job."""
    found = listings.groupBy(job).agg(
        F.count_distinct("category_url").alias("n_categories"),
        F.count("*").alias("n_products_found"),
    )
    fresh = new_categories.groupBy(job).agg(F.count("*").alias("n_new_categories"))
    return found.join(fresh, job, "full_outer").na.fill(0)


def image_counts(offers: DataFrame) -> DataFrame:
    return offers.select("url", F.size("images").alias("n_images"))
