"""Outcome labels of captured pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from offerloom.functions.urls import domain_of, is_product_url

# Error types and whether a retry makes sense.
RETRYABLE = {
    "IllFormattedPageError": False,
    "PageNotFoundError": False,
    "CaptchaEncounteredError": True,
    "GotBlockedError": True,
    "PriceLiteUnavailableError": True,
}

Rule = tuple[Callable[[], Column], str]

# Rules read the columns url (final URL), status and html. First match decides.
DEFAULT_OUTCOMES: list[Rule] = [
    (lambda: F.col("status") == 404, "PageNotFoundError"),
]
ANTI_BOT_OUTCOMES: list[Rule] = [
    (lambda: F.col("status") == 429, "CaptchaEncounteredError"),
]


def _has(pattern: str) -> Callable[[], Column]:
    return lambda: F.col("html").rlike(pattern)


DOMAIN_OUTCOMES: dict[str, list[Rule]] = {
    "wayfair.de": [
        (
            lambda: F.contains("url", F.lit("https://www.wayfair.de/blocked.php")),
            "GotBlockedError",
        ),
        (
            lambda: F.contains("url", F.lit("https://www.wayfair.de/v/captcha"))
            | F.coalesce(
                F.col("html").rlike(
                    r"<iframe[^>]*title=[\"']reCAPTCHA[\"']"
                    r"|<div[^>]*class=[\"']px-captcha-error-container[\"']"
                ),
                F.lit(False),
            )
            | (F.col("status") == 429),
            "CaptchaEncounteredError",
        ),
        (lambda: ~F.contains("url", F.lit("/pdp/")), "PageNotFoundError"),
    ],
    "baldai1.lt": ANTI_BOT_OUTCOMES,
    "trademax.se": [
        (
            lambda: ~is_product_url(F.col("url"), F.lit("trademax.se")),
            "PageNotFoundError",
        )
    ],
    "ebuy24.dk": [
        (
            _has(r"<article[^>]*class=[\"'][^\"']*\bm-notfound-article\b"),
            "PageNotFoundError",
        )
    ],
    "bernomobler.se": [
        (
            _has(r"<header[^>]*class=[\"'][^\"']*\bsection-header--404\b"),
            "PageNotFoundError",
        )
    ],
    "norliving.dk": [
        (_has(r"(?is)<title[^>]*>\s*404 ikke fundet\s*</title>"), "PageNotFoundError")
    ],
}

# Marks of a search or category page that is empty on purpose.
EMPTY_LISTING = {
    "amazon.de": r"No results",
    "royaldesign.se": r"<div[^>]*>0 produkter</div>",
}


def first_match(rules: list[Rule]) -> Column:
    """Label of the first rule that holds; NULL when none does."""
    if not rules:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(predicate(), F.lit(label)) for predicate, label in rules])


def apply_rules(
    pages: DataFrame, rules: list[Rule], column: str = "error", fallback: Column | None = None
) -> DataFrame:
    """Ordered rules, first match decides; unmatched rows pass through with
    the fallback (NULL by default)."""
    label = first_match(rules)
    if fallback is not None:
        label = F.coalesce(label, fallback)
    return pages.withColumn(column, label)


def classify_pages(
    pages: DataFrame, domain_rules: dict[str, list[Rule]] | None = None, shop: str = "url"
) -> DataFrame:
    """``error`` of every captured page, NULL for a good one. The default rules
    come first, then those of the domain of ``shop``: the requested URL where
    there is one, as a shop may send its visitors elsewhere."""
    rules = DOMAIN_OUTCOMES if domain_rules is None else domain_rules
    domain = domain_of(F.col(shop))
    label = first_match(DEFAULT_OUTCOMES)
    for name, own in rules.items():
        label = F.coalesce(label, F.when(domain == name, first_match(own)))
    return pages.withColumn("error", label)


def is_retryable(error: Column) -> Column:
    """Retry flag by error type; an unknown error may be retried, no error is
    NULL."""
    final = [name for name, again in RETRYABLE.items() if not again]
    return ~error.isin(*final)


def is_empty_listing(domain: Column, html: Column) -> Column:
    out = F.lit(False)
    for name, mark in EMPTY_LISTING.items():
        out = F.when(domain == name, html.rlike(mark)).otherwise(out)
    return out


def still_exists(pages: DataFrame, by: str = "status") -> DataFrame:
    """Dead-product check: ``final_url`` is kept while the product exists.

    ``status``: anything but 404. ``pattern``: the URL the request ended at
    still looks like a product page of the domain; a failed request is unknown
    and gives NULL with ``checked`` false.
    """
    url = F.col("final_url")
    if by == "status":
        return pages.withColumns(
            {"checked": F.lit(True), "found_url": F.when(F.col("status") != 404, url)}
        )
    alive = is_product_url(url, domain_of(url))
    ok = F.col("status") < 300
    return pages.withColumns({"checked": ok, "found_url": F.when(ok & alive, url)})
