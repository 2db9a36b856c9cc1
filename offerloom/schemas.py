"""Schemas of inputs and tables, as DDL text (readers take it as is)."""

from __future__ import annotations

CATEGORY = "STRUCT<name: STRING, url: STRING>"
SPECIFICATION = "STRUCT<key: STRING, value: STRING>"
REVIEWS = (
    "STRUCT<review_count: BIGINT, average_review: DOUBLE,"
    " recent_reviews: ARRAY<STRUCT<score: DOUBLE, content: STRING>>>"
)
JOB_CONTEXT = (
    "STRUCT<jobId: STRING, env: STRING, skipPublishing: BOOLEAN,"
    " scraperCategoryPage: STRING, scraperProductPage: STRING>"
)

# Captured pages: the input of all extraction.
PAGES = (
    "request_url STRING, url STRING, html STRING, status INT, fetched_at TIMESTAMP"
)

_COMMON = f"""
    url STRING, name STRING, brand STRING, brand_url STRING, description STRING,
    price BIGINT, currency STRING, is_discounted BOOLEAN, original_price BIGINT,
    gtin STRING, sku STRING, mpn STRING, popularity_index BIGINT,
    popularity_category ARRAY<{CATEGORY}>, category_url STRING,
    category_tree ARRAY<{CATEGORY}>, fetched_at TIMESTAMP, retailer_domain STRING,
    metadata STRING
"""
LISTINGS = _COMMON
OFFERS = (
    _COMMON
    + f""", availability STRING, images ARRAY<STRING>,
    specifications ARRAY<{SPECIFICATION}>, reviews {REVIEWS},
    matching_type STRING, variant_group_url STRING, variant INT
"""
)

# Stored rows: nested fields as JSON text, lists as lists of JSON text.
WAREHOUSE = """
    url STRING, name STRING, brand STRING, brand_url STRING, description STRING,
    price BIGINT, currency STRING, is_discounted BOOLEAN, original_price BIGINT,
    gtin STRING, sku STRING, mpn STRING, popularity_index BIGINT,
    popularity_category ARRAY<STRING>, category_url STRING,
    category_tree ARRAY<STRING>, fetched_at TIMESTAMP, retailer_domain STRING,
    metadata STRING, availability STRING, images ARRAY<STRING>,
    specifications ARRAY<STRING>, reviews STRING, matching_type STRING,
    variant_group_url STRING, variant INT, job_id STRING
"""

# Requests, as posted: names are those of the messages.
REQUEST_BATCH = f"""
    productDetails ARRAY<STRUCT<url: STRING, userData: STRUCT<
        jobId: STRING, url: STRING, name: STRING, brand: STRING, label: STRING,
        popularityIndex: BIGINT, categoryUrl: STRING, matchingType: STRING,
        fetchedAt: STRING>>>,
    jobContext {JOB_CONTEXT}
"""
REQUESTS = {
    "category": (
        f"url STRING, retailerDomain STRING, country STRING, jobContext {JOB_CONTEXT}",
        "LIST",
    ),
    "search": (
        f"query STRING, retailer STRING, jobContext {JOB_CONTEXT}",
        "SEARCH",
    ),
    "leaf_category": (
        "intermediate_categories ARRAY<STRING>, known_category_urls ARRAY<STRING>,"
        f" jobContext {JOB_CONTEXT}",
        "INTERMEDIATE_CATEGORY",
    ),
}
CATEGORY_DIM = f"url STRING, category_tree ARRAY<{CATEGORY}>"
# An offer dump carries the message names; unknown fields are ignored.
OFFER_DUMP = f"""
    url STRING, name STRING, brand STRING, brandUrl STRING, description STRING,
    price BIGINT, currency STRING, isDiscounted BOOLEAN, originalPrice BIGINT,
    gtin STRING, sku STRING, mpn STRING, popularityIndex BIGINT,
    popularityCategory ARRAY<{CATEGORY}>, categoryUrl STRING,
    categoryTree ARRAY<{CATEGORY}>, fetchedAt STRING, retailerDomain STRING,
    availability STRING, images ARRAY<STRING>, specifications ARRAY<{SPECIFICATION}>,
    matchingType STRING, variantGroupUrl STRING, variant INT, jobId STRING
"""
