"""Scalar column functions (JVM-side expressions only)."""

from offerloom.functions.availability import (
    ALLOWED_AVAILABILITY,
    availability_of,
    is_availability,
    snake,
    snake_name,
)
from offerloom.functions.identifiers import (
    clean_brand,
    clean_gtin,
    mpn_of,
    product_id,
    screenshot_key,
    sku_of,
)
from offerloom.functions.missing import blank_to_null, falsy_to_null
from offerloom.functions.prices import (
    currency_iso,
    currency_or,
    currency_token,
    first_number,
    parse_price,
    parse_price_as,
    parse_price_safe,
    to_minor_units,
)
from offerloom.functions.text import simple, squash, stars, trim_text
from offerloom.functions.urls import (
    absolute_if_rooted,
    clean_image,
    comparable_url,
    country_of,
    domain_of,
    is_brand_url,
    is_product_url,
    normalise_url,
    origin_of,
    query_param,
    strip_query,
    url_included,
)

__all__ = [name for name in dir() if not name.startswith("_")]
