"""Product identifiers taken from text and URLs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from offerloom.functions.text import WS, trim_text
from offerloom.functions.urls import query_param


def _found(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_gtin(c: Column) -> Column:
    """8 to 14 digits, never padded; anything else is NULL."""
    return F.when(c.rlike(r"^[0-9]{8,14}\z"), c)


def product_id(url: Column, style: str) -> Column:
    """Product id carried by a URL, NULL when there is none."""
    if style == "asin":
        return _found(F.regexp_extract(url, r"/[dg]p/([^/?]+)", 1))
    if style == "productpage":
        return _found(F.regexp_extract(url, r"productpage\.(\d+)", 1))
    if style == "piid":
        return query_param(url, "piid")
    if style == "query_suffix":
        query = F.try_element_at(F.split(url, r"\?"), F.lit(2))
        first = F.substring_index(query, "&", 1)
        return F.try_element_at(F.split(first, "-"), F.lit(2))
    raise ValueError(f"unknown style {style!r}")


def sku_of(c: Column, style: str) -> Column:
    """SKU from a text that carries a label, a prefix or a suffix."""
    if style == "after_article_label":
        tail = F.substring_index(c, "Artikelnummer:", -1)
        return F.when(
            F.contains(c, F.lit("Artikelnummer:")),
            trim_text(F.substring_index(tail, "\n", 1)),
        )
    if style == "after_colon":
        return trim_text(F.try_element_at(F.split(c, ":"), F.lit(2)))
    if style == "after_first_dash":
        return _found(F.regexp_extract(trim_text(c), r"(?s)^[^-]*-(.*)\z", 1))
    if style == "cut_country":
        return F.regexp_replace(c, r"USA\z", "")
    if style == "drop_label":
        return trim_text(F.replace(c, F.lit("Artikelnummer:"), F.lit("")))
    raise ValueError(f"unknown style {style!r}")


def mpn_of(sku: Column, style: str) -> Column:
    """Manufacturer part number derived from a SKU."""
    if style == "same":
        return sku
    if style == "drop_two":
        return F.substring(sku, 3, 2**31 - 1)
    if style == "drop_vd":
        # "VD51074-320-340x240-cm" -> "51074-320"
        return F.when(
            F.startswith(sku, F.lit("VD")),
            F.substring_index(F.substring(sku, 3, 2**31 - 1), "-", 2),
        )
    if style == "drop_m_prefix":
        # "M131-GR456" -> "GR456"
        return F.regexp_replace(sku, r"^M\d+-", "")
    raise ValueError(f"unknown style {style!r}")


def clean_brand(c: Column) -> Column:
    """Stock phrase and the dash next to it removed from a brand."""
    bare = trim_text(F.regexp_replace(c, rf"(?i)eget{WS}+lager", ""))
    return trim_text(F.regexp_replace(bare, r"^-|-\z", ""))


def screenshot_key(url: Column) -> Column:
    """Stable object key of the page image."""
    return F.concat(F.lit("screenshots/"), F.md5(url), F.lit(".jpg"))
