"""Availability values and the case conversion behind them."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# The closed set of availability labels.
ALLOWED_AVAILABILITY = (
    "back_order",
    "discounted",
    "in_stock",
    "in_store_only",
    "limited_availability",
    "online_only",
    "out_of_stock",
    "pre_order",
    "pre_sale",
    "sold_out",
)


def snake(c: Column) -> Column:
    """PascalCase -> snake_case."""
    return F.lower(F.regexp_replace(c, "(?<!^)(?=[A-Z])", "_"))


def availability_of(c: Column) -> Column:
    """Last path segment of a schema.org availability, in snake_case."""
    return snake(F.nullif(F.substring_index(c, "/", -1), F.lit("")))


def is_availability(c: Column) -> Column:
    return c.isin(*ALLOWED_AVAILABILITY)


def snake_name(name: str) -> str:
    """camelCase column name -> snake_case (every capital starts a word)."""
    return re.sub(r"[A-Z]", lambda m: "_" + m.group().lower(), name)
