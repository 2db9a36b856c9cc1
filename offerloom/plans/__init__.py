"""Whole jobs composed of the operators."""

from offerloom.plans.jobs import (
    explore_category,
    explore_category_pages,
    explore_homepage,
    extract_categories,
    scrape_details,
)

__all__ = [name for name in dir() if not name.startswith("_")]
