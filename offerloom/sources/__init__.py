"""Readers of captured pages, requests, schedules, dimensions and dumps."""

from offerloom.sources.readers import (
    import_catalog,
    read_category_dim,
    read_offer_dump,
    read_pages,
    read_request_batches,
    read_requests,
    read_schedules,
)

__all__ = [name for name in dir() if not name.startswith("_")]
