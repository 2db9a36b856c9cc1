"""Imports every query module, so that their queries are registered."""

from workload import extraction, links, offers, reports, scalars, shops, streams  # noqa: F401
from workload.registry import ORACLES, QUERIES  # noqa: F401
