"""All named queries; importing the modules registers them."""

from . import analytics_queries, features, io_queries, matching_queries, page_queries, profile_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
