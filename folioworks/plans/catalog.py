"""All registered queries."""

from folioworks.plans import flows_catalog, links_catalog, pages_catalog, posts_catalog  # noqa: F401
from folioworks.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
