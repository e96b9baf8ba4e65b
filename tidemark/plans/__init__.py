"""Registered queries and the SQL that checks them."""

from tidemark.plans import live, live_oracle, scale, scale_oracle, serving, serving_oracle, stores, stores_oracle  # noqa: F401  (they register themselves)
from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]
