"""Imports every module that registers queries."""

from jurispark.plans import court, rules, uploads, wiki, work  # noqa: F401
from jurispark.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
