"""Registered queries: importing this package fills the registry."""

from vexa.plans import aggregates, ann, dml, filters, maintain, search, sources, streams, text  # noqa: F401
from vexa.plans.registry import ORACLES, QUERIES, load, register

__all__ = ["ORACLES", "QUERIES", "load", "register"]
