"""Registered queries: each module pairs a Spark query with the SQL it must agree with."""

from __future__ import annotations

import importlib

MODULES = ["urls", "discovery", "stats", "audit", "texts", "search", "domains", "conversion", "flows", "keyed", "nested"]


def all_queries():
    """``(queries, oracles)`` of every module, in registration order."""
    for m in MODULES:
        importlib.import_module(f"{__name__}.{m}")
    from .registry import ORACLES, QUERIES
    return QUERIES, ORACLES
