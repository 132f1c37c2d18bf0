"""All queries of the library proper."""

from __future__ import annotations

import importlib

MODULES = ["audit_queries", "place_queries", "graph_queries", "probe_queries", "stream_queries", "source_queries"]

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
for _name in MODULES:
    _module = importlib.import_module(f"canopy.plans.{_name}")
    QUERIES |= _module.QUERIES
    ORACLE |= _module.ORACLE
