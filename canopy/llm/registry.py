"""The queries of this subpackage and their SQL."""

from __future__ import annotations

import importlib

MODULES = ["quality", "exact_dedup", "substring_dedup", "url_trust", "pack", "pseudonyms", "lm_score", "simhash", "decontaminate", "hilbert_shards"]

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
for _name in MODULES:
    _module = importlib.import_module(f"canopy.llm.{_name}")
    QUERIES |= _module.QUERIES
    ORACLE |= _module.ORACLE
