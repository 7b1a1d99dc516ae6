"""Every registered query of the llm operators, with its oracle SQL where SQL can express it."""

from __future__ import annotations

import corpus_pipeline
from sitewatts.llm import (
    decontaminate,
    extendible,
    fertility,
    filter_audit,
    huffman,
    licenses,
    near_dups,
    packing,
    pii,
    prefix_counts,
    spelling,
    toxicity,
    url_filters,
)

_MODULES = (
    fertility, pii, packing, decontaminate, licenses, huffman, toxicity, url_filters, near_dups, prefix_counts, spelling,
    extendible, filter_audit,
)

QUERIES = {name: fn for module in _MODULES for name, fn in module.QUERIES.items()} | {"pipeline": corpus_pipeline.run}
ORACLE = {name: sql for module in _MODULES for name, sql in getattr(module, "ORACLE", {}).items()}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
