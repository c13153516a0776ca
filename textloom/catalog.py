"""All queries of the core, by name, with the equivalent SQL."""

from __future__ import annotations

from .plans import curation, exchange, extras, features, orphans, pipeline, retrieval, texts

FLAGSHIP = "bm25_topk"
_MODULES = (orphans, retrieval, texts, curation, features, extras, pipeline, exchange)


def queries() -> dict:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: q for m in _MODULES for k, q in m.ORACLE.items()}
