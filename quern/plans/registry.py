"""The registered queries of the engine, and their SQL."""

from __future__ import annotations

from quern.plans import queries_corpus, queries_dedup, queries_layout, queries_manifest, queries_text, queries_tokens
from quern.plans.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "queries_corpus", "queries_dedup", "queries_layout", "queries_manifest", "queries_text", "queries_tokens"]
