"""Queries and oracle SQL of the operators in this subpackage."""

from __future__ import annotations

from llm import (conversations, embedding_dedup, exact_search, language, licenses, mixing, passages, pieces, quality,
                 shingle_join, suffix_dedup, tokens, vector_codes)

_MODULES = (quality, mixing, tokens, suffix_dedup, passages, embedding_dedup, language,
            shingle_join, pieces, licenses, conversations, exact_search, vector_codes)

QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
ORACLE = {k: s for m in _MODULES for k, s in m.ORACLE.items()}
