"""The operators bound to the test tables with production parameters."""

from __future__ import annotations

from lakesift.llm import q_dedup, q_licences, q_neardup, q_pages, q_scores, q_search, q_substrings, q_tokens, q_words  # noqa: F401
from lakesift.llm.common import QUERIES

__all__ = ["QUERIES"]
