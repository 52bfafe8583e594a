"""Queries of the tokens."""

from __future__ import annotations

import public_tokenizers

from lakesift.llm.bpe import encoded_digests
from lakesift.llm.common import query, table
from lakesift.llm.packing import pack


@query("op9_bpe_backtracking")
def op9(spark, folder):
    """Digests of the ids of every document, and of the text decoded from them."""
    return encoded_digests(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op10_window_packing")
def op10(spark, folder):
    """All documents as pieces of sequences of at most 2048 tokens."""
    files = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
    return pack(table(spark, folder, "documents"), *files, end_id=1)
