"""Query of the exact duplicates."""

from __future__ import annotations

from lakesift.llm.blocknames import exact_groups
from lakesift.llm.common import query, table

OP4_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""


@query("op4_block_naming_dedup", OP4_SQL)
def op4(spark, folder):
    """Every document with the one that stays of its equals."""
    return exact_groups(table(spark, folder, "documents"))
