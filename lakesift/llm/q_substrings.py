"""Query of the repeated passages."""

from __future__ import annotations

from lakesift.llm.common import query, table
from lakesift.llm.substrings import repeat_digests

OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)
), later AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY t ORDER BY doc_id, s) AS n FROM windows) WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM later
), kept AS (
  SELECT doc_id, p, w[p] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)
  ANTI JOIN gone USING (doc_id, p)
), texts AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM kept GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN texts USING (doc_id)
"""


@query("op7_anchor_repeats", OP7_SQL)
def op7(spark, folder):
    """Every document with its words that no repeated window of 20 words covers."""
    return repeat_digests(table(spark, folder, "documents"))
