"""Query of the near-duplicates."""

from __future__ import annotations

from lakesift.llm.common import query, table
from lakesift.llm.neardup import near_groups

OP6_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(
      string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
      lambda w: w <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, x FROM (
    SELECT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS x
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0))
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), inter AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM inter JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)
), both_ways AS (
  SELECT x, y FROM links UNION SELECT y, x FROM links
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM d
  UNION
  SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x
), c AS (
  SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""


@query("op6_chosen_path_neardup", OP6_SQL)
def op6(spark, folder):
    """Every document with the component of documents whose two-word shingles are alike."""
    return near_groups(table(spark, folder, "documents"), size=2)
