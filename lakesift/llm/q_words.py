"""Query of the spelling variants."""

from __future__ import annotations

from lakesift.llm.common import query, table
from lakesift.llm.spelling import document_words, variants

# CRC-32 byte by byte: its table, then a reduction over the bytes of each text. The letters have one byte or two.
OP12_SQL = r"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8
), runs AS (
  SELECT coalesce(cast(doc_id AS VARCHAR), '') AS id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS w FROM documents)
  GROUP BY 1, 2
), hashed AS (
  SELECT w, k, xor(list_reduce(
      list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(id || ':' || w, ''), lambda x:
        CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [(192 + unicode(x) // 64)::BIGINT, (128 + unicode(x) % 64)::BIGINT] END))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM runs, crc
), words AS (
  SELECT word, cast(sum(k) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, k FROM hashed)
  WHERE length(word) >= 6
  GROUP BY word HAVING sum(k) >= 5
), less AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS x
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word AS a, b.word AS b FROM less a JOIN less b ON a.i = b.i AND a.x = b.x AND a.word <> b.word
  UNION
  SELECT a.word, b.word FROM less a JOIN words b ON a.x = b.word
  UNION
  SELECT b.word, a.word FROM less a JOIN words b ON a.x = b.word
), best AS (
  SELECT a AS word, count(*) AS n_near, arg_min(b, (-w.n, b)) AS form, max(w.n) AS form_n
  FROM near JOIN words w ON w.word = b GROUP BY a
), forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN form END AS form, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), chains(word, last) AS (
  SELECT word, form FROM forms WHERE form IS NOT NULL
  UNION ALL
  SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.last WHERE f.form IS NOT NULL
), roots AS (
  SELECT c.word, c.last AS root FROM chains c JOIN forms f ON f.word = c.last WHERE f.form IS NULL
)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM forms LEFT JOIN roots USING (word)
"""


@query("op12_chunk_variants", OP12_SQL)
def op12(spark, folder):
    """Words of the documents with the form that each is a variant of, one in 199 occurrences being damaged."""
    return variants(document_words(table(spark, folder, "documents"), damage_every=199))
