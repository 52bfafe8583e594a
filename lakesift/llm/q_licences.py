"""Query of the licences."""

from __future__ import annotations

from lakesift.llm.common import query, table
from lakesift.llm.licences import all_templates, document_licences


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# Notices, paragraphs, headers, identifiers and bare names, against lines and whole texts. Whole licences and runs of words
# within a line are held against a plain version in the tests.
_VALUES = ", ".join(f"({k}, {_text(licence)}, {_text(text)})" for k, (licence, text, _, whole) in enumerate(all_templates()) if not whole)


def _bigrams(text: str) -> str:
    words = rf"list_filter(string_split_regex(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
    return f"(SELECT list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM (SELECT {words} AS w))"


OP1_SQL = f"""
WITH templates AS (
  SELECT template, licence, {_bigrams("text")} AS b FROM (VALUES {_VALUES}) AS v(template, licence, text)
), known AS (
  SELECT template, licence, len(b) AS m, unnest(b) AS bigram FROM templates
), split AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), units AS (
  SELECT doc_id, unnest(range(len(lines))) AS line, unnest(lines) AS unit FROM split
  UNION ALL SELECT doc_id, -1, text FROM split WHERE len(lines) > 1
), bigrams AS (
  SELECT doc_id, line, len(b) AS n, unnest(b) AS bigram FROM (SELECT doc_id, line, {_bigrams("unit")} AS b FROM units)
), shared AS (
  SELECT doc_id, line, n, template, licence, m, count(*) AS c FROM bigrams JOIN known USING (bigram) GROUP BY ALL
), best AS (
  SELECT doc_id, line, licence, round(2.0 * c / (n + m), 6) AS dice FROM shared WHERE 20 * c >= 8 * (n + m)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, licence) AS k FROM best
), counts AS (
  SELECT doc_id, count(DISTINCT line) FILTER (line >= 0) AS n_lines FROM best GROUP BY doc_id
)
SELECT d.doc_id, r.licence, r.dice, coalesce(n_lines, 0) AS n_lines
FROM documents d LEFT JOIN (SELECT * FROM ranked WHERE k = 1) r USING (doc_id) LEFT JOIN counts USING (doc_id)
"""


@query("op1_licence_dice", OP1_SQL)
def op1(spark, folder):
    """Every document with the licence that its lines name."""
    return document_licences(table(spark, folder, "documents"))
