"""Query of the vector search."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakesift.llm.common import query, table
from lakesift.llm.rtree import hard_negatives
from lakesift.llm.topk import scaled, search, usable

OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * cast(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), q AS (
  SELECT vec_id, min(e) AS e FROM v WHERE vec_id % 50 = 0 GROUP BY vec_id, len(e)
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, cast(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT query_id, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM p
)
SELECT * FROM r WHERE rank <= 5
"""


@query("op8_exact_topk", OP8_SQL)
def op8(spark, folder):
    """The five vectors of highest inner product for every 50th vector, against all others."""
    vectors = table(spark, folder, "embeddings").filter(usable("embedding")).select(F.col("vec_id").alias("id"), scaled("embedding", 256).alias("vec"))
    return search(vectors.filter("id % 50 = 0"), vectors, 5)


OP11_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * cast(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, c.r, c.vec_id, a.label = c.label AS same, cast(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e)
  WHERE a.vec_id % 100 = 0
), p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, r) AS n FROM s WHERE same) WHERE n <= 5
), m AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, cast(row_number() OVER (PARTITION BY p.anchor, p.n ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
    s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT * FROM m WHERE rank <= 10
"""


@query("op11_rtree_negatives", OP11_SQL)
def op11(spark, folder):
    """Up to ten hard negatives for every positive of every 100th vector; every seventh label is moved on by one."""
    vectors = table(spark, folder, "embeddings").filter(usable("embedding"))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), label.alias("label"), scaled("embedding", 256).alias("vec"))
    return hard_negatives(rows, F.col("id") % 100 == 0, positives=5, negatives=10, low_percent=30, high_percent=90)
