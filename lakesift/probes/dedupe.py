from __future__ import annotations

from pyspark.sql import functions as F

from lakesift.operators import dedupe as U
from lakesift.operators.ordering import number_rows, running_total
from lakesift.probes.registry import probe
from lakesift.probes.views import labelled

LINE_KEY = ["l_orderkey", "l_linenumber"]

_ALL = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus, l_shipdate"
)
_ORDER_SQL = f"l_shipdate DESC NULLS LAST, {_ALL}"


def _natural(*first):
    """An order with every column in it, as the SQL has it."""
    return [*first, *[F.col(c).asc_nulls_first() for c in _ALL.split(", ")]]


def _latest():
    return _natural(*U.latest_complete("l_shipdate"))


@probe(
    "d5_duplicate_keys",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    """,
)
def d5(t):
    return U.duplicate_keys(t.lineitem, LINE_KEY)


@probe(
    "e1_key_count",
    "SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS key_count FROM lineitem",
)
def e1(t):
    return U.flag_dupes(t.lineitem, LINE_KEY)


@probe(
    "e2_keep_latest",
    f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER_SQL}) AS rn
      FROM lineitem) WHERE rn = 1
    """,
)
def e2(t):
    return U.keep_best(t.lineitem, LINE_KEY, _latest())


@probe(
    "e3_surplus_rows",
    f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER_SQL}) AS rn
      FROM lineitem) WHERE rn > 1
    """,
)
def e3(t):
    return U.surplus_rows(t.lineitem, LINE_KEY, _latest())


@probe(
    "e4_number_copies",
    """
    SELECT l_suppkey, l_linenumber, l_quantity,
           row_number() OVER (PARTITION BY l_suppkey, l_linenumber, l_quantity) AS copy_number
    FROM lineitem
    """,
)
def e4(t):
    return U.number_copies(t.lineitem, ["l_suppkey", "l_linenumber", "l_quantity"])


@probe(
    "e4_number_copies_of_key",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
           row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, {_ALL}) AS copy_number
    FROM lineitem
    """,
)
def e4_key(t):
    numbered = number_rows(t.lineitem, LINE_KEY, _natural(F.col("l_shipdate").asc()), "copy_number")
    return numbered.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "copy_number"
    )


@probe(
    "e4_number_hot_groups",
    """
    SELECT event_id, event_type, ts,
           row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS seq
    FROM events
    """,
)
def e4_hot(t):
    """Few keys with very many rows each: every group is spread over range partitions."""
    events = t.events.select("event_id", "event_type", "ts")
    return number_rows(
        events, ["event_type"], [F.col("ts").asc(), F.col("event_id").asc()], "seq", spread=True
    )


@probe(
    "e4_running_weight",
    """
    SELECT *, CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS weight,
           cast(sum(CASE WHEN o_orderstatus <> 'F' THEN o_custkey END) OVER (
             PARTITION BY o_orderpriority ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS bigint) AS so_far
    FROM orders
    """,
)
def e4_weight(t):
    """A running sum of weights of which many are null, spread over range partitions."""
    orders = t.orders.withColumn("weight", F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")))
    return running_total(orders, ["o_orderpriority"], [F.col("o_orderkey").asc()], "weight", "so_far", spread=True)


@probe(
    "b13_running_number_key",
    f"""
    SELECT *, cast(l_orderkey as varchar) || '_' || cast(l_linenumber as varchar) || '_' ||
              cast(row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER_SQL}) as varchar) AS row_key
    FROM lineitem
    """,
)
def b13(t):
    return U.disambiguate(t.lineitem, LINE_KEY, _latest())


@probe("g1_distinct_rows", "SELECT DISTINCT l_suppkey, l_linenumber, l_quantity FROM lineitem")
def g1(t):
    return U.dedupe(t.lineitem.select("l_suppkey", "l_linenumber", "l_quantity"))


@probe(
    "g2_distinct_keys",
    f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, {_ALL}) AS rn
      FROM lineitem) WHERE rn = 1
    """,
)
def g2(t):
    return U.dedupe(t.lineitem, ["l_orderkey"], _natural(F.col("l_linenumber").desc()))


@probe(
    "g4_same_key_sets",
    """
    WITH x AS (SELECT d.doc_id, quality IS NULL AS a, toxic IS NULL AS b
               FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    SELECT count(*) FILTER (a) AS keys_a, count(*) FILTER (b) AS keys_b,
           count(*) FILTER (a AND NOT b) AS only_a, count(*) FILTER (b AND NOT a) AS only_b,
           count(*) FILTER (a <> b) = 0 AS same
    FROM x
    """,
)
def g4(t):
    docs = labelled(t)
    return U.same_keys(
        docs.where(F.col("quality").isNull()), docs.where(F.col("toxic").isNull()), "doc_id"
    )


@probe(
    "g5_value_set_overlap",
    """
    WITH a AS (SELECT DISTINCT cast(o_orderdate as date) AS day FROM orders
               WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)),
         b AS (SELECT DISTINCT cast(o_orderdate as date) AS day FROM orders
               WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
         x AS (SELECT coalesce(a.day, b.day) AS day, a.day IS NOT NULL AS in_a, b.day IS NOT NULL AS in_b
               FROM a FULL JOIN b ON a.day = b.day)
    SELECT count(*) FILTER (in_a AND in_b) AS shared, count(*) FILTER (in_a AND NOT in_b) AS only_a,
           count(*) FILTER (in_b AND NOT in_a) AS only_b,
           count(*) FILTER (in_a AND NOT in_b) = 0 AS is_subset,
           count(*) FILTER (in_a AND in_b) > 0 AS overlaps
    FROM x
    """,
)
def g5(t):
    lines = t.lineitem.select("l_orderkey").distinct()
    orders = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    on = F.col("o_orderkey") == F.col("l_orderkey")
    return U.overlap(orders.join(lines, on, "left_anti"), orders.join(lines, on, "left_semi"), "day")
