from __future__ import annotations

from pyspark.sql import functions as F

from lakesift.operators.dedupe import duplicate_rows
from lakesift.operators.joins import Lookup, in_set, join_dimension, matched, orphans
from lakesift.probes.registry import probe
from lakesift.probes.views import LINE_RATES_SQL, line_rates


@probe(
    "c1_inner_join",
    f"""
    SELECT r.l_suppkey, r.l_orderkey, r.total_l_extendedprice, o.o_orderdate, o.o_orderpriority
    FROM ({LINE_RATES_SQL}) r JOIN orders o ON r.l_orderkey = o.o_orderkey
    """,
)
def c1(t):
    look = Lookup(
        t.orders, "l_orderkey", "o_orderkey",
        {"o_orderdate": "o_orderdate", "o_orderpriority": "o_orderpriority"},
    )
    return join_dimension(line_rates(t), look).select(
        "l_suppkey", "l_orderkey", "total_l_extendedprice", "o_orderdate", "o_orderpriority"
    )


@probe(
    "c3_left_anti_orphans",
    """
    SELECT * FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
    """,
)
def c3(t):
    return orphans(t.documents, t.labels, "doc_id")


@probe(
    "c3_text_keys",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    """,
)
def c3_text(t):
    """Number against text keys, some of them malformed: these match nothing."""
    lines = t.lineitem.select(
        F.explode(
            F.array(F.col("l_orderkey").cast("string"), F.concat(F.lit("x"), "l_orderkey"))
        ).alias("order_ref")
    )
    return orphans(t.orders, lines, "o_orderkey", "order_ref").select("o_orderkey", "o_custkey")


@probe(
    "c4_left_semi_matched",
    """
    SELECT * FROM orders o
    WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
    """,
)
def c4(t):
    return matched(t.orders, t.lineitem, "o_orderkey", "l_orderkey")


@probe(
    "c5_duplicate_rows",
    """
    SELECT l.* FROM lineitem l JOIN (
      SELECT l_orderkey, l_linenumber FROM lineitem
      GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) d
    ON l.l_orderkey = d.l_orderkey AND l.l_linenumber = d.l_linenumber
    """,
)
def c5(t):
    return duplicate_rows(t.lineitem, ["l_orderkey", "l_linenumber"])


_DEBTOR_ORDERS = """
  SELECT l_orderkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal < 0
"""


def _debtor_orders(t):
    return matched(t.lineitem, t.supplier.where("s_acctbal < 0"), "l_suppkey", "s_suppkey")


@probe("c6_in_set", f"SELECT * FROM orders WHERE o_orderkey IN ({_DEBTOR_ORDERS})")
def c6(t):
    return in_set(t.orders, "o_orderkey", _debtor_orders(t), "l_orderkey")


@probe("c6_not_in_set", f"SELECT * FROM orders WHERE o_orderkey NOT IN ({_DEBTOR_ORDERS})")
def c6_not(t):
    return in_set(t.orders, "o_orderkey", _debtor_orders(t), "l_orderkey", negate=True)
