"""Roles of the test tables shared by several probes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesift.functions.columns import venue
from lakesift.operators.facts import rate_fact
from lakesift.operators.joins import Lookup, matched, star
from lakesift.probes.registry import Tables, sql_round

LINE_GRAIN = ["l_suppkey", "l_orderkey"]
LINE_METRICS = ["l_linenumber", "l_extendedprice", "l_tax"]


def money(df: DataFrame, *cols: str, digits: int = 18) -> DataFrame:
    """Two-digit amounts as decimals, so that sums are exact in any order.

    Up to eight digits, the sums still fit a 64-bit number and are twice as fast.
    """
    return df.withColumns({c: F.col(c).cast(f"decimal({digits},2)") for c in cols})


def line_amounts(t: Tables) -> DataFrame:
    """The lines with exact amounts, only the columns the line fact needs."""
    lines = t.lineitem.select(*LINE_GRAIN, "l_quantity", *LINE_METRICS)
    return money(lines, "l_extendedprice", "l_tax", digits=8)


def doubles(df: DataFrame) -> DataFrame:
    """Decimal results back to double for comparison."""
    return df.select(
        *[
            F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c)
            for c, t in df.dtypes
        ]
    )


def labelled(t: Tables) -> DataFrame:
    """Documents with their labels; most have none."""
    return t.documents.join(t.labels, "doc_id", "left")


LABELLED_SQL = """
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def line_rates(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    """Sums and rates per supplier and order; quantity plays the part of time."""
    lines = line_amounts(t) if lines is None else lines
    return doubles(rate_fact(lines, LINE_GRAIN, LINE_METRICS, "l_quantity", "total_minutes"))


_TOTALS = {
    "l_linenumber": "cast(sum(l_linenumber) as bigint)",
    "l_extendedprice": "cast(sum(cast(l_extendedprice as decimal(18,2))) as double)",
    "l_tax": "cast(sum(cast(l_tax as decimal(18,2))) as double)",
}

LINE_TOTALS_SQL = f"""
  SELECT l_suppkey, l_orderkey, sum(l_quantity) / 60 AS raw_time,
         {", ".join(f"{e} AS total_{m}" for m, e in _TOTALS.items())}
  FROM lineitem GROUP BY l_suppkey, l_orderkey
"""

LINE_RATES_SQL = f"""
  SELECT l_suppkey, l_orderkey,
         {", ".join(f"total_{m}" for m in LINE_METRICS)},
         {", ".join(sql_round(f"cast(total_{m} as double) / nullif(raw_time, 0) * 60") + f" AS {m}_per_60" for m in LINE_METRICS)},
         {sql_round("raw_time")} AS total_minutes
  FROM ({LINE_TOTALS_SQL})
"""


def line_orders(orders: DataFrame) -> Lookup:
    """What the line fact takes from its orders."""
    cols = ["o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"]
    return Lookup(orders, "l_orderkey", "o_orderkey", {c: c for c in cols})


def line_fact(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """The wide fact: line rates, their order, and nations in a home and an away role.

    Given a selection of orders, only their lines are grouped.
    """
    lines = None if orders is None else matched(line_amounts(t), orders, "l_orderkey", "o_orderkey")
    orders = t.orders if orders is None else orders
    homes = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("home_nation_id"))
    aways = t.customer.select("c_custkey", F.col("c_nationkey").alias("away_nation_id"))
    wide = star(
        line_rates(t, lines),
        [
            line_orders(orders),
            Lookup(homes, "l_suppkey", "s_suppkey", {"home_nation_id": "home_nation_id"}),
            Lookup(aways, "o_custkey", "c_custkey", {"away_nation_id": "away_nation_id"}),
            Lookup(t.nation, "away_nation_id", "n_nationkey", {"n_name": "away_nation_name"}),
            Lookup(t.nation, "home_nation_id", "n_nationkey", {"n_name": "home_nation_name"}),
        ],
        ["inner", "left", "left", "left", "left"],
    )
    return wide.withColumns(
        {
            "venue": venue("away_nation_id", "home_nation_id"),
            "season": F.year("o_orderdate"),
        }
    )


def season_lines(t: Tables) -> DataFrame:
    """The line fact with its orders only, for measures that need no other role."""
    return star(line_rates(t), [line_orders(t.orders)], ["inner"]).withColumn("season", F.year("o_orderdate"))


LINE_FACT_SQL = f"""
  SELECT r.*, o.o_custkey, o.o_orderdate, o.o_orderpriority, o.o_orderstatus,
         s.s_nationkey AS home_nation_id, c.c_nationkey AS away_nation_id,
         a.n_name AS away_nation_name, h.n_name AS home_nation_name,
         CASE WHEN c.c_nationkey = s.s_nationkey THEN 'Home' ELSE 'Away' END AS venue,
         cast(year(o.o_orderdate) as integer) AS season
  FROM ({LINE_RATES_SQL}) r
  JOIN orders o ON r.l_orderkey = o.o_orderkey
  LEFT JOIN supplier s ON r.l_suppkey = s.s_suppkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation a ON c.c_nationkey = a.n_nationkey
  LEFT JOIN nation h ON s.s_nationkey = h.n_nationkey
"""


def order_seasons(t: Tables) -> DataFrame:
    """Orders with their year as season and exact prices."""
    return money(
        t.orders.withColumn("season", F.year("o_orderdate")), "o_totalprice"
    )


ORDER_SEASONS_SQL = """
  SELECT *, cast(year(o_orderdate) as integer) AS season FROM orders
"""
