from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from lakesift.operators import measures as M
from lakesift.probes.registry import probe, sql_money
from lakesift.session import scratch
from lakesift.sources.aggregates import StoredSums
from lakesift.sources.published import Shelf
from lakesift.probes.views import (
    LINE_FACT_SQL,
    LINE_RATES_SQL,
    ORDER_SEASONS_SQL,
    doubles,
    line_fact,
    line_rates,
    money,
    order_seasons,
    season_lines,
)


def _fact(fact):
    return money(
        fact, "total_l_extendedprice", "total_minutes", "l_linenumber_per_60",
        "l_tax_per_60", "l_extendedprice_per_60",
    )


def _money_sum(c: str) -> str:
    return f"sum(cast({c} as decimal(18,2)))"


@probe(
    "d18_additive_measures",
    f"""
    SELECT season, {sql_money("total_minutes")} AS minutes,
           {sql_money("total_l_extendedprice")} AS price,
           cast(sum(total_l_linenumber) as bigint) AS linenumbers
    FROM ({LINE_FACT_SQL}) GROUP BY season
    """,
)
def d18(t):
    cols = {
        "minutes": "total_minutes",
        "price": "total_l_extendedprice",
        "linenumbers": "total_l_linenumber",
    }
    return doubles(M.measure_sum(_fact(season_lines(t)), ["season"], cols))


_RATES = f"""
  cast({_money_sum("total_l_extendedprice")} as double) / nullif(cast({_money_sum("total_minutes")} as double), 0) * 60 AS price_per_60,
  cast(sum(total_l_linenumber) as double) / nullif(cast({_money_sum("total_minutes")} as double), 0) * 60 AS linenumber_per_60
"""
_RATE_COLS = {"price_per_60": "total_l_extendedprice", "linenumber_per_60": "total_l_linenumber"}


@probe(
    "d19_ratio_of_sums",
    f"SELECT season, o_orderpriority, {_RATES} FROM ({LINE_FACT_SQL}) GROUP BY season, o_orderpriority",
)
def d19(t):
    return M.measure_rate(_fact(season_lines(t)), ["season", "o_orderpriority"], _RATE_COLS, "total_minutes")


@probe("d19_ratio_of_sums_overall", f"SELECT {_RATES} FROM ({LINE_FACT_SQL})")
def d19_all(t):
    return M.measure_rate(_fact(season_lines(t)), [], _RATE_COLS, "total_minutes")


@probe(
    "d20_conversion_ratio",
    f"""
    SELECT l_suppkey, cast({_money_sum("l_tax_per_60")} as double)
           / nullif(cast({_money_sum("l_linenumber_per_60")} as double), 0) AS ratio
    FROM ({LINE_RATES_SQL}) GROUP BY l_suppkey
    """,
)
def d20(t):
    rates = money(line_rates(t), "l_tax_per_60", "l_linenumber_per_60")
    return M.measure_ratio(rates, ["l_suppkey"], "l_tax_per_60", "l_linenumber_per_60")


def _yoy_sql(by: str, value: str) -> str:
    on = f"c.{by} = p.{by} AND " if by else ""
    cols = f"{by}, " if by else ""
    own = f"c.{by}, " if by else ""
    return f"""
    WITH s AS (SELECT {cols}season, {sql_money("o_totalprice")} AS total
               FROM ({ORDER_SEASONS_SQL}) GROUP BY {cols}season)
    SELECT {own}c.season, c.total AS "current", p.total AS previous, {value}
    FROM s c LEFT JOIN s p ON {on}c.season = p.season + 1
    """


_PCT = """CASE WHEN p.total IS NULL THEN NULL
          ELSE coalesce((coalesce(c.total, 0) - p.total) / nullif(p.total, 0), 0) * 100 END AS pct_change"""


@probe("d21_season_difference", _yoy_sql("o_orderpriority", "coalesce(c.total, 0) - p.total AS change"))
def d21(t):
    return M.yoy_diff(order_seasons(t), ["o_orderpriority"], "season", "o_totalprice")


@probe("d21_season_difference_overall", _yoy_sql("", "coalesce(c.total, 0) - p.total AS change"))
def d21_all(t):
    return M.yoy_diff(order_seasons(t), [], "season", "o_totalprice")


@probe("d22_season_percent", _yoy_sql("o_orderpriority", _PCT))
def d22(t):
    return M.yoy_pct(order_seasons(t), ["o_orderpriority"], "season", "o_totalprice")


@probe("d22_customer_season_percent", _yoy_sql("o_custkey", _PCT))
def d22_customer(t):
    """Most customers have gap years, which leave no previous value."""
    return M.yoy_pct(order_seasons(t), ["o_custkey"], "season", "o_totalprice")


def _span_sql(by: str, source: str) -> str:
    return f"""
    WITH s AS (SELECT {by}, season, {sql_money("o_totalprice")} AS total
               FROM ({source}) GROUP BY {by}, season),
         e AS (SELECT {by}, arg_min(total, season) AS first_value, arg_max(total, season) AS last_value
               FROM s GROUP BY {by})
    SELECT *, coalesce((last_value - first_value) / nullif(first_value, 0), 0) * 100 AS pct_change FROM e
    """


_SEGMENTS = f"""
  SELECT o.*, c_mktsegment FROM ({ORDER_SEASONS_SQL}) o JOIN customer ON o_custkey = c_custkey
"""


@probe("d23_first_to_last_percent", _span_sql("c_mktsegment", _SEGMENTS))
def d23(t):
    segments = t.customer.select("c_custkey", "c_mktsegment")
    joined = order_seasons(t).join(segments, F.col("o_custkey") == F.col("c_custkey"))
    return M.span_pct(joined, ["c_mktsegment"], "season", "o_totalprice")


@probe(
    "d24_next_season",
    f"""
    SELECT o_custkey, CASE WHEN count(DISTINCT season) = 1 THEN max(season) + 1 END AS next_season
    FROM ({ORDER_SEASONS_SQL}) GROUP BY o_custkey
    """,
)
def d24(t):
    return M.next_season(order_seasons(t), ["o_custkey"], "season")


_SLICE_SQL = f"""
    SELECT l_suppkey, {_RATES} FROM ({LINE_FACT_SQL})
    WHERE season = 1996 AND venue = 'Home' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
    GROUP BY l_suppkey
    """


@probe("d25_dashboard_slice", _SLICE_SQL)
def d25(t):
    """What is selected by the orders' own columns is selected before the lines are grouped."""
    orders = t.orders.withColumn("season", F.year("o_orderdate"))
    orders = M.slice_by(orders, {"season": 1996, "o_orderpriority": ["1-URGENT", "2-HIGH"]})
    picked = M.slice_by(_fact(line_fact(t, orders)), {"venue": "Home"})
    return M.measure_rate(picked, ["l_suppkey"], _RATE_COLS, "total_minutes")


def _stored_sums(t) -> StoredSums:
    """The line fact's sums at three grains; its last season is added after the others."""
    sums, fact = StoredSums(t.spark, scratch(t.spark, "sums")), _fact(line_fact(t))
    grains = [["l_suppkey", "season", "venue", "o_orderpriority"], ["season", "o_orderpriority"], ["l_suppkey"]]
    sums.store(fact.where("season < 1998"), ["total_l_extendedprice", "total_l_linenumber", "total_minutes"], grains)
    sums.add(fact.where("season >= 1998"))
    return sums


@probe("d25_slice_of_stored_sums", _SLICE_SQL)
def d25_stored(t):
    filters = {"season": 1996, "venue": "Home", "o_orderpriority": ["1-URGENT", "2-HIGH"]}
    return _stored_sums(t).rates(["l_suppkey"], _RATE_COLS, "total_minutes", filters=filters)


@probe(
    "d19_rates_of_stored_sums",
    f"SELECT season, o_orderpriority, {_RATES} FROM ({LINE_FACT_SQL}) GROUP BY season, o_orderpriority",
)
def d19_stored(t):
    return _stored_sums(t).rates(["season", "o_orderpriority"], _RATE_COLS, "total_minutes")


@probe(
    "d20_ratio_of_stored_sums",
    f"""SELECT l_suppkey, cast({_money_sum("total_l_extendedprice")} as double) / nullif(cast({_money_sum("total_minutes")} as double), 0) AS ratio
        FROM ({LINE_FACT_SQL}) GROUP BY l_suppkey""",
)
def d20_stored(t):
    return _stored_sums(t).ratio(["l_suppkey"], "total_l_extendedprice", "total_minutes")


@probe(
    "f4_most_improved",
    f"""
    SELECT * FROM ({_span_sql("o_custkey", ORDER_SEASONS_SQL)})
    ORDER BY pct_change DESC NULLS LAST, o_custkey LIMIT 20
    """,
)
def f4(t):
    return M.most_improved(order_seasons(t), "o_custkey", "season", "o_totalprice", 20)


def _published_lines(t):
    """The line fact with its season as text, such as 19951996, published and read back."""
    year = F.col("season")
    fact = season_lines(t).withColumn("season", F.concat(year.cast("string"), (year + 1).cast("string")))
    shelf, stamp = Shelf(t.spark, scratch(t.spark, "shelf")), datetime(2024, 1, 1, tzinfo=timezone.utc)
    shelf.publish({"lines": shelf.stage(fact, "lines", stamp, cluster_by=["season"])}, "p1", "r1", stamp)
    return _fact(shelf.read_published("lines"))


_TEXT_SEASONS = f"""
  WITH s AS (SELECT season, cast(sum(total_l_linenumber) as double) AS total FROM ({LINE_FACT_SQL}) GROUP BY season)
  SELECT c.season, c.total AS "current", p.total AS previous, %s FROM s c LEFT JOIN s p ON c.season = p.season + 1
"""


@probe("d21_text_season_difference", _TEXT_SEASONS % "coalesce(c.total, 0) - p.total AS change")
def d21_text(t):
    return M.yoy_diff(_published_lines(t), [], "season", "total_l_linenumber")


@probe("d22_text_season_percent", _TEXT_SEASONS % _PCT)
def d22_text(t):
    return M.yoy_pct(_published_lines(t), [], "season", "total_l_linenumber")


@probe(
    "d19_measure_set",
    f"""
    SELECT cast(season as varchar) || cast(season + 1 as varchar) AS season, {sql_money("total_minutes")} AS minutes,
           {sql_money("total_l_extendedprice")} AS price, cast(sum(total_l_linenumber) as bigint) AS linenumbers, {_RATES}
    FROM ({LINE_FACT_SQL}) GROUP BY season
    """,
)
def d19_set(t):
    """A fixed set of sums and rates on a published fact."""
    sums = {"minutes": "total_minutes", "price": "total_l_extendedprice", "linenumbers": "total_l_linenumber"}
    return doubles(M.measure_set(_published_lines(t), ["season"], sums, _RATE_COLS, "total_minutes"))
