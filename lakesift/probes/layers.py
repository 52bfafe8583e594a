"""The whole layered load on the test tables: check, build, judge, publish, read back."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from lakesift.operators.expectations import non_negative_suite
from lakesift.plans.medallion import (
    FactRules,
    GalaxyRules,
    Role,
    StarRules,
    build_gold,
    load_silver,
    publish_gold,
)
from lakesift.probes.registry import probe, sql_round
from lakesift.session import scratch
from lakesift.sources.published import Shelf
from lakesift.sources.rejects import read_reasons
from lakesift.sources.runlog import RunLog

TS = datetime(2024, 3, 1, 6, tzinfo=timezone.utc)

GALAXY = GalaxyRules(
    primary_keys={
        "orders": ["o_orderkey"],
        "supplier": ["s_suppkey"],
        "customer": ["c_custkey"],
        "nation": ["n_nationkey"],
    },
    references={
        "lineitem": {
            "orders": ("l_orderkey", "o_orderkey"),
            "supplier": ("l_suppkey", "s_suppkey"),
        }
    },
    non_negative={"lineitem": ["margin", "l_quantity"]},
)

LINES_PER_60 = FactRules(
    name="line_stats_per_60",
    source="lineitem",
    keys=["l_suppkey", "l_orderkey"],
    metrics=["l_linenumber"],
    time="l_quantity",
    time_out="total_minutes",
    suite=non_negative_suite(["l_linenumber_per_60", "total_l_linenumber", "total_minutes"], 13),
)

STAR = StarRules(
    main=Role(
        "orders", "l_orderkey", "o_orderkey",
        {"o_custkey": "o_custkey", "o_orderpriority": "o_orderpriority", "season": "season"},
    ),
    roles=[
        Role("supplier", "l_suppkey", "s_suppkey", {"s_nationkey": "home_nation_id"}),
        Role("customer", "o_custkey", "c_custkey", {"c_nationkey": "away_nation_id"}),
        Role("nation", "away_nation_id", "n_nationkey", {"n_name": "away_nation_name"}),
        Role("nation", "home_nation_id", "n_nationkey", {"n_name": "home_nation_name"}),
    ],
    own_key="away_nation_id",
    home_key="home_nation_id",
)

REQUIRED = {
    "lineitem": ["l_suppkey", "l_orderkey", "l_linenumber", "l_quantity"],
    "orders": ["o_orderkey", "o_custkey", "o_orderpriority", "season"],
    "supplier": ["s_suppkey", "s_nationkey"],
    "customer": ["c_custkey", "c_nationkey"],
    "nation": ["n_nationkey", "n_name"],
}


def _load(t):
    """Solvent suppliers and unfinished orders only, so that both leave orphans."""
    staged = {
        "orders": t.orders.where("o_orderstatus <> 'F'").withColumn("season", F.year("o_orderdate")),
        "supplier": t.supplier.where("s_acctbal >= 0"),
        "customer": t.customer,
        "nation": t.nation,
        "lineitem": t.lineitem.withColumn("margin", F.col("l_extendedprice") - 1000),
    }
    log = RunLog("p1", "r1", scratch(t.spark, "runlog"))
    rejects = scratch(t.spark, "rejects")
    silver = load_silver(staged, GALAXY, scratch(t.spark, "silver"), rejects, log)
    return silver, rejects, log


_JUDGED = """
  SELECT *, CASE
    WHEN l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') THEN 'rejected_lineitem_orders_orphans'
    WHEN l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) THEN 'rejected_lineitem_supplier_orphans'
    WHEN l_extendedprice - 1000 < 0 THEN 'rejected_lineitem_margin_negatives' END AS report
  FROM lineitem
"""


@probe(
    "layered_load_rejects",
    f"""
    SELECT report, CASE WHEN report LIKE '%orphans' THEN 'ri_orphan' ELSE 'negative_value' END AS issue_type,
           count(*) AS n_rows FROM ({_JUDGED}) WHERE report IS NOT NULL GROUP BY ALL
    """,
)
def rejects(t):
    _, root, _ = _load(t)
    reasons = read_reasons(t.spark, root)
    return reasons.groupBy("report", "issue_type").agg(F.count(F.lit(1)).alias("n_rows"))


@probe("layered_load_plain_silver", f"SELECT * EXCLUDE (report) FROM ({_JUDGED}) WHERE report IS NULL".replace("SELECT *, CASE", "SELECT *, l_extendedprice - 1000 AS margin, CASE"))
def plain_silver(t):
    """A silver table read as plain files holds its accepted rows and no others."""
    silver, _, _ = _load(t)
    stored = t.spark.read.parquet(silver["lineitem"].inputFiles()[0].rpartition("/")[0])
    return stored.drop("load_timestamp", "pipeline_id", "run_id")


@probe(
    "layered_load_line_fact",
    f"""
    SELECT r.*, o.o_custkey, o.o_orderpriority, cast(year(o.o_orderdate) as integer) AS season,
           s.s_nationkey AS home_nation_id, c.c_nationkey AS away_nation_id,
           a.n_name AS away_nation_name, h.n_name AS home_nation_name,
           CASE WHEN c.c_nationkey = s.s_nationkey THEN 'Home' ELSE 'Away' END AS venue
    FROM (SELECT l_suppkey, l_orderkey, cast(sum(l_linenumber) as bigint) AS total_l_linenumber,
                 {sql_round("cast(sum(l_linenumber) as double) / nullif(sum(l_quantity) / 60, 0) * 60")} AS l_linenumber_per_60,
                 {sql_round("sum(l_quantity) / 60")} AS total_minutes
          FROM ({_JUDGED}) WHERE report IS NULL GROUP BY l_suppkey, l_orderkey) r
    JOIN orders o ON r.l_orderkey = o.o_orderkey
    LEFT JOIN supplier s ON r.l_suppkey = s.s_suppkey
    LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN nation a ON c.c_nationkey = a.n_nationkey
    LEFT JOIN nation h ON s.s_nationkey = h.n_nationkey
    """,
)
def line_fact(t):
    silver, _, log = _load(t)
    shelf = Shelf(t.spark, scratch(t.spark, "shelf"))
    staged, proceed = build_gold(silver, REQUIRED, [LINES_PER_60], STAR, shelf, log, TS, ["season"])
    publish_gold(shelf, staged, proceed, log, TS)
    log.flush(t.spark)
    return shelf.read_published("line_stats_per_60")
