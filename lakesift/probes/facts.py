from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F

from lakesift.functions.columns import cast_columns
from lakesift.operators.facts import add_rates, aggregate_metrics, finish_time, rate_fact
from lakesift.probes.registry import probe, sql_money, sql_round
from lakesift.probes.views import (
    LINE_FACT_SQL,
    LINE_GRAIN,
    LINE_METRICS,
    LINE_RATES_SQL,
    LINE_TOTALS_SQL,
    doubles,
    line_amounts,
    line_fact,
    line_rates,
)
from lakesift.session import scratch
from lakesift.sources import catalog as C


def _totals(t):
    return aggregate_metrics(line_amounts(t), LINE_GRAIN, LINE_METRICS, "l_quantity")


@probe("d1_metric_sums", LINE_TOTALS_SQL)
def d1(t):
    return doubles(_totals(t))


@probe(
    "d2_rates_per_60",
    f"""
    SELECT *, {", ".join(sql_round(f"cast(total_{m} as double) / nullif(raw_time, 0) * 60") + f" AS {m}_per_60" for m in LINE_METRICS)}
    FROM ({LINE_TOTALS_SQL})
    """,
)
def d2(t):
    return doubles(add_rates(_totals(t), LINE_METRICS))


@probe(
    "d3_display_time",
    f"""SELECT * EXCLUDE (raw_time), {sql_round("raw_time")} AS total_minutes FROM ({LINE_TOTALS_SQL})""",
)
def d3(t):
    return doubles(finish_time(_totals(t), "total_minutes"))


@probe("d1_d3_line_rates", LINE_RATES_SQL)
def d13(t):
    return line_rates(t)


@probe(
    "d1_event_fact",
    f"""
    SELECT user_id, day, sum_time / 60 AS raw_time, total_events,
           {sql_round("cast(total_events as double) / nullif(sum_time / 60, 0) * 60")} AS events_per_60
    FROM (SELECT user_id, cast(ts as date) AS day,
                 {sql_money("round(cast(cast(value as varchar) as decimal(38,20)), 2)")} AS sum_time,
                 count(*) AS total_events
          FROM events GROUP BY user_id, cast(ts as date))
    """,
)
def d1_events(t):
    events = t.events.select(
        "user_id",
        F.to_date("ts").alias("day"),
        F.round("value", 2).cast("decimal(18,2)").alias("value"),
        F.lit(1).alias("events"),
    )
    totals = aggregate_metrics(events, ["user_id", "day"], ["events"], "value")
    return add_rates(totals, ["events"])


@probe("c2_star_enrichment", LINE_FACT_SQL)
def c2(t):
    return line_fact(t)


@probe("c2_bucketed_star", LINE_FACT_SQL)
def c2_bucketed(t):
    """The same star over lines and orders that are stored in equal buckets of the order key."""
    space = "buckets_" + scratch(t.spark, "ns")[-8:]
    C.create_namespace(t.spark, space, scratch(t.spark, "namespace"))
    buckets = C.buckets_for(t.lineitem)
    C.write_buckets(t.lineitem, f"{space}.lineitem", ["l_orderkey"], buckets)
    C.write_buckets(t.orders, f"{space}.orders", ["o_orderkey"], buckets)
    stored = C.load_namespace(t.spark, space)
    return line_fact(SimpleNamespace(**stored, supplier=t.supplier, customer=t.customer, nation=t.nation))


@probe(
    "b7_cast_by_map",
    """
    SELECT l_orderkey, l_linenumber, cast(trunc(l_quantity) as integer) AS l_quantity,
           cast(l_extendedprice as float) AS l_extendedprice, cast(l_tax as float) AS l_tax, l_returnflag
    FROM lineitem
    """,
)
def b7(t):
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax", "l_returnflag"
    )
    return cast_columns(lines, {"l_quantity": "int", "l_extendedprice": "float", "l_tax": "float"})


@probe(
    "d1_rate_fact_with_casts",
    f"""
    SELECT l_suppkey, l_orderkey, cast(total_l_linenumber as integer) AS total_l_linenumber,
           cast({sql_round("cast(total_l_linenumber as double) / nullif(raw_time, 0) * 60")} as float) AS l_linenumber_per_60,
           {sql_round("raw_time")} AS total_minutes
    FROM ({LINE_TOTALS_SQL})
    """,
)
def d1_cast(t):
    return rate_fact(
        t.lineitem, LINE_GRAIN, ["l_linenumber"], "l_quantity", "total_minutes",
        cast={"total_l_linenumber": "int", "l_linenumber_per_60": "float"},
    )
