from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakesift.functions import columns as C


def test_audit_and_reject_columns(frame):
    df = frame([(1,)], "a int")
    audited = C.with_audit(df, "p", "r")
    assert audited.columns == ["a", "load_timestamp", "pipeline_id", "run_id"]
    rejected = C.with_reject_meta(df, "p", "r")
    assert rejected.columns == ["a", "rejected_at", "pipeline_id", "run_id"]
    assert audited.where("load_timestamp is not null").count() == 1


def test_label(frame):
    df = C.label(frame([(1,)], "a int"), issue_type="x", join_key="k")
    assert rows(df) == [(1, "x", "k")]


def test_row_ids_are_unique(spark):
    df = C.with_row_id(spark.range(0, 1000, 1, 7))
    assert df.select("index").distinct().count() == 1000
    stable = C.with_row_id(spark.range(100), stable=["id"])
    again = C.with_row_id(spark.range(100).repartition(5), stable=["id"])
    assert rows(stable) == rows(again)


def test_cast_columns_keeps_nulls_order_and_bad_text(frame):
    df = frame([("1", 2.7, None), ("x", None, "y")], "a string, b double, c string")
    out = C.cast_columns(df, {"a": "int", "b": "int"})
    assert out.dtypes == [("a", "int"), ("b", "int"), ("c", "string")]
    assert rows(out) == [(None, None, "y"), (1, 2, None)]


def test_clean_numeric(frame):
    df = frame([("NA",), ("1.5",), ("",), (None,), ("abc",)], "a string")
    assert rows(df.select(C.clean_numeric("a"))) == [(None,)] * 4 + [(1.5,)]


@pytest.mark.parametrize("to", ["int", "bigint", "double", "float", "decimal(10,2)"])
def test_parse_number_equals_try_cast(frame, to):
    texts = ["1", " 7 ", "+3", "-4", "1.5", ".5", "5.", "1e3", "x1", "1x", "", " ", "NA", "NaN", "inf",
             "-Infinity", "1d", "0x1", "99999999999999999999", "\t8\n", "--1", None]
    df = frame([(t,) for t in texts], "a string")
    got = df.select(C.parse_number("a", to).cast("string").alias("p"), F.col("a").try_cast(to).cast("string").alias("t"))
    assert [r["p"] for r in got.collect()] == [r["t"] for r in got.collect()]


def test_to_ts(frame):
    df = frame([("2020-01-02 03:04:05",), ("junk",), (None,)], "a string")
    assert rows(df.select(C.to_ts("a"))) == [(None,), (None,), (datetime(2020, 1, 2, 3, 4, 5),)]


def test_to_ts_equals_try_cast(frame):
    texts = ["2020-01-02", "2020-1-2 3:4:5.678", " 2020-01-02T03:04:05 ", "2020", "2020-13-01", "NA", "",
             "+2020-01-01", "-0001-01-01", "20200102", "12/31/2020", "2020-01-02 03:04:05Z", "today", None]
    df = frame([(t,) for t in texts], "a string")
    both = df.select(C.to_ts("a").cast("string").alias("p"), F.col("a").try_cast("timestamp_ntz").cast("string").alias("t"))
    assert [r["p"] for r in both.collect()] == [r["t"] for r in both.collect()]


def test_to_ts_with_a_format(frame):
    df = frame([("31.12.2020 23:59",), ("2020",)], "a string")
    assert rows(df.select(C.to_ts("a", "dd.MM.yyyy HH:mm"))) == [(None,), (datetime(2020, 12, 31, 23, 59),)]


def test_composite_key_shows_nulls(frame):
    df = frame([("a", None), ("a", "b"), (None, "a")], "x string, y string")
    keys = [r[0] for r in df.select(C.composite_key(["x", "y"])).collect()]
    assert keys == ["a_\\N", "a_b", "\\N_a"]


def test_full_name(frame):
    df = frame([("a", "b"), (None, "b"), ("a", None)], "x string, y string")
    assert [r[0] for r in df.select(C.full_name("x", "y")).collect()] == ["a b", " b", "a "]


def test_table_name_strips_only_the_last_extension(frame):
    df = frame([("game.csv",), ("a.b.csv",), ("plain",)], "f string")
    assert [r[0] for r in df.select(C.table_name("f")).collect()] == ["game", "a.b", "plain"]


def test_venue(frame):
    df = frame([(1, 1), (1, 2), (None, 1)], "t int, h int")
    assert [r[0] for r in df.select(C.venue("t", "h")).collect()] == ["Home", "Away", "Away"]


def test_rate_and_ratio(frame):
    df = frame([(5, 20.0), (5, 0.0), (None, 20.0)], "n int, t double")
    assert [r[0] for r in df.select(C.rate("n", "t", 60, 2)).collect()] == [15.0, None, None]
    assert [r[0] for r in df.select(C.safe_ratio("n", "t")).collect()] == [0.25, None, None]


def test_rounding_is_half_up(frame):
    df = frame([(1.005,), (2.675,), (-0.125,)], "v double")
    assert [r[0] for r in df.select(F.round("v", 2)).collect()] == [1.01, 2.68, -0.13]


def test_season_start(frame):
    df = frame([("19951996",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(C.season_start("s")).collect()] == [1995, None, None]


def test_null_reason_takes_the_first_rule(frame):
    df = frame([(1, "a"), (None, "a"), (None, "b"), (None, "c")], "v int, k string")
    rules = {"is a": F.col("k") == "a", "not c": F.col("k") != "c"}
    got = [r[0] for r in df.select(C.null_reason("v", rules)).collect()]
    assert got == [None, "is a", "not c", "unexplained"]


def test_current_values(frame):
    df = frame([("a", 1), ("a", 1), ("b", 1), ("b", 2), ("c", 1), ("c", None)], "k string, s int")
    out = df.groupBy("k").agg(C.current_values("s").alias("s"))
    assert rows(out) == [("a", 1), ("b", None), ("c", None)]


def test_as_role(frame):
    df = C.as_role(frame([(1, "x")], "id int, name string"), "home", "id", {"name": "label"})
    assert df.columns == ["home_id", "home_label"]
