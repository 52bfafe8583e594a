from __future__ import annotations

from datetime import datetime

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from lakesift.operators import checks as K
from lakesift.operators import expectations as X

KEYED = [(None, 1), (None, 2), (1, 3), (1, 4), (2, 5)]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_primary_key(frame, conf, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    split = K.check_primary_key(frame(KEYED, "k int, v int"), ["k"], [F.col("v").desc()])
    assert rows(split.rejects) == [(None, 1, "pkey_dupe"), (None, 2, "pkey_dupe"), (1, 3, "pkey_dupe"), (1, 4, "pkey_dupe")]
    assert rows(split.clean) == [(None, 2), (1, 4), (2, 5)]
    assert tuple(split.metrics.first()) == (2, 4)
    again = K.check_primary_key(split.clean, ["k"])
    assert again.rejects.isEmpty() and rows(again.clean) == rows(split.clean)
    assert tuple(again.metrics.first()) == (0, 0)


def test_unique_rows_of_a_key_check_are_not_shuffled(spark):
    """Few repeated keys: only they are sorted, all other rows pass a broadcast join."""
    df = spark.range(20000).selectExpr("IF(id < 3, 0, id) AS k", "id AS v")
    split = K.check_primary_key(df, ["k"])
    text = plan(split.clean)
    assert text.count("BroadcastHashJoin") == 2
    assert text.count("Exchange hashpartitioning") == 1


FACT = [("a", 10, 1), ("b", 20, 1), ("c", None, 1), ("d", 20, 9), ("e", 10, 9)]


@pytest.mark.parametrize("threshold", ["10485760", "-1", "2000"])
def test_references_report_the_first_failure(frame, conf, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    fact = frame(FACT, "id string, g int, p int")
    refs = [
        K.Reference("game", frame([(10,), (10,), (None,)], "g int"), "g"),
        K.Reference("player", frame([(1,)], "pid int"), "p", "pid"),
    ]
    split = K.check_references(fact, refs)
    assert rows(split.clean) == [("a", 10, 1)]
    assert rows(split.rejects, "id", "issue_type", "failed_dimension", "join_key") == [
        ("b", "ri_orphan", "game", "g"), ("c", "ri_orphan", "game", "g"),
        ("d", "ri_orphan", "game", "g"), ("e", "ri_orphan", "player", "p"),
    ]
    assert split.clean.count() + split.rejects.count() == fact.count()


def test_wide_rows_are_not_shuffled_for_a_large_dimension(spark, frame):
    """The dimension is over the threshold, its orphans are not."""
    from lakesift.session import fits_broadcast

    dim = spark.range(3_000_000).selectExpr("id AS k")
    assert not fits_broadcast(dim)
    fact = spark.range(1010).selectExpr("id * 3001 AS k", "id AS v")
    flagged = K.flag_rows(fact, [K.Reference("d", dim, "k")])
    text = plan(flagged)
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
    assert flagged.where("issue_type IS NULL").count() == 1000


def test_keys_of_text_and_number_types(frame, conf):
    texts = frame([("10",), ("abc",), (None,)], "g string")
    numbers = frame([(10,)], "g int")
    for threshold in ("10485760", "-1"):
        conf("spark.sql.autoBroadcastJoinThreshold", threshold)
        assert rows(K.check_references(texts, [K.Reference("n", numbers, "g")]).clean) == [("10",)]
        assert rows(K.check_references(numbers, [K.Reference("t", texts, "g")]).clean) == [(10,)]


def test_signs(frame):
    nan = float("nan")
    df = frame([(1.0, 1), (-1.0, -1), (None, -2), (nan, 0)], "a double, b int")
    split = K.check_non_negative(df, ["a", "b"])
    assert rows(split.rejects) == [
        (None, -2, "negative_value", "b", "must_be_non_negative"),
        (-1.0, -1, "negative_value", "a", "must_be_non_negative"),
    ]
    assert split.clean.count() == 2
    assert K.check_non_negative(split.clean, ["a", "b"]).rejects.isEmpty()


def test_reference_failures_come_before_signs(frame):
    df = frame([(1, -5), (2, -5), (1, 5)], "k int, v int")
    flagged = K.flag_rows(df, [K.Reference("d", frame([(1,)], "k int"), "k")], ["v"])
    assert rows(flagged, "k", "v", "issue_type") == [
        (1, -5, "negative_value"), (1, 5, None), (2, -5, "ri_orphan"),
    ]
    counts = {r["issue_type"]: r["n_rows"] for r in K.reject_counts(flagged).collect()}
    assert counts == {None: 1, "negative_value": 1, "ri_orphan": 1}


def test_assertions(frame):
    df = frame([(1, None), (2, "x")], "k int, v string")
    K.assert_unique(df, ["k"])
    K.assert_not_null(df, ["k"])
    with pytest.raises(K.CheckFailed):
        K.assert_not_null(df, ["k", "v"])
    with pytest.raises(K.CheckFailed):
        K.assert_unique(df.unionByName(df), ["k"])


def test_required_when(frame):
    df = frame([("penalty", None), ("penalty", "x"), ("shot", None), (None, None)], "e string, s string")
    assert tuple(K.check_required_when(df, F.col("e") == "penalty", "s").first()) == (2, 1, False)


def test_reconcile(frame):
    detail = frame([(1, 2), (1, 3), (2, 1), (4, 1)], "k int, v int")
    summary = frame([(1, 5), (2, 2), (3, 1)], "k int, s int")
    got = {r["k"]: r["matches"] for r in K.reconcile(detail, summary, "k", "v", "s").collect()}
    assert got == {1: True, 2: False, 3: False, 4: False}


def test_classify():
    got = K.classify(["game", "plays", "odd"], ["game", "team"], ["plays"])
    assert got == {"dimension": ["game"], "fact": ["plays"], "uncategorised": ["odd"]}


# -- suites ------------------------------------------------------------------


def test_suite_statuses(frame):
    df = frame([(1.0, "a", None), (-1.0, "z", "x"), (None, None, "x")], "v double, c string, n string")
    suite = [
        X.Between("v", low=0), X.Between("v", -5, 5), X.InSet("c", ("a", "b")), X.NotNull("n"),
        X.NullShare("n", 0.1, 0.5), X.NullShare("n", 0.4, 0.5), X.NullShare("n", 0.0, 0.2), X.ColumnCount(3),
    ]
    report = X.run_suite(df, suite)
    assert [r["status"] for r in report.collect()] == ["fail", "pass", "fail", "fail", "warn", "pass", "fail", "pass"]
    assert [r["measured"] for r in report.collect()][:4] == [1.0, 0.0, 1.0, 1.0]
    assert [r["missing"] for r in report.collect()] == [1, 1, 1, 1, 1, 1, 1, None]
    assert tuple(X.suite_summary(report).first()) == (8, 4, 4, 50.0, False)
    assert X.failures(report).count() == 4
    assert not X.gate(report)
    assert X.gate(X.run_suite(df, suite[1:2]))
    assert not X.gate(X.run_suite(df, suite[1:2]), report)


def test_suite_is_one_aggregate(frame):
    df = frame([(1, 2)], "a int, b int")
    text = plan(X.run_suite(df, X.non_negative_suite(["a", "b"], 2)))
    assert text.count("Exchange") == 1


def test_datetime_range(frame):
    df = frame([(datetime(1995, 1, 1),), (datetime(2005, 1, 1),)], "t timestamp_ntz")
    low, high = [F.lit(x).cast("timestamp_ntz") for x in ("1990-01-01", "2000-01-01")]
    assert X.run_suite(df, [X.Between("t", low, high)]).first()["measured"] == 1.0


def test_whitelist_table(frame):
    df = frame([("a",), ("z",), (None,)], "c string")
    assert tuple(X.expect_in_table(df, "c", frame([("a",)], "v string"), "v").first()) == (1, False)
