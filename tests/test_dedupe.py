from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from conftest import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakesift.operators import dedupe as U
from lakesift.operators.ordering import first_rows, has_rows, number_rows, running_total, top_k

SCHEMA = "k int, v int, w string"
ROWS = [(1, 5, "a"), (1, 9, "b"), (1, None, "c"), (2, 1, "d"), (None, 1, "e"), (None, 2, "f"), (3, 3, "g")]


def test_duplicate_keys_counts_nulls_as_one_group(frame):
    assert rows(U.duplicate_keys(frame(ROWS, SCHEMA), ["k"])) == [(None, 2), (1, 3)]


def test_flag_dupes(frame):
    got = {r["w"]: r["key_count"] for r in U.flag_dupes(frame(ROWS, SCHEMA), ["k"]).collect()}
    assert got == {"a": 3, "b": 3, "c": 3, "d": 1, "e": 2, "f": 2, "g": 1}


def test_duplicate_and_unique_rows_cover_the_table(frame):
    df = frame(ROWS, SCHEMA)
    dups = U.repeated_keys(df, ["k"])
    both = U.duplicate_rows(df, ["k"], dups).unionByName(U.unique_rows(df, ["k"], dups))
    assert rows(both) == rows(df)


def test_keep_best_prefers_complete_and_latest(frame):
    best = U.keep_best(frame(ROWS, SCHEMA), ["k"], U.latest_complete("v"))
    assert rows(best, "w") == [("b",), ("d",), ("f",), ("g",)]


def test_keep_best_limits_before_the_shuffle(frame):
    text = plan(U.keep_best(frame(ROWS, SCHEMA), ["k"], U.latest_complete("v")))
    below = text[text.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below


def test_dedupe_is_idempotent(frame):
    df = frame(ROWS + ROWS[:3], SCHEMA)
    once = U.dedupe(df)
    assert rows(once) == rows(U.dedupe(once)) == rows(frame(ROWS, SCHEMA))
    by_key = U.dedupe(df, ["k"], U.latest_complete("v"))
    assert rows(by_key) == rows(U.dedupe(by_key, ["k"], U.latest_complete("v")))


@pytest.mark.parametrize("spread", [True, False])
def test_surplus_and_survivors_cover_the_table(frame, spread):
    df = frame(ROWS + ROWS[:1], SCHEMA)
    order = U.latest_complete("v")
    both = U.keep_best(df, ["k"], order).unionByName(U.surplus_rows(df, ["k"], order, spread))
    assert rows(both) == rows(df)


@pytest.mark.parametrize("per_task", [1, 3, 100])
def test_number_copies(frame, per_task):
    df = frame([(1, "a")] * 7 + [(2, "b")] + [(None, "c")] * 2, "k int, v string")
    got = rows(U.number_copies(df, copies_per_task=per_task))
    want = [(1, "a", i) for i in range(1, 8)] + [(2, "b", 1), (None, "c", 1), (None, "c", 2)]
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_disambiguate(frame, conf, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    keys = U.disambiguate(frame(ROWS, SCHEMA), ["k"], [F.col("v").desc_nulls_last()])
    got = {r["w"]: r["row_key"] for r in keys.collect()}
    assert got == {"b": "1_1", "a": "1_2", "c": "1_3", "d": "2_1", "f": "\\N_1", "e": "\\N_2", "g": "3_1"}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 4), st.integers(1, 3)), min_size=1, max_size=60))
def test_running_total_is_the_same_on_both_paths(frame, data):
    """The range-partitioned form against brute force, with many ties and hot keys."""
    df = frame(data, "k int, v int, n int")
    order = [F.col("v").desc(), F.col("n").asc()]
    got = running_total(df, ["k"], order, "n", "t", spread=True)
    groups, want = defaultdict(int), []
    for k, v, n in sorted(data, key=lambda r: (r[0], -r[1], r[2])):
        groups[k] += n
        want.append((k, v, n, groups[k]))
    assert rows(got) == sorted(want)
    plain = running_total(df, ["k"], order, "n", "t")
    assert rows(plain) == sorted(want)


@pytest.mark.parametrize("kind", ["int", "double", "decimal(10,2)"])
def test_nullable_weights_give_the_same_rows_and_types(frame, kind):
    """Null until the first weight that is there; equal types whatever the plan."""
    weights = [None, 1, 1, 1, None, 2, None, None, 3] * 30
    df = frame([(1 if i % 5 else 2, i, w) for i, w in enumerate(weights)], "k int, v int, n int")
    df = df.withColumn("n", F.col("n").cast(kind)).repartition(5)
    order = [F.col("v").asc()]
    plain, spread = (running_total(df, ["k"], order, "n", "t", spread=s) for s in (False, True))
    assert plain.dtypes == spread.dtypes
    assert rows(plain) == rows(spread)
    so_far = {1: None, 2: None}
    for i, w in enumerate(weights):
        k = 1 if i % 5 else 2
        so_far[k] = so_far[k] if w is None else (so_far[k] or 0) + w
    last = {r["k"]: r["t"] for r in spread.orderBy("v").collect()}
    assert {k: float(t) for k, t in last.items()} == so_far


def test_number_rows_of_a_hot_key(spark):
    df = spark.range(0, 30000, 1, 6).selectExpr("IF(id % 3 = 0, -1, id) AS k", "30000 - id AS v")
    got = number_rows(df, ["k"], [F.col("v").asc()], "n", spread=True)
    hot = sorted((r["v"], r["n"]) for r in got.where("k = -1").collect())
    assert [n for _, n in hot] == list(range(1, 10001))
    assert got.where("k <> -1 AND n <> 1").isEmpty()
    assert got.count() == 30000


def test_number_all_rows_without_keys(spark):
    df = spark.range(0, 5000, 1, 5).selectExpr("id % 7 AS a", "id AS b")
    got = number_rows(df, [], [F.col("a").asc(), F.col("b").asc()], "n", spread=True)
    assert [r["n"] for r in got.orderBy("a", "b").collect()] == list(range(1, 5001))


def test_hot_equal_rows_are_spread(spark):
    """A third of the rows are copies of one row; their numbers are still 1 to n."""
    df = spark.range(0, 9000, 1, 6).selectExpr("IF(id % 3 = 0, -1, id) AS k", "0 AS v")
    got = number_rows(df, ["k"], [F.col("v").asc()], "n", spread=True)
    assert sorted(r["n"] for r in got.where("k = -1").collect()) == list(range(1, 3001))


def test_ties_are_settled_alike_on_both_paths(spark):
    df = spark.range(0, 3000, 1, 3).selectExpr("id % 2 AS k", "id % 3 AS v", "id AS w")
    order = [F.col("v").asc()]
    assert rows(number_rows(df, ["k"], order, "n", True)) == rows(number_rows(df, ["k"], order, "n"))
    first = number_rows(df, ["k"], order, "n", True).where("n = 1").drop("n")
    assert rows(first) == rows(U.keep_best(df, ["k"], order))


def test_offsets_of_the_distributed_numbering_are_broadcast(spark):
    df = spark.range(0, 5000, 1, 5).selectExpr("id % 2 AS k", "id AS b")
    assert "BroadcastHashJoin" in plan(number_rows(df, ["k"], [F.col("b").asc()], spread=True))


def test_top_k_and_first_rows(frame):
    df = frame([(k, i) for k, n in ((1, 3), (2, 1), (3, 3)) for i in range(n)], "k int, i int")
    assert [tuple(r) for r in top_k(df, "k", 2).collect()] == [(1, 3), (3, 3)]
    assert [tuple(r) for r in top_k(df, "k", 1, ascending=True).collect()] == [(2, 1)]
    assert "TakeOrderedAndProject" in plan(first_rows(df, [F.col("i").desc()], 2))
    assert has_rows(df) and not has_rows(df.where("k > 9"))


def test_key_set_comparison(frame):
    a, b = frame([(1,), (2,), (2,), (None,)], "k int"), frame([(2,), (1,), (None,)], "k int")
    assert U.same_keys(a, b, "k").first().asDict() == {
        "keys_a": 3, "keys_b": 3, "only_a": 0, "only_b": 0, "same": True,
    }
    c = frame([(1,), (5,)], "k int")
    got = U.overlap(c, b, "k").first().asDict()
    assert got == {"shared": 1, "only_a": 1, "only_b": 2, "is_subset": False, "overlaps": True}
    assert Counter(U.overlap(b, a, "k").first().asDict())["is_subset"]


def test_a_hot_key_is_spread_unless_asked_otherwise(spark, conf):
    """No task numbers a whole group that holds a third of the rows."""
    conf("spark.sql.adaptive.enabled", "false")
    df = spark.range(0, 30000, 1, 6).selectExpr("IF(id % 3 = 0, -1, id DIV 2) AS k", "id AS v")
    order = [F.col("v").asc()]
    for made in (number_rows(df, ["k"], order), U.surplus_rows(df, ["k"], order), U.disambiguate(df, ["k"], order)):
        parts = made.where("k = -1").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in parts) >= 9999
        assert max(r["count"] for r in parts) < 9000
    assert rows(U.surplus_rows(df, ["k"], order)) == rows(U.surplus_rows(df, ["k"], order, False))
    assert rows(U.disambiguate(df, ["k"], order)) == rows(U.disambiguate(df, ["k"], order, spread=False))
