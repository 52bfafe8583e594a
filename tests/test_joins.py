from __future__ import annotations

import pytest
from conftest import plan, rows

from lakesift.operators.dedupe import duplicate_rows, flag_dupes
from lakesift.operators.joins import Lookup, enrich, in_set, join_dimension, matched, orphans


def test_orphans_and_matches(frame):
    fact = frame([("a", 10), ("b", 20), ("c", None)], "v string, k int")
    dim = frame([(10,), (10,)], "k int")
    assert rows(orphans(fact, dim, "k")) == [("b", 20), ("c", None)]
    assert matched(fact, dim, "k").columns == ["v", "k"]
    assert rows(matched(fact, dim, "k")) == [("a", 10)]


def test_keys_of_different_types(frame):
    numbers = frame([(10,), (11,)], "k int")
    texts = frame([("10",), ("abc",)], "k string")
    assert rows(matched(numbers, texts, "k")) == [(10,)]
    assert rows(matched(texts, numbers, "k")) == [("10",)]
    assert rows(orphans(texts, numbers, "k")) == [("abc",)]


def test_in_set(frame):
    df = frame([(1,), (2,), (None,)], "a int")
    ids = frame([(2,), (2,)], "b int")
    assert rows(in_set(df, "a", ids, "b")) == [(2,)]
    assert rows(in_set(df, "a", ids, "b", negate=True)) == [(None,), (1,)]


def test_star_has_two_roles_and_keys_first(frame):
    fact = frame([(1, 7, 8), (2, 8, 9)], "id int, away int, home int")
    team = frame([(7, "seven"), (8, "eight")], "team int, name string")
    wide = enrich(
        fact,
        [Lookup(team, "away", "team", {"name": "away_name"}), Lookup(team, "home", "team", {"name": "home_name"})],
    )
    assert wide.columns == ["home", "away", "id", "away_name", "home_name"]
    assert rows(wide, "id", "away_name", "home_name") == [(1, "seven", "eight"), (2, "eight", None)]


def test_text_dimension_key_keeps_the_fact_type(frame):
    fact = frame([(1,), (2,)], "g int")
    game = frame([("1", "x"), ("bad", "y")], "g string, v string")
    out = join_dimension(fact, Lookup(game, "g", "g", {"v": "v"}))
    assert out.dtypes == [("g", "int"), ("v", "string")]
    assert rows(out) == [(1, "x")]


@pytest.fixture
def shuffled(conf):
    """Joins shuffle, and a partition of some kilobytes already counts as skewed."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20000b")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000b")


@pytest.fixture
def hot(spark):
    """A third of all rows has key 1."""
    return spark.range(0, 60000, 1, 8).selectExpr("IF(id % 3 = 0, 1, id) AS k", "id AS v")


def test_hot_key_of_a_star_join_is_split(spark, shuffled, hot):
    dim = spark.range(0, 60000).selectExpr("id AS k", "id * 2 AS w")
    joined = join_dimension(hot, Lookup(dim, "k", "k", {"w": "w"}), "left")
    assert "skew=true" in plan(joined)
    assert joined.count() == 60000


def test_hot_key_of_a_membership_join_is_split(spark, shuffled, hot):
    dim = spark.range(0, 30000).selectExpr("id % 15000 AS k")
    kept, lost = matched(hot, dim, "k"), orphans(hot, dim, "k")
    assert "skew=true" in plan(kept)
    assert "skew=true" in plan(orphans(hot, dim.where("k <> 1"), "k"))
    want = 20000 + sum(1 for i in range(15000) if i % 3)
    assert (kept.count(), lost.count()) == (want, 60000 - want)


def test_hot_key_of_a_duplicate_search_is_split(spark, shuffled, hot):
    twice = hot.unionByName(hot)
    found = duplicate_rows(twice, ["k"])
    assert "skew=true" in plan(found)
    assert found.count() == 120000
    assert flag_dupes(hot, ["k"]).where("k = 1 AND key_count = 20001").count() == 20001
