from __future__ import annotations

import pytest
from conftest import rows

from lakesift.operators.facts import add_rates, aggregate_metrics, finish_time, rate_fact
from lakesift.operators import measures as M

STATS = [(1, 1200, 5, None), (1, 0, 1, None), (2, 0, 5, 2), (3, 1200, None, 7)]
SCHEMA = "player int, toi int, goals int, hits int"


def test_sums_rates_and_time(frame):
    wide = aggregate_metrics(frame(STATS, SCHEMA), ["player"], ["goals", "hits"], "toi")
    out = finish_time(add_rates(wide, ["goals", "hits"]), "minutes")
    assert rows(out, "player", "total_goals", "total_hits", "goals_per_60", "hits_per_60", "minutes") == [
        (1, 6, None, 18.0, None, 20.0),
        (2, 5, 2, None, None, 0.0),
        (3, None, 7, None, 21.0, 20.0),
    ]
    assert dict(out.dtypes)["total_goals"] == "bigint"


def test_rate_uses_unrounded_time(frame):
    df = frame([(1, 100, 7)], "player int, toi int, goals int")
    out = rate_fact(df, ["player"], ["goals"], "toi", "minutes").first()
    assert out["minutes"] == 1.67
    assert out["goals_per_60"] == 252.0


def test_rate_fact_casts(frame):
    out = rate_fact(
        frame(STATS, SCHEMA), ["player"], ["hits"], "toi", "minutes",
        cast={"total_hits": "int", "hits_per_60": "float"},
    )
    assert out.dtypes[1:3] == [("total_hits", "int"), ("hits_per_60", "float")]


SEASONS = [("a", 1995, 10.0), ("a", 1996, 15.0), ("a", 1998, 30.0), ("b", 1995, 0.0), ("b", 1996, 5.0),
           ("c", 1996, 4.0), ("c", 1997, None)]


@pytest.fixture
def seasons(frame):
    return frame(SEASONS, "k string, s int, v double")


def test_difference_needs_the_season_before(seasons):
    got = {(r["k"], r["s"]): r["change"] for r in M.yoy_diff(seasons, ["k"], "s", "v").collect()}
    assert got == {
        ("a", 1995): None, ("a", 1996): 5.0, ("a", 1998): None,
        ("b", 1995): None, ("b", 1996): 5.0, ("c", 1996): None, ("c", 1997): -4.0,
    }


def test_percent_is_zero_on_a_zero_base(seasons):
    got = {(r["k"], r["s"]): r["pct_change"] for r in M.yoy_pct(seasons, ["k"], "s", "v").collect()}
    assert got[("a", 1996)] == 50.0
    assert got[("a", 1998)] is None
    assert got[("b", 1996)] == 0.0
    assert got[("c", 1997)] == -100.0


def test_difference_of_everything(seasons):
    got = {r["s"]: r["change"] for r in M.yoy_diff(seasons, [], "s", "v").collect()}
    # 1997 holds no value at all, so 1998 has nothing to be compared with.
    assert got == {1995: None, 1996: 14.0, 1997: -24.0, 1998: None}


def test_span(seasons):
    got = {r["k"]: r["pct_change"] for r in M.span_pct(seasons, ["k"], "s", "v").collect()}
    assert got == {"a": 200.0, "b": 0.0, "c": -100.0}
    single = seasons.where("k = 'a' AND s = 1995")
    assert M.span_pct(single, ["k"], "s", "v").first()["pct_change"] == 0.0


def test_most_improved(seasons):
    assert [r["k"] for r in M.most_improved(seasons, "k", "s", "v", 2).collect()] == ["a", "b"]


def test_next_season(frame):
    df = frame([("a", 1995), ("a", 1995), ("b", 1995), ("b", 1996)], "k string, s int")
    assert rows(M.next_season(df, ["k"], "s")) == [("a", 1996), ("b", None)]


def test_ratio_of_sums_is_not_the_mean_of_ratios(frame):
    df = frame([("a", 1, 10.0), ("a", 9, 20.0), ("b", 1, 0.0)], "k string, n int, t double")
    assert rows(M.measure_rate(df, ["k"], {"r": "n"}, "t")) == [("a", 20.0), ("b", None)]
    assert rows(M.measure_ratio(df, ["k"], "n", "t")) == [("a", 10 / 30), ("b", None)]
    assert rows(M.measure_sum(df, ["k"], {"n": "n"})) == [("a", 10), ("b", 1)]


def test_slice(frame):
    df = frame([("a", 1), ("b", 2), ("c", 2)], "k string, s int")
    assert rows(M.slice_by(df, {"k": ["a", "b"], "s": 2})) == [("b", 2)]
