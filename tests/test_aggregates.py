"""Measures answered from stored sums."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from conftest import plan, rows

from lakesift.operators import measures as M
from lakesift.session import scratch
from lakesift.sources.aggregates import NotStored, StoredSums

SCHEMA = "player int, season int, venue string, goals decimal(12,2), minutes decimal(12,2)"


def _facts(rnd, n):
    return [(rnd.randrange(30), rnd.randrange(2000, 2005), rnd.choice(["Home", "Away", None]), Decimal(rnd.randrange(9)), Decimal(rnd.randrange(60))) for _ in range(n)]


@pytest.fixture
def stored(spark, frame):
    rnd = random.Random(1)
    first, later = _facts(rnd, 400), _facts(rnd, 300)
    sums = StoredSums(spark, scratch(spark, "sums"))
    sums.store(frame(first, SCHEMA), ["goals", "minutes"], [["player", "season", "venue"], ["season"], ["player", "season"]])
    sums.add(frame(later, SCHEMA))
    return sums, frame(first + later, SCHEMA)


@pytest.mark.parametrize(
    "by, filters, grain",
    [
        (["season"], {}, {"season"}), ([], {}, {"season"}), (["player"], {"season": 2001}, {"player", "season"}),
        (["season"], {"venue": "Home"}, {"player", "season", "venue"}), (["venue"], {"season": [2001, 2003]}, {"player", "season", "venue"}),
    ],
)
def test_answers_equal_those_of_the_fact_and_read_the_smallest_grain(stored, by, filters, grain):
    sums, fact = stored
    picked = M.slice_by(fact, filters)
    assert rows(sums.sums(by, {"g": "goals"}, filters)) == rows(M.measure_sum(picked, by, {"g": "goals"}))
    got = sums.rates(by, {"g60": "goals"}, "minutes", filters=filters)
    assert rows(got) == rows(M.measure_rate(picked, by, {"g60": "goals"}, "minutes"))
    assert rows(sums.ratio(by, "goals", "minutes", filters=filters)) == rows(M.measure_ratio(picked, by, "goals", "minutes"))
    path = next(g.path for g in sums.grains() if g.columns == grain)
    assert got.inputFiles() and all(path in f for f in got.inputFiles())
    assert "Join" not in plan(got)


def test_what_is_not_stored_is_refused(stored):
    sums, _ = stored
    with pytest.raises(NotStored):
        sums.rows_for(["player", "rink"])
    with pytest.raises(NotStored):
        sums.sums(["season"], {"s": "shots"})


def test_stored_grains_are_small_and_replaced_as_a_whole(stored, frame):
    sums, fact = stored
    sizes = {g.columns: g.n_rows for g in sums.grains()}
    assert sizes[frozenset(["season"])] == 5 and sizes[frozenset(["player", "season"])] == fact.select("player", "season").distinct().count()
    sums.store(frame([], SCHEMA), ["goals"], [["season"]])
    assert [g.n_rows for g in sums.grains()] == [0] and sums.measures() == ["goals"]
