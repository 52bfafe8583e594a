from __future__ import annotations

import random
import statistics

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from lakesift.operators import profile as P
from lakesift.operators import sketches as S

DATA = [(1, "a", None), (2, "a", 1.0), (3, None, None), (3, None, None)]
SCHEMA = "k int, c string, v double"


def test_null_profiles(frame):
    df = frame(DATA, SCHEMA)
    assert rows(P.null_counts(df)) == [(0, 2, 3)]
    assert rows(P.null_pct(df)) == [(0.0, 50.0, 75.0)]
    assert rows(P.total_nulls(df)) == [(5,)]
    assert rows(P.null_pct(df.where("k > 9"))) == [(None, None, None)]


def test_duplicates_and_distinct(frame):
    df = frame(DATA, SCHEMA)
    assert rows(P.duplicate_profile(df)) == [(4, 3, 1)]
    assert rows(P.duplicate_profile(df.where("k > 9"))) == [(0, 0, 0)]
    assert rows(P.distinct_counts(df)) == [(3, 1, 1)]
    assert rows(P.distinct_counts(df, approximate=True)) == [(3, 1, 1)]
    assert rows(P.distinct_values(df, "c")) == [(None,), ("a",)]
    assert rows(P.values_by_category(df, "c", "k")) == [(None, 3, 2), ("a", 1, 1), ("a", 2, 1)]


def test_column_profile(frame):
    got = rows(P.column_profile(frame(DATA, SCHEMA)))
    assert got == [("c", "string", 4, 2), ("k", "int", 4, 4), ("v", "double", 4, 1)]


def test_frequency(frame):
    df = frame(DATA, SCHEMA)
    assert [tuple(r) for r in P.frequency(df, "k").collect()] == [(3, 2), (1, 1), (2, 1)]
    assert [tuple(r) for r in P.frequency(df, "k", 1).collect()] == [(3, 2)]


def test_range_by_flag(frame):
    df = frame(DATA, SCHEMA)
    got = rows(P.min_max(df, "k", F.col("v").isNull().alias("missing")))
    assert got == [(False, 2, 2), (True, 1, 3)]


def test_summary(frame):
    r = P.summary(frame([(1.0,), (2.0,), (4.0,), (None,)], "v double"), ["v"]).first()
    assert (r["count"], r["min"], r["max"]) == (3, 1.0, 4.0)
    assert r["mean"] == pytest.approx(7 / 3)
    assert r["stddev"] == pytest.approx(statistics.stdev([1, 2, 4]))


def test_quantiles_against_brute_force(frame):
    rng = random.Random(3)
    values = [float(rng.choice([1, 1, 1, rng.randint(0, 50)])) for _ in range(101)]
    got = P.quantiles(frame([(v,) for v in values], "v double"), "v", [0.0, 0.25, 0.5, 0.9, 1.0])
    ordered = sorted(values)

    def at(p):
        x = (len(ordered) - 1) * p
        lo = int(x)
        hi = min(lo + 1, len(ordered) - 1)
        return ordered[lo] + (ordered[hi] - ordered[lo]) * (x - lo)

    for r in got.collect():
        assert r["value"] == pytest.approx(at(r["point"]))


def test_histogram(frame):
    df = frame([(float(v),) for v in [0, 0, 1, 5, 9, 10]] + [(None,)], "v double")
    got = P.histogram(df, "v", 5).orderBy("bin").collect()
    assert [r["n_rows"] for r in got] == [3, 0, 1, 0, 2]
    assert (got[0]["lower"], got[-1]["upper"]) == (0.0, 10.0)
    flat = P.histogram(frame([(3.0,), (3.0,)], "v double"), "v", 2).orderBy("bin").collect()
    assert [r["n_rows"] for r in flat] == [2, 0]


def test_co_null(frame):
    df = frame([(1, None, None), (2, 1, 1), (3, None, None)], "k int, a int, b int")
    assert rows(P.check_co_null(df, "k", ["a", "b"])) == [("b", 2, 2, 0, 0, True)]
    off = frame([(1, None, None), (1, 1, 1), (3, None, 2)], "k int, a int, b int")
    assert rows(P.check_co_null(off, "k", ["a", "b"])) == [("b", 2, 1, 1, 1, False)]


def test_null_iff(frame):
    df = frame([(None, 0), (1.0, 2), (None, 3)], "r double, d int")
    got = P.check_null_iff(df, "r", F.col("d") == 0).first()
    assert tuple(got) == (2, 1, 1, False)


def test_null_by_category(frame):
    df = frame([("a", None), ("b", None), ("b", 1), ("c", 1)], "k string, v int")
    assert rows(P.null_by_category(df, "k", "v"), ) == [
        ("a", 1, 1, 1.0, "always"), ("b", 2, 1, 0.5, "sometimes"), ("c", 1, 0, 0.0, "never"),
    ]


def test_null_period(frame):
    df = frame([(1, None), (2, None), (3, 5), (4, 5)], "t int, v int")
    assert tuple(P.null_period(df, "t", "v").first()) == (1, 2, 3, 4, False)
    both = frame([(1, None), (3, None), (2, 5)], "t int, v int")
    assert P.null_period(both, "t", "v").first()["overlap"]
    assert not P.null_period(df.where("t > 2"), "t", "v").first()["overlap"]


def test_distinct_counts_multiply_no_rows(frame):
    df = frame([(i % 7, str(i % 11), None if i % 2 else float(i)) for i in range(200)] + [(None, None, float("nan"))] * 2, "k int, c string, v double")
    assert rows(P.distinct_counts(df)) == [(7, 11, 101)]
    assert "Expand" not in plan(P.distinct_counts(df))
    assert rows(P.distinct_counts(df.where("k > 9"))) == [(0, 0, 0)]


def test_sketches_of_loads_merge_to_that_of_the_whole(frame):
    data = [(i, f"t{i % 500}", None if i % 3 == 0 else i / 2, i % 2 == 0) for i in range(6000)]
    schema = "k int, c string, v double, b boolean"
    parts = [S.sketch(frame(data[i::3], schema)) for i in range(3)]
    merged = {r["column"]: r for r in S.profile(S.merge(parts[0].unionByName(parts[1]).unionByName(parts[2])), [0.0, 0.5, 1.0]).collect()}
    for c, exact in (("k", 6000), ("c", 500), ("v", 4000), ("b", 2)):
        assert abs(merged[c]["n_distinct"] - exact) <= max(1, S.distinct_error() * exact)
    assert (merged["v"]["n_rows"], merged["v"]["non_null"], merged["v"]["least"], merged["v"]["most"]) == (6000, 4000, 0.5, 2999.5)
    assert merged["c"]["quantiles"] is None and merged["c"]["least"] is None
    low, middle, high = merged["k"]["quantiles"]
    assert low == 0 and high == 5999 and abs(middle / 6000 - 0.5) <= S.rank_error()
    nothing = {r["column"]: r for r in S.profile(S.merge(S.sketch(frame([], schema)))).collect()}
    assert nothing["k"]["n_rows"] == 0 and nothing["k"]["quantiles"] is None and nothing["c"]["n_distinct"] == 0
