"""Ranged tables and checks of tables that arrive in loads."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakesift.operators.checks import check_primary_key, check_references
from lakesift.operators.dedupe import keep_best
from lakesift.session import scratch
from lakesift.sources.commits import CommitLog
from lakesift.sources.increments import CheckedTable, LoadConflict
from lakesift.sources.ranged import RangedTable


@pytest.fixture
def table(spark):
    def make(keys=("a", "b"), rows_per_range=40):
        return RangedTable(spark, scratch(spark, "ranged"), keys, rows_per_range)

    return make


def _rows(rnd, n, version):
    key = lambda: (rnd.choice([None, *range(12)]), rnd.choice([None, "x", "y", "z", *map(str, range(9))]))
    return [(*key(), version, rnd.randrange(1000)) for _ in range(n)]


SCHEMA = "a int, b string, version int, v int"


def test_loads_equal_a_merge_of_all(table, frame):
    """One row per key, the latest; keys with nulls, in any range, new and known."""
    rnd, t, everything = random.Random(1), table(), []
    order = [F.col("version").desc()]
    for version in range(4):
        delta = _rows(rnd, 120, version)
        everything += delta
        assert t.load(frame(delta, SCHEMA), order) == version + 1
        assert rows(t.read()) == rows(keep_best(frame(everything, SCHEMA), ["a", "b"], order))
    ranges = t.ranges()
    assert len(ranges) > 3 and ranges[0].lo is None and all(r.lo for r in ranges[1:])
    assert sum(r.n_rows for r in ranges) == t.read().count()
    assert rows(t.read(1)) == rows(keep_best(frame(everything[:120], SCHEMA), ["a", "b"], order))


def test_a_load_reads_and_writes_touched_ranges_only(table, frame):
    t = table(("a",), 50)
    t.load(frame([(i, "x", 0, i) for i in range(1000)], SCHEMA))
    before = t.ranges()
    assert 15 <= len(before) <= 40
    delta = frame([(k, "y", 1, 0) for k in (100, 101, 103)], SCHEMA)
    numbers = t.touched(delta)
    assert len(numbers) <= 2
    read = t.matching(delta)
    assert all(any(before[i].path.split("file:")[-1] in f for i in numbers) for f in read.inputFiles())
    t.load(delta, [F.col("version").desc()])
    after = t.ranges()
    kept = [r.path for i, r in enumerate(before) if i not in numbers]
    assert [r.path for r in after if r.path in {b.path for b in before}] == kept and len(after) >= len(before)
    assert rows(t.read().where("a IN (100, 102)").select("a", "b")) == [(100, "y"), (102, "x")]
    # Keys beyond both ends, and a load of nothing.
    t.load(frame([(-5, "n", 2, 0), (None, "n", 2, 0), (9999, "n", 2, 0)], SCHEMA))
    assert rows(t.read().where("b = 'n'").select("a")) == [(None,), (-5,), (9999,)]
    assert t.load(frame([], SCHEMA)) == t.version() == 3


def test_a_range_that_grows_is_cut(table, frame):
    t = table(("a",), 30)
    t.load(frame([(i, "x", 0, i) for i in range(20)], SCHEMA))
    assert len(t.ranges()) == 1
    t.load(frame([(1000 + i, "x", 0, i) for i in range(200)], SCHEMA))
    assert len(t.ranges()) >= 6 and t.read().count() == 220
    # A hot first key is told apart by the second.
    t = table(("a", "b"), 30)
    t.load(frame([(7, str(i), 0, i) for i in range(200)], SCHEMA))
    assert len(t.ranges()) >= 5


@pytest.mark.parametrize("parts", [1, 3])
def test_checked_loads_equal_one_check(spark, frame, parts):
    rnd = random.Random(parts)
    data = _rows(rnd, 400, 0) + [(99, "hot", 0, i) for i in range(150)] + [(1, "x", 0, 5)] * 3
    rnd.shuffle(data)
    order = [F.col("v").desc()]
    t = CheckedTable(spark, scratch(spark, "checked"), ["a", "b"], order, rows_per_range=50)
    for k in range(parts):
        t.load(frame(data[k::parts], SCHEMA))
    t.load(frame([], SCHEMA))
    whole = check_primary_key(frame(data, SCHEMA), ["a", "b"], order)
    assert rows(t.clean()) == rows(whole.clean)
    assert rows(t.rejects()) == rows(whole.rejects)
    assert rows(t.metrics()) == rows(whole.metrics)


def test_references_to_an_index(spark, frame):
    dim = CheckedTable(spark, scratch(spark, "dim"), ["k"], rows_per_range=2)
    dim.load(frame([(1, "a"), (2, "b")], "k int, name string"))
    dim.load(frame([(2, "c"), (None, "d"), (3, "e")], "k int, name string"))
    fact = frame([(1, 1), (2, 2), (4, 3), (None, 4)], "k int, v int")
    split = check_references(fact, [dim.reference("dim", "k")])
    assert rows(split.clean) == [(1, 1), (2, 2)]
    assert "name" not in dim.reference("dim", "k").dim.columns


def test_a_load_that_is_broken_off_leaves_no_trace(spark, frame, monkeypatch):
    data = [(i % 7, "x", 0, i) for i in range(20)]
    t = CheckedTable(spark, scratch(spark, "checked"), ["a"], [F.col("v").desc()], rows_per_range=3)
    with pytest.raises(LookupError):
        t.clean()
    t.load(frame(data[:10], SCHEMA))
    before = [rows(t.clean()), rows(t.rejects()), rows(t.metrics())]
    original = RangedTable.load

    def ended(self, *args):
        if self.root.endswith("/keys"):
            raise KeyboardInterrupt  # after the clean rows were written
        return original(self, *args)

    monkeypatch.setattr(RangedTable, "load", ended)
    with pytest.raises(KeyboardInterrupt):
        t.load(frame(data[10:], SCHEMA))
    monkeypatch.undo()
    assert [rows(t.clean()), rows(t.rejects()), rows(t.metrics())] == before
    t.load(frame(data[10:], SCHEMA))
    whole = check_primary_key(frame(data, SCHEMA), ["a"], [F.col("v").desc()])
    assert [rows(t.clean()), rows(t.rejects()), rows(t.metrics())] == [rows(whole.clean), rows(whole.rejects), rows(whole.metrics)]


def test_the_later_of_two_loads_at_once_fails(spark, frame, monkeypatch):
    t = CheckedTable(spark, scratch(spark, "checked"), ["a"])
    monkeypatch.setattr(CommitLog, "try_add", lambda self, number, commit: False)
    with pytest.raises(LoadConflict):
        t.load(frame([(1, "x", 0, 1)], SCHEMA))


def test_ranges_stay_apart_when_every_second_one_is_cut(table, frame):
    """More runs than a task keeps files open, each cut into several ranges, and no folder for each of them."""
    t = table(("a",), 10)
    t.load(frame([(i * 10, "x", 0, i) for i in range(400)], SCHEMA))
    before = t.ranges()
    assert len(before) == 40
    delta = [(k + i, "y", 1, i) for r in before[1::2] for k in (r.lo[0] + 10, r.lo[0] + 30) for i in range(1, 9)]
    t.load(frame(delta, SCHEMA), [F.col("version").desc()])
    after = t.ranges()
    assert len(after) >= 60 and max(r.n_rows for r in after) <= 10 and t.read().count() == 400 + len(delta)
    for r, nxt in zip(after, [*after[1:], None]):
        keys = [k for (k,) in rows(t._rows([r]).select("a"))]
        assert len(keys) == r.n_rows and (r.lo is None or r.lo[0] <= min(keys)) and (nxt is None or max(keys) < nxt.lo[0])
    # A version that holds all of a load is listed by the load's folder.
    t.load(frame([(k, "z", 2, 0) for k in range(0, 4000, 10)], SCHEMA), [F.col("version").desc()])
    assert len({r.folder for r in t.ranges()}) == 1 and t.ranges()[0].n_files == len(t.ranges())


def test_rows_are_placed_by_halving_the_bounds(spark, frame, table):
    """The plan does not grow with the ranges, nor does a row meet more bounds than their logarithm."""
    t = table(("a",), 3)
    t.load(frame([(i, "x", 0, i) for i in range(0, 300)], SCHEMA))
    ranges = t.ranges()
    placed = t.placed(frame([(k, "x", 0, 0) for k in (None, -1, 0, 2, 3, 150, 299, 999)], SCHEMA), ranges)
    assert rows(placed.select("a", "_lakesift_range")) == rows(frame([(None, 0), (-1, 0), (0, 0), (2, 0), (3, 1), (150, 50), (299, 99), (999, 99)], "a int, r int"))
    assert "Join" not in placed._jdf.queryExecution().executedPlan().toString()


def test_a_hot_key_is_reduced_before_a_merge(table, frame, monkeypatch):
    from lakesift.sources import ranged

    stored = []
    monkeypatch.setattr(ranged, "materialize", lambda df, label, write=ranged.materialize: stored.append(label) or write(df, label))
    t = table(("a",), 50)
    t.load(frame([(1, "x", v, v) for v in range(1500)] + [(2, "x", 0, 0)], SCHEMA), [F.col("version").desc()])
    assert rows(t.read().select("a", "version")) == [(1, 1499), (2, 0)] and len(stored) == 2


def test_a_single_key_may_be_null(table, frame):
    """Ranges of one row: a null key is the first of all and a range of its own."""
    t, order = table(("a",), 1), [F.col("version").desc()]
    t.load(frame([(k, "x", 0, 0) for k in (3, None, 1)], SCHEMA), order)
    t.load(frame([(k, "y", 1, 0) for k in (None, 2)], SCHEMA), order)
    assert [(r.lo, r.n_rows) for r in t.ranges()] == [(None, 1), ((1,), 1), ((2,), 1), ((3,), 1)]
    assert rows(t.read().select("a", "b")) == rows(frame([(None, "y"), (1, "x"), (2, "y"), (3, "x")], "a int, b string"))


def test_many_ranges_are_listed_in_few_tasks(spark, table, frame):
    t = table(("a",), 1)
    t.load(frame([(i, "x", 0, i) for i in range(100)], SCHEMA))
    spark.sparkContext.setJobGroup("listing", "")
    try:
        assert t._rows(t.ranges()[:90]).count() == 90
    finally:
        spark.sparkContext.setJobGroup("", "")
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert 32 < max(s.numTasks for s in stages if s) <= 64
