"""Every registered query against its SQL on the smallest scale."""

from __future__ import annotations

import os

import duckdb
import pytest

from lakesift.probes import load_all
from lakesift.probes.registry import NAMES
from lakesift.sources.published import Shelf

FOLDER = os.environ.get("PROBE_SF_DIR", "/root/testdata/sf0.001")
PROBES = load_all()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for n in NAMES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{FOLDER}/{n}.parquet')")
    return con


def _sorted(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in data), key=repr)


@pytest.mark.parametrize("key", sorted(PROBES))
def test_query_equals_sql(spark, duck, key):
    p = PROBES[key]
    df = p.run(spark, FOLDER)
    got = df.toArrow()
    want = duck.sql(p.sql).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    a = _sorted(got.column_names, zip(*[c.to_pylist() for c in got.columns]))
    b = _sorted(want.column_names, zip(*[c.to_pylist() for c in want.columns]))
    assert a == b
    text = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "PandasUDF"):
        assert unwanted not in text


def test_keys_follow_the_naming_rules():
    assert all(k.islower() and not k.startswith("op") and "pipeline" not in k for k in PROBES)


def test_the_refused_version_is_whole_and_differs(spark, monkeypatch):
    staged = []
    stage = Shelf.stage
    monkeypatch.setattr(Shelf, "stage", lambda self, df, *rest: staged.append(df) or stage(self, df, *rest))
    shown = PROBES["j4_older_stamp_refused"].run(spark, FOLDER)
    first, refused = staged
    assert refused.count() == first.count() == shown.count()
    assert refused.columns == first.columns and refused.intersect(first).isEmpty()
