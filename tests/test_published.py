from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesift.sources.commits import CommitLog
from lakesift.sources.published import PublishError, Shelf, check_complete, upsert, verify_loaded
from lakesift.sources.rejects import append_rejects, common_type, read_reasons, read_rejects
from lakesift.sources.runlog import RunLog, entries, latest, read_log, step_report

DAYS = [datetime(2024, 1, d, 12, tzinfo=timezone.utc) for d in range(1, 6)]


@pytest.fixture
def shelf(spark, tmp_path):
    return Shelf(spark, str(tmp_path))


def test_publish_snapshot_and_audit(shelf, frame):
    a, b = frame([(1, "x")], "k int, v string"), frame([(2, "y"), (3, "z")], "k int, v string")
    assert shelf.current("t") is None
    with pytest.raises(PublishError):
        shelf.read_published("t")
    first = shelf.stage(a, "t", DAYS[0])
    assert first == "t_20240101_120000"
    shelf.publish({"t": first}, "p", "r1", DAYS[0])
    assert rows(shelf.read_published("t")) == rows(a)
    second = shelf.stage(b, "t", DAYS[1], cluster_by=["v"])
    assert rows(shelf.read_published("t")) == rows(a)
    result = shelf.publish({"t": second}, "p", "r2", DAYS[1]).first()
    assert (result["staging_table"], result["snapshot_table"]) == (second, first)
    assert rows(shelf.read_published("t")) == rows(b)
    assert rows(shelf.read_version(first)) == rows(a)
    assert shelf.audit().count() == 2


def test_columns_are_replaced_by_name(shelf, frame):
    shelf.publish({"t": shelf.stage(frame([(1, "x")], "k int, v string"), "t", DAYS[0])}, "p", "r", DAYS[0])
    wide = shelf.stage(frame([("y", 2.0, 2)], "v string, extra double, k int"), "t", DAYS[1])
    shelf.publish({"t": wide}, "p", "r", DAYS[2])
    assert shelf.read_published("t").columns == ["k", "v"]
    assert rows(shelf.read_published("t")) == [(2, "y")]


def test_one_bad_table_publishes_nothing(shelf, frame):
    good, bad = frame([(1,)], "k int"), frame([("x",)], "k string")
    names = {t: shelf.stage(good, t, DAYS[0]) for t in ("a", "b")}
    shelf.publish(names, "p", "r1", DAYS[0])
    new = {"a": shelf.stage(frame([(2,)], "k int"), "a", DAYS[1]), "b": shelf.stage(bad, "b", DAYS[1])}
    with pytest.raises(PublishError):
        shelf.publish(new, "p", "r2", DAYS[1])
    assert rows(shelf.read_published("a")) == [(1,)]
    assert shelf.audit().count() == 2
    shelf.publish(new, "p", "r3", DAYS[2], recreate=True)
    assert rows(shelf.read_published("a")) == [(2,)]
    assert rows(shelf.read_published("b")) == [("x",)]


def test_rejects_accept_new_columns(spark, frame, tmp_path):
    root = str(tmp_path)
    append_rejects(frame([(1, "neg")], "k int, failed_column string"), root, "t", "p", "r1")
    append_rejects(frame([(2, "dim")], "k int, failed_dimension string"), root, "t", "p", "r2")
    got = read_rejects(spark, root, "t")
    assert rows(got, "k", "failed_column", "failed_dimension", "run_id") == [
        (1, "neg", None, "r1"), (2, None, "dim", "r2"),
    ]
    assert read_reasons(spark, root).select("report").distinct().collect()[0][0] == "rejected_t"


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_upsert(frame, conf, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    base = frame([(1, 1, "a"), (2, 1, "b"), (3, 5, "c")], "k int, ts int, v string")
    delta = frame([(2, 2, "B"), (2, 3, "BB"), (3, 4, "old"), (4, 1, "d")], "k int, ts int, v string")
    got = upsert(base, delta, ["k"], [F.col("ts").desc()])
    assert rows(got, "k", "v") == [(1, "a"), (2, "BB"), (3, "c"), (4, "d")]
    again = upsert(got, delta, ["k"], [F.col("ts").desc()])
    assert rows(again) == rows(got)


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_upsert_of_stored_tables_with_repeated_keys(spark, frame, conf, tmp_path, threshold):
    """Of keys that the delta has one row stays, others pass as they are, whatever the join."""
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    frame([(1, 1, "a"), (1, 2, "aa"), (2, 1, "b"), (2, 2, "bb"), (None, 1, "n")], "k int, ts int, v string").write.parquet(f"{tmp_path}/base")
    frame([(2, 3, "B"), (3, 1, "c"), (None, 2, "N")], "k int, ts int, v string").write.parquet(f"{tmp_path}/delta")
    base, delta = spark.read.parquet(f"{tmp_path}/base"), spark.read.parquet(f"{tmp_path}/delta")
    got = upsert(base, delta, ["k"], [F.col("ts").desc()])
    assert rows(got, "k", "v") == rows(frame([(1, "a"), (1, "aa"), (2, "B"), (3, "c"), (None, "N")], "k int, v string"))


def test_one_stamp_and_older_stamps(shelf, frame):
    shelf.publish({"t": shelf.stage(frame([(1, "a")], "k int, v string"), "t", DAYS[0])}, "p", "r1", DAYS[0])
    shelf.publish({"t": shelf.stage(frame([("b", 2)], "v string, k int"), "t", DAYS[1])}, "p", "r2", DAYS[1])
    assert [tuple(r) for r in shelf.read_published("t").collect()] == [(2, "b")]
    again = shelf.stage(frame([(3, "c")], "k int, v string"), "t", DAYS[1])
    for old in (DAYS[0], DAYS[1]):
        with pytest.raises(PublishError):
            shelf.publish({"t": again}, "p", "r3", old)
    assert [tuple(r) for r in shelf.read_published("t").collect()] == [(2, "b")]


def test_unreadable_tables_are_reported_beside_good_ones(spark, frame, tmp_path):
    good, bad = str(tmp_path / "good"), tmp_path / "bad"
    frame([(1,)], "k int").write.parquet(good)
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"PAR1 no footer")
    late = spark.read.schema("k int").parquet(str(bad))
    report = {r["table_name"]: (r["row_count"], r["status"]) for r in verify_loaded(spark, {"good": good, "bad": str(bad), "late": late}).collect()}
    assert report == {"good": (1, "PASS"), "bad": (None, "FAIL"), "late": (None, "FAIL")}


def test_initial_and_incremental_load(shelf, frame):
    order = [F.col("ts").desc()]
    first = frame([(1, 1, "a"), (1, 2, "A"), (2, 1, "b")], "k int, ts int, v string")
    name = shelf.stage_increment(first, "t", ["k"], order, DAYS[0])
    shelf.publish({"t": name}, "p", "r1", DAYS[0])
    assert rows(shelf.read_published("t"), "k", "v") == [(1, "A"), (2, "b")]
    kept = shelf.snapshot(["t", "unknown"])
    assert kept == {"t": name}
    more = frame([(2, 3, "B"), (3, 1, "c")], "k int, ts int, v string")
    shelf.publish({"t": shelf.stage_increment(more, "t", ["k"], order, DAYS[1])}, "p", "r2", DAYS[1])
    assert rows(shelf.read_published("t"), "k", "v") == [(1, "A"), (2, "B"), (3, "c")]
    assert rows(shelf.read_version(kept["t"]), "k", "v") == [(1, "A"), (2, "b")]


def test_verification_and_completeness(spark, frame, tmp_path):
    path = str(tmp_path / "good")
    frame([(1,), (2,)], "k int").write.parquet(path)
    report = verify_loaded(
        spark, {"good": path, "empty": frame([], "k int"), "absent": str(tmp_path / "none")}
    )
    got = {r["table_name"]: (r["row_count"], r["status"], r["problem"]) for r in report.collect()}
    assert got == {
        "good": (2, "PASS", None),
        "empty": (0, "FAIL", "empty"),
        "absent": (None, "FAIL", "error: AnalysisException"),
    }
    assert rows(check_complete(report, ["good", "empty", "other"])) == [("empty",), ("other",)]


def test_run_log(spark, tmp_path):
    log = RunLog("p", "r", str(tmp_path / "log"))
    log.step("load", "started")
    log.flush(spark)
    log.step("load", "success", 5)
    log.add("load", "tables", "a")
    log.add("load", "tables", "b")
    log.error("check", ValueError("x"), "row 7")
    log.end()
    log.flush(spark)
    log.flush(spark)
    stored = read_log(spark, log.path)
    assert stored.count() == 8
    assert rows(entries(stored, "load", "tables"), "entry") == [("a",), ("b",)]
    assert rows(entries(stored, "check", "error"), "status", "entry") == [("ValueError", "row 7")]
    report = {r["step"]: (r["errors"], r["entries"]) for r in step_report(stored).collect()}
    assert report == {"run": (0, 0), "load": (0, 2), "check": (1, 0)}
    got = {r["step"]: (r["status"], r["entry"]) for r in latest(stored).collect()}
    assert got == {"run": ("ended", None), "load": ("success", "5"), "check": ("failed", "ValueError")}
    assert rows(latest(log.frame(spark)).drop("at")) == rows(latest(stored).drop("at"))


def test_two_publishers_at_once_make_a_chain(shelf, frame):
    """Both are visible, and the later one has the other's version as its snapshot."""
    first = shelf.stage(frame([(0,)], "k int"), "t", datetime(2024, 1, 1, tzinfo=timezone.utc))
    shelf.publish({"t": first}, "p", "r0", datetime(2024, 1, 1, tzinfo=timezone.utc))
    names = {f"r{k}": shelf.stage(frame([(k,)], "k int"), "t", datetime(2024, 1, 2, k, tzinfo=timezone.utc)) for k in range(1, 5)}

    def publish(item):
        return shelf.publish({"t": item[1], item[0]: item[1]}, "p", item[0]).collect()

    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(publish, names.items()))
    rows = sorted((r for d in done for r in d if r["gold_table"] == "t"), key=lambda r: r["publish_ts"])
    assert [r["snapshot_table"] for r in rows] == [first, *[r["staging_table"] for r in rows[:-1]]]
    assert shelf.current("t") == rows[-1]["staging_table"] and shelf.commits.last() == 5
    assert {shelf.current(k) for k in names} == set(names.values())
    assert shelf.audit().where("gold_table = 't'").count() == 5


def test_a_taken_number_is_not_written_again(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "commits"))
    assert log.head() == {} and log.try_add(1, {"a": 1}) and not log.try_add(1, {"a": 2})
    calls = []

    def make(head):
        calls.append(head)
        if len(calls) == 1:
            log.try_add(2, {"a": 5})  # somebody else
        return {"a": head["a"] + 1}

    assert log.add(make) == {"a": 6} == log.head() and calls == [{"a": 1}, {"a": 5}]
    assert sorted(n for n in os.listdir(tmp_path / "commits") if not n.startswith(".")) == ["000000000001.json", "000000000002.json", "000000000003.json"]


def test_rejects_whose_columns_change_type(spark, tmp_path, frame):
    root = str(tmp_path / "rejects")
    loads = [("k int, v int, w float", (1, 2, 0.5)), ("k bigint, v string, w double", (2**40, "x", 0.25)), ("k int, u date", (3, None)), ("k int, v int, w float", (4, 5, 1.0))]
    for i, (schema, row) in enumerate(loads):
        append_rejects(frame([(*row, "bad")], f"{schema}, issue_type string"), root, "t", "p", f"r{i}")
    got = read_rejects(spark, root, "t")
    types = dict(got.dtypes)
    assert (types["k"], types["v"], types["w"], types["u"]) == ("bigint", "string", "double", "date")
    assert rows(got, "k", "v", "w") == [(1, "2", 0.5), (3, None, None), (4, "5", 1.0), (2**40, "x", 0.25)]
    assert read_reasons(spark, root).count() == 4 and "shape" not in read_reasons(spark, root).columns
    with pytest.raises(LookupError):
        read_rejects(spark, root, "nothing")


@pytest.mark.parametrize(
    "types, common",
    [
        ([T.ShortType(), T.LongType()], T.LongType()), ([T.LongType(), T.DoubleType()], T.StringType()), ([T.IntegerType(), T.FloatType()], T.DoubleType()),
        ([T.DateType(), T.TimestampType()], T.TimestampType()), ([T.DateType(), T.IntegerType()], T.StringType()), ([T.NullType()], T.StringType()), ([T.BooleanType()] * 2, T.BooleanType()),
    ],
)
def test_common_types_lose_nothing(types, common):
    assert common_type(types) == common
