from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from lakesift.operators import checks as K
from lakesift.probes.registry import NAMES, probe
from lakesift.probes.views import LINE_FACT_SQL, line_fact
from lakesift.session import scratch
from lakesift.sources.published import PublishError, Shelf, check_complete, upsert, verify_loaded
from lakesift.sources.ranged import RangedTable
from lakesift.sources.rejects import append_rejects, read_rejects
from lakesift.sources.runlog import RunLog, entries, latest, read_log, step_report

FIRST = datetime(2024, 1, 1, 12, 0, 0, tzinfo=timezone.utc)
SECOND = datetime(2024, 1, 2, 12, 0, 0, tzinfo=timezone.utc)


def _shelf(t) -> Shelf:
    return Shelf(t.spark, scratch(t.spark, "shelf"))


@probe("a14_staged_version", "SELECT *, 'orders_20240101_120000' AS staging_table FROM orders")
def a14(t):
    shelf = _shelf(t)
    name = shelf.stage(t.orders, "orders", FIRST)
    return shelf.read_version(name).withColumn("staging_table", F.lit(name))


@probe(
    "a15_rejects_appended",
    """
    SELECT c_custkey AS id, c_acctbal AS balance, 'negative_value' AS issue_type,
           'c_acctbal' AS failed_column, 'must_be_non_negative' AS check_type,
           NULL AS failed_dimension, NULL AS join_key, 'p1' AS pipeline_id, 'r1' AS run_id,
           'rejected_accounts' AS report
    FROM customer WHERE c_acctbal < 0
    UNION ALL
    SELECT o_orderkey, o_totalprice, 'ri_orphan', NULL, NULL, 'lineitem', 'id', 'p1', 'r2', 'rejected_accounts'
    FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    """,
)
def a15(t):
    """Two reports with different reason columns under one key."""
    root = scratch(t.spark, "rejects")
    accounts = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    orders = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("balance"))
    negative = K.check_non_negative(accounts, ["balance"]).rejects
    negative = negative.withColumn("failed_column", F.lit("c_acctbal"))
    orphans = K.check_references(orders, [K.Reference("lineitem", t.lineitem, "id", "l_orderkey")]).rejects
    append_rejects(negative, root, "accounts", "p1", "r1")
    append_rejects(orphans, root, "accounts", "p1", "r2")
    return read_rejects(t.spark, root, "accounts").drop("rejected_at")


@probe(
    "a15_rejects_of_two_types",
    """
    SELECT cast(c_custkey AS VARCHAR) AS id, c_nationkey::bigint AS number, c_acctbal AS balance, 'negative_value' AS issue_type, 'p1' AS pipeline_id, 'r1' AS run_id,
           'rejected_accounts' AS report
    FROM customer WHERE c_acctbal < 0
    UNION ALL
    SELECT 'K' || s_suppkey, s_suppkey, NULL, 'negative_value', 'p1', 'r2', 'rejected_accounts' FROM supplier
    """,
)
def a15_types(t):
    """The id comes as a number first and as text later, a number grows wider, and a column is missing."""
    root = scratch(t.spark, "rejects")
    first = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("number"), F.col("c_acctbal").alias("balance"))
    later = t.supplier.select(F.concat(F.lit("K"), F.col("s_suppkey")).alias("id"), F.col("s_suppkey").alias("number"))
    for rows, run in ((first, "r1"), (later, "r2")):
        append_rejects(rows.withColumn("issue_type", F.lit("negative_value")), root, "accounts", "p1", run)
    return read_rejects(t.spark, root, "accounts").drop("rejected_at")


def _published_twice(t):
    """A first version with all orders, a second with finished ones only."""
    shelf = _shelf(t)
    first = shelf.stage(t.orders, "orders", FIRST, cluster_by=["o_orderstatus"])
    shelf.publish({"orders": first}, "p1", "r1", FIRST)
    second = shelf.stage(t.orders.where("o_orderstatus = 'F'"), "orders", SECOND)
    results = shelf.publish({"orders": second}, "p1", "r2", SECOND)
    return shelf, results


@probe("j1_snapshot", "SELECT * FROM orders")
def j1(t):
    shelf, results = _published_twice(t)
    return shelf.read_version(results.first()["snapshot_table"])


@probe("j2_replaced_contents", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def j2(t):
    shelf, _ = _published_twice(t)
    return shelf.read_published("orders")


@probe(
    "j2_columns_by_name",
    "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal >= 0",
)
def j2_names(t):
    """The second version has another column order and one column more."""
    shelf = _shelf(t)
    shelf.publish({"c": shelf.stage(t.customer.select("c_custkey", "c_name", "c_acctbal"), "c", FIRST)}, "p1", "r1", FIRST)
    wider = t.customer.where("c_acctbal >= 0").select("c_acctbal", "c_name", "c_mktsegment", "c_custkey")
    later = datetime(2024, 1, 2, 11, 0, 0, tzinfo=timezone.utc)
    shelf.publish({"c": shelf.stage(wider, "c", later)}, "p1", "r2", SECOND)
    return shelf.read_published("c")


@probe("j2_one_stamp", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0")
def j2_one_stamp(t):
    """Staged and published under one stamp, with another column order."""
    shelf = _shelf(t)
    shelf.publish({"c": shelf.stage(t.customer.select("c_custkey", "c_name"), "c", FIRST)}, "p1", "r1", FIRST)
    shelf.publish({"c": shelf.stage(t.customer.where("c_acctbal >= 0").select("c_name", "c_custkey"), "c", SECOND)}, "p1", "r2", SECOND)
    return shelf.read_published("c")


@probe("j4_older_stamp_refused", "SELECT *, 'PublishError' AS outcome FROM orders")
def j4_older(t):
    """A publish that could not become visible is refused; what was published stays."""
    shelf, outcome = _shelf(t), "published"
    shelf.publish({"orders": shelf.stage(t.orders, "orders", SECOND)}, "p1", "r1", SECOND)
    other = t.orders.withColumn("o_orderstatus", F.lit("refused"))
    try:
        shelf.publish({"orders": shelf.stage(other, "orders", FIRST)}, "p1", "r2", FIRST)
    except PublishError as e:
        outcome = type(e).__name__
    return shelf.read_published("orders").withColumn("outcome", F.lit(outcome))


@probe("j3_recreated", "SELECT c_name, c_mktsegment, c_acctbal FROM customer")
def j3(t):
    """The schema follows the staged table."""
    shelf = _shelf(t)
    shelf.publish({"c": shelf.stage(t.customer.select("c_custkey", "c_name"), "c", FIRST)}, "p1", "r1", FIRST)
    other = shelf.stage(t.customer.select("c_name", "c_mktsegment", "c_acctbal"), "c", SECOND)
    shelf.publish({"c": other}, "p1", "r2", SECOND, recreate=True)
    return shelf.read_published("c")


@probe(
    "j4_publish_audit",
    """
    SELECT v.*, n AS published_rows FROM (VALUES
      ('p1', 'r1', 'orders', 'orders_20240101_120000', NULL),
      ('p1', 'r1', 'customer', 'customer_20240101_120000', NULL),
      ('p1', 'r2', 'orders', 'orders_20240102_120000', 'orders_20240101_120000'),
      ('p1', 'r2', 'customer', 'customer_20240102_120000', 'customer_20240101_120000'))
      AS v(pipeline_id, run_id, gold_table, staging_table, snapshot_table)
    JOIN (SELECT 'orders' AS name, count(*) AS n FROM orders
          UNION ALL SELECT 'customer', count(*) FROM customer) ON name = gold_table
    """,
)
def j4(t):
    """Two tables published together, twice; every run leaves one row per table."""
    shelf = _shelf(t)
    for ts, run in ((FIRST, "r1"), (SECOND, "r2")):
        staged = {n: shelf.stage(getattr(t, n), n, ts) for n in ("orders", "customer")}
        shelf.publish(staged, "p1", run, ts)
    counts = verify_loaded(t.spark, {n: shelf.read_published(n) for n in ("orders", "customer")})
    rows = counts.select(F.col("table_name").alias("gold_table"), F.col("row_count").alias("published_rows"))
    return shelf.audit().drop("publish_ts").join(rows, "gold_table")


@probe("a17_published_fact", LINE_FACT_SQL)
def a17(t):
    """The wide line fact staged by season, published and read back."""
    shelf = _shelf(t)
    name = shelf.stage(line_fact(t), "line_fact", FIRST, cluster_by=["season"])
    shelf.publish({"line_fact": name}, "p1", "r1", FIRST)
    return shelf.read_published("line_fact")


_UPSERT = """
    SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice * 2 AS o_totalprice,
           o_orderdate + INTERVAL 1 DAY AS o_orderdate, o_orderpriority
    FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT * FROM orders WHERE o_orderpriority <> '1-URGENT'
    UNION ALL SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderstatus = 'P'
    """


def _delta(t):
    """Changed urgent orders and new pending ones."""
    changed = t.orders.where("o_orderpriority = '1-URGENT'").withColumns(
        {
            "o_orderstatus": F.lit("X"),
            "o_totalprice": F.col("o_totalprice") * 2,
            "o_orderdate": (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).cast("timestamp_ntz"),
        }
    )
    new = t.orders.where("o_orderstatus = 'P'").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    return changed.unionByName(new)


@probe("j6_upsert", _UPSERT)
def j6(t):
    return upsert(t.orders, _delta(t), ["o_orderkey"], [F.col("o_orderdate").desc()])


@probe("j6_initial_and_incremental", _UPSERT)
def j6_loads(t):
    """The orders as initial load, the delta as the load after it, both published."""
    shelf, order = _shelf(t), [F.col("o_orderdate").desc()]
    for rows, run, ts in ((t.orders, "r1", FIRST), (_delta(t), "r2", SECOND)):
        name = shelf.stage_increment(rows, "orders", ["o_orderkey"], order, ts)
        shelf.publish({"orders": name}, "p1", run, ts)
    return shelf.read_published("orders")


@probe(
    "j6_ranged_loads",
    f"""
    WITH second AS ({_UPSERT})
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 3 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus, o_totalprice,
           CASE WHEN o_orderkey % 10 = 3 THEN o_orderdate + INTERVAL 9 DAY ELSE o_orderdate END AS o_orderdate, o_orderpriority
    FROM second
    """,
)
def j6_ranged(t):
    """The orders, the delta and changes of every tenth order, each loaded into the ranges that it touches."""
    table, order = RangedTable(t.spark, scratch(t.spark, "ranged"), ["o_orderkey"], rows_per_range=5_000), [F.col("o_orderdate").desc()]
    table.load(t.orders, order, stored=True)
    table.load(_delta(t), order)
    later = (F.col("o_orderdate") + F.expr("INTERVAL 9 DAY")).cast("timestamp_ntz")
    changed = table.read().where("o_orderkey % 10 = 3").withColumns({"o_orderstatus": F.lit("Z"), "o_orderdate": later})
    table.load(changed, order)
    return table.read()


@probe(
    "i15_load_verification",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS table_name, count(*) AS row_count,
                   CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status,
                   CASE WHEN count(*) = 0 THEN 'empty' END AS problem FROM {n}"""
        for n in NAMES
    )
    + " UNION ALL SELECT 'invoices', NULL, 'FAIL', 'error: AnalysisException' UNION ALL SELECT 'payments', NULL, 'FAIL', 'unreadable'",
)
def i15(t):
    """All tables beside one that is absent and one whose files are no parquet."""
    broken = scratch(t.spark, "payments")
    t.region.select("r_name").write.text(broken)
    frame = t.spark.read.schema("k int").option("pathGlobFilter", "part-*").parquet(broken)
    report = verify_loaded(t.spark, {**{n: t.path(n) for n in [*NAMES, "invoices"]}, "payments": frame})
    unreadable = (F.col("table_name") == "payments") & F.col("problem").startswith("error: ")
    return report.withColumn("problem", F.when(unreadable, "unreadable").otherwise(F.col("problem")))


@probe(
    "i21_missing_tables",
    "SELECT 'invoices' AS table_name UNION ALL SELECT 'rich_customers' WHERE (SELECT max(c_acctbal) FROM customer) < 1e9",
)
def i21(t):
    tables = {n: t.path(n) for n in [*NAMES, "invoices"]}
    report = verify_loaded(t.spark, {**tables, "rich_customers": t.customer.where("c_acctbal >= 1e9")})
    return check_complete(report, [*tables, "rich_customers"])


@probe(
    "k1_run_log_entries",
    " UNION ALL ".join(
        f"""SELECT 'load' AS step, 'rows of {n}: ' || count(*) AS entry, {i}::bigint AS errors,
                   NULL::varchar AS status FROM {n}"""
        for i, n in ((1, "orders"), (1, "customer"))
    )
    + " UNION ALL SELECT 'load', 'invoices', 1, 'TableMissing'",
)
def k1_entries(t):
    """Lists and errors of a step, recorded by two jobs of one run."""
    path = scratch(t.spark, "runlog")
    for n in ("orders", "customer", "invoices"):
        log = RunLog("p1", "r1", path)
        if n == "invoices":
            log.error("load", "TableMissing", n)
        else:
            log.add("load", "loaded", f"rows of {n}: {getattr(t, n).count()}")
        log.flush(t.spark)
    stored = read_log(t.spark, path)
    found = entries(stored, "load", "loaded").unionByName(entries(stored, "load", "error"))
    report = step_report(stored).select("step", "errors")
    return report.where("step = 'load'").join(found.withColumn("step", F.lit("load")), "step").select(
        "step", "entry", "errors", "status"
    )


@probe(
    "k1_run_log",
    """
    SELECT 'p1' AS pipeline_id, 'r1' AS run_id, 'run' AS step, 'ended' AS status, NULL AS entry
    UNION ALL SELECT 'p1', 'r1', 'check_keys', 'success',
      (SELECT cast(sum(n) as bigint)::varchar FROM (SELECT count(*) AS n FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
    UNION ALL SELECT 'p1', 'r1', 'check_signs', 'success',
      (SELECT count(*)::varchar FROM customer WHERE c_acctbal < 0)
    UNION ALL SELECT 'p1', 'r1', 'assert_keys', 'failed', 'CheckFailed'
    """,
)
def k1(t):
    """The log of real checks: the last record of every step counts."""
    log = RunLog("p1", "r1", scratch(t.spark, "runlog"))
    log.step("check_keys", "started")
    found = K.check_primary_key(t.lineitem, ["l_orderkey", "l_linenumber"]).metrics.first()
    log.step("check_keys", "success", found["rejected_rows"])
    log.flush(t.spark)
    log.step("check_signs", "success", K.check_non_negative(t.customer, ["c_acctbal"]).rejects.count())
    try:
        K.assert_unique(t.lineitem, ["l_orderkey", "l_linenumber"])
    except K.CheckFailed as e:
        log.error("assert_keys", e)
    log.end()
    log.flush(t.spark)
    return latest(read_log(t.spark, log.path)).drop("seq", "at")
