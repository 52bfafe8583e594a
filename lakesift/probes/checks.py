from __future__ import annotations

from pyspark.sql import functions as F

from lakesift.operators import checks as K
from lakesift.operators import expectations as X
from lakesift.probes.dedupe import _ORDER_SQL, LINE_KEY, _latest
from lakesift.probes.registry import probe, sql_money
from lakesift.probes.views import (
    LABELLED_SQL,
    LINE_RATES_SQL,
    doubles,
    labelled,
    line_rates,
    money,
)
from lakesift.session import scratch
from lakesift.sources.increments import CheckedTable

_DUPED = """
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem
"""


@probe(
    "i3_primary_key_rejects",
    f"SELECT * EXCLUDE (n), 'pkey_dupe' AS issue_type FROM ({_DUPED}) WHERE n > 1",
)
def i3_rejects(t):
    return K.check_primary_key(t.lineitem, LINE_KEY, _latest()).rejects


_CLEAN_SQL = f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER_SQL}) AS rn
      FROM lineitem) WHERE rn = 1
    """


@probe("i3_primary_key_clean", _CLEAN_SQL)
def i3_clean(t):
    return K.check_primary_key(t.lineitem, LINE_KEY, _latest()).clean


_METRICS_SQL = """
    SELECT count(*) AS duplicate_keys, cast(sum(n) as bigint) AS rejected_rows
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    """


@probe("i3_primary_key_metrics", _METRICS_SQL)
def i3_metrics(t):
    return K.check_primary_key(t.lineitem, LINE_KEY).metrics


def _lines_in_loads(t) -> CheckedTable:
    """All lines, arriving in three loads that share keys."""
    table = CheckedTable(t.spark, scratch(t.spark, "checked"), LINE_KEY, _latest(), rows_per_range=100_000)
    for k in range(3):
        table.load(t.lineitem.where(F.col("l_suppkey") % 3 == k))
    return table


@probe("i3_loads_clean", _CLEAN_SQL)
def i3_loads_clean(t):
    return _lines_in_loads(t).clean()


@probe(
    "i3_loads_rejects",
    f"SELECT * EXCLUDE (n), 'pkey_dupe' AS issue_type FROM ({_DUPED}) WHERE n > 1",
)
def i3_loads_rejects(t):
    return _lines_in_loads(t).rejects()


@probe("i3_loads_metrics", _METRICS_SQL)
def i3_loads_metrics(t):
    return _lines_in_loads(t).metrics()


@probe(
    "i4_index_orphans",
    """SELECT l.*, 'ri_orphan' AS issue_type, 'orders' AS failed_dimension, 'l_orderkey' AS join_key
       FROM lineitem l WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')""",
)
def i4_index(t):
    """Lines against the key index of orders that came in two loads; the orders themselves are not read again."""
    orders = CheckedTable(t.spark, scratch(t.spark, "orders"), ["o_orderkey"], rows_per_range=100_000)
    for status in ("O", "P"):
        orders.load(t.orders.where(F.col("o_orderstatus") == status))
    return K.check_references(t.lineitem, [orders.reference("orders", "l_orderkey", "o_orderkey")]).rejects


def _line_references(t):
    """Lines against open orders, large parts and solvent suppliers: all three have orphans."""
    return [
        K.Reference("orders", t.orders.where("o_orderstatus <> 'F'"), "l_orderkey", "o_orderkey"),
        K.Reference("part", t.part.where("p_size > 10"), "l_partkey", "p_partkey"),
        K.Reference("supplier", t.supplier.where("s_acctbal >= 0"), "l_suppkey", "s_suppkey"),
    ]


_FLAGGED = """
  SELECT l.*, CASE
    WHEN l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') THEN 'orders'
    WHEN l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10) THEN 'part'
    WHEN l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) THEN 'supplier'
    END AS failed_dimension
  FROM lineitem l
"""
_JOIN_KEY = """CASE failed_dimension WHEN 'orders' THEN 'l_orderkey' WHEN 'part' THEN 'l_partkey'
               WHEN 'supplier' THEN 'l_suppkey' END AS join_key"""


@probe(
    "i4_reference_rejects",
    f"""SELECT *, 'ri_orphan' AS issue_type, {_JOIN_KEY} FROM ({_FLAGGED})
        WHERE failed_dimension IS NOT NULL""",
)
def i4_rejects(t):
    return K.check_references(t.lineitem, _line_references(t)).rejects


@probe(
    "i4_reference_clean",
    f"SELECT * EXCLUDE (failed_dimension) FROM ({_FLAGGED}) WHERE failed_dimension IS NULL",
)
def i4_clean(t):
    return K.check_references(t.lineitem, _line_references(t)).clean


@probe(
    "i4_reference_metrics",
    f"""
    SELECT 'ri_orphan' AS issue_type, failed_dimension, join_key,
           cast(NULL as varchar) AS failed_column, cast(NULL as varchar) AS check_type, count(*) AS n_rows
    FROM (SELECT *, {_JOIN_KEY} FROM ({_FLAGGED})) WHERE failed_dimension IS NOT NULL
    GROUP BY failed_dimension, join_key
    """,
)
def i4_metrics(t):
    return K.check_references(t.lineitem, _line_references(t)).metrics


@probe(
    "i4_document_orphans",
    """
    SELECT doc_id, text, lang, source, n_chars, 'ri_orphan' AS issue_type,
           'labels' AS failed_dimension, 'doc_id' AS join_key
    FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    """,
)
def i4_documents(t):
    return K.check_references(t.documents, [K.Reference("labels", t.labels, "doc_id")]).rejects


_NEG = "'negative_value' AS issue_type, 'must_be_non_negative' AS check_type"


@probe(
    "i5_negative_rejects",
    f"SELECT *, 'c_acctbal' AS failed_column, {_NEG} FROM customer WHERE c_acctbal < 0",
)
def i5_rejects(t):
    return K.check_non_negative(t.customer, ["c_custkey", "c_acctbal"]).rejects


@probe("i5_negative_clean", "SELECT * FROM supplier WHERE s_acctbal >= 0")
def i5_clean(t):
    return K.check_non_negative(t.supplier, ["s_acctbal"]).clean


@probe(
    "i5_first_negative_column",
    f"""
    SELECT *, CASE WHEN price_gap < 0 THEN 'price_gap' ELSE 'size_gap' END AS failed_column, {_NEG}
    FROM (SELECT *, p_retailprice - 1200 AS price_gap, p_size - 25 AS size_gap FROM part)
    WHERE price_gap < 0 OR size_gap < 0
    """,
)
def i5_first(t):
    gaps = t.part.withColumns(
        {"price_gap": F.col("p_retailprice") - 1200, "size_gap": F.col("p_size") - 25}
    )
    return K.check_non_negative(gaps, ["price_gap", "size_gap"]).rejects


@probe(
    "i4_i5_table_outcomes",
    f"""
    SELECT issue_type, failed_dimension, join_key, failed_column, check_type, count(*) AS n_rows
    FROM (SELECT CASE WHEN failed_dimension IS NOT NULL THEN 'ri_orphan'
                      WHEN net < 0 THEN 'negative_value' END AS issue_type,
                 failed_dimension, {_JOIN_KEY},
                 CASE WHEN failed_dimension IS NULL AND net < 0 THEN 'net' END AS failed_column,
                 CASE WHEN failed_dimension IS NULL AND net < 0 THEN 'must_be_non_negative' END AS check_type
          FROM (SELECT *, l_quantity - 5 AS net FROM ({_FLAGGED})))
    GROUP BY ALL
    """,
)
def i45(t):
    lines = t.lineitem.withColumn("net", F.col("l_quantity") - 5)
    return K.reject_counts(K.flag_rows(lines, _line_references(t), ["net"]))


def _halted(t, check) -> bool:
    try:
        check()
    except K.CheckFailed:
        return True
    return False


@probe(
    "i6_i7_assertions",
    f"""
    SELECT 'orders_unique' AS assertion,
           (SELECT count(*) - count(DISTINCT o_orderkey) FROM orders) > 0 AS halted
    UNION ALL SELECT 'lineitem_unique', (SELECT count(*) FROM ({_DUPED}) WHERE n > 1) > 0
    UNION ALL SELECT 'orders_not_null',
           (SELECT count(*) FROM orders WHERE o_orderkey IS NULL OR o_orderdate IS NULL) > 0
    UNION ALL SELECT 'labelled_not_null',
           (SELECT count(*) FROM ({LABELLED_SQL}) WHERE doc_id IS NULL OR quality IS NULL) > 0
    """,
)
def i67(t):
    rows = [
        ("orders_unique", _halted(t, lambda: K.assert_unique(t.orders, ["o_orderkey"]))),
        ("lineitem_unique", _halted(t, lambda: K.assert_unique(t.lineitem, LINE_KEY))),
        ("orders_not_null", _halted(t, lambda: K.assert_not_null(t.orders, ["o_orderkey", "o_orderdate"]))),
        ("labelled_not_null", _halted(t, lambda: K.assert_not_null(labelled(t), ["doc_id", "quality"]))),
    ]
    return t.spark.createDataFrame(rows, "assertion string, halted boolean")


def _suite_sql(rows: list[tuple[str, str, str, str]], source: str) -> str:
    """rows: (expectation, column, measured, status)."""
    parts = [
        f"""SELECT (SELECT count(*) FROM ({source})) AS n_rows, '{name}' AS expectation,
                   {"NULL" if col is None else f"'{col}'"}::varchar AS "column",
                   n AS missing, m::double AS measured, {status} AS status, {status} <> 'fail' AS success
            FROM (SELECT {measured} AS m,
                         {"nullif(0 * count(*), 0)::bigint" if col is None else f"count(*) FILTER ({col} IS NULL)"} AS n
                  FROM ({source}))"""
        for name, col, measured, status in rows
    ]
    return " UNION ALL ".join(parts)


_ZERO = "CASE WHEN m = 0 THEN 'pass' ELSE 'fail' END"


@probe(
    "i8_range_expectations",
    _suite_sql(
        [
            ("between", c, f"count(*) FILTER ({c} < 0)", _ZERO)
            for c in (
                "l_linenumber_per_60", "l_extendedprice_per_60", "l_tax_per_60",
                "total_l_linenumber", "total_l_extendedprice", "total_l_tax", "total_minutes",
            )
        ]
        + [("column_count", None, "0 * count(*)", _ZERO)],
        LINE_RATES_SQL,
    ),
)
def i8(t):
    columns = [
        "l_linenumber_per_60", "l_extendedprice_per_60", "l_tax_per_60",
        "total_l_linenumber", "total_l_extendedprice", "total_l_tax", "total_minutes",
    ]
    return X.run_suite(line_rates(t), X.non_negative_suite(columns, column_count=9))


def _customer_suite():
    return [
        X.Between("c_acctbal", low=0),
        X.Between("c_acctbal", low=-1000, high=10000),
        X.NotNull("c_name"),
        X.InSet("c_mktsegment", ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY", "HOUSEHOLD")),
        X.ColumnCount(6),
    ]


_CUSTOMER_ROWS = [
    ("between", "c_acctbal", "count(*) FILTER (c_acctbal < 0)", _ZERO),
    ("between", "c_acctbal", "count(*) FILTER (c_acctbal < -1000 OR c_acctbal > 10000)", _ZERO),
    ("not_null", "c_name", "count(*) FILTER (c_name IS NULL)", _ZERO),
    (
        "in_set", "c_mktsegment",
        "count(*) FILTER (c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY', 'HOUSEHOLD'))",
        _ZERO,
    ),
    ("column_count", None, "1 + 0 * count(*)", _ZERO),
]
_CUSTOMER_SUITE = _suite_sql(_CUSTOMER_ROWS, "SELECT * FROM customer")


@probe("i10_suite_report", _CUSTOMER_SUITE)
def i10(t):
    return X.run_suite(t.customer, _customer_suite())


@probe(
    "i10_suite_summary",
    f"""
    SELECT count(*) AS evaluated, count(*) FILTER (success) AS successful,
           count(*) FILTER (NOT success) AS unsuccessful,
           count(*) FILTER (success)::double / count(*) * 100 AS success_percent,
           bool_and(success) AS success
    FROM ({_CUSTOMER_SUITE})
    """,
)
def i10_summary(t):
    return X.suite_summary(X.run_suite(t.customer, _customer_suite()))


@probe("i10_suite_failures", f"SELECT * FROM ({_CUSTOMER_SUITE}) WHERE NOT success")
def i10_failures(t):
    return X.failures(X.run_suite(t.customer, _customer_suite()))


@probe(
    "i16_required_when",
    f"""
    SELECT count(*) FILTER (lang = 'en') AS rows_in_scope,
           count(*) FILTER (lang = 'en' AND quality IS NULL) AS missing,
           count(*) FILTER (lang = 'en' AND quality IS NULL) = 0 AS success
    FROM ({LABELLED_SQL})
    """,
)
def i16(t):
    return K.check_required_when(labelled(t), F.col("lang") == "en", "quality")


@probe(
    "i18_datetime_range",
    _suite_sql(
        [
            (
                "between", "o_orderdate",
                "count(*) FILTER (o_orderdate < timestamp '1995-01-01' OR o_orderdate > timestamp '1998-12-31')",
                _ZERO,
            )
        ],
        "SELECT * FROM orders",
    ),
)
def i18(t):
    low, high = [F.lit(d).cast("timestamp_ntz") for d in ("1995-01-01", "1998-12-31")]
    return X.run_suite(t.orders, [X.Between("o_orderdate", low, high)])


@probe(
    "i19_category_whitelist",
    _suite_sql(
        [("in_set", "o_orderstatus", "count(*) FILTER (o_orderstatus NOT IN ('F', 'O'))", _ZERO)],
        "SELECT * FROM orders",
    ),
)
def i19(t):
    return X.run_suite(t.orders, [X.InSet("o_orderstatus", ("F", "O"))])


@probe(
    "i19_whitelist_table",
    """
    SELECT count(*) AS unexpected, count(*) = 0 AS success FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)
    """,
)
def i19_table(t):
    return X.expect_in_table(t.lineitem, "l_partkey", t.part.where("p_size <= 45"), "p_partkey")


@probe(
    "i20_reconcile",
    f"""
    SELECT l_suppkey, d AS detail_sum, s AS summary_sum, coalesce(abs(d - s) <= 0, d IS NULL AND s IS NULL) AS matches
    FROM (SELECT l_suppkey, {sql_money("l_extendedprice")} AS d FROM lineitem GROUP BY l_suppkey)
    FULL JOIN (SELECT l_suppkey, {sql_money("total_l_extendedprice")} AS s
               FROM ({LINE_RATES_SQL}) WHERE total_minutes > 0.2 GROUP BY l_suppkey) USING (l_suppkey)
    """,
)
def i20(t):
    """The summary misses short groups, so most suppliers do not reconcile."""
    summary = money(line_rates(t).where("total_minutes > 0.2"), "total_l_extendedprice")
    detail = money(t.lineitem, "l_extendedprice")
    return doubles(
        K.reconcile(detail, summary, "l_suppkey", "l_extendedprice", "total_l_extendedprice")
    )


@probe(
    "i22_null_share",
    _suite_sql(
        [
            (
                "null_share", c,
                f"avg(cast({c} IS NULL as integer))",
                f"CASE WHEN m > {fail} THEN 'fail' WHEN m > {warn} THEN 'warn' ELSE 'pass' END",
            )
            for c, warn, fail in (("quality", 0.4, 0.9), ("toxic", 0.2, 0.5), ("lang", 0.1, 0.2))
        ],
        LABELLED_SQL,
    ),
)
def i22(t):
    return X.run_suite(
        labelled(t),
        [X.NullShare("quality", 0.4, 0.9), X.NullShare("toxic", 0.2, 0.5), X.NullShare("lang", 0.1, 0.2)],
    )


@probe(
    "j5_gate",
    f"""
    SELECT 'line_rates' AS table_name,
           (SELECT count(*) FROM ({LINE_RATES_SQL}) WHERE total_minutes < 0 OR total_l_tax < 0) = 0 AS proceed
    UNION ALL SELECT 'line_rates_and_customer',
           (SELECT count(*) FROM ({LINE_RATES_SQL}) WHERE total_minutes < 0 OR total_l_tax < 0) = 0
           AND (SELECT bool_and(success) FROM ({_CUSTOMER_SUITE}))
    """,
)
def j5(t):
    good = X.run_suite(line_rates(t), X.non_negative_suite(["total_minutes", "total_l_tax"]))
    bad = X.run_suite(t.customer, _customer_suite())
    rows = [("line_rates", X.gate(good)), ("line_rates_and_customer", X.gate(good, bad))]
    return t.spark.createDataFrame(rows, "table_name string, proceed boolean")
