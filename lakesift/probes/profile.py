from __future__ import annotations

from pyspark.sql import functions as F

from lakesift.operators import profile as P
from lakesift.operators import sketches as S
from lakesift.operators.ordering import first_rows, has_rows, top_k
from lakesift.probes.registry import NAMES, probe, sql_round
from lakesift.probes.views import LABELLED_SQL, labelled

LABELLED_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]


@probe(
    "d4_row_counts",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in NAMES),
)
def d4(t):
    counts = [
        P.row_count(getattr(t, n)).select(F.lit(n).alias("table_name"), "row_count") for n in NAMES
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@probe(
    "d6_duplicate_profile",
    """
    SELECT sum(n)::bigint AS total_rows, count(*) AS distinct_rows,
           (sum(n) - count(*))::bigint AS duplicate_rows
    FROM (SELECT l_suppkey, l_linenumber, l_quantity, count(*) AS n FROM lineitem GROUP BY ALL)
    """,
)
def d6(t):
    return P.duplicate_profile(t.lineitem.select("l_suppkey", "l_linenumber", "l_quantity"))


@probe(
    "d7_null_counts",
    "SELECT "
    + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in LABELLED_COLUMNS)
    + f" FROM ({LABELLED_SQL})",
)
def d7(t):
    return P.null_counts(labelled(t))


@probe(
    "d8_null_percent",
    "SELECT "
    + ", ".join(
        f"count(*) FILTER ({c} IS NULL)::double / count(*) * 100 AS {c}" for c in LABELLED_COLUMNS
    )
    + f" FROM ({LABELLED_SQL})",
)
def d8(t):
    return P.null_pct(labelled(t))


@probe(
    "d9_total_nulls",
    "SELECT "
    + " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in LABELLED_COLUMNS)
    + f" AS total_nulls FROM ({LABELLED_SQL})",
)
def d9(t):
    return P.total_nulls(labelled(t))


@probe(
    "d10_distinct_counts",
    """
    SELECT count(DISTINCT c_custkey) AS c_custkey, count(DISTINCT c_name) AS c_name,
           count(DISTINCT c_nationkey) AS c_nationkey, count(DISTINCT c_acctbal) AS c_acctbal,
           count(DISTINCT c_mktsegment) AS c_mktsegment
    FROM customer
    """,
)
def d10(t):
    return P.distinct_counts(t.customer)


@probe("d11_distinct_values", "SELECT DISTINCT o_orderpriority FROM orders")
def d11(t):
    return P.distinct_values(t.orders, "o_orderpriority")


@probe("d11_distinct_value_count", "SELECT count(DISTINCT l_suppkey) AS row_count FROM lineitem")
def d11_count(t):
    return P.row_count(P.distinct_values(t.lineitem, "l_suppkey"))


@probe("d12_range", "SELECT min(o_orderdate) AS min_value, max(o_orderdate) AS max_value FROM orders")
def d12(t):
    return P.min_max(t.orders, "o_orderdate")


def _orders_with_lines(t):
    lines = t.lineitem.select("l_orderkey").distinct()
    return t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")


ORDERS_WITH_LINES_SQL = """
  SELECT * FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem)
  ON o_orderkey = l_orderkey
"""


@probe(
    "d12_range_by_null_flag",
    f"""
    SELECT l_orderkey IS NULL AS no_lines, min(o_orderdate) AS min_value, max(o_orderdate) AS max_value
    FROM ({ORDERS_WITH_LINES_SQL}) GROUP BY l_orderkey IS NULL
    """,
)
def d12_split(t):
    return P.min_max(
        _orders_with_lines(t), "o_orderdate", F.col("l_orderkey").isNull().alias("no_lines")
    )


@probe(
    "d13_summary",
    f"""
    SELECT 'c_acctbal' AS "column", count(c_acctbal) AS "count", {sql_round("avg(c_acctbal)", 6)} AS mean,
           {sql_round("stddev_samp(c_acctbal)", 6)} AS stddev, min(c_acctbal) AS "min", max(c_acctbal) AS "max"
    FROM customer
    """,
)
def d13(t):
    rounded = {c: F.round(c, 6) for c in ("mean", "stddev")}
    return P.summary(t.customer, ["c_acctbal"]).withColumns(rounded)


@probe(
    "d13_quantiles",
    " UNION ALL ".join(
        f"SELECT {p}::double AS point, {sql_round(f'quantile_cont(l_extendedprice, {p})', 6)} AS value FROM lineitem"
        for p in (0.25, 0.5, 0.75)
    ),
)
def d13_quantiles(t):
    points = P.quantiles(t.lineitem, "l_extendedprice", [0.25, 0.5, 0.75])
    return points.withColumn("value", F.round("value", 6))


@probe(
    "d14_frequency",
    "SELECT user_id, count(*) AS n_rows FROM events GROUP BY user_id",
)
def d14(t):
    return P.frequency(t.events, "user_id")


@probe(
    "d15_histogram",
    """
    WITH b AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
         c AS (SELECT greatest(0, least(cast(floor((l_quantity - lo) / ((hi - lo) / 10)) as integer), 9)) AS bin,
                      count(*) AS n_rows FROM lineitem, b GROUP BY 1)
    SELECT cast(r.range as integer) AS bin, lo + (hi - lo) / 10 * r.range AS lower,
           lo + (hi - lo) / 10 * (r.range + 1) AS upper, coalesce(n_rows, 0) AS n_rows
    FROM range(10) r, b LEFT JOIN c ON c.bin = r.range
    """,
)
def d15(t):
    return P.histogram(t.lineitem, "l_quantity", 10)


@probe(
    "d16_values_by_category",
    f"SELECT lang, quality, count(*) AS n_rows FROM ({LABELLED_SQL}) GROUP BY lang, quality",
)
def d16(t):
    return P.values_by_category(labelled(t), "lang", "quality")


@probe(
    "d16_null_share_by_category",
    f"""
    SELECT lang, count(*) AS n_rows, count(*) FILTER (quality IS NULL) AS null_rows,
           count(*) FILTER (quality IS NULL)::double / count(*) AS null_share
    FROM ({LABELLED_SQL}) GROUP BY lang
    """,
)
def d16_share(t):
    return P.null_share_by_category(labelled(t), "lang", "quality")


_TYPES = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint",
          "quality": "int", "toxic": "int"}


@probe(
    "d17_column_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{ty}' AS data_type, count(*) AS n_rows, count({c}) AS non_null
            FROM ({LABELLED_SQL})"""
        for c, ty in _TYPES.items()
    ),
)
def d17(t):
    return P.column_profile(labelled(t))


@probe(
    "f1_sort_first_rows",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
    ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 100
    """,
)
def f1(t):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    order = [F.col("l_quantity").desc(), *[F.col(c).asc() for c in cols]]
    return first_rows(t.lineitem.select(*cols, "l_quantity"), order, 100)


@probe(
    "f2_bottom_k",
    "SELECT user_id, count(*) AS n_rows FROM events GROUP BY user_id ORDER BY n_rows, user_id LIMIT 10",
)
def f2_bottom(t):
    return top_k(t.events, "user_id", 10, ascending=True)


@probe(
    "f2_top_k",
    "SELECT user_id, count(*) AS n_rows FROM events GROUP BY user_id ORDER BY n_rows DESC, user_id LIMIT 10",
)
def f2_top(t):
    return top_k(t.events, "user_id", 10)


@probe(
    "f3_existence",
    """
    SELECT 'debtors' AS what, count(*) > 0 AS present FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT 'free_parts', count(*) > 0 FROM part WHERE p_retailprice = 0
    UNION ALL SELECT 'orders_without_lines', count(*) > 0 FROM orders
      WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    """,
)
def f3(t):
    found = [
        ("debtors", has_rows(t.customer.where("c_acctbal < 0"))),
        ("free_parts", has_rows(t.part.where("p_retailprice = 0"))),
        ("orders_without_lines", has_rows(_orders_with_lines(t).where("l_orderkey IS NULL"))),
    ]
    return t.spark.createDataFrame(found, "what string, present boolean")


@probe(
    "i11_co_null",
    f"""
    SELECT 'toxic' AS "column",
           count(*) FILTER (nq) AS null_keys_first, count(*) FILTER (nt) AS null_keys,
           count(*) FILTER (nq <> nt) AS differing_keys, count(*) FILTER (nt AND ft) AS mixed_keys,
           count(*) FILTER (nq <> nt) = 0 AND count(*) FILTER (nt AND ft) = 0 AS co_null
    FROM (SELECT doc_id, bool_or(quality IS NULL) AS nq, bool_or(toxic IS NULL) AS nt,
                 bool_or(toxic IS NOT NULL) AS ft
          FROM ({LABELLED_SQL}) GROUP BY doc_id)
    """,
)
def i11(t):
    return P.check_co_null(labelled(t), "doc_id", ["quality", "toxic"])


@probe(
    "i12_null_iff_zero",
    """
    SELECT count(*) FILTER (r IS NULL) AS null_rows, count(*) FILTER (l_discount = 0) AS condition_rows,
           count(*) FILTER ((r IS NULL) <> (l_discount = 0)) AS violations,
           count(*) FILTER ((r IS NULL) <> (l_discount = 0)) = 0 AS explained
    FROM (SELECT l_discount, l_tax / nullif(l_discount, 0) AS r FROM lineitem)
    """,
)
def i12(t):
    ratio = F.try_divide("l_tax", "l_discount")
    return P.check_null_iff(t.lineitem, ratio, F.col("l_discount") == 0)


@probe(
    "i13_null_by_category",
    f"""
    SELECT *, CASE WHEN null_rows = n_rows THEN 'always' WHEN null_rows > 0 THEN 'sometimes'
                   ELSE 'never' END AS null_status
    FROM (SELECT source, count(*) AS n_rows, count(*) FILTER (quality IS NULL) AS null_rows,
                 count(*) FILTER (quality IS NULL)::double / count(*) AS null_share
          FROM ({LABELLED_SQL}) GROUP BY source)
    """,
)
def i13(t):
    return P.null_by_category(labelled(t), "source", "quality")


@probe(
    "i14_null_period",
    f"""
    SELECT *, coalesce(null_from <= value_to AND value_from <= null_to, false) AS overlap
    FROM (SELECT min(o_orderdate) FILTER (l_orderkey IS NULL) AS null_from,
                 max(o_orderdate) FILTER (l_orderkey IS NULL) AS null_to,
                 min(o_orderdate) FILTER (l_orderkey IS NOT NULL) AS value_from,
                 max(o_orderdate) FILTER (l_orderkey IS NOT NULL) AS value_to
          FROM ({ORDERS_WITH_LINES_SQL}))
    """,
)
def i14(t):
    return P.null_period(_orders_with_lines(t), "o_orderdate", "l_orderkey")


_LINE_COLUMNS = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split()
_LINE_NUMBERS = _LINE_COLUMNS[:8]


@probe(
    "d10_line_distinct_counts",
    "SELECT " + ", ".join(f"count(DISTINCT {c}) AS {c}" for c in _LINE_COLUMNS) + " FROM lineitem",
)
def d10_lines(t):
    return P.distinct_counts(t.lineitem.select(*_LINE_COLUMNS))


@probe(
    "d17_merged_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS n_rows, count({c}) AS non_null, {f'min({c})::double' if c in _LINE_NUMBERS else 'NULL::double'} AS least,
                   {f'max({c})::double' if c in _LINE_NUMBERS else 'NULL::double'} AS most, count(DISTINCT {c}) AS exact_distinct, true AS distinct_within, true AS as_of_one_load,
                   {'true' if c in _LINE_NUMBERS else 'NULL::boolean'} AS median_within FROM lineitem"""
        for c in _LINE_COLUMNS
    ),
)
def d17_merged(t):
    """Profiles of three loads of the lines merged, held against one profile of all lines and exact values."""
    lines = t.lineitem.select(*_LINE_COLUMNS)
    loads = [S.sketch(lines.where(F.col("l_suppkey") % 3 == k)) for k in range(3)]
    merged = S.profile(S.merge(loads[0].unionByName(loads[1]).unionByName(loads[2])), [0.5])
    whole = S.profile(S.merge(S.sketch(lines)), [0.5]).select("column", F.col("n_distinct").alias("whole_distinct"))
    exact = P.distinct_counts(lines).unpivot([], _LINE_COLUMNS, "column", "exact_distinct")
    # The share of values below and up to the estimated median, which must enclose one half but for the error.
    medians = {r["column"]: r["median"] for r in merged.where("quantiles IS NOT NULL").select("column", F.col("quantiles")[0].alias("median")).collect()}
    n, error = F.count(F.lit(1)), S.rank_error()
    inside = [((F.count_if(F.col(c) < m) / n <= 0.5 + error) & (F.count_if(F.col(c) <= m) / n >= 0.5 - error)).alias(c) for c, m in medians.items()]
    ranks = lines.agg(*inside).unpivot([], _LINE_NUMBERS, "column", "median_within")
    out = merged.join(whole, "column").join(exact, "column").join(ranks, "column", "left")
    near = F.abs(F.col("n_distinct") - F.col("exact_distinct")) <= F.greatest(F.lit(1.0), S.distinct_error() * F.col("exact_distinct"))
    return out.select(
        "column", "n_rows", "non_null", "least", "most", "exact_distinct", near.alias("distinct_within"),
        (F.abs(F.col("n_distinct") - F.col("whole_distinct")) <= 0.01 * F.col("whole_distinct")).alias("as_of_one_load"), "median_within",
    )
