from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakesift.functions import columns as C
from lakesift.probes.registry import probe
from lakesift.probes.views import LABELLED_SQL, labelled


@probe(
    "b1_audit_columns",
    "SELECT *, true AS stamped, 'p1' AS pipeline_id, 'r1' AS run_id FROM orders",
)
def b1(t):
    df = C.with_audit(t.orders, "p1", "r1")
    return df.withColumn("stamped", F.col("load_timestamp").isNotNull()).drop("load_timestamp")


@probe(
    "b2_reject_columns",
    "SELECT *, true AS stamped, 'p1' AS pipeline_id, 'r1' AS run_id FROM customer WHERE c_acctbal < 0",
)
def b2(t):
    df = C.with_reject_meta(t.customer.where("c_acctbal < 0"), "p1", "r1")
    return df.withColumn("stamped", F.col("rejected_at").isNotNull()).drop("rejected_at")


@probe(
    "b3_issue_labels",
    """
    SELECT *, 'negative_value' AS issue_type, 'c_acctbal' AS failed_column,
           'must_be_non_negative' AS check_type
    FROM customer WHERE c_acctbal < 0
    """,
)
def b3(t):
    return C.label(
        t.customer.where("c_acctbal < 0"),
        issue_type="negative_value",
        failed_column="c_acctbal",
        check_type="must_be_non_negative",
    )


@probe("b4_row_id", "SELECT *, true AS only_once FROM lineitem")
def b4(t):
    """Every line with its id, which no other line has."""
    ids = C.with_row_id(t.lineitem)
    once = F.count(F.lit(1)).over(Window.partitionBy("index")) == 1
    return ids.withColumn("only_once", once).drop("index")


@probe(
    "b4_stable_row_id",
    "SELECT count(*) AS n_rows, count(*) AS n_ids FROM (SELECT DISTINCT * FROM orders)",
)
def b4_stable(t):
    ids = C.with_row_id(t.orders.distinct(), stable=t.orders.columns)
    return ids.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("index").alias("n_ids"))


@probe("b5_unit_conversion", "SELECT l_orderkey, l_linenumber, l_quantity, l_quantity / 60 AS minutes FROM lineitem")
def b5(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return C.with_scaled(lines, "l_quantity", "minutes", 60)


@probe(
    "b6_role_projection",
    """
    SELECT s_suppkey, home_n_nationkey, home_name, home_region
    FROM supplier JOIN (SELECT n_nationkey AS home_n_nationkey, n_name AS home_name,
                               n_regionkey AS home_region FROM nation)
    ON s_nationkey = home_n_nationkey
    """,
)
def b6(t):
    home = C.as_role(t.nation, "home", "n_nationkey", {"n_name": "name", "n_regionkey": "region"})
    joined = t.supplier.join(home, F.col("s_nationkey") == F.col("home_n_nationkey"))
    return joined.select("s_suppkey", "home_n_nationkey", "home_name", "home_region")


@probe(
    "b8_venue_label",
    """
    SELECT o_orderkey, s_suppkey,
           CASE WHEN c_nationkey = s_nationkey THEN 'Home' ELSE 'Away' END AS venue
    FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) ON l_suppkey = s_suppkey
    """,
)
def b8(t):
    pairs = t.lineitem.select("l_orderkey", "l_suppkey").distinct()
    sellers = t.supplier.where("s_acctbal >= 0")
    joined = (
        pairs.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    )
    return joined.select(
        "o_orderkey", "s_suppkey", C.venue("c_nationkey", "s_nationkey").alias("venue")
    )


@probe(
    "b9_clean_numeric",
    "SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS discount FROM lineitem",
)
def b9(t):
    text = F.when(F.col("l_discount") == 0, F.lit("NA")).otherwise(F.col("l_discount").cast("string"))
    lines = t.lineitem.withColumn("text", text)
    return lines.select("l_orderkey", "l_linenumber", C.clean_numeric("text").alias("discount"))


@probe("b10_negative", "SELECT * FROM customer WHERE c_acctbal < 0")
def b10_negative(t):
    return t.customer.where(F.col("c_acctbal") < 0)


@probe("b10_not_negative", "SELECT * FROM supplier WHERE s_acctbal >= 0")
def b10_not_negative(t):
    return t.supplier.where(F.col("s_acctbal") >= 0)


@probe("b10_equal", "SELECT * FROM events WHERE event_type = 'click'")
def b10_equal(t):
    return t.events.where(F.col("event_type") == "click")


@probe("b10_greater", "SELECT * FROM part WHERE p_size > 40")
def b10_greater(t):
    return t.part.where(F.col("p_size") > 40)


@probe("b10_is_null", f"SELECT * FROM ({LABELLED_SQL}) WHERE quality IS NULL")
def b10_is_null(t):
    return labelled(t).where(F.col("quality").isNull())


@probe("b10_not_null", f"SELECT * FROM ({LABELLED_SQL}) WHERE toxic IS NOT NULL")
def b10_not_null(t):
    return labelled(t).where(F.col("toxic").isNotNull())


@probe(
    "b10_is_nan",
    "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount = 0",
)
def b10_is_nan(t):
    ratio = F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_discount"))
    lines = t.lineitem.withColumn("ratio", ratio).where(F.isnan("ratio"))
    return lines.select("l_orderkey", "l_linenumber", "l_discount")


@probe("b10_in_list", "SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def b10_in_list(t):
    return t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))


@probe("b10_not_in_list", "SELECT * FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def b10_not_in_list(t):
    return t.orders.where(~F.col("o_orderstatus").isin("F", "O"))


@probe(
    "b10_any_of",
    f"SELECT * FROM ({LABELLED_SQL}) WHERE quality IS NULL OR toxic = 1 OR n_chars > 5000",
)
def b10_any_of(t):
    return labelled(t).where(
        F.col("quality").isNull() | (F.col("toxic") == 1) | (F.col("n_chars") > 5000)
    )


@probe("b10_sql_text", "SELECT * FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 45")
def b10_sql_text(t):
    return t.lineitem.where("l_returnflag = 'R' AND l_quantity >= 45")


@probe("b11_drop_columns", "SELECT * EXCLUDE (props, value) FROM events")
def b11(t):
    return t.events.drop("props", "value")


@probe(
    "b12_composite_key",
    """
    SELECT l_orderkey, l_linenumber,
           cast(l_orderkey as varchar) || '_' || cast(l_linenumber as varchar) AS row_key
    FROM lineitem
    """,
)
def b12(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", C.composite_key(["l_orderkey", "l_linenumber"]).alias("row_key")
    )


@probe(
    "b12_composite_key_nulls",
    rf"""
    SELECT doc_id, lang || '_' || coalesce(cast(quality as varchar), '\N') AS row_key
    FROM ({LABELLED_SQL})
    """,
)
def b12_nulls(t):
    return labelled(t).select("doc_id", C.composite_key(["lang", "quality"]).alias("row_key"))


@probe(
    "b14_full_name",
    """
    SELECT c_custkey, c_mktsegment || ' ' || coalesce(n_name, '') AS full_name
    FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0)
    ON c_nationkey = n_nationkey
    """,
)
def b14(t):
    nations = t.nation.where("n_regionkey <> 0")
    joined = t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select("c_custkey", C.full_name("c_mktsegment", "n_name").alias("full_name"))


@probe(
    "b15_safe_ratio",
    "SELECT l_orderkey, l_linenumber, l_tax / nullif(l_discount, 0) AS ratio FROM lineitem",
)
def b15(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", C.safe_ratio("l_tax", "l_discount").alias("ratio")
    )


@probe(
    "b16_season_start",
    "SELECT o_orderkey, cast(year(o_orderdate) as integer) AS season FROM orders",
)
def b16(t):
    year = F.year("o_orderdate")
    text = F.concat(year.cast("string"), (year + 1).cast("string"))
    return t.orders.select("o_orderkey", C.season_start(text).alias("season"))


@probe(
    "b17_null_reason",
    f"""
    SELECT doc_id, CASE WHEN quality IS NOT NULL THEN NULL
                        WHEN lang = 'en' THEN 'english_not_labelled'
                        WHEN n_chars < 500 THEN 'short'
                        ELSE 'unexplained' END AS reason
    FROM ({LABELLED_SQL})
    """,
)
def b17(t):
    rules = {"english_not_labelled": F.col("lang") == "en", "short": F.col("n_chars") < 500}
    return labelled(t).select("doc_id", C.null_reason("quality", rules).alias("reason"))


@probe("b18_parse_timestamp", "SELECT o_orderkey, o_orderdate AS parsed FROM orders")
def b18(t):
    text = F.col("o_orderdate").cast("string")
    return t.orders.select("o_orderkey", C.to_ts(text).alias("parsed"))


@probe(
    "a7_table_name",
    r"""
    SELECT page_id, regexp_replace(regexp_extract(url, '[^/]*$'), '\.[^.]*$', '') AS table_name
    FROM pages
    """,
)
def a7(t):
    tail = F.substring_index("url", "/", -1)
    return t.pages.select("page_id", C.table_name(tail).alias("table_name"))
