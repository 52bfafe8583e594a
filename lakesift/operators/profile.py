"""Table profiling: counts, nulls, ranges, statistics, and why values are missing.

Every profile is one aggregate, or one aggregate per distinct-value question;
none collects values into arrays or onto the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesift.operators.ordering import first_rows, running_total
from lakesift.session import materialize


def _long(agg: DataFrame, names: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn one row with a struct per column into one row per column."""
    entries = F.array(
        *[
            F.struct(F.lit(n).alias("column"), *[F.col(f"`{n}`.`{f}`").alias(f) for f in fields])
            for n in names
        ]
    )
    return agg.select(F.explode(entries).alias("e")).select("e.*")


def row_count(df: DataFrame, out: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(out))


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Total rows, distinct rows and the surplus, from one grouping."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    total = F.coalesce(F.sum("_n"), F.lit(0))
    return groups.agg(
        total.alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        (total - F.count(F.lit(1))).alias("duplicate_rows"),
    )


# -- nulls -------------------------------------------------------------------


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of nulls of every column."""
    return df.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def null_pct(df: DataFrame) -> DataFrame:
    """One row: the percentage of nulls of every column; null for an empty table."""
    n = F.count(F.lit(1))
    return df.select(
        *[(F.try_divide(F.count_if(F.col(c).isNull()), n) * F.lit(100.0)).alias(c) for c in df.columns]
    )


def total_nulls(df: DataFrame, out: str = "total_nulls") -> DataFrame:
    """Null cells of the whole table."""
    counts = [F.count_if(F.col(c).isNull()) for c in df.columns]
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    return df.select(total.alias(out))


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, rows and non-null count."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    agg = df.agg(
        *[
            F.struct(
                F.lit(types[c]).alias("data_type"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count(F.col(c)).alias("non_null"),
            ).alias(c)
            for c in df.columns
        ]
    )
    return _long(agg, df.columns, ["data_type", "n_rows", "non_null"])


# -- distinct values ---------------------------------------------------------


def distinct_counts(df: DataFrame, approximate: bool = False, rsd: float = 0.02) -> DataFrame:
    """One row: distinct non-null values per column.

    The exact form reads every column by itself, so no row is multiplied by the
    number of columns, and shuffles its distinct values, pre-aggregated per map
    task. Store a frame first that is costly to compute. The approximate form
    shuffles sketches of fixed size only.
    """
    if approximate:
        return df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in df.columns])
    counts = [
        df.select(F.col(c).alias("value")).where("value IS NOT NULL").distinct().agg(F.lit(i).alias("at"), F.count(F.lit(1)).alias("n"))
        for i, c in enumerate(df.columns)
    ]
    every = reduce(DataFrame.unionAll, counts)
    return every.agg(*[F.max(F.when(F.col("at") == i, F.col("n"))).alias(c) for i, c in enumerate(df.columns)])


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def values_by_category(df: DataFrame, category: str, col: str) -> DataFrame:
    """Which values occur inside each category, as rows with their counts."""
    return df.groupBy(category, col).agg(F.count(F.lit(1)).alias("n_rows"))


def frequency(df: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Rows per key, most frequent first."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    order = [F.col("n_rows").desc(), F.col(key).asc()]
    return counts.orderBy(*order) if limit is None else first_rows(counts, order, limit)


# -- ranges and statistics ---------------------------------------------------


def min_max(df: DataFrame, col: str, by: str | Column | None = None) -> DataFrame:
    """Minimum and maximum, of the table or per group (for example a null flag)."""
    keys = [] if by is None else [by]
    return df.groupBy(*keys).agg(F.min(col).alias("min_value"), F.max(col).alias("max_value"))


def quantiles(df: DataFrame, col: str, points: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation: one row (point, value) each.

    Values are counted first and the counts summed in value order over range
    partitions, so no task sees the whole column. Each point then needs only the
    two values around its position.
    """
    counts = materialize(
        df.where(F.col(col).isNotNull())
        .groupBy(F.col(col).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("_n")),
        "value-counts",
    )
    ranks = running_total(counts, [], [F.col("value").asc()], "_n", "_upto", spread=True)
    total = counts.agg(F.sum("_n").alias("n")).scalar()
    wanted = []
    for p in points:
        at = (total - 1) * F.lit(float(p))
        for side, position in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            hit = (F.col("_upto") - F.col("_n") <= position) & (position < F.col("_upto"))
            wanted.append(F.max(F.when(hit, F.col("value"))).alias(f"{side}_{p}"))
    picked = ranks.agg(*wanted)
    rows = []
    for p in points:
        at = (total - 1) * F.lit(float(p))
        lo, hi = F.col(f"`lo_{p}`"), F.col(f"`hi_{p}`")
        value = lo + (hi - lo) * (at - F.floor(at))
        rows.append(F.struct(F.lit(float(p)).alias("point"), value.alias("value")))
    return picked.select(F.explode(F.array(*rows)).alias("e")).select("e.*")


def summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, standard deviation, minimum, maximum."""
    agg = df.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).cast("double").alias("mean"),
                F.stddev_samp(F.col(c).cast("double")).alias("stddev"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in cols
        ]
    )
    return _long(agg, cols, ["count", "mean", "stddev", "min", "max"])


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins between minimum and maximum, empty bins included.

    The last bin includes its upper end. The bounds come from a scalar
    subquery, so the plan stays lazy and has no join on the data side.
    """
    value = F.col(col).cast("double")
    known = df.where(value.isNotNull() & ~F.isnan(value))
    bounds = known.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("b")).scalar()
    lo, hi = bounds.getField("lo"), bounds.getField("hi")
    width = (hi - lo) / F.lit(bins)
    raw = F.floor(F.try_divide(value - lo, width)).cast("int")
    bin_no = F.greatest(F.lit(0), F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1)))
    counts = known.groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return edges.join(counts, "bin", "left").select(
        "bin",
        (lo + width * F.col("bin")).alias("lower"),
        (lo + width * (F.col("bin") + 1)).alias("upper"),
        F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("n_rows"),
    )


# -- explanations for missing values -----------------------------------------


def check_co_null(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Are the columns null on the same keys? One row per column after the first.

    ``mixed_*`` counts keys that have both null and non-null rows.
    """
    flags = [F.bool_or(F.col(c).isNull()).alias(f"_null_{c}") for c in cols]
    full = [F.bool_or(F.col(c).isNotNull()).alias(f"_full_{c}") for c in cols]
    per_key = df.groupBy(key).agg(*flags, *full)
    first, others = cols[0], list(cols[1:])
    agg = per_key.agg(
        *[
            F.struct(
                F.count_if(f"_null_{first}").alias("null_keys_first"),
                F.count_if(f"_null_{c}").alias("null_keys"),
                F.count_if(F.col(f"_null_{first}") != F.col(f"_null_{c}")).alias("differing_keys"),
                F.count_if(F.col(f"_null_{c}") & F.col(f"_full_{c}")).alias("mixed_keys"),
            ).alias(c)
            for c in others
        ]
    )
    long = _long(agg, others, ["null_keys_first", "null_keys", "differing_keys", "mixed_keys"])
    return long.withColumn("co_null", (F.col("differing_keys") == 0) & (F.col("mixed_keys") == 0))


def check_null_iff(df: DataFrame, col: str | Column, condition: Column) -> DataFrame:
    """Is the value null exactly where the condition holds?"""
    target = F.col(col) if isinstance(col, str) else col
    holds = F.coalesce(condition, F.lit(False))
    violations = F.count_if(target.isNull() != holds)
    return df.agg(
        F.count_if(target.isNull()).alias("null_rows"),
        F.count_if(holds).alias("condition_rows"),
        violations.alias("violations"),
        (violations == 0).alias("explained"),
    )


def null_share_by_category(df: DataFrame, category: str, col: str) -> DataFrame:
    """Rows, nulls and null share of a column inside each category."""
    n, nulls = F.count(F.lit(1)), F.count_if(F.col(col).isNull())
    return df.groupBy(category).agg(
        n.alias("n_rows"), nulls.alias("null_rows"), (nulls / n).alias("null_share")
    )


def null_by_category(df: DataFrame, category: str, col: str) -> DataFrame:
    """Categories where the column is always, sometimes or never null."""
    status = (
        F.when(F.col("null_rows") == F.col("n_rows"), F.lit("always"))
        .when(F.col("null_rows") > 0, F.lit("sometimes"))
        .otherwise(F.lit("never"))
    )
    return null_share_by_category(df, category, col).withColumn("null_status", status)


def null_period(df: DataFrame, ts: str, col: str) -> DataFrame:
    """Time ranges of null and non-null rows, and whether they overlap."""
    missing = F.col(col).isNull()
    ends = df.agg(
        F.min(F.when(missing, F.col(ts))).alias("null_from"),
        F.max(F.when(missing, F.col(ts))).alias("null_to"),
        F.min(F.when(~missing, F.col(ts))).alias("value_from"),
        F.max(F.when(~missing, F.col(ts))).alias("value_to"),
    )
    meets = (F.col("null_from") <= F.col("value_to")) & (F.col("value_from") <= F.col("null_to"))
    return ends.withColumn("overlap", F.coalesce(meets, F.lit(False)))
