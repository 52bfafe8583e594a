"""Ordered numbering inside groups of any size, sorting and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesift.operators.keys import prefixed, same_keys_condition, sortable
from lakesift.session import materialize


def content_hash(df: DataFrame, ignore: Sequence[str] = ()) -> Column:
    """A number made of the whole row: short to compare, equal in every run."""
    return F.xxhash64(*[c for c in sortable(df) if c not in ignore])


def total_order(df: DataFrame, order: Sequence[Column], ignore: Sequence[str] = ()) -> list[Column]:
    """``order`` completed by the row's content, so that every run picks the same rows.

    ``ignore`` names columns that differ from run to run, such as surrogate ids and load times.
    """
    rest = [F.col(c).asc_nulls_first() for c in sortable(df) if c not in ignore]
    return [*order, content_hash(df, ignore).asc(), *rest]


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    weight: str | None = None,
    out: str = "running_total",
    spread: bool = False,
) -> DataFrame:
    """Running sum of ``weight`` (1 by default) per key in a total order.

    Ties in ``order`` are settled by the row's content. A sum is null until the
    first weight that is not. The type is that of a sum of the weight.

    The caller chooses the plan; rows and types are the same either way (sums of
    doubles but for rounding). By default a window sorts each group in one task,
    on disk where it must. With ``spread`` the rows are range-partitioned over
    keys *and* order into ``spark.sql.shuffle.partitions`` parts, which spreads a
    hot key, or a table without keys, over many tasks; each part numbers its own
    rows and adds what earlier parts hold of the same key. Only a part's first
    key can reach back, so there is at most one offset per part. The rows are
    stored before the partitioning, so that a lost executor does not repeat the
    row ids that split equal rows.
    """
    amount = F.lit(1) if weight is None else F.col(weight)
    upto_here = (Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys).orderBy(*total_order(df, order)).rowsBetween(*upto_here)
    plain = df.withColumn(out, F.sum(amount).over(whole))
    if not spread:
        return plain

    kind = plain.schema[out].dataType
    tied = materialize(
        df.withColumns({"_hash": content_hash(df), "_tie": F.monotonically_increasing_id()}),
        "tied",
    )
    content = [F.col(c).asc_nulls_first() for c in sortable(df)]
    by = [*order, F.col("_hash").asc(), *content, F.col("_tie").asc()]
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = tied.repartitionByRange(n_parts, *[F.col(k) for k in keys], *by)
    parts = ranged.withColumn("_part", F.spark_partition_id())

    earlier = (
        Window.partitionBy(*keys)
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        parts.groupBy(*keys, "_part")
        .agg(F.sum(amount).alias("_n"))
        .withColumn("_before", F.sum("_n").over(earlier).cast(kind))
        .where(F.col("_before").isNotNull())
        .drop("_n")
    )
    on = [*keys, "_part"]
    window = Window.partitionBy(*on).orderBy(*by).rowsBetween(*upto_here)
    numbered = parts.withColumn("_here", F.sum(amount).over(window))
    joined = numbered.join(
        F.broadcast(prefixed(offsets, on, "_o_")), same_keys_condition(on, "_o_"), "left"
    )
    here, before = F.col("_here"), F.col("_before")
    total = F.when(before.isNull(), here).otherwise(before + F.coalesce(here, F.lit(0)))
    return joined.select(*df.columns, total.cast(kind).alias(out))


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    out: str = "row_number",
    spread: bool = True,
) -> DataFrame:
    """1, 2, 3, ... per key; ties are settled by the row's content.

    By default the rows are spread over range partitions, see :func:`running_total`;
    callers who know that all groups are small can number each in one task.
    """
    return running_total(df, keys, order, None, out, spread)


def first_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Multi-key sort and the first n rows; every task keeps n rows at most."""
    return df.orderBy(*order).limit(n)


def top_k(df: DataFrame, key: str, k: int, ascending: bool = False) -> DataFrame:
    """The k keys with most (or fewest) rows; ties by key."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    by_count = F.col("n_rows").asc() if ascending else F.col("n_rows").desc()
    return first_rows(counts, [by_count, F.col(key).asc()], k)


def has_rows(df: DataFrame) -> bool:
    """True if at least one row exists; stops at the first."""
    return not df.isEmpty()
