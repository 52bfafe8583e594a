"""Duplicate search, survivors, copies and set comparison of key columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesift.functions.columns import composite_key
from lakesift.operators.keys import prefixed, same_keys_condition
from lakesift.operators.ordering import number_rows, total_order
from lakesift.session import materialize

# Copies of one row that a single task writes out.
COPIES_PER_TASK = 1_000_000
# Rows of one key that a single task numbers in any case.
ROWS_PER_KEY = 1_000


def duplicate_keys(df: DataFrame, keys: Sequence[str], out: str = "n_rows") -> DataFrame:
    """Keys that occur more than once, with their row count; nulls form one group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """:func:`duplicate_keys` as a stored table.

    Its true size lets the planner broadcast it when it is small, as it is for a
    key that is meant to be unique. Then no full row is shuffled, only keys.
    """
    return materialize(duplicate_keys(df, keys), "repeated-keys")


def duplicate_rows(df: DataFrame, keys: Sequence[str], dup_keys: DataFrame | None = None) -> DataFrame:
    """All rows whose key occurs more than once; nulls compare equal.

    Groups are counted with map-side pre-aggregation and joined back, so no
    task has to hold a whole group.
    """
    dups = repeated_keys(df, keys) if dup_keys is None else dup_keys
    right = prefixed(dups.select(*keys), keys, "_d_")
    return df.join(right, same_keys_condition(keys, "_d_"), "left_semi")


def unique_rows(df: DataFrame, keys: Sequence[str], dup_keys: DataFrame) -> DataFrame:
    """The complement of :func:`duplicate_rows`."""
    right = prefixed(dup_keys.select(*keys), keys, "_d_")
    return df.join(right, same_keys_condition(keys, "_d_"), "left_anti")


def flag_dupes(df: DataFrame, keys: Sequence[str], out: str = "key_count") -> DataFrame:
    """Every row with the number of rows that share its key."""
    dups = prefixed(repeated_keys(df, keys), keys, "_d_").withColumnRenamed("n_rows", "_n")
    return df.join(dups, same_keys_condition(keys, "_d_"), "left").select(
        *df.columns, F.coalesce(F.col("_n"), F.lit(1)).cast("bigint").alias(out)
    )


def keep_best(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] = (),
    ignore: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the first in ``order``, ties settled by the row's content
    except the columns of ``ignore``.

    The filter on row number 1 lets the planner keep one row per key on the map
    side already, so a hot key is reduced before the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(*total_order(df, order, ignore))
    return (
        df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") == 1).drop("_rn")
    )


def latest_complete(column: str) -> list[Column]:
    """Order for :func:`keep_best`: present before missing, then latest."""
    return [F.col(column).desc_nulls_last()]


def dedupe(df: DataFrame, keys: Sequence[str] | None = None, order: Sequence[Column] = ()) -> DataFrame:
    """Whole-row duplicates, or one row per key in a fixed order."""
    return keep_best(df, keys, order) if keys else df.dropDuplicates()


def _number_repeated(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], dups: DataFrame, spread: bool
) -> DataFrame:
    """The rows of repeated keys with their number ``_rn``.

    Keys with more rows than a shuffle partition gets on average, as the stored
    counts have them, are spread over range partitions; all others take a plain
    window. Rows and types are the same.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = dups.agg(F.sum("n_rows").alias("rows"), F.max("n_rows").alias("most")).first()
    share = max(ROWS_PER_KEY, (sums["rows"] or 0) // parts)
    if not spread or (sums["most"] or 0) <= share:
        return number_rows(duplicate_rows(df, keys, dups), keys, order, "_rn", False)
    hot, rest = dups.where(F.col("n_rows") > share), dups.where(F.col("n_rows") <= share)
    few = number_rows(duplicate_rows(df, keys, rest), keys, order, "_rn", False)
    return few.unionByName(number_rows(duplicate_rows(df, keys, hot), keys, order, "_rn", True))


def surplus_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], spread: bool = True
) -> DataFrame:
    """The rows that :func:`keep_best` would drop: all but the first of each key.

    Only rows of repeated keys are numbered. With ``spread`` very frequent keys
    are spread over many tasks, see :func:`lakesift.operators.ordering.number_rows`.
    """
    numbered = _number_repeated(df, keys, order, repeated_keys(df, keys), spread)
    return numbered.where(F.col("_rn") > 1).drop("_rn")


def number_copies(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    out: str = "copy_number",
    copies_per_task: int = COPIES_PER_TASK,
) -> DataFrame:
    """Number the exact copies of every row over ``cols`` (all by default).

    Copies are interchangeable, so they are counted before the shuffle and
    written out again from the count. The numbers of one row are cut into
    stretches that go to different tasks; the number of tasks is fixed, because
    sizing them by the few bytes of a count would put too many copies into one.
    """
    cols = list(cols or df.columns)
    step = F.lit(copies_per_task).cast("bigint")
    one = F.lit(1).cast("bigint")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stretches = (
        df.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_from", F.explode(F.sequence(one, F.col("_n"), step)))
        .repartition(tasks, *cols, "_from")
    )
    upto = F.least(F.col("_n"), F.col("_from") + step - 1)
    return stretches.select(*cols, F.explode(F.sequence(F.col("_from"), upto)).alias(out))


def disambiguate(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    out: str = "row_key",
    spread: bool = True,
) -> DataFrame:
    """Make a repeated composite key unique by adding a running number to it.

    Only rows of repeated keys are numbered, all others are number 1; ``spread``
    as in :func:`surplus_rows`.
    """
    dups = repeated_keys(df, keys)
    rest = unique_rows(df, keys, dups).withColumn("_rn", F.lit(1).cast("bigint"))
    repeated = _number_repeated(df, keys, order, dups, spread)
    numbered = rest.unionByName(repeated)
    key = F.concat_ws("_", composite_key(keys), F.col("_rn").cast("string"))
    return numbered.withColumn(out, key).drop("_rn")


# -- comparison of two key sets ----------------------------------------------


def _presence(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row per key of either side with two presence flags, in one shuffle."""
    left = a.select(key).withColumns({"_a": F.lit(True), "_b": F.lit(False)})
    right = b.select(key).withColumns({"_a": F.lit(False), "_b": F.lit(True)})
    return left.unionByName(right).groupBy(key).agg(
        F.bool_or("_a").alias("in_a"), F.bool_or("_b").alias("in_b")
    )


def same_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Do both sides hold the same set of keys? One row of counts and the answer."""
    only_a = F.count_if(F.col("in_a") & ~F.col("in_b"))
    only_b = F.count_if(F.col("in_b") & ~F.col("in_a"))
    return _presence(a, b, key).agg(
        F.count_if("in_a").alias("keys_a"),
        F.count_if("in_b").alias("keys_b"),
        only_a.alias("only_a"),
        only_b.alias("only_b"),
        ((only_a == 0) & (only_b == 0)).alias("same"),
    )


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Is the set of a-values part of the b-values, and do they meet at all?"""
    shared = F.count_if(F.col("in_a") & F.col("in_b"))
    only_a = F.count_if(F.col("in_a") & ~F.col("in_b"))
    return _presence(a, b, key).agg(
        shared.alias("shared"),
        only_a.alias("only_a"),
        F.count_if(F.col("in_b") & ~F.col("in_a")).alias("only_b"),
        (only_a == 0).alias("is_subset"),
        (shared > 0).alias("overlaps"),
    )
