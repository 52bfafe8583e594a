"""Measures over a published fact, evaluated per group and under filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesift.functions.columns import current_values, rate, safe_ratio, season_start


def slice_by(df: DataFrame, filters: Mapping[str, object]) -> DataFrame:
    """Keep the rows a dashboard selection leaves: equality or membership per column."""
    for col, wanted in filters.items():
        if isinstance(wanted, (list, tuple, set)):
            df = df.where(F.col(col).isin(*wanted))
        else:
            df = df.where(F.col(col) == F.lit(wanted))
    return df


def measure_sum(df: DataFrame, by: Sequence[str], cols: Mapping[str, str]) -> DataFrame:
    """Additive measures: ``{result: column}`` summed per group."""
    return df.groupBy(*by).agg(*[F.sum(c).alias(name) for name, c in cols.items()])


def measure_rate(
    df: DataFrame, by: Sequence[str], nums: Mapping[str, str], time: str, per: float = 60
) -> DataFrame:
    """Ratio of sums per unit of time, not the mean of row rates; null on zero time."""
    return df.groupBy(*by).agg(
        *[rate(F.sum(c), F.sum(time), per).alias(name) for name, c in nums.items()]
    )


def measure_ratio(df: DataFrame, by: Sequence[str], num: str, den: str, out: str = "ratio") -> DataFrame:
    """Ratio of two sums; null on a zero denominator."""
    return df.groupBy(*by).agg(safe_ratio(F.sum(num), F.sum(den)).alias(out))


def measure_set(
    df: DataFrame,
    by: Sequence[str],
    sums: Mapping[str, str],
    rates: Mapping[str, str],
    time: str,
    per: float = 60,
) -> DataFrame:
    """A fixed set of sums and of rates of sums, in one aggregate."""
    every = {name: F.sum(c).alias(name) for name, c in sums.items()}
    every |= {name: rate(F.sum(c), F.sum(time), per).alias(name) for name, c in rates.items()}
    return df.groupBy(*by).agg(*every.values())


def _season_totals(df: DataFrame, by: Sequence[str], season: str, measure: str) -> DataFrame:
    """Totals per season; a text such as 19951996 counts as the year it starts in."""
    if isinstance(df.schema[season].dataType, T.StringType):
        df = df.withColumn(season, season_start(season))
    return df.groupBy(*by, season).agg(F.sum(measure).cast("double").alias("current"))


def _with_previous(df: DataFrame, by: Sequence[str], season: str, measure: str) -> DataFrame:
    """Season totals with the total of exactly one season earlier.

    The range frame looks at season - 1 only, so a gap year has no previous
    value. A partition holds one row per season, whatever the size of the fact.
    """
    window = Window.partitionBy(*by).orderBy(season).rangeBetween(-1, -1)
    return _season_totals(df, by, season, measure).withColumn(
        "previous", F.sum("current").over(window)
    )


def _change() -> Column:
    return F.coalesce(F.col("current"), F.lit(0.0)) - F.col("previous")


def yoy_diff(df: DataFrame, by: Sequence[str], season: str, measure: str, out: str = "change") -> DataFrame:
    """Difference to the previous season; null without one."""
    return _with_previous(df, by, season, measure).withColumn(out, _change())


def yoy_pct(df: DataFrame, by: Sequence[str], season: str, measure: str, out: str = "pct_change") -> DataFrame:
    """Percentage change to the previous season; 0 on a zero base, null without one."""
    pct = F.coalesce(F.try_divide(_change(), F.col("previous")), F.lit(0.0)) * F.lit(100.0)
    return _with_previous(df, by, season, measure).withColumn(
        out, F.when(F.col("previous").isNotNull(), pct)
    )


def span_pct(df: DataFrame, by: Sequence[str], season: str, measure: str, out: str = "pct_change") -> DataFrame:
    """Percentage change from the first to the last season of each group.

    0 when the base is zero or missing, hence 0 for a single season.
    """
    ends = (
        _season_totals(df, by, season, measure)
        .where(F.col(season).isNotNull())
        .groupBy(*by)
        .agg(
            F.min_by("current", season).alias("first_value"),
            F.max_by("current", season).alias("last_value"),
        )
    )
    zero = F.lit(0.0)
    diff = F.coalesce(F.col("last_value"), zero) - F.coalesce(F.col("first_value"), zero)
    return ends.withColumn(
        out, F.coalesce(F.try_divide(diff, F.col("first_value")), zero) * F.lit(100.0)
    )


def next_season(df: DataFrame, by: Sequence[str], season: str, out: str = "next_season") -> DataFrame:
    """Season + 1 for groups that hold a single season, else null."""
    return df.groupBy(*by).agg((current_values(season) + 1).alias(out))


def most_improved(df: DataFrame, by: str, season: str, measure: str, k: int) -> DataFrame:
    """The k groups with the largest first-to-last change; ties by group."""
    ranked = span_pct(df, [by], season, measure)
    return ranked.orderBy(F.col("pct_change").desc_nulls_last(), F.col(by).asc()).limit(k)
