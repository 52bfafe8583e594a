"""Wide facts: sums at a grain and rates per unit of time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesift.functions.columns import cast_columns, rate

RAW_TIME = "raw_time"


def aggregate_metrics(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    time: str,
    time_divisor: float = 60,
) -> DataFrame:
    """Sum every metric and the time at one grain: ``total_<metric>`` and ``raw_time``.

    Nulls are skipped; a group with only nulls sums to null. The time unit is
    converted after the sum, which loses no digits to repeated division.
    """
    return df.groupBy(*keys).agg(
        (F.sum(time).cast("double") / F.lit(time_divisor)).alias(RAW_TIME),
        *[F.sum(m).alias(f"total_{m}") for m in metrics],
    )


def add_rates(
    df: DataFrame, metrics: Sequence[str], time: str = RAW_TIME, per: float = 60, scale: int = 2
) -> DataFrame:
    """``<metric>_per_60`` from the unrounded time; null where no time was spent."""
    return df.withColumns(
        {f"{m}_per_{per:g}": rate(f"total_{m}", time, per, scale) for m in metrics}
    )


def finish_time(df: DataFrame, out: str, time: str = RAW_TIME, scale: int = 2) -> DataFrame:
    """Rounded time for display in place of the raw one."""
    return df.withColumn(out, F.round(F.col(time), scale)).drop(time)


def rate_fact(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    time: str,
    time_out: str,
    time_divisor: float = 60,
    per: float = 60,
    cast: Mapping[str, str] | None = None,
) -> DataFrame:
    """Sums, rates and display time in one aggregate and one projection."""
    totals = aggregate_metrics(df, keys, metrics, time, time_divisor)
    wide = finish_time(add_rates(totals, metrics, per=per), time_out)
    return cast_columns(wide, cast) if cast else wide
