"""Expectation suites: many column rules, one aggregate, one report row per rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Between:
    """Values lie in [low, high]; either end may be open, nulls pass."""

    column: str
    low: object = None
    high: object = None

    name = "between"

    def measure(self, df: DataFrame) -> Column:
        outside = F.lit(False)
        if self.low is not None:
            outside = outside | (F.col(self.column) < F.lit(self.low))
        if self.high is not None:
            outside = outside | (F.col(self.column) > F.lit(self.high))
        return F.count_if(outside)

    def status(self, measured: Column) -> Column:
        return F.when(measured == 0, F.lit("pass")).otherwise(F.lit("fail"))


@dataclass(frozen=True)
class InSet:
    """Values belong to a short list; nulls pass."""

    column: str
    values: tuple

    name = "in_set"

    def measure(self, df: DataFrame) -> Column:
        return F.count_if(~F.col(self.column).isin(*self.values))

    def status(self, measured: Column) -> Column:
        return F.when(measured == 0, F.lit("pass")).otherwise(F.lit("fail"))


@dataclass(frozen=True)
class NotNull:
    """No value is missing."""

    column: str

    name = "not_null"

    def measure(self, df: DataFrame) -> Column:
        return F.count_if(F.col(self.column).isNull())

    def status(self, measured: Column) -> Column:
        return F.when(measured == 0, F.lit("pass")).otherwise(F.lit("fail"))


@dataclass(frozen=True)
class NullShare:
    """Share of nulls: above ``fail`` fails, above ``warn`` warns and passes."""

    column: str
    warn: float = 0.0
    fail: float = 1.0

    name = "null_share"

    def measure(self, df: DataFrame) -> Column:
        return F.coalesce(F.avg(F.col(self.column).isNull().cast("int")), F.lit(0.0))

    def status(self, measured: Column) -> Column:
        return (
            F.when(measured > self.fail, F.lit("fail"))
            .when(measured > self.warn, F.lit("warn"))
            .otherwise(F.lit("pass"))
        )


@dataclass(frozen=True)
class ColumnCount:
    """The table has exactly n columns."""

    n: int
    column: str | None = None

    name = "column_count"

    def measure(self, df: DataFrame) -> Column:
        return F.lit(abs(len(df.columns) - self.n))

    def status(self, measured: Column) -> Column:
        return F.when(measured == 0, F.lit("pass")).otherwise(F.lit("fail"))


Expectation = Between | InSet | NotNull | NullShare | ColumnCount


def run_suite(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """Evaluate a suite in one pass over the columns it names.

    ``measured`` is a count of unexpected values, or the null share; ``missing``
    counts the nulls of the column.
    """

    def missing(e: Expectation) -> Column:
        return F.lit(None) if e.column is None else F.count_if(F.col(e.column).isNull())

    measured = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[e.measure(df).cast("double").alias(f"m{i}") for i, e in enumerate(suite)],
        *[missing(e).cast("bigint").alias(f"n{i}") for i, e in enumerate(suite)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(e.name).alias("expectation"),
                F.lit(e.column).cast("string").alias("column"),
                F.col(f"n{i}").alias("missing"),
                F.col(f"m{i}").alias("measured"),
                e.status(F.col(f"m{i}")).alias("status"),
                (e.status(F.col(f"m{i}")) != "fail").alias("success"),
            )
            for i, e in enumerate(suite)
        ]
    )
    return measured.select("n_rows", F.explode(entries).alias("e")).select("n_rows", "e.*")


def non_negative_suite(columns: Sequence[str], column_count: int | None = None) -> list[Expectation]:
    """Every listed column at least 0, and optionally a fixed number of columns."""
    suite: list[Expectation] = [Between(c, low=0) for c in columns]
    return suite if column_count is None else [*suite, ColumnCount(column_count)]


def suite_summary(results: DataFrame) -> DataFrame:
    """Evaluated, successful, unsuccessful, success percentage, overall answer."""
    n, good = F.count(F.lit(1)), F.count_if("success")
    return results.agg(
        n.alias("evaluated"),
        good.alias("successful"),
        (n - good).alias("unsuccessful"),
        (good / n * 100).alias("success_percent"),
        F.bool_and("success").alias("success"),
    )


def failures(results: DataFrame) -> DataFrame:
    return results.where(~F.col("success"))


def gate(*results: DataFrame) -> bool:
    """May the tables be published? True only if every suite passed; no suite, no objection.

    Suites whose results were collected are judged by :func:`passed`.
    """
    return all(passed(r.select("success").collect()) for r in results)


def passed(rows: Sequence[Row]) -> bool:
    """Did every evaluated expectation hold?"""
    return all(r["success"] for r in rows)


def expect_in_table(df: DataFrame, col: str, allowed: DataFrame, allowed_col: str) -> DataFrame:
    """Category whitelist of any length, given as a table; nulls pass."""
    from lakesift.operators.joins import orphans

    present = df.where(F.col(col).isNotNull())
    unexpected = F.count(F.lit(1))
    return orphans(present, allowed, col, allowed_col).agg(
        unexpected.alias("unexpected"), (unexpected == 0).alias("success")
    )
