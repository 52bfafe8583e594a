from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakesift.session import tune

NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


class Tables:
    """The test tables of one folder, opened on first use: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


@dataclass(frozen=True)
class Probe:
    key: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


PROBES: dict[str, Probe] = {}


def probe(key: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``key`` with its SQL counterpart."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(tune(spark), folder))

        if key in PROBES:
            raise ValueError(f"{key} is registered twice")
        PROBES[key] = Probe(key, run, sql)
        return fn

    return register


def sql_round(expr: str, digits: int = 2) -> str:
    """Half-up rounding of a double on its shortest decimal text."""
    return f"cast(round(cast(cast({expr} as varchar) as decimal(38,20)), {digits}) as double)"


def sql_money(expr: str) -> str:
    """Sum of a two-digit double column that does not depend on row order."""
    return f"cast(sum(cast({expr} as decimal(18,2))) as double)"
