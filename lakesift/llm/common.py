"""What the corpus operators share: the query registry, session limits and small column helpers."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesift.session import materialize, tune

#: Between Spark and a Python worker: batches small enough for very long texts.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 * 1024 * 1024),
}

#: Fixed by the contracts: what separates words.
SPACES = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def ship(spark: SparkSession) -> None:
    """Send the library's code to the executors, once for each application."""
    context = spark.sparkContext
    if not any("lakesift-code" in f for f in context.listFiles):
        root = Path(__file__).resolve().parents[2]
        packed = shutil.make_archive(f"{tempfile.mkdtemp(prefix='run-')}/lakesift-code", "zip", root, "lakesift")
        context.addPyFile(packed)


def prepare(spark: SparkSession) -> SparkSession:
    """The library's run-time options, bounded batches to Python workers, and the code they need."""
    tune(spark)
    ship(spark)
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    return spark


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, folder)`` under ``key`` with its SQL counterpart."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[key] = Query(lambda spark, folder: fn(prepare(spark), folder.rstrip("/")), sql)
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(col: str) -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def one_space(text: Column) -> Column:
    """Each run of white space as one space.

    Single spaces need no replacement, so only other runs are matched.
    """
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; see ``materialize``.

    The shuffle files of steps that are over are given up as soon as the driver has collected their plans, which
    a driver with little to do would put off for long.
    """
    out = materialize(df, label)
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def shuffled(side: DataFrame) -> DataFrame:
    """Join by shuffling also where this side is small: what a step moves then grows with the input at every size."""
    return side.hint("merge")
