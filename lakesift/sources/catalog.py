"""Namespaces, tables and layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

STAMP = "%Y%m%d_%H%M%S"


def stamp(ts: datetime | None = None) -> str:
    """yyyyMMdd_HHmmss in UTC."""
    return (ts or datetime.now(timezone.utc)).strftime(STAMP)


def staging_namespace(ts: datetime) -> str:
    """Name of the namespace of one run: staging_yyyyMMdd_HHmm."""
    return "staging_" + ts.strftime("%Y%m%d_%H%M")


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> str:
    """Create the namespace if it is missing."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")
    return name


def single_namespace(names: Sequence[str]) -> str:
    """The one namespace all files of a run were loaded into."""
    distinct = set(names)
    if len(distinct) != 1:
        raise ValueError(f"expected one staging namespace, found {sorted(distinct)}")
    return distinct.pop()


def list_tables(spark: SparkSession, namespace: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(namespace) if not t.isTemporary)


def load_namespace(spark: SparkSession, namespace: str) -> dict[str, DataFrame]:
    """Every table of a namespace as a lazy frame."""
    return {t: spark.table(f"{namespace}.{t}") for t in list_tables(spark, namespace)}


def load_layer(spark: SparkSession, root: str, tables: Sequence[str], suffix: str = "") -> dict[str, DataFrame]:
    """The named tables of a path layer as lazy frames."""
    return {t: spark.read.parquet(f"{root.rstrip('/')}/{t}{suffix}") for t in tables}


def load_required(
    tables: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]]
) -> dict[str, DataFrame]:
    """Only the named columns of the named tables; the scan reads nothing else."""
    return {t: tables[t].select(*cols) for t, cols in required.items()}


def write_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Write a managed catalog table."""
    df.write.mode(mode).saveAsTable(name)


def buckets_for(df: DataFrame, least: int = 16, rows_per_bucket: int = 500_000) -> int:
    """Number of buckets that grows with the table, so that what one task sorts and groups does not."""
    return max(least, -(-df.count() // rows_per_bucket))


def write_buckets(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> None:
    """Write a managed table in buckets of its join key, each one sorted file.

    Tables in equally many buckets of one another's key are joined on it, and grouped by it and further columns,
    without a shuffle. The rows of one key lie in one file, so this is for keys none of which holds a large share.
    """
    dealt = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def write_layer(tables: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """Overwrite each table of a path layer; returns the paths."""
    paths = {t: f"{root.rstrip('/')}/{t}" for t in tables}
    for t, df in tables.items():
        df.write.mode("overwrite").parquet(paths[t])
    return paths
