"""Published tables as immutable versions behind one commit log.

A version is written once under ``versions/<table>/<stamp>`` and never changed.
The audit log decides which version is current. A publish is one numbered commit
with the rows of all its tables, so either all of them become visible or none;
of two that end at once, one takes the next number and has the other's versions
as its snapshots. Every commit names all current versions, so a read opens one
file. The version that was current before is the snapshot, at no copying cost
whatever its size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesift.operators.dedupe import keep_best
from lakesift.operators.keys import prefixed, same_keys_condition
from lakesift.session import exists, materialize
from lakesift.sources.catalog import stamp
from lakesift.sources.commits import CommitLog

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("pipeline_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("publish_ts", T.TimestampType()),
        T.StructField("gold_table", T.StringType()),
        T.StructField("staging_table", T.StringType()),
        T.StructField("snapshot_table", T.StringType()),
    ]
)


# What a table that cannot be read raises: when it is opened, or from inside a task.
READ_ERRORS = (PySparkException, Py4JJavaError)


class PublishError(Exception):
    """A staged table cannot replace its target; nothing was published."""


@dataclass(frozen=True)
class Shelf:
    """The published tables under one root folder."""

    spark: SparkSession
    root: str

    def _version(self, name: str) -> str:
        table, day, time = name.rsplit("_", 2)  # the time may carry a counter
        return f"{self.root.rstrip('/')}/versions/{table}/{day}_{time}"

    @property
    def _audit_path(self) -> str:
        return f"{self.root.rstrip('/')}/audit"

    def _free_name(self, table: str, ts: datetime | None) -> str:
        """``<table>_<stamp>``, with a counter where that stamp is taken."""
        first = name = f"{table}_{stamp(ts)}"
        taken = 1
        while exists(self.spark, self._version(name)):
            taken += 1
            name = f"{first}-{taken}"
        return name

    # -- staging -----------------------------------------------------------

    def stage(
        self,
        df: DataFrame,
        table: str,
        ts: datetime | None = None,
        cluster_by: Sequence[str] = (),
    ) -> str:
        """Write a new version without publishing it; returns ``<table>_<stamp>``.

        With cluster columns, equal values are brought together so that file
        statistics prune a later scan; small groups share a file and a hot one
        is split over several tasks.
        """
        name = self._free_name(table, ts)
        if cluster_by:
            df = df.hint("rebalance", *cluster_by).sortWithinPartitions(*cluster_by)
        df.write.parquet(self._version(name))
        return name

    def read_version(self, name: str) -> DataFrame:
        """A staged table or a snapshot by its name."""
        return self.spark.read.parquet(self._version(name))

    # -- publishing --------------------------------------------------------

    @property
    def commits(self) -> CommitLog:
        return CommitLog(self.spark, self._audit_path)

    def audit(self) -> DataFrame:
        """Every publish so far, one row per table."""
        if not self.commits.last():
            return self.spark.createDataFrame([], AUDIT_SCHEMA)
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in AUDIT_SCHEMA])
        commits = self.spark.read.schema(T.StructType([T.StructField("rows", T.ArrayType(text))])).json(self._audit_path)
        rows = commits.select(F.explode("rows").alias("r")).select("r.*")
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in AUDIT_SCHEMA])

    def current(self, table: str) -> str | None:
        """Name of the version that is published now."""
        return self.commits.head().get("current", {}).get(table, [None])[0]

    def read_published(self, table: str) -> DataFrame:
        version = self.current(table)
        if version is None:
            raise PublishError(f"table {table!r} was never published")
        return self.read_version(version)

    def snapshot(self, tables: Sequence[str]) -> dict[str, str]:
        """Names of the versions that are current now, one per published table.

        Versions never change, so each name stays readable as it is, whatever is
        published later.
        """
        names = {t: self.current(t) for t in tables}
        return {t: n for t, n in names.items() if n is not None}

    def stage_increment(
        self,
        delta: DataFrame,
        table: str,
        keys: Sequence[str],
        order: Sequence,
        ts: datetime | None = None,
    ) -> str:
        """Stage the published table with the delta merged in.

        The initial load, before anything was published, takes the delta alone,
        one row per key.
        """
        before = self.current(table)
        if before is None:
            return self.stage(keep_best(delta, keys, order), table, ts)
        return self.stage(upsert(self.read_version(before), delta, keys, order), table, ts)

    def _replacement(self, table: str, staged: str, before: str | None, ts: datetime) -> str:
        """The version that keeps the target's columns, chosen by name.

        Equal schemas promote the staged version as it is; another column order
        or extra columns need one rewrite; missing columns or other types fail.
        """
        if before is None:
            return staged
        old, new = self.read_version(before).schema, self.read_version(staged).schema
        if old == new:
            return staged
        types = {f.name: f.dataType for f in new.fields}
        wrong = [f.name for f in old.fields if types.get(f.name) != f.dataType]
        if wrong:
            raise PublishError(f"{staged} does not fit {table}: {', '.join(wrong)}")
        name = self._free_name(table, ts)
        self.read_version(staged).select(*old.names).write.parquet(self._version(name))
        return name

    def publish(
        self,
        staged: Mapping[str, str],
        pipeline_id: str,
        run_id: str,
        ts: datetime | None = None,
        recreate: bool = False,
    ) -> DataFrame:
        """Make staged versions current, all together; returns the new audit rows.

        ``recreate`` lets the schema follow the staged table. A stamp that is not
        later than a table's last publish would leave the older version current,
        so it is refused. Another publish that ends first is taken account of.
        """

        def commit(head: dict) -> dict:
            at = ts or datetime.now(timezone.utc)
            at = at if at.tzinfo else at.astimezone()
            current = dict(head.get("current", {}))
            if stale := sorted(t for t in staged if t in current and datetime.fromisoformat(current[t][1]) >= at):
                raise PublishError(f"published later than {at}: {', '.join(stale)}")
            rows = []
            for table, name in staged.items():
                before = current.get(table, [None])[0]
                version = name if recreate else self._replacement(table, name, before, at)
                rows.append(dict(zip(AUDIT_SCHEMA.names, (pipeline_id, run_id, at.isoformat(), table, version, before))))
                current[table] = [version, at.isoformat()]
            return {"rows": rows, "current": current}

        made = self.commits.add(commit)["rows"]
        rows = [tuple(datetime.fromisoformat(v) if k == "publish_ts" else v for k, v in r.items()) for r in made]
        return self.spark.createDataFrame(rows, AUDIT_SCHEMA)


# -- incremental load --------------------------------------------------------


def upsert(base: DataFrame, delta: DataFrame, keys: Sequence[str], order: Sequence, ignore: Sequence[str] = ()) -> DataFrame:
    """Base with the rows of delta merged in.

    Of a key that the delta has, the first row in ``order`` among base and delta
    stays, ties settled by content without the columns of ``ignore``. Rows of other keys pass as they are, also where base repeats a key.
    The delta is stored, so it is computed once and its true size lets the
    planner join by broadcast where it is small.
    """
    delta = materialize(delta, "delta")
    touched = prefixed(delta.select(*keys).distinct(), keys, "_u_")
    on = same_keys_condition(keys, "_u_")
    rivals = base.join(touched, on, "left_semi").unionByName(delta)
    return base.join(touched, on, "left_anti").unionByName(keep_best(rivals, keys, order, ignore))


# -- verification after a load -----------------------------------------------


def _counted(df: DataFrame, name: str) -> DataFrame:
    n = F.count(F.lit(1))
    return df.agg(
        F.lit(name).alias("table_name"),
        n.alias("row_count"),
        F.when(n > 0, "PASS").otherwise("FAIL").alias("status"),
        F.when(n == 0, "empty").alias("problem"),
    )


def verify_loaded(spark: SparkSession, tables: Mapping[str, str | DataFrame]) -> DataFrame:
    """Row count and PASS or FAIL per table, given as frames or paths.

    The counts come from one job over file footers. Where a table cannot be
    opened or read it is reported with its error class, and the others are
    counted one by one.
    """
    schema = "table_name string, row_count bigint, status string, problem string"
    broken, counts = [], {}
    for name, source in tables.items():
        try:
            df = spark.read.parquet(source) if isinstance(source, str) else source
            counts[name] = _counted(df, name)
        except READ_ERRORS as e:
            broken.append((name, None, "FAIL", f"error: {type(e).__name__}"))
    try:
        rows = reduce(DataFrame.unionByName, counts.values()).collect() if counts else []
    except READ_ERRORS:
        rows = []
        for name, count in counts.items():
            try:
                rows += count.collect()
            except READ_ERRORS as e:
                broken.append((name, None, "FAIL", f"error: {type(e).__name__}"))
    return spark.createDataFrame([*map(tuple, rows), *broken], schema)


def check_complete(report: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Expected tables that are absent or did not pass."""
    wanted = report.sparkSession.createDataFrame([(t,) for t in expected], "table_name string")
    good = report.where(F.col("status") == "PASS").select("table_name")
    return wanted.join(good, "table_name", "left_anti")
