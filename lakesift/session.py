"""Session helpers: build a session, set run-time SQL options, find shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Join partitions that hold a hot key are split at run time, also where the
# split costs one more exchange downstream. Writes to a handful of partition
# values keep one file open per value instead of sorting the rows first. Many
# paths are listed in a bounded number of tasks instead of one for each path.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.session.timeZone": "UTC",
}


def build(app: str = "lakesift", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the library's run-time options."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time options to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 128 * 1024 * 1024) -> int:
    """Partition count that keeps one shuffle partition near ``target_bytes``."""
    return max(8, -(-input_bytes // target_bytes))


#: Folders of local sessions that name none, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: whatever ``spark.checkpoint.dir`` names.

    A machine-local folder is used only by a ``local`` master that names none. The option cannot be set on a
    running session, so the folder is remembered here.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = os.environ.get("LAKESIFT_LOCAL_SCRATCH") or tempfile.mkdtemp(prefix="lakesift-")
    return _LOCAL_ROOTS[app]


def scratch(spark: SparkSession, label: str) -> str:
    """A path under the scratch root that no other call has been given."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    This cuts the lineage, survives the loss of any executor, fixes values of
    non-deterministic columns, and tells the planner the true size, so that a
    later join is broadcast only if the written table is below
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame) -> bool:
    """Would the planner broadcast ``df``? Compares its size estimate with the threshold."""
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(estimate)) <= limit


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder at ``path``, on whatever file system it names?"""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it does not exist."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder whose contents are no longer needed."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
