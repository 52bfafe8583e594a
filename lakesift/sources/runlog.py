"""Run and step log as an append-only table."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesift.operators.dedupe import keep_best

LOG_SCHEMA = T.StructType(
    [
        T.StructField("pipeline_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("step", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("entry", T.StringType()),
        T.StructField("at", T.TimestampType()),
    ]
)

RUN = ["pipeline_id", "run_id"]
STARTED, ENDED, FAILED = "started", "ended", "failed"
STATUS, ERROR = "status", "error"


@dataclass
class RunLog:
    """Collects the steps of one run; ``flush`` appends them under ``path``.

    A run may be continued by another job: give it the same ids and path.
    """

    pipeline_id: str
    run_id: str
    path: str | None = None
    rows: list[tuple] = field(default_factory=list)
    _flushed: int = 0

    def __post_init__(self) -> None:
        self.step("run", STARTED)

    def _record(self, step: str, what: str, status: str | None, entry: object) -> None:
        text = None if entry is None else str(entry)
        at = datetime.now(timezone.utc)
        seq = len(self.rows)
        self.rows.append((self.pipeline_id, self.run_id, seq, step, what, status, text, at))

    def step(self, name: str, status: str, entry: object = None) -> None:
        """Record a status; a later one of the same step replaces it in :func:`latest`."""
        self._record(name, STATUS, status, entry)

    def add(self, step: str, what: str, entry: object) -> None:
        """Add one entry to a list of a step, for example a loaded table."""
        self._record(step, what, None, entry)

    def error(self, step: str, exc: BaseException | str, entry: object = None) -> None:
        """Record a failed step and its error class with what it happened to."""
        name = exc if isinstance(exc, str) else type(exc).__name__
        self._record(step, ERROR, name, entry)
        self.step(step, FAILED, name)

    def end(self) -> None:
        self.step("run", ENDED)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, LOG_SCHEMA)

    def flush(self, spark: SparkSession) -> None:
        """Append what was recorded since the last flush."""
        fresh = self.rows[self._flushed :]
        if self.path and fresh:
            frame = spark.createDataFrame(fresh, LOG_SCHEMA).coalesce(1)
            frame.write.mode("append").parquet(self.path)
            self._flushed = len(self.rows)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def latest(log: DataFrame) -> DataFrame:
    """The last status of every step of every run."""
    statuses = log.where(F.col("field") == STATUS).drop("field")
    return keep_best(statuses, [*RUN, "step"], [F.col("at").desc(), F.col("seq").desc()])


def step_report(log: DataFrame) -> DataFrame:
    """Per step: first and last record, errors, and entries in its lists."""
    kind = F.col("field")
    return log.groupBy(*RUN, "step").agg(
        F.min("at").alias("started_at"),
        F.max("at").alias("ended_at"),
        F.count_if(kind == ERROR).alias("errors"),
        F.count_if(~kind.isin(STATUS, ERROR)).alias("entries"),
    )


def entries(log: DataFrame, step: str, what: str) -> DataFrame:
    """The list of one step, or its errors with their classes."""
    return log.where((F.col("step") == step) & (F.col("field") == what)).select(
        *RUN, "seq", "status", "entry"
    )
