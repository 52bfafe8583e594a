"""One long-lived dataset of rejected rows, a partition per report."""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesift.functions.columns import with_reject_meta
from lakesift.operators.checks import REASONS
from lakesift.session import names_in

PREFIX = "rejected_"

# What every report has in common, whatever table its rows come from.
REASON_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in REASONS]
    + [T.StructField("rejected_at", T.TimestampType())]
    + [T.StructField(c, T.StringType()) for c in ("pipeline_id", "run_id", "report")]
)


def append_rejects(
    df: DataFrame, root: str, key: str | Column, pipeline_id: str, run_id: str
) -> None:
    """Append rejected rows under their report key; later appends may add columns and change their types.

    Rows of equal columns and types lie together, so that a reader knows what to widen. A key computed from the row spreads one frame over several reports in one job.
    Rejects come in small numbers from many tasks, so they are rebalanced into
    files of a sensible size; a report with very many rows still gets several.
    """
    key = F.lit(key) if isinstance(key, str) else key
    rows = with_reject_meta(df, pipeline_id, run_id)
    rows = rows.withColumns({"report": F.concat(F.lit(PREFIX), key), "shape": F.lit(_shape(rows))})
    rows.hint("rebalance", "report").write.mode("append").partitionBy("report", "shape").parquet(root)


def _shape(df: DataFrame) -> str:
    """A name for the frame's columns and types."""
    text = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields)
    return f"s{zlib.crc32(text.encode()):08x}"


_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_FLOATING = [T.FloatType(), T.DoubleType()]


def common_type(types: Sequence[T.DataType]) -> T.DataType:
    """A type that holds the values of all: the widest number, the finer point in time, else text."""
    found = list(dict.fromkeys(t for t in types if not isinstance(t, T.NullType)))
    if len(found) <= 1:
        return found[0] if found else T.StringType()
    if all(t in _WHOLE for t in found):
        return max(found, key=_WHOLE.index)
    if all(t in _FLOATING or t in _WHOLE[:3] for t in found):
        return T.DoubleType()
    if set(found) == {T.DateType(), T.TimestampType()}:
        return T.TimestampType()
    return T.StringType()


def read_rejects(spark: SparkSession, root: str, key: str) -> DataFrame:
    """The rows of one report with the union of the columns of all its appends.

    A column that came with several types has a common one, text if need be.
    """
    report = f"{root.rstrip('/')}/report={PREFIX}{key}"
    parts = [spark.read.parquet(f"{report}/{n}") for n in sorted(names_in(spark, report)) if n.startswith("shape=")]
    if not parts:
        raise LookupError(f"no rejects of {key!r} in {root}")
    types: dict[str, list[T.DataType]] = {}
    for part in parts:
        for f in part.schema.fields:
            types.setdefault(f.name, []).append(f.dataType)
    wide = {c: common_type(ts) for c, ts in types.items()}
    parts = [p.select(*[F.col(c).cast(wide[c]).alias(c) for c in p.columns]) for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).withColumn("report", F.lit(PREFIX + key))


def read_reasons(spark: SparkSession, root: str) -> DataFrame:
    """Why and when rows were rejected, over all reports; table columns are not read."""
    return spark.read.schema(REASON_SCHEMA).parquet(root).select(*REASON_SCHEMA.names)
