"""Landing files: admission, header and type checks, typed scans, triage."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass, fields

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesift.functions.columns import table_name, with_row_id
from lakesift.sources.catalog import write_table

Registry = Mapping[str, Mapping[str, T.DataType]]

CORRUPT = "_corrupt_record"

# What a scan raises: at analysis, or from inside a task.
READ_ERRORS = (PySparkException, Py4JJavaError)


# -- registry ----------------------------------------------------------------


def schema_for(registry: Registry, table: str) -> T.StructType:
    """Declared columns of a table as a schema, every field nullable."""
    if table not in registry:
        raise KeyError(f"no schema is declared for table {table!r}")
    return T.StructType([T.StructField(c, t, True) for c, t in registry[table].items()])


# -- listing and admission ---------------------------------------------------


def landing_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Path, length and time of every part file; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", "length", "modificationTime")


def file_of(folder: str) -> Column:
    """The landing file that a part's path belongs to: the first name below the folder."""
    base = re.escape(re.sub(r"^\w+:/*", "/", folder).rstrip("/"))
    return F.regexp_extract("path", base + r"/([^/]+)", 1)


def list_landing(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file (or per folder of part files): name, bytes, parts.

    Only paths and lengths are read, no content.
    """
    return landing_parts(spark, folder).groupBy(file_of(folder).alias("file")).agg(
        F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("parts")
    )


def admit(files: DataFrame, tables: Iterable[str], extension: str = ".csv") -> DataFrame:
    """Files with the right extension whose stem is a registered table."""
    name = F.col("file")
    return files.where(name.endswith(extension) & table_name(name).isin(*tables)).withColumn(
        "table", table_name(name)
    )


# -- scans -------------------------------------------------------------------


def read_typed_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    null_token: str = "NA",
    mode: str = "FAILFAST",
    corrupt_col: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Typed scan with a header line; ``null_token`` is null in every type.

    The header of each file must carry the schema's names in order. FAILFAST
    stops at the first malformed row that is parsed in full; PERMISSIVE keeps it
    and, with ``corrupt_col``, shows its text.

    ``multi_line`` reads free text whose quoted values hold line breaks and
    doubled quotes. Such a file cannot be split, so each is read by one task: land
    large tables as many part files.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    reader = reader.option("nullValue", null_token).option("nanValue", null_token)
    if multi_line:
        reader = reader.options(multiLine=True, escape='"', emptyValue="")
    reader = reader.option("mode", mode)
    if corrupt_col:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
        schema = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType())])
    return reader.schema(schema).csv(path)


def read_inferred_csv(spark: SparkSession, path: str, infer: bool = True, null_token: str = "NA") -> DataFrame:
    """Exploratory scan: types inferred from the data, or every column as text."""
    return (
        spark.read.option("header", True)
        .option("nullValue", null_token)
        .option("inferSchema", infer)
        .csv(path)
    )


def header_of(spark: SparkSession, path: str) -> list[str]:
    """The column names the file itself declares."""
    return spark.read.option("header", True).csv(path).columns


def check_headers(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Are the file's own column names the declared ones, in order?

    Of a folder of part files this sees the first; the others are checked by the
    scan that loads them, see :func:`header_error`.
    """
    return header_of(spark, path) == schema.names


def cause_of(e: BaseException) -> str:
    """Class of what made a job fail, without the layers around it."""
    java = getattr(e, "java_exception", None)
    while java is not None and java.getCause() is not None:
        java = java.getCause()
    return type(e).__name__ if java is None else java.getClass().getSimpleName()


def header_error(e: BaseException) -> bool:
    """Did a scan stop because a part file has other column names?"""
    return "CSV header does not conform to the schema" in str(e)


def check_types(df: DataFrame, schema: T.StructType) -> bool:
    """Does the frame have the declared name-to-type map?"""
    actual = {f.name: f.dataType for f in df.schema.fields}
    return actual == {f.name: f.dataType for f in schema.fields}


def require_rows(df: DataFrame) -> bool:
    """False for a file that holds a header only."""
    return not df.isEmpty()


# -- ingest of one file ------------------------------------------------------


@dataclass
class FileStatus:
    """Outcome of every ingest step of one file; a step that was not reached is None."""

    file: str
    table: str
    schema_known: bool | None = None
    header_ok: bool | None = None
    not_empty: bool | None = None
    parsed: bool | None = None
    types_ok: bool | None = None
    loaded: bool | None = None
    rows_read: int | None = None
    malformed_rows: int | None = None
    rows_loaded: int | None = None
    error: str | None = None
    digest: str | None = None


STEPS = ["schema_known", "header_ok", "not_empty", "parsed", "types_ok", "loaded"]

STATUS_SCHEMA = T.StructType(
    [T.StructField("file", T.StringType()), T.StructField("table", T.StringType())]
    + [T.StructField(s, T.BooleanType()) for s in STEPS]
    + [T.StructField(c, T.LongType()) for c in ("rows_read", "malformed_rows", "rows_loaded")]
    + [T.StructField("error", T.StringType()), T.StructField("digest", T.StringType())]
)


def ingest_file(
    spark: SparkSession,
    path: str,
    file: str,
    registry: Registry,
    namespace: str,
    null_token: str = "NA",
    multi_line: bool = False,
) -> FileStatus:
    """Check one landing file and load it, deduplicated and numbered, as a staging table.

    One job parses every column, checks the header of every part, counts malformed
    rows on the way, removes duplicate rows and writes. Rows are numbered by their
    content, so two ingests of a file number them alike. A file that fails any step
    leaves no table.
    """
    table = file.rsplit(".", 1)[0]
    status = FileStatus(file, table)
    target = f"{namespace}.{table}"
    written = False
    try:
        status.schema_known = table in registry
        if not status.schema_known:
            return status
        schema = schema_for(registry, table)
        status.header_ok = check_headers(spark, path, schema)
        if not status.header_ok:
            return status
        raw = read_typed_csv(spark, path, schema, null_token, "PERMISSIVE", CORRUPT, multi_line)
        status.not_empty = require_rows(raw)
        if not status.not_empty:
            return status
        seen, kept = Observation(f"ingest {table}"), Observation(f"load {table}")
        # A sum of row hashes: the same for the same rows in any order.
        digest = F.sum(F.xxhash64(*schema.names).cast("decimal(38,0)"))
        rows = raw.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count(CORRUPT).alias("malformed"), digest.cast("string").alias("digest")
        )
        distinct = rows.drop(CORRUPT).dropDuplicates().observe(kept, F.count(F.lit(1)).alias("rows"))
        written = True
        write_table(with_row_id(distinct, stable=schema.names), target)
        status.rows_read = seen.get["rows"]
        status.malformed_rows = seen.get["malformed"]
        status.digest = seen.get["digest"]
        status.parsed = status.malformed_rows == 0
        status.types_ok = check_types(spark.table(target).drop("index"), schema)
        if status.parsed and status.types_ok:
            status.rows_loaded = kept.get["rows"]
            status.loaded = status.rows_loaded > 0
    except READ_ERRORS as e:
        status.error = cause_of(e)
        if header_error(e):
            status.header_ok = False
    finally:
        if written and not status.loaded:
            spark.sql(f"DROP TABLE IF EXISTS {target}")
    return status


def status_frame(spark: SparkSession, statuses: Sequence[FileStatus]) -> DataFrame:
    names = [f.name for f in fields(FileStatus)]
    rows = [dict(zip(names, astuple(s))) for s in statuses]
    ordered = [[r[n] for n in STATUS_SCHEMA.names] for r in rows]
    return spark.createDataFrame(ordered, STATUS_SCHEMA)


def triage(statuses: DataFrame) -> DataFrame:
    """Every step passed: processed; otherwise quarantine, with the first step that failed."""
    failed = F.coalesce(
        *[F.when(~F.coalesce(F.col(s), F.lit(False)), F.lit(s)) for s in STEPS]
    )
    return statuses.withColumn("failed_step", failed).withColumn(
        "decision",
        F.when(F.col("failed_step").isNull(), F.lit("processed")).otherwise(F.lit("quarantine")),
    )


def ingest_folder(
    spark: SparkSession,
    folder: str,
    registry: Registry,
    namespace: str,
    null_token: str = "NA",
    multi_line: Iterable[str] = (),
    at_once: int = 8,
) -> DataFrame:
    """Ingest every admitted file of a landing folder; returns the triage manifest.

    Each file is one distributed job; ``at_once`` of them run side by side.
    ``multi_line`` names the tables whose text may hold line breaks.
    """
    names = [r["file"] for r in admit(list_landing(spark, folder), registry).select("file").collect()]
    free_text = {f"{t}.csv" for t in multi_line}

    def one(name: str) -> FileStatus:
        path = f"{folder.rstrip('/')}/{name}"
        return ingest_file(spark, path, name, registry, namespace, null_token, name in free_text)

    with ThreadPoolExecutor(at_once) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(one), sorted(names)))
    return triage(status_frame(spark, done))
