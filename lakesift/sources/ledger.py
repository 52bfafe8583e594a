"""Which landing files were ingested, so that a second run loads new and changed files only.

A file is known by its parts: paths, lengths and times, summed up in one number without looking inside. The ledger
entry is written after the staging table, so what a broken-off run did not finish is taken up again. An entry also
holds a digest of the rows that were read, which tells a file that was touched from one whose content is new.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesift.functions.columns import table_name
from lakesift.session import exists
from lakesift.sources.catalog import stamp
from lakesift.sources.landing import Registry, admit, file_of, ingest_file, landing_parts, status_frame, triage

LEDGER = "file string, mark string, bytes long, parts long, decision string, failed_step string, rows_read long, rows_loaded long, digest string, target string, written timestamp"


def marks(spark: SparkSession, folder: str) -> DataFrame:
    """``(file, bytes, parts, mark)``: the mark changes with the path, length or time of any part."""
    part = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    name = file_of(folder)
    return landing_parts(spark, folder).groupBy(name.alias("file")).agg(
        F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("parts"), F.sum(part).cast("string").alias("mark")
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Every entry so far."""
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("recursiveFileLookup", True).parquet(path)


def latest_entries(ledger: DataFrame) -> DataFrame:
    """The last entry of each file."""
    last = ledger.groupBy("file").agg(F.max_by(F.struct(*ledger.columns), F.struct("written", "mark")).alias("e"))
    return last.select("e.*")


def pending(spark: SparkSession, folder: str, registry: Registry, ledger: str) -> DataFrame:
    """``(file, bytes, parts, mark, state)`` of the admitted files; the state is new, changed or known.

    Files that were set aside are known as well, until they change.
    """
    seen = latest_entries(read_ledger(spark, ledger)).select("file", F.col("mark").alias("_mark"))
    state = F.when(F.col("_mark").isNull(), "new").when(F.col("_mark") == F.col("mark"), "known").otherwise("changed")
    files = admit(marks(spark, folder), registry).drop("table")
    return files.join(seen, "file", "left").withColumn("state", state).drop("_mark")


def ingest_new(
    spark: SparkSession,
    folder: str,
    registry: Registry,
    namespace: str,
    ledger: str,
    null_token: str = "NA",
    multi_line: Iterable[str] = (),
    at_once: int = 8,
) -> DataFrame:
    """Ingest the new and changed files of a landing folder; returns the triage manifest with every file's ``state``.

    Known files are in it with the decision ``skipped``. A changed file replaces its staging table. Each file's entry
    is a folder of its own, so that files which end together do not meet.
    """
    files = pending(spark, folder, registry, ledger).collect()
    free_text = {f"{t}.csv" for t in multi_line}

    def one(file) -> DataFrame:
        status = ingest_file(spark, f"{folder.rstrip('/')}/{file.file}", file.file, registry, namespace, null_token, file.file in free_text)
        done = triage(status_frame(spark, [status]))
        entry = done.select(
            "file", F.lit(file.mark).alias("mark"), F.lit(file.bytes).cast("long").alias("bytes"), F.lit(file.parts).cast("long").alias("parts"), "decision",
            "failed_step", "rows_read", "rows_loaded", "digest", F.lit(f"{namespace}.{status.table}").alias("target"), F.current_timestamp().alias("written"),
        )
        entry.write.parquet(f"{ledger.rstrip('/')}/{stamp()}-{status.table}-{abs(int(file.mark))}")
        return status

    todo = [f for f in files if f.state != "known"]
    with ThreadPoolExecutor(at_once) as pool:
        statuses = list(pool.map(inheritable_thread_target(spark)(one), sorted(todo, key=lambda f: f.file)))
    done = triage(status_frame(spark, statuses))
    states = spark.createDataFrame([(f.file, f.state) for f in files], "file string, state string")
    stem = table_name(F.col("file"))
    return states.join(done, "file", "left").withColumns(
        {"table": F.coalesce("table", stem), "decision": F.coalesce("decision", F.lit("skipped"))}
    )
