"""Tables kept in ranges of their key, so that a load rewrites no more than the ranges that it touches.

A version is a manifest: for every range its first key, its file and its number of rows. A load finds the ranges
that hold its keys, merges into those, writes them to new files and carries all others over by name. Ranges that
have grown too large are cut on that occasion. Files never change, so every version stays readable.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesift.operators.dedupe import keep_best
from lakesift.operators.keys import prefixed, same_keys_condition
from lakesift.session import materialize, names_in

RANGE, RUN = "_lakesift_range", "_lakesift_run"
# Rows that one task merges and writes, in as many files as they make ranges.
ROWS_PER_TASK = 500_000
# A key with more rows in one load is reduced to its first before the rows are brought together.
HOT_ROWS = 1_000


@dataclass(frozen=True)
class Range:
    """Keys from ``lo`` on, up to the next range; the first has no ``lo``.

    ``folder`` is that of the load which wrote the range, and ``n_files`` the number of ranges that it wrote.
    """

    lo: tuple | None
    path: str
    n_rows: int
    folder: str = ""
    n_files: int = 0


@dataclass(frozen=True)
class RangedTable:
    """One table under ``root``. Keys may be null and are compared in order, nulls first."""

    spark: SparkSession
    root: str
    keys: Sequence[str]
    rows_per_range: int = 2_000_000

    # -- versions ------------------------------------------------------------

    @property
    def _manifests(self) -> str:
        return f"{self.root.rstrip('/')}/manifest"

    def version(self) -> int:
        """Number of the last complete load; 0 before the first."""
        return max((int(n) for n in names_in(self.spark, self._manifests) if n.isdigit()), default=0)

    def ranges(self, version: int | None = None) -> list[Range]:
        """The ranges in key order: as many as the table has ``rows_per_range``."""
        version = self.version() if version is None else version
        if not version:
            return []
        rows = self.spark.read.parquet(f"{self._manifests}/{version}").orderBy("number").collect()
        more = [f for f in ("folder", "n_files") if rows and f in rows[0]]
        return [Range(None if r.lo is None else tuple(r.lo), r.path, r.n_rows, *[r[f] for f in more]) for r in rows]

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.ranges(version))

    def _rows(self, ranges: Sequence[Range]) -> DataFrame:
        """The rows of some ranges; a load all of whose ranges are wanted is listed as one folder."""
        if not ranges:
            raise LookupError(f"nothing was loaded into {self.root}")
        wanted = Counter(r.folder for r in ranges)
        paths = [r.folder if wanted[r.folder] == r.n_files else r.path for r in ranges]
        return self.spark.read.option("recursiveFileLookup", True).parquet(*dict.fromkeys(paths))

    # -- the ranges of rows ----------------------------------------------------

    def _key(self) -> Column:
        return F.struct(*self.keys)

    def _ends(self) -> list[Column]:
        """The first and the last key of a group; those of a single column need no sorting of the rows by group."""
        if len(self.keys) > 1:
            return [F.min("key").alias("lo"), F.max("key").alias("hi")]
        key = F.col("key").getField(self.keys[0])
        lowest = F.when(F.count(key) == F.count(F.lit(1)), F.min(key))
        return [F.struct(lowest.alias(self.keys[0])).alias("lo"), F.struct(F.max(key).alias(self.keys[0])).alias("hi")]

    def _lows(self, lows: Sequence[tuple], types: Sequence[T.DataType]) -> Column:
        """The bounds as one array that every task is sent once."""
        key = T.StructType([T.StructField(k, t) for k, t in zip(self.keys, types)])
        schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("lo", key)])
        bounds = self.spark.createDataFrame(list(enumerate(lows)), schema)
        return bounds.agg(F.array_sort(F.collect_list(F.struct("i", "lo"))).alias("b")).select(F.col("b.lo")).scalar()

    def placed(self, df: DataFrame, ranges: Sequence[Range], out: str = RANGE) -> DataFrame:
        """``df`` with the number of each row's range, found by halving the bounds: as many steps as their logarithm."""
        lows = [r.lo for r in ranges[1:]]
        if not lows:
            return df.withColumn(out, F.lit(0))
        found = df.select(*df.columns, self._key().alias("_key"), self._lows(lows, [df.schema[k].dataType for k in self.keys]).alias("_lows"))
        found = found.withColumn(out, F.lit(0))
        # ``out`` is how many bounds are known not to be above the key; past the last bound there is none, so null.
        for step in reversed([1 << i for i in range(len(lows).bit_length())]):
            reached = F.get("_lows", F.col(out) + (step - 1)) <= F.col("_key")
            found = found.withColumn(out, F.when(reached, F.col(out) + step).otherwise(F.col(out)))
        return found.select(*df.columns, out)

    def touched(self, df: DataFrame, version: int | None = None) -> list[int]:
        """Numbers of the ranges that hold keys of ``df``."""
        rows = self.placed(df.select(*self.keys), self.ranges(version)).select(RANGE).distinct().collect()
        return sorted(r[0] for r in rows)

    def around(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """All rows of the ranges that may have rows with ``keys``."""
        ranges = self.ranges(version)
        numbers = self.touched(keys, version) if ranges else []
        return self._rows([ranges[i] for i in numbers]) if numbers else self._rows(ranges).limit(0)

    def matching(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """The stored rows whose key is in ``keys``; only the ranges that may have them are read."""
        wanted = prefixed(keys.select(*self.keys).distinct(), self.keys, "_w_")
        return self.around(keys, version).join(wanted, same_keys_condition(self.keys, "_w_"), "left_semi")

    # -- loads -----------------------------------------------------------------

    def load(
        self, delta: DataFrame, order: Sequence[Column] = (), ignore: Sequence[str] = (), base: int | None = None, stored: bool = False
    ) -> int:
        """Merge ``delta`` in, one row per key, the first in ``order``; returns the new version.

        The last version is merged with, or the version ``base``. A load without rows makes no version. Another load
        that ends at the same time makes this one fail before it is visible. ``stored`` says that ``delta`` is a table
        that was written and need not be written again.
        """
        last = self.version()
        before = last if base is None else base
        old = self.ranges(before)
        delta = delta if stored else materialize(delta, "delta")
        keys = self.placed(delta.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_n")), old)
        found = keys.groupBy(RANGE).agg(F.sum("_n").alias("rows"), F.max("_n").alias("most")).collect()
        if not found:
            return before
        if max(r.most for r in found) > HOT_ROWS:
            delta = materialize(keep_best(delta, self.keys, order, ignore), "delta")
        # Touched ranges side by side are one run: within it, new ranges need not end where the old ones did.
        touched = {r[RANGE] for r in found}
        runs = [i for i in sorted(touched) if i - 1 not in touched]
        n_rows = sum(r["rows"] for r in found) + sum(old[i].n_rows for i in touched if old)
        tasks = -(-n_rows // max(self.rows_per_range, ROWS_PER_TASK))
        rows = delta.unionByName(self._rows([old[i] for i in sorted(touched)])) if old else delta
        by = list(self.keys)
        if len(runs) > 1:
            rows, by = self.placed(rows, [old[i] for i in runs], RUN), [RUN, *by]
        # Range partitions keep the rows of a key together, so they are merged, sorted and written where they are.
        # A constant must not be among the columns: the planner would drop it and shuffle once more, by hash.
        rows = keep_best(rows.repartitionByRange(tasks, *by), by, order, [*ignore, RUN]).sortWithinPartitions(*by)
        rows = rows if RUN in by else rows.withColumn(RUN, F.lit(0))
        folder = f"{self.root.rstrip('/')}/data/{last + 1}-{uuid.uuid4().hex}"
        rows.write.option("maxRecordsPerFile", self.rows_per_range).partitionBy(RUN).parquet(folder)
        stored = self.spark.read.parquet(folder).select(RUN, F.col("_metadata.file_name").alias("file"), self._key().alias("key"))
        files = stored.groupBy(RUN, "file").agg(*self._ends(), F.count(F.lit(1)).alias("n"))
        in_order = Window.orderBy(RUN, "lo")
        files = files.withColumn("apart", F.coalesce(F.lag("hi").over(in_order) < F.col("lo"), F.lit(True))).orderBy(RUN, "lo").collect()
        if not all(r["apart"] for r in files):
            raise RuntimeError(f"ranges of {folder} overlap")
        new: dict[int, list[Range]] = {}
        for r in files:
            # The first file of a run keeps the bound of its first range, so that ranges leave no gaps.
            start = runs[r[RUN]]
            first = start not in new
            lo = old[start].lo if first and old else None if first else tuple(r["lo"])
            new.setdefault(start, []).append(Range(lo, f"{folder}/{RUN}={r[RUN]}/{r['file']}", r["n"], folder, len(files)))
        kept = {i: [own] for i, own in enumerate(old) if i not in touched}
        ranges = [r for _, own in sorted({**kept, **new}.items()) for r in own]
        types = [delta.schema[k].dataType.simpleString() for k in self.keys]
        fields = ",".join(f"`{k}`:{t}" for k, t in zip(self.keys, types))
        rows = [(i, r.lo, r.path, r.n_rows, r.folder, r.n_files) for i, r in enumerate(ranges)]
        manifest = self.spark.createDataFrame(rows, f"number int, lo struct<{fields}>, path string, n_rows long, folder string, n_files int")
        manifest.coalesce(1).write.mode("errorifexists").parquet(f"{self._manifests}/{last + 1}")
        return last + 1
