"""Key and reference checks of a table that arrives in loads, without reading its history again.

Beside the clean rows an index keeps every key with its number of rows so far, in ranges of the key. A load looks up
its own keys there. Clean rows, rejects and counts after any number of loads are those of one load of all rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesift.functions.columns import label
from lakesift.operators.checks import PKEY_DUPE, Reference
from lakesift.operators.keys import prefixed, same_keys_condition
from lakesift.session import materialize
from lakesift.sources.commits import CommitLog
from lakesift.sources.ranged import RangedTable

class LoadConflict(Exception):
    """Another load ended first; nothing of this one is visible, and it may be tried again."""


@dataclass(frozen=True)
class CheckedTable:
    """A table with a primary key. Of a repeated key all rows are rejects, and the first in ``order`` is clean.

    Null keys are equal to one another, as in a check of the whole table.
    """

    spark: SparkSession
    root: str
    keys: Sequence[str]
    order: Sequence[Column] = ()
    ignore: Sequence[str] = ()
    rows_per_range: int = 2_000_000

    def _table(self, name: str) -> RangedTable:
        return RangedTable(self.spark, f"{self.root.rstrip('/')}/{name}", self.keys, self.rows_per_range)

    @property
    def rows(self) -> RangedTable:
        """The clean rows."""
        return self._table("clean")

    @property
    def index(self) -> RangedTable:
        """Every key and its number of rows."""
        return self._table("keys")

    @property
    def _commits(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.root.rstrip('/')}/commits")

    def load(self, delta: DataFrame) -> None:
        """Check and merge one load; one without rows changes nothing."""
        number = self._commits.last()
        head = self._commits.read(number) if number else {"rows": 0, "index": 0, "rejects": [], "duplicate_keys": 0, "rejected_rows": 0}
        delta = materialize(delta, "load")
        fresh = materialize(delta.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n_new")), "new-keys")
        if fresh.isEmpty():
            return
        if head["index"]:
            known = prefixed(self.index.around(fresh, head["index"]), self.keys, "_k_")
            both = fresh.join(known, same_keys_condition(self.keys, "_k_"), "left")
            both = both.select(*self.keys, "n_new", F.coalesce("n_rows", F.lit(0)).alias("n_before"))
        else:
            both = fresh.withColumn("n_before", F.lit(0).cast("long"))
        both = materialize(both.withColumn("n_rows", F.col("n_new") + F.col("n_before")), "key-counts")
        repeated = prefixed(both.where("n_rows > 1").select(*self.keys), self.keys, "_r_")
        rejects = delta.join(repeated, same_keys_condition(self.keys, "_r_"), "left_semi")
        if head["rows"]:
            # A row that was the only one of its key until now is a reject from now on.
            rejects = rejects.unionByName(self.rows.matching(both.where("n_before = 1"), head["rows"]))
        folder = f"{self.root.rstrip('/')}/rejects/{uuid.uuid4().hex}"
        label(rejects, issue_type=PKEY_DUPE).write.parquet(folder)
        more = F.when(F.col("n_before") > 1, F.col("n_new")).otherwise(F.col("n_rows"))
        counts = both.where("n_rows > 1").agg(F.count_if(F.col("n_before") <= 1), F.coalesce(F.sum(more), F.lit(0))).first()
        commit = {
            "rows": self.rows.load(delta, self.order, self.ignore, head["rows"], True),
            "index": self.index.load(both.select(*self.keys, "n_rows"), [F.col("n_rows").desc()], (), head["index"], True),
            "rejects": [*head["rejects"], folder],
            "duplicate_keys": head["duplicate_keys"] + counts[0],
            "rejected_rows": head["rejected_rows"] + counts[1],
        }
        if not self._commits.try_add(number + 1, commit):
            raise LoadConflict(self.root)

    def _head(self) -> dict:
        if not (head := self._commits.head()):
            raise LookupError(f"nothing was loaded into {self.root}")
        return head

    def clean(self) -> DataFrame:
        return self.rows.read(self._head()["rows"])

    def rejects(self) -> DataFrame:
        return self.spark.read.parquet(*self._head()["rejects"])

    def metrics(self) -> DataFrame:
        """One row, like the metrics of a check of the whole table."""
        head = self._head()
        return self.spark.createDataFrame([(head["duplicate_keys"], head["rejected_rows"])], "duplicate_keys long, rejected_rows long")

    def reference(self, name: str, key: str, own_key: str | None = None) -> Reference:
        """This table as a dimension that a fact's ``key`` must refer to: only the index is read."""
        return Reference(name, self.index.read(self._head()["index"]).select(*self.keys), key, own_key or self.keys[0])
