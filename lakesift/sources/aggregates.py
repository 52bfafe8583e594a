"""Sums of a fact stored at a few grains, from which measures are answered.

A grain is a set of columns to group by. Each stored grain has the sums of all measures, coarser ones are made from
finer ones, and a question is answered from the stored grain with the fewest rows whose columns it can do with.
Ratios are taken of sums, never stored. New rows of the fact are added grain by grain without the old ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesift.operators import measures as M
from lakesift.sources.commits import CommitLog


@dataclass(frozen=True)
class Grain:
    columns: frozenset[str]
    path: str
    n_rows: int


class NotStored(LookupError):
    """No stored grain has the columns of a question."""


@dataclass(frozen=True)
class StoredSums:
    """The grains under one root. Several writers may add to it; readers see one commit as a whole."""

    spark: SparkSession
    root: str

    @property
    def _commits(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.root.rstrip('/')}/commits")

    @staticmethod
    def _grains(head: Mapping) -> list[Grain]:
        return [Grain(frozenset(g["columns"]), g["path"], g["n_rows"]) for g in head.get("grains", [])]

    def grains(self) -> list[Grain]:
        return self._grains(self._commits.head())

    def measures(self) -> list[str]:
        return self._commits.head().get("measures", [])

    def _write(self, rows: DataFrame, columns: Sequence[str], measures: Sequence[str]) -> Grain:
        path = f"{self.root.rstrip('/')}/grains/{uuid.uuid4().hex}"
        rows.groupBy(*columns).agg(*[F.sum(m).alias(m) for m in measures]).write.parquet(path)
        return Grain(frozenset(columns), path, self.spark.read.parquet(path).count())

    def _all(self, fact: DataFrame, grains: Sequence[Sequence[str]], measures: Sequence[str]) -> list[Grain]:
        """The grains of ``fact``, widest first; each is made from the smallest one that has its columns."""
        made: list[Grain] = []
        for columns in sorted(map(sorted, map(set, grains)), key=lambda c: (-len(c), c)):
            source = min((g for g in made if g.columns >= set(columns)), key=lambda g: g.n_rows, default=None)
            rows = fact if source is None else self.spark.read.parquet(source.path)
            made.append(self._write(rows, columns, measures))
        return made

    def _commit(self, measures: Sequence[str], grains: Sequence[Grain]) -> dict:
        return {"measures": list(measures), "grains": [{"columns": sorted(g.columns), "path": g.path, "n_rows": g.n_rows} for g in grains]}

    def store(self, fact: DataFrame, measures: Sequence[str], grains: Sequence[Sequence[str]]) -> list[Grain]:
        """Replace what is stored by the sums of ``fact``."""
        made = self._all(fact, grains, measures)
        self._commits.add(lambda head: self._commit(measures, made))
        return made

    def add(self, rows: DataFrame) -> list[Grain]:
        """Add the sums of further rows of the fact to every grain."""
        measures = self.measures()
        more = {g.columns: g for g in self._all(rows, [list(g.columns) for g in self.grains()], measures)}

        def commit(head: Mapping) -> dict:
            both = []
            for g in self._grains(head):
                union = self.spark.read.parquet(g.path).unionByName(self.spark.read.parquet(more[g.columns].path))
                both.append(self._write(union, sorted(g.columns), measures))
            return self._commit(measures, both)

        return self._grains(self._commits.add(commit))

    def rows_for(self, columns: Sequence[str], measures: Sequence[str] = ()) -> DataFrame:
        """The smallest stored grain that has ``columns``."""
        if missing := sorted(set(measures) - set(self.measures())):
            raise NotStored(f"measures {missing}")
        fits = [g for g in self.grains() if g.columns >= set(columns)]
        if not fits:
            raise NotStored(f"columns {sorted(columns)}")
        return self.spark.read.parquet(min(fits, key=lambda g: (g.n_rows, sorted(g.columns))).path)

    # -- questions ---------------------------------------------------------------

    def _slice(self, by: Sequence[str], filters: Mapping[str, object], measures: Sequence[str]) -> DataFrame:
        return M.slice_by(self.rows_for([*by, *filters], measures), filters)

    def sums(self, by: Sequence[str], cols: Mapping[str, str], filters: Mapping[str, object] | None = None) -> DataFrame:
        return M.measure_sum(self._slice(by, filters or {}, list(cols.values())), by, cols)

    def rates(self, by: Sequence[str], nums: Mapping[str, str], time: str, per: float = 60, filters: Mapping[str, object] | None = None) -> DataFrame:
        return M.measure_rate(self._slice(by, filters or {}, [*nums.values(), time]), by, nums, time, per)

    def ratio(self, by: Sequence[str], num: str, den: str, out: str = "ratio", filters: Mapping[str, object] | None = None) -> DataFrame:
        return M.measure_ratio(self._slice(by, filters or {}, [num, den]), by, num, den, out)
