"""Row checks that split a table into clean rows, labelled rejects and metrics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesift.functions.columns import label
from lakesift.operators.dedupe import (
    duplicate_keys,
    duplicate_rows,
    keep_best,
    repeated_keys,
    unique_rows,
)
from lakesift.operators.keys import key_set, normalised, type_of
from lakesift.operators.ordering import has_rows
from lakesift.session import fits_broadcast, materialize

PKEY_DUPE = "pkey_dupe"
RI_ORPHAN = "ri_orphan"
NEGATIVE = "negative_value"
MUST_BE_NON_NEGATIVE = "must_be_non_negative"

REASONS = ["issue_type", "failed_dimension", "join_key", "failed_column", "check_type"]
_REASON_TYPE = T.StructType([T.StructField(n, T.StringType()) for n in REASONS])


class CheckFailed(Exception):
    """A halting assertion did not hold."""


@dataclass(frozen=True)
class Split:
    """Result of a row check: surviving rows, rejected rows, and counts per reason."""

    clean: DataFrame
    rejects: DataFrame
    metrics: DataFrame


@dataclass(frozen=True)
class Reference:
    """A dimension a fact must refer to."""

    name: str
    dim: DataFrame
    key: str
    dim_key: str | None = None


# -- primary keys ------------------------------------------------------------


def check_primary_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] = (),
    ignore: Sequence[str] = (),
) -> Split:
    """Rejects: all rows of repeated keys. Clean: one row per key.

    The survivor is the first in ``order``, ties settled by the row's content
    without the columns of ``ignore``, so it is the same in every run.

    Only key columns are shuffled to find the repeated keys, which are written
    to a table. If that is small enough to broadcast, rows with a unique key
    pass through an anti join without a shuffle and only the rows of repeated
    keys are sorted to pick a survivor. Otherwise all rows are, after each map
    task has dropped what cannot survive.
    """
    dups = repeated_keys(df, keys)
    repeated = duplicate_rows(df, keys, dups)
    if fits_broadcast(dups):
        clean = unique_rows(df, keys, dups).unionByName(keep_best(repeated, keys, order, ignore))
    else:
        clean = keep_best(df, keys, order, ignore)
    metrics = dups.agg(
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rejected_rows"),
    )
    return Split(clean, label(repeated, issue_type=PKEY_DUPE), metrics)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Stop if any key occurs twice."""
    if has_rows(duplicate_keys(df, keys)):
        raise CheckFailed(f"key ({', '.join(keys)}) is not unique")


def assert_not_null(df: DataFrame, cols: Sequence[str]) -> None:
    """Stop if any of the columns holds a null."""
    missing = F.lit(False)
    for c in cols:
        missing = missing | F.col(c).isNull()
    if has_rows(df.where(missing)):
        raise CheckFailed(f"null in mandatory column ({', '.join(cols)})")


# -- references and signs ----------------------------------------------------


def _reason(**texts: str) -> Column:
    return F.struct(*[F.lit(texts.get(n)).cast("string").alias(n) for n in REASONS])


def orphan_keys(fact: DataFrame, ref: Reference, out: str) -> DataFrame:
    """Non-null keys of the fact that the dimension lacks, each once.

    Only distinct keys are shuffled, pre-aggregated per map task.
    """
    dim_key = ref.dim_key or ref.key
    dim_keys = key_set(ref.dim, dim_key, "_dim_key", type_of(fact, ref.key))
    used = key_set(fact, ref.key, out, type_of(ref.dim, dim_key))
    return used.join(dim_keys, F.col(out) == F.col("_dim_key"), "left_anti")


def flag_rows(
    df: DataFrame, references: Sequence[Reference] = (), non_negative: Sequence[str] = ()
) -> DataFrame:
    """Add the reason columns of the first failed check; all null for a good row.

    References are tested in their order, then signs in theirs. Null and NaN are
    not negative. A dimension whose keys are small enough to broadcast is joined
    to the fact directly. For a larger one the missing keys are found first and
    written to a table, which is small in a sound lake, so that the wide fact
    rows need no shuffle; should it be large, the join shuffles and splits hot
    keys.
    """
    out, tests = df, []
    for i, ref in enumerate(references):
        dim_key, found = ref.dim_key or ref.key, f"_found_{i}"
        own = normalised(df, ref.key, type_of(ref.dim, dim_key))
        keys = key_set(ref.dim, dim_key, found, type_of(df, ref.key))
        if fits_broadcast(keys):
            missing = F.col(found).isNull()
        else:
            keys = materialize(orphan_keys(df, ref, found), "orphan-keys")
            missing = own.isNull() | F.col(found).isNotNull()
        out = out.join(keys, own == F.col(found), "left")
        reason = _reason(issue_type=RI_ORPHAN, failed_dimension=ref.name, join_key=ref.key)
        tests.append(F.when(missing, reason))
    for c in non_negative:
        reason = _reason(issue_type=NEGATIVE, failed_column=c, check_type=MUST_BE_NON_NEGATIVE)
        tests.append(F.when(F.col(c) < 0, reason))
    first = F.coalesce(*tests, F.lit(None).cast(_REASON_TYPE))
    flagged = out.select(*df.columns, first.alias("_reason"))
    return flagged.select(*df.columns, *[F.col(f"_reason.{n}").alias(n) for n in REASONS])


def reject_counts(flagged: DataFrame) -> DataFrame:
    """Rows per reason; the row without an issue_type counts the clean ones."""
    reasons = [c for c in REASONS if c in flagged.columns]
    return flagged.groupBy(*reasons).agg(F.count(F.lit(1)).alias("n_rows"))


def split_flagged(flagged: DataFrame) -> Split:
    """Clean rows without the reason columns, rejects with those that were used."""
    good = F.col("issue_type").isNull()
    rejects = flagged.where(~good)
    return Split(flagged.where(good).drop(*REASONS), rejects, reject_counts(rejects))


def check_references(fact: DataFrame, references: Sequence[Reference]) -> Split:
    """Referential integrity; a row is reported for the first dimension it misses."""
    split = split_flagged(flag_rows(fact, references))
    return Split(
        split.clean, split.rejects.drop("failed_column", "check_type"), split.metrics
    )


def check_non_negative(df: DataFrame, cols: Sequence[str]) -> Split:
    """Sign check; a row is reported for its first negative column."""
    split = split_flagged(flag_rows(df, non_negative=cols))
    return Split(split.clean, split.rejects.drop("failed_dimension", "join_key"), split.metrics)


def check_required_when(df: DataFrame, condition: Column, col: str) -> DataFrame:
    """A value that must be present where the condition holds."""
    holds = F.coalesce(condition, F.lit(False))
    missing = F.count_if(holds & F.col(col).isNull())
    return df.agg(
        F.count_if(holds).alias("rows_in_scope"),
        missing.alias("missing"),
        (missing == 0).alias("success"),
    )


# -- comparisons between tables ----------------------------------------------


def reconcile(
    detail: DataFrame,
    summary: DataFrame,
    key: str,
    detail_col: str,
    summary_col: str,
    tolerance: float = 0.0,
) -> DataFrame:
    """Sums of a detail and a summary table per key, side by side.

    Both sides are pre-aggregated, then matched by a full outer join on the key,
    so a key missing on either side shows up as unequal.
    """
    a = detail.groupBy(key).agg(F.sum(detail_col).alias("detail_sum"))
    b = summary.groupBy(key).agg(F.sum(summary_col).alias("summary_sum"))
    gap = F.abs(F.col("detail_sum") - F.col("summary_sum"))
    equal = F.coalesce(gap <= tolerance, F.col("detail_sum").isNull() & F.col("summary_sum").isNull())
    return a.join(b, key, "full_outer").withColumn("matches", equal)


def classify(tables: Sequence[str], dims: Sequence[str], facts: Sequence[str]) -> dict[str, list[str]]:
    """Sort table names into dimension, fact and uncategorised."""
    known = {*dims, *facts}
    return {
        "dimension": [t for t in tables if t in dims],
        "fact": [t for t in tables if t in facts and t not in dims],
        "uncategorised": [t for t in tables if t not in known],
    }
