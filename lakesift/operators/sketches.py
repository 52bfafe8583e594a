"""Column profiles that are kept with every load and merged into the profile of the whole.

A load leaves one row per column: counts, range, a HyperLogLog sketch of its distinct values and a KLL sketch of the
values of numbers. Rows of any loads merge without reading their data again. Counts and ranges are exact; the number
of distinct values is off by a relative error of ``distinct_error``, ranks of quantiles by ``rank_error`` of the rows,
both with a confidence of about 99 %.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Sizes of the sketches: 2 to the power of the first registers for distinct values, the second for quantiles.
DISTINCT_BITS = 14
QUANTILE_K = 400

_NUMBERS = (T.NumericType, T.BooleanType)


def distinct_error(bits: int = DISTINCT_BITS) -> float:
    """Relative error of a distinct count, at three deviations."""
    return 3 * 1.04 / math.sqrt(2**bits)


def rank_error(k: int = QUANTILE_K) -> float:
    """Error of a quantile's rank, as a share of all values."""
    return 2.446 / k**0.9433


def sketch(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: ``(column, n_rows, non_null, least, most, distinct, values)``.

    ``least`` and ``most`` are of numbers, as doubles, and null for other columns, as ``values`` is. One pass, one
    partial aggregate per task.
    """
    names = list(columns or df.columns)
    parts = []
    for c in names:
        number = isinstance(df.schema[c].dataType, _NUMBERS)
        value = F.col(c).cast("double") if number else F.lit(None).cast("double")
        parts.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count(F.col(c)).alias("non_null"),
                F.min(value).alias("least"),
                F.max(value).alias("most"),
                F.hll_sketch_agg(F.col(c).cast("string"), DISTINCT_BITS).alias("distinct"),
                (F.kll_sketch_agg_double(value, QUANTILE_K) if number else F.lit(None).cast("binary")).alias("values"),
            ).alias(c)
        )
    one = df.agg(*parts)
    return one.select(F.explode(F.array(*[F.col(f"`{c}`") for c in names])).alias("s")).select("s.*")


def merge(sketches: DataFrame) -> DataFrame:
    """Rows of several loads as one row per column, in the same form."""
    return sketches.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("non_null").alias("non_null"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("values", QUANTILE_K).alias("values"),
    )


def profile(merged: DataFrame, points: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``(column, n_rows, non_null, least, most, n_distinct, quantiles)``; quantiles in the order of ``points``."""
    at = F.array(*[F.lit(float(p)) for p in points])
    quantiles = F.when((F.col("non_null") > 0) & F.col("least").isNotNull(), F.kll_sketch_get_quantile_double("values", at))
    return merged.select("column", "n_rows", "non_null", "least", "most", F.hll_sketch_estimate("distinct").alias("n_distinct"), quantiles.alias("quantiles"))
