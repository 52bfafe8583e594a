"""Key comparison shared by joins, duplicate search and checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesift.functions.columns import parse_number


def type_of(df: DataFrame, col: str) -> T.DataType:
    return df.schema[col].dataType


def normalised(df: DataFrame, col: str, other: T.DataType) -> Column:
    """``col`` ready to be compared with a key of type ``other``.

    Text compared with a number is parsed: a malformed key becomes null, matches
    nothing, and never stops the job.
    """
    own = type_of(df, col)
    if isinstance(own, T.StringType) and isinstance(other, T.NumericType):
        return parse_number(col, other)
    return F.col(col)


def key_set(dim: DataFrame, key: str, name: str, like: T.DataType) -> DataFrame:
    """Distinct non-null keys of a dimension as column ``name``.

    The distinct pre-aggregates before the shuffle, so a key that fills a third
    of the dimension still arrives as one row per map task.
    """
    value = normalised(dim, key, like).alias(name)
    return dim.select(value).where(F.col(name).isNotNull()).distinct()


def same_keys_condition(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of ``keys`` with the columns renamed by :func:`prefixed`."""
    return reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys]
    )


def prefixed(df: DataFrame, cols: Sequence[str], prefix: str) -> DataFrame:
    return df.select(
        *[F.col(c).alias(prefix + c) if c in cols else F.col(c) for c in df.columns]
    )


def sortable(df: DataFrame) -> list[str]:
    """Columns that can take part in a total order."""

    def ok(t: T.DataType) -> bool:
        if isinstance(t, T.ArrayType):
            return ok(t.elementType)
        if isinstance(t, T.StructType):
            return all(ok(f.dataType) for f in t.fields)
        return not isinstance(t, (T.MapType, T.VariantType))

    return [f.name for f in df.schema.fields if ok(f.dataType)]
