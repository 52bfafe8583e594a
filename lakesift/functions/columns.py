"""Projections and scalar expressions used by every layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

# Stands for a null inside a composite key; concat_ws alone would drop the part
# and make ('a', null) equal to ('a').
NULL_PART = "\\N"

NUMBERS = ("tinyint", "smallint", "int", "integer", "bigint", "long", "float", "real", "double")


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


# -- audit and reject columns ------------------------------------------------


def with_audit(df: DataFrame, pipeline_id: str, run_id: str) -> DataFrame:
    """Add load_timestamp, pipeline_id and run_id."""
    return df.withColumns(
        {
            "load_timestamp": F.current_timestamp(),
            "pipeline_id": F.lit(pipeline_id),
            "run_id": F.lit(run_id),
        }
    )


def with_reject_meta(df: DataFrame, pipeline_id: str, run_id: str) -> DataFrame:
    """Add rejected_at, pipeline_id and run_id."""
    return df.withColumns(
        {
            "rejected_at": F.current_timestamp(),
            "pipeline_id": F.lit(pipeline_id),
            "run_id": F.lit(run_id),
        }
    )


def label(df: DataFrame, **literals: str) -> DataFrame:
    """Add constant text columns such as issue_type or failed_column."""
    return df.withColumns({name: F.lit(text) for name, text in literals.items()})


def with_row_id(df: DataFrame, col: str = "index", stable: Sequence[str] | None = None) -> DataFrame:
    """Add a surrogate id.

    By default unique and increasing but different from run to run; with
    ``stable`` columns it is a 64-bit hash of them, equal in every run.
    """
    value = F.xxhash64(*stable) if stable else F.monotonically_increasing_id()
    return df.withColumn(col, value)


# -- casts and cleaning ------------------------------------------------------

# How a number can begin, how a floating one can besides, and how a timestamp can.
_DIGITS = r"^[\s\p{Cntrl}]*[+-]?[.0-9]"
_FLOATING = _DIGITS + r"|^[\s\p{Cntrl}]*[+-]?(?i:inf|nan)"
_MOMENT = r"^[\s\p{Cntrl}]*[+-]?[T0-9]"


def parse_number(text: ColumnOrName, to: T.DataType | str) -> Column:
    """Text to number; malformed text becomes null.

    ``try_cast`` raises and catches an error inside for every malformed value,
    which is slow where many are, so text that cannot begin a number is set
    aside first.
    """
    name = to if isinstance(to, str) else to.simpleString()
    shape = _FLOATING if name in ("float", "double", "real") else _DIGITS
    return F.when(_c(text).rlike(shape), _c(text)).try_cast(to)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; the others, the order and nulls stay as they are.

    Text is cast with ``try_cast``, so a malformed value turns null.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}

    def one(name: str) -> Column:
        if name not in types:
            return F.col(name)
        if isinstance(fields[name], T.StringType):
            parse = parse_number if types[name] in NUMBERS else Column.try_cast
            return parse(F.col(name), types[name]).alias(name)
        return F.col(name).cast(types[name]).alias(name)

    return df.select(*[one(name) for name in df.columns])


def clean_numeric(col: ColumnOrName, tokens: Sequence[str] = ("NA",), to: str = "double") -> Column:
    """Text to number: null tokens and malformed text become null."""
    text = _c(col).cast("string")
    return F.when(~text.isin(*tokens), parse_number(text, to))


def to_ts(col: ColumnOrName, fmt: str | None = None) -> Column:
    """Text to timestamp without time zone; malformed text becomes null.

    Without a format, text that cannot begin a date or a time is set aside first.
    """
    if fmt:
        return F.try_to_timestamp(_c(col), F.lit(fmt)).cast("timestamp_ntz")
    return F.when(_c(col).rlike(_MOMENT), _c(col)).try_cast("timestamp_ntz")


def with_scaled(df: DataFrame, src: str, dst: str, divisor: float) -> DataFrame:
    """Unit conversion, for example seconds to minutes with divisor 60."""
    return df.withColumn(dst, F.col(src) / F.lit(divisor))


# -- keys and names ----------------------------------------------------------


def composite_key(cols: Sequence[str], sep: str = "_") -> Column:
    """One text key out of several columns; a null part stays visible."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_PART)) for c in cols]
    return F.concat_ws(sep, *parts)


def full_name(first: ColumnOrName, last: ColumnOrName) -> Column:
    """First and last name with a blank between them; a missing part is empty text."""
    return F.concat(F.coalesce(_c(first), F.lit("")), F.lit(" "), F.coalesce(_c(last), F.lit("")))


def table_name(col: ColumnOrName) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(_c(col), r"\.[^.]*$", "")


def as_role(dim: DataFrame, prefix: str, key: str, cols: Mapping[str, str]) -> DataFrame:
    """Project a dimension under the names of one role.

    The key becomes ``<prefix>_<key>``; ``cols`` maps source names to suffixes.
    """
    return dim.select(
        F.col(key).alias(f"{prefix}_{key}"),
        *[F.col(src).alias(f"{prefix}_{suffix}") for src, suffix in cols.items()],
    )


# -- ratios and labels -------------------------------------------------------


def safe_ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / b, null where b is zero or either side is null."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def rate(total: ColumnOrName, time: ColumnOrName, per: float = 60, scale: int | None = None) -> Column:
    """total / time * per, null on zero time, optionally rounded half up."""
    value = safe_ratio(total, time) * F.lit(per)
    return value if scale is None else F.round(value, scale)


def venue(own: ColumnOrName, home: ColumnOrName, yes: str = "Home", no: str = "Away") -> Column:
    """Home where both keys agree; anything else, null included, is Away."""
    return F.when(_c(own) == _c(home), F.lit(yes)).otherwise(F.lit(no))


def season_start(col: ColumnOrName) -> Column:
    """Start year of a season text such as 19951996."""
    return F.left(_c(col).cast("string"), F.lit(4)).try_cast("int")


def null_reason(col: ColumnOrName, rules: Mapping[str, Column], other: str = "unexplained") -> Column:
    """Why a value is missing: the first rule that holds; null where it is present."""
    target = _c(col)
    reason = F.lit(other)
    for text, holds in reversed(list(rules.items())):
        reason = F.when(holds, F.lit(text)).otherwise(reason)
    return F.when(target.isNull(), reason)


def current_values(season: ColumnOrName) -> Column:
    """Aggregate: the value if the group holds exactly one distinct value, else null.

    A null counts as a value of its own.
    """
    s = _c(season)
    return F.when((F.min(s) == F.max(s)) & (F.count(s) == F.count(F.lit(1))), F.max(s))
