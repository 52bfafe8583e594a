"""Column functions: all of them build JVM expressions, none is a UDF."""

from lakesift.functions.columns import (  # noqa: F401
    as_role,
    cast_columns,
    clean_numeric,
    composite_key,
    current_values,
    full_name,
    label,
    null_reason,
    rate,
    safe_ratio,
    season_start,
    table_name,
    to_ts,
    venue,
    with_audit,
    with_reject_meta,
    with_row_id,
    with_scaled,
)
