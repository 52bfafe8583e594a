"""Star joins and key-membership joins.

No join here carries a broadcast hint: the planner broadcasts a side only when
its known size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
shuffles, where the run-time skew handling splits hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesift.operators.keys import key_set, normalised, type_of
from lakesift.session import fits_broadcast, materialize


@dataclass(frozen=True)
class Lookup:
    """One dimension of a star in one role.

    ``key`` is the fact column, ``dim_key`` the dimension's; ``cols`` maps
    dimension columns to result names.
    """

    dim: DataFrame
    key: str
    dim_key: str
    cols: Mapping[str, str] = field(default_factory=dict)


def _projected(fact: DataFrame, look: Lookup) -> DataFrame:
    key = normalised(look.dim, look.dim_key, type_of(fact, look.key))
    return look.dim.select(
        key.alias(look.key), *[F.col(c).alias(a) for c, a in look.cols.items()]
    )


def join_dimension(fact: DataFrame, look: Lookup, how: str = "inner") -> DataFrame:
    """Join one dimension on its key; the key keeps the fact's type and comes first."""
    return fact.join(_projected(fact, look), look.key, how)


def enrich(fact: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Left-join several dimensions, the same one in several roles if wanted.

    A dimension must be unique on its key, as :func:`check_primary_key` leaves it.
    """
    return star(fact, lookups)


def star(fact: DataFrame, lookups: Sequence[Lookup], hows: Sequence[str] | None = None) -> DataFrame:
    """Join dimensions, among them those that are reached through another one.

    A lookup whose key comes from an earlier lookup is joined to that dimension
    first, so only dimensions are shuffled for it and the fact takes part in one
    join per dimension of its own. Columns come in the order in which one join
    after the other would leave them. ``hows`` gives the kind of each join, left
    by default; a dimension of a dimension is always joined left.
    """
    hows = list(hows or ["left"] * len(lookups))
    home: list[int | None] = []
    for i, look in enumerate(lookups):
        above = [k for k in range(i) if look.key in lookups[k].cols.values()]
        home.append(None if look.key in fact.columns or not above else above[0])

    def resolved(like: DataFrame, i: int) -> DataFrame:
        df = _projected(like, lookups[i])
        for k in range(len(lookups)):
            if home[k] == i:
                df = df.join(resolved(df, k), lookups[k].key, "left")
        return df

    columns = list(fact.columns)
    for look in lookups:
        columns = [look.key, *[c for c in columns if c != look.key], *look.cols.values()]
    for i, look in enumerate(lookups):
        if home[i] is None:
            fact = fact.join(resolved(fact, i), look.key, hows[i])
    return fact.select(*columns)


def _membership(
    fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None, how: str
) -> DataFrame:
    """Semi or anti join with the distinct keys of the dimension.

    Keys too large to broadcast are written to a table first: the run-time skew
    handling splits a hot fact key only where both join sides come straight from
    an exchange, which an aggregate on the key side would prevent.
    """
    dim_key = dim_key or key
    keys = key_set(dim, dim_key, "_dim_key", type_of(fact, key))
    if not fits_broadcast(keys):
        keys = materialize(keys, "dimension-keys")
    own = normalised(fact, key, type_of(dim, dim_key))
    return fact.join(keys, own == F.col("_dim_key"), how)


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows without a dimension row; a null key is an orphan."""
    return _membership(fact, dim, key, dim_key, "left_anti")


def matched(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows with a dimension row, each once, columns in their own order."""
    return _membership(fact, dim, key, dim_key, "left_semi")


def in_set(df: DataFrame, col: str, ids: DataFrame, id_col: str | None = None, negate: bool = False) -> DataFrame:
    """Rows whose ``col`` is (or is not) in a derived set of ids."""
    return (orphans if negate else matched)(df, ids, col, id_col)
