"""Exact top-k search by inner product: tiled matrix products, partial selection, tree merging.

Candidates are dealt to shards and queries to tiles by a hash of their id, so that every cell of the grid
(tile, shard) holds a bounded number of components. A cell is one matrix product, done in slices; each query
keeps its k best of the shard. The lists of a query are then merged by groups of shards until one is left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Components in a shard or tile, score cells in one product, lists merged at once.
SHARD_CELLS = 500_000
TILE_CELLS = 250_000
PRODUCT_CELLS = 4_000_000
FAN_IN = 16

_SCHEMA = "query_id long, shard int, vec_id long, score long"


def usable(vec: str) -> Column:
    """True for vectors without null and non-finite components."""
    return F.col(vec).isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def scaled(vec: str, factor: int) -> Column:
    """Each component as double, times ``factor``, rounded down."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * factor).cast("double"))


def _matrix(t: pa.Table, once: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids in rising order and their vectors; with ``once``, a repeated id counts once, with its smallest vector."""
    ids = t.column("id").to_numpy()
    flat = t.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    rows = flat.reshape(len(ids), -1)
    order = np.argsort(ids, kind="stable")
    if once and len(np.unique(ids)) < len(ids):
        order = np.lexsort((*rows.T[::-1], ids))
        order = order[np.r_[True, ids[order][1:] != ids[order][:-1]]]
    return ids[order], rows[order]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer rows. Doubles hold them exactly unless they are very large."""
    bound = a.shape[1] * np.abs(a).max(initial=0) * np.abs(b).max(initial=0)
    if bound < 2**53:
        return a @ b.T
    exact = np.array([[int(x) for x in r] for r in a], dtype=object) @ np.array([[int(x) for x in r] for r in b], dtype=object).T
    return np.clip(exact, -(2**63), 2**63 - 1)


def _best(scores: np.ndarray, own: slice, k: int) -> np.ndarray:
    """Positions of the k best scores outside of ``own``; ties to the smaller position, as ids rise."""
    scores = np.concatenate([scores[: own.start], scores[own.stop :]])
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    at = at[np.argsort(-scores[at], kind="stable")][:k]
    return at + (at >= own.start) * (own.stop - own.start)


def _cell(k: int):
    def search(key, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        # A side without rows may come with its key columns only.
        if all(t.num_rows and "vec" in t.column_names for t in (queries, candidates)):
            q_ids, q = _matrix(queries, once=True)
            c_ids, c = _matrix(candidates, once=False)
            own = [slice(a, b) for a, b in zip(np.searchsorted(c_ids, q_ids), np.searchsorted(c_ids, q_ids, side="right"))]
            step = max(1, PRODUCT_CELLS // len(c_ids))
            for start in range(0, len(q_ids), step):
                scores = _products(q[start : start + step], c)
                for i, row in enumerate(scores, start):
                    at = _best(row, own[i], k)
                    out[0] += [q_ids[i]] * len(at)
                    out[1] += c_ids[at].tolist()
                    out[2] += [int(x) for x in row[at]]
        shard = pa.array([key[2].as_py()] * len(out[0]), pa.int32())
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "shard": shard, "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.int64())})

    return search


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """The k best of each query and shard."""
    order = Window.partitionBy("query_id", "shard").orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k candidates of highest inner product for each query.

    Both sides have ``id`` (long) and ``vec`` (array of doubles that are whole numbers). A candidate with the
    query's id is the query itself and not returned. Ties go to the smaller id. Rows with a null id or vector
    take no part. Of queries that repeat an id the one with the smallest vector counts; candidates that do are rows
    like all others, so an id may come more than once. Vectors are compared with vectors of
    the same length only. Fewer candidates than k: all of them; an empty side: no rows.
    """
    sides = [d.select("id", "vec", F.size("vec").alias("dim")).filter("id IS NOT NULL AND vec IS NOT NULL") for d in (queries, candidates)]
    n_tiles, n_shards = (
        max(1, -(-(d.agg(F.sum(F.greatest("dim", F.lit(1)))).first()[0] or 0) // cells)) for d, cells in zip(sides, (TILE_CELLS, SHARD_CELLS))
    )
    part = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    tiles = sides[0].withColumn("tile", part(n_tiles)).withColumn("shard", every(n_shards))
    shards = sides[1].withColumn("shard", part(n_shards)).withColumn("tile", every(n_tiles))
    # Both sides may come from one table: new columns tell them apart.
    grid, columns = ["dim", "tile", "shard"], ["dim", "tile", "shard", "id", "vec"]
    both = [side.select(*columns).toDF(*[f"{c}_{x}" for c in columns]).toDF(*columns).groupBy(*grid) for x, side in (("q", tiles), ("c", shards))]
    lists = both[0].cogroup(both[1]).applyInArrow(_cell(k), _SCHEMA)
    while n_shards > 1:
        n_shards = -(-n_shards // FAN_IN)
        lists = _merged(lists.withColumn("shard", F.floor(F.col("shard") / FAN_IN).cast("int")), k).drop("rank")
    return _merged(lists, k).select("query_id", "rank", "vec_id", "score")
