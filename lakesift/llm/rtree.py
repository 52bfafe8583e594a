"""Mining of hard negatives with STR-packed R-trees.

Rows are dealt by label and first coordinate, and each task packs its rows by sort-tile-recursive: sorted by label,
then cut into slices by one coordinate after the other, those of largest variance first, until a slice fills a leaf.
Leaves in a row form inner nodes, those a tree of at most ``TREE_ROWS`` rows. A node's box holds the least and largest
value of every coordinate, which bounds its inner products with a vector from below and above.

Anchors meet every group of trees once, in tiles. An anchor's queue holds nodes by their upper bound, best first. Nodes
are dropped whose bounds lie outside all score windows, whose upper bound is strictly below the k-th score found, or
whose labels do not fit. Trees of a group are searched best first as well, each with what those before it found; what
the groups return for an anchor is merged.

Positives are searched first (same label, any score), then negatives within the window that each positive's score sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesift.llm.common import settle
from lakesift.llm.topk import _products

LEAF_ROWS = 32
FANOUT = 16
TREE_ROWS = 2048
#: Components in a task that packs, in a tile of anchors, and in a group of trees on average.
PACK_CELLS = 1_000_000
TILE_CELLS = 65_536
GROUP_CELLS = 262_144
#: Nodes taken from an anchor's queue at once.
BATCH = 8

_TREE = "tree long, dim int, ids binary, labels binary, vecs binary, leaves binary"
_HIT = "anchor long, window int, id long, score long"
_LARGE = 2**62
NOTHING = (np.empty(0, np.int64), np.empty(0, np.int64))


def _pack_order(vecs: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The order of rows in the leaves of packed trees, and the leaves' sizes."""
    spread = np.argsort(-vecs.var(axis=0), kind="stable") if vecs.shape[1] else np.zeros(1, np.int64)
    leaves: list[np.ndarray] = []

    def tile(rows: np.ndarray, level: int) -> None:
        if len(rows) <= LEAF_ROWS or not vecs.shape[1]:
            leaves.extend(rows[i : i + LEAF_ROWS] for i in range(0, len(rows), LEAF_ROWS))
            return
        pages = -(-len(rows) // LEAF_ROWS)
        slices = max(2, round(pages ** (1 / max(1, len(spread) - level))))
        rows = rows[np.argsort(vecs[rows, spread[level % len(spread)]], kind="stable")]
        size = -(-pages // slices) * LEAF_ROWS
        for i in range(0, len(rows), size):
            tile(rows[i : i + size], level + 1)

    by_label = np.argsort(labels, kind="stable")
    for part in np.split(by_label, np.flatnonzero(np.diff(labels[by_label])) + 1):
        tile(part, 0)
    return np.concatenate(leaves), [len(x) for x in leaves]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trees of a task's rows."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    rows = pa.Table.from_batches(parts)
    ids, labels = (rows.column(c).to_numpy() for c in ("id", "label"))
    dims = rows.column("dim").to_numpy()
    number = TaskContext.get().partitionId() << 32
    for dim in np.unique(dims):
        here = np.flatnonzero(dims == dim)
        vecs = rows.column("vec").take(pa.array(here)).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(here), dim)
        order, sizes = _pack_order(vecs, labels[here])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        first = 0
        while first < len(sizes):
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + TREE_ROWS, side="right")) - 1)
            at = order[bounds[first] : bounds[last]]
            columns = [[number], [int(dim)], *([x.tobytes()] for x in (ids[here][at], labels[here][at], vecs[at], np.array(sizes[first:last], np.int64)))]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[2:])], [c.split()[0] for c in _TREE.split(", ")])
            number += 1
            first = last


class Tree:
    """A packed tree: rows in the order of their leaves, boxes and label ranges of leaves and inner nodes."""

    def __init__(self, dim: int, ids: bytes, labels: bytes, vecs: bytes, leaves: bytes) -> None:
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.vecs = np.frombuffer(vecs, np.float64).reshape(len(self.ids), dim)
        bounds = np.concatenate([[0], np.cumsum(np.frombuffer(leaves, np.int64))])
        levels = []  # (row bounds of nodes, bounds of their children)
        while True:
            levels.append(bounds)
            if len(bounds) <= 2:
                break
            bounds = bounds[np.append(np.arange(0, len(bounds) - 1, FANOUT), len(bounds) - 1)]
        start = np.concatenate([b[:-1] for b in levels])
        self.start, self.end = start, np.concatenate([b[1:] for b in levels])
        self.n_leaves = len(levels[0]) - 1
        offsets = np.cumsum([0, *(len(b) - 1 for b in levels)])
        self.children = [np.empty(0, np.int64)] * self.n_leaves
        for below, off, level in zip(levels, offsets, levels[1:]):
            n = len(below) - 1
            self.children += [off + np.arange(i, min(i + FANOUT, n)) for i in range(0, n, FANOUT)]
        self.root = len(start) - 1
        least, most = zip(*((np.minimum.reduceat(self.vecs, b[:-1]), np.maximum.reduceat(self.vecs, b[:-1])) for b in levels))
        self.least, self.most = np.concatenate(least), np.concatenate(most)
        self.label_least = np.concatenate([np.minimum.reduceat(self.labels, b[:-1]) for b in levels])
        self.label_most = np.concatenate([np.maximum.reduceat(self.labels, b[:-1]) for b in levels])

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product of every vector with every node's box."""
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        low, high = up @ self.least.T + down @ self.most.T, up @ self.most.T + down @ self.least.T
        # Whole numbers are exact unless very large; then bounds give way by more than rounding can be.
        slack = np.abs(q) @ np.maximum(np.abs(self.least), np.abs(self.most)).T
        slack = np.where(slack < 2**53, 0, slack * 1e-9)
        return low - slack, high + slack

    def search(self, q: np.ndarray, label: int, own: int, low: np.ndarray, high: np.ndarray, windows: list[tuple[int, int]], k: int, same: bool, found: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Per window ``(ids, scores)`` of the k best rows in it: higher scores first, ties by the smaller id.

        ``found`` has what other trees gave, and gets what this one adds. ``low`` and ``high`` are the nodes' bounds for ``q``. Rows of the id ``own`` are left out, and rows of other
        labels than ``label``, or of that label if ``same`` is false.
        """
        if same:
            fits = (self.label_least <= label) & (self.label_most >= label)
        else:
            fits = (self.label_least != label) | (self.label_most != label)
        lo, hi = np.array([w[0] for w in windows], float), np.array([w[1] for w in windows], float)
        kth = np.array([float(scores[-1]) if len(scores) == k else -np.inf for _, scores in found])
        queue = np.array([self.root])
        while True:
            need = (high[queue, None] >= np.maximum(lo, kth)) & (low[queue, None] <= hi)
            queue = queue[fits[queue] & need.any(axis=1)]
            if not len(queue):
                return
            order = np.argsort(-high[queue], kind="stable")
            best, queue = queue[order[:BATCH]], queue[order[BATCH:]]
            leaves, inner = best[best < self.n_leaves], best[best >= self.n_leaves]
            queue = np.concatenate([queue, *(self.children[i] for i in inner)])
            if not len(leaves):
                continue
            at = np.concatenate([np.arange(self.start[i], self.end[i]) for i in leaves])
            at = at[(self.ids[at] != own) & ((self.labels[at] == label) == same)]
            if not len(at):
                continue
            scores = _products(q[None, :], self.vecs[at])[0].astype(np.int64)
            ids = self.ids[at]
            for i, (a, b) in enumerate(windows):
                inside = (scores >= a) & (scores <= b) & (scores >= kth[i])
                if inside.any():
                    both_ids, both = np.concatenate([found[i][0], ids[inside]]), np.concatenate([found[i][1], scores[inside]])
                    top = np.lexsort((both_ids, -both))[:k]
                    found[i] = both_ids[top], both[top]
                    if len(top) == k:
                        kth[i] = float(both[top[-1]])


def _cell(k: int, same: bool):
    def run(anchors: pa.Table, trees: pa.Table) -> pa.Table:
        out: tuple[list, list, list, list] = ([], [], [], [])
        # A side without rows may come with its key columns only.
        if all(t.num_rows and c in t.column_names for t, c in ((anchors, "vec"), (trees, "vecs"))):
            number, own, label, windows = (anchors.column(c).to_pylist() for c in ("anchor", "id", "label", "windows"))
            q = anchors.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(number), -1)
            windows = [[(w["lo"], w["hi"]) for w in ws] for ws in windows]
            forest = [Tree(*parts) for parts in zip(*(trees.column(c).to_pylist() for c in ("dim", "ids", "labels", "vecs", "leaves")))]
            bounds = [tree.bounds(q) for tree in forest]
            tops = np.array([high[:, tree.root] for tree, (_, high) in zip(forest, bounds)])
            for i, n in enumerate(number):
                found = [NOTHING] * len(windows[i])
                for t in np.argsort(-tops[:, i], kind="stable").tolist():
                    low, high = bounds[t]
                    forest[t].search(q[i], label[i], own[i], low[i], high[i], windows[i], k, same, found)
                for w, (ids, scores) in enumerate(found):
                    out[0].extend([n] * len(ids))
                    out[1].extend([w] * len(ids))
                    out[2].extend(ids.tolist())
                    out[3].extend(scores.tolist())
        return pa.table({"anchor": pa.array(out[0], pa.int64()), "window": pa.array(out[1], pa.int32()), "id": pa.array(out[2], pa.int64()), "score": pa.array(out[3], pa.int64())})

    return run


def pack(rows: DataFrame) -> DataFrame:
    """Packed trees of ``(id, label, vec)``; vectors of different lengths are in different trees."""
    rows = rows.withColumn("dim", F.size("vec"))
    size = rows.agg(F.sum(F.greatest("dim", F.lit(1)))).first()[0] or 0
    # Equal labels and coordinates are told apart by a hash of the id, so that no task gets all of them.
    dealt = rows.repartitionByRange(1 + size // PACK_CELLS, "dim", "label", F.try_element_at("vec", F.lit(1)), F.xxhash64("id"))
    return settle(dealt.select("id", "label", "dim", "vec").mapInArrow(_packed, _TREE), "trees")


def search(anchors: DataFrame, trees: DataFrame, k: int, same: bool) -> DataFrame:
    """``(anchor, window, id, score, rank)``: the k best rows in each window of each anchor.

    ``anchors`` has ``(anchor, id, label, vec, windows)``, windows being an array of ``(lo, hi)``, both included.
    """
    anchors = anchors.withColumn("dim", F.size("vec"))
    cells = lambda df, n: int(df.agg(F.sum(n)).first()[0] or 0)
    n_tiles = 1 + cells(anchors, F.greatest("dim", F.lit(1))) // TILE_CELLS
    n_groups = 1 + cells(trees, F.octet_length("vecs") / 8) // GROUP_CELLS
    part = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    grid = ["dim", "tile", "group"]
    left = anchors.withColumn("tile", part("anchor", n_tiles)).withColumn("group", every(n_groups))
    right = trees.withColumn("group", part("tree", n_groups)).withColumn("tile", every(n_tiles))
    hits = left.groupBy(*grid).cogroup(right.groupBy(*grid)).applyInArrow(_cell(k, same), _HIT)
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int, negatives: int, low_percent: int, high_percent: int) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows`` has ``id`` (long), ``label`` (long) and ``vec`` (array of doubles that are whole numbers). An anchor's
    positives are the first rows of its label, its negatives those of other labels whose score is at least
    ``low_percent`` and at most ``high_percent`` of the positive's; higher scores come first, ties by the smaller id.
    Rows with an anchor's own id are neither. Rows with a null id, label or vector take no part; vectors are
    compared with vectors of the same length only. Rows that repeat an id are rows like all others: a repeated
    anchor is mined as often as it comes. An anchor without positives or negatives, and an empty table, give no rows.
    Scores beyond 64 bits count as the largest or smallest number of 64 bits.
    """
    rows = rows.select("id", "label", "vec").dropna()
    trees = pack(rows)
    anchors = settle(rows.filter(is_anchor).withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    whole = F.array(F.struct(F.lit(-_LARGE * 2).cast("long").alias("lo"), F.lit(_LARGE * 2 - 1).cast("long").alias("hi")))
    near = settle(search(anchors.withColumn("windows", whole), trees, positives, same=True), "positives")
    # Whole-number bounds of low * positive <= 100 * negative <= high * positive.
    wide = F.col("score").cast("decimal(38,0)")
    lo = F.ceil(wide * low_percent / 100).cast("long").alias("lo")
    hi = F.floor(wide * high_percent / 100).cast("long").alias("hi")
    windows = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", lo, hi, "id", "score"))).alias("found"))
    windows = settle(windows, "windows")
    wanted = anchors.join(windows, "anchor")
    bounds = F.transform("found", lambda f: F.struct(f["lo"].alias("lo"), f["hi"].alias("hi")))
    hits = search(wanted.withColumn("windows", bounds).drop("found"), trees, negatives, same=False)
    named = wanted.select("anchor", F.col("id").alias("anchor_id"), F.posexplode("found").alias("window", "positive"))
    named = named.select("anchor", "window", "anchor_id", F.col("positive.id").alias("positive_id"), F.col("positive.score").alias("positive_score"))
    out = hits.select("anchor", "window", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(named, ["anchor", "window"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
