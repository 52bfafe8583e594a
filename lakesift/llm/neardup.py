"""Near-duplicates by a chosen-path set similarity join.

Every text is a set of word shingles. Texts with equal sets are one class. A class follows, in each of several
independent trees, paths of chosen minwise tokens: at a node two positions of its minwise signature are chosen (by
the node alone), and the tokens there name its children. Similar sets choose the same tokens and so meet in some
node; with two children per node a pair of similarity 0.8 shares a path of any depth in one tree with probability
0.94, and in one of four trees but for about one in 65,000.

* Small nodes are compared exhaustively on 128-bit sketches. They give out a forest of the closest pairs rather than
  all pairs. At the first depth, where a node may hold a whole group of near copies, few members make a node small;
  further down, where loosely related texts part slowly, more of them do, which saves most of the levels.
* Members of large nodes are compared with one pivot. Those near it are its family and go no further; all others
  follow their paths to the next level.
* Pairs given out are confirmed on full shingle sets and joined to components.
* Only pairs whose members are connected already may be left out. So nodes that have more near pairs, and families of
  more than one component, are looked at again: near pairs between components are confirmed too, but a node that has
  many of them for its members becomes a family. In a family the members outside its main component are compared with all members, block by block, on full sets. A block gives out a
  forest over the components that it links. Blocks come in rounds, each of four times as many as the one before, and
  what a round has joined to the main component is not compared again: links grow with the members, not with their pairs.
* Nodes are split until they are small. In deep nodes that are not, only members far from the pivot go on, so every level leaves
  fewer; what is nearer is compared in the family.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesift.llm.common import settle, shuffled, text_of
from lakesift.llm.components import components
from lakesift.llm.words import LAST_ID, hasher, mixed, run_hashes, word_hashes

TREES = 4
BRANCHES = 2
POSITIONS = 128
FIRST_DEPTH = 2
#: Branchings from one comparison with pivots to the next.
STEP = 1
#: From here on all that is near a pivot by its sketch stays behind in the family, whatever its size.
DEEP = 6
SMALL = 64
#: Below the first depth nodes of so many times ``SMALL`` members are small: a million pairs, compared in one task.
LATER = 16
#: A small node with more near pairs between components for each member is compared as a family.
PAIRS_EACH = 16
#: Sketches of sets of similarity 0.8 differ in 12.8 of 128 bits on average, with a deviation of 3.4. What is linked
#: with a set of that similarity has 0.6 at least: 25.6 bits, with a deviation of 4.5.
NEAR_BITS = 26
FAMILY_BITS = 38
#: Whoever is within NEAR_BITS of a member that stays behind in a deep node is within this many bits of the pivot.
DEEP_FAMILY_BITS = 2 * NEAR_BITS
#: Members in one block of a family; growth of the number of blocks compared in a round.
BLOCK = 512
ROUND_GROWTH = 4

_RNG = np.random.default_rng(20240531)
_FACTORS = _RNG.integers(1, 2**63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 2**63, POSITIONS, dtype=np.uint64)


def shingles(text: str, size: int, known) -> np.ndarray:
    """Sorted hashes of the distinct shingles; fewer words than ``size`` are one shingle, no words none."""
    hashes = word_hashes(text.encode().lower().split(), known)
    if not len(hashes):
        return np.empty(0, np.uint64)
    return np.unique(run_hashes(hashes, min(size, len(hashes))))


def signature(values: np.ndarray) -> np.ndarray:
    """Smallest 32-bit token of the set at each position."""
    out = np.full(POSITIONS, 2**32 - 1, np.uint32)
    for at in range(0, len(values), 2048):
        tokens = (mixed(values[at : at + 2048, None] * _FACTORS + _SHIFTS) >> np.uint64(32)).astype(np.uint32)
        out = np.minimum(out, tokens.min(axis=0))
    return out


def sketch(sig: np.ndarray) -> np.ndarray:
    """One bit of every token, packed into two integers."""
    return np.packbits(sig & 1).view(np.int64)


def _keys(text: Column) -> list[Column]:
    """128 bits that tell texts apart."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def _summaries(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hasher()
        for batch in batches:
            n, sets, sigs, bits = [], [], [], []
            for text in batch.column("text").to_pylist():
                values = shingles(text, size, known)
                n.append(len(values))
                weigh = mixed(values)
                sets.append((int(values.sum()), int((weigh * (weigh >> np.uint64(7) | np.uint64(1))).sum())))
                sig = signature(values)
                sigs.append(sig.tobytes())
                bits.append(sketch(sig))
            both = np.array(bits).reshape(-1, 2)
            two = np.array(sets, np.uint64).reshape(-1, 2).view(np.int64)
            columns = [batch.column(c) for c in ("id", "k1", "k2")]
            columns += [pa.array(n, pa.int32()), pa.array(two[:, 0]), pa.array(two[:, 1]), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "k1", "k2", "n", "s1", "s2", "b1", "b2", "sig"])

    return run


_SUMMARY = "id long, k1 long, k2 long, n int, s1 long, s2 long, b1 long, b2 long, sig binary"
_ROW = "node long, cls long, n int, b1 long, b2 long"


def _children(nodes: np.ndarray, sigs: np.ndarray) -> np.ndarray:
    """Children of each row's nodes: (rows, nodes) to (rows, nodes * BRANCHES)."""
    out = []
    for branch in range(BRANCHES):
        choice = mixed(nodes + np.uint64(branch + 1))
        at = (choice % np.uint64(POSITIONS // BRANCHES)).astype(np.int64) + branch * (POSITIONS // BRANCHES)
        token = np.take_along_axis(sigs, at, axis=1).astype(np.uint64)
        out.append(mixed(choice ^ mixed(token + np.uint64(1))))
    return np.concatenate(out, axis=1)


def _rows(nodes: np.ndarray, batch: pa.RecordBatch) -> pa.RecordBatch:
    repeat = np.repeat(np.arange(batch.num_rows), nodes.shape[1])
    rest = [batch.column(c).take(pa.array(repeat)) for c in ("cls", "n", "b1", "b2")]
    return pa.RecordBatch.from_arrays([pa.array(nodes.reshape(-1).view(np.int64)), *rest], ["node", "cls", "n", "b1", "b2"])


def _sigs(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, POSITIONS)


def _first_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    roots = mixed(np.arange(1, TREES + 1, dtype=np.uint64))
    for batch in batches:
        nodes = np.tile(roots, (batch.num_rows, 1))
        for _ in range(FIRST_DEPTH):
            nodes = _children(nodes, _sigs(batch))
        yield _rows(nodes, batch)


def _next_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, sigs = batch.column("node").to_numpy().view(np.uint64)[:, None], _sigs(batch)
        for _ in range(STEP):
            nodes = _children(nodes, sigs)
        yield _rows(nodes, batch)


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Batches of rows sorted by node, cut so that no node is split."""
    rest: dict[str, np.ndarray] | None = None
    for batch in batches:
        rows = {c: batch.column(c).to_numpy() for c in batch.schema.names}
        if rest is not None:
            rows = {c: np.concatenate([rest[c], v]) for c, v in rows.items()}
        if len(rows["node"]):
            last = np.searchsorted(rows["node"], rows["node"][-1])
            yield {c: v[:last] for c, v in rows.items()}
            rest = {c: v[last:] for c, v in rows.items()}
    if rest is not None:
        yield rest


def _forest(near: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """A forest of the closest pairs; ties by the members, so that nodes that share members agree."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    out = []
    for pair in sorted(near):
        a, b = root(pair[1]), root(pair[2])
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append(pair)
    return out


def _dense_forest(apart: np.ndarray, i: np.ndarray, j: np.ndarray, cls: np.ndarray) -> list[tuple[int, int]]:
    """The pairs ``(low, high)`` of ``_forest`` for many near pairs ``i, j`` of one node, grown member by member."""
    order, far = np.argsort(np.argsort(cls)), np.iinfo(np.int64).max - 1
    cost, low, high = np.full(apart.shape, far), np.minimum(order[i], order[j]), np.maximum(order[i], order[j])
    cost[i, j] = cost[j, i] = (apart[i, j].astype(np.int64) * len(cls) + low) * len(cls) + high
    best, via, left, out = np.full(len(cls), far), np.zeros(len(cls), int), np.ones(len(cls), bool), []
    for _ in range(len(cls)):
        at = int(best.argmin())
        if best[at] < far:
            x, y = int(cls[at]), int(cls[via[at]])
            out.append((min(x, y), max(x, y)))
        left[at], best[at] = False, far + 1
        closer = left & (cost[at] < best)
        best[closer], via[closer] = cost[at][closer], at
    return out


def _bits_apart(x1, y1, x2, y2) -> np.ndarray:
    # The count of a signed number would be that of its absolute value.
    count = lambda x, y: np.bitwise_count((x ^ y).view(np.uint64))
    return count(x1, y1) + count(x2, y2)


def _similar_sizes(a, b):
    """Sets of similarity 0.8 or more have sizes within that ratio."""
    return 100 * np.minimum(a, b) >= 80 * np.maximum(a, b)


def _near_pairs(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bits apart of all members of a node, and the positions of its near pairs."""
    b1, b2, n = rows["b1"], rows["b2"], rows["n"].astype(int)
    apart = _bits_apart(b1[:, None], b1, b2[:, None], b2)
    i, j = np.nonzero(np.triu((apart <= NEAR_BITS) & _similar_sizes(n[:, None], n), 1))
    return apart, i, j


def _bounds(rows: dict[str, np.ndarray]) -> np.ndarray:
    """Where nodes begin and end."""
    node = rows["node"]
    return np.flatnonzero(np.diff(node, prepend=node[:1] - 1, append=node[-1:] + 1)) if len(node) else np.zeros(1, np.int64)


_FOUND = f"a long, b long, {_ROW}"


def _small_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a forest of each node's near pairs; where it has other near pairs, also its rows that have such pairs."""
    for rows in _sorted_groups(batches):
        bounds = _bounds(rows)
        sizes = np.diff(bounds)
        a, b, again = [], [], [np.empty(0, np.int64)]
        two = bounds[:-1][sizes == 2]
        apart = _bits_apart(rows["b1"][two], rows["b1"][two + 1], rows["b2"][two], rows["b2"][two + 1])
        two = two[(apart <= NEAR_BITS) & _similar_sizes(rows["n"][two].astype(int), rows["n"][two + 1].astype(int))]
        a += np.minimum(rows["cls"][two], rows["cls"][two + 1]).tolist()
        b += np.maximum(rows["cls"][two], rows["cls"][two + 1]).tolist()
        for start, size in zip(bounds[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            part = {c: v[start : start + size] for c, v in rows.items()}
            apart, i, j = _near_pairs(part)
            if not len(i):
                continue
            cls = part["cls"]
            if len(i) > 8 * size:
                kept = _dense_forest(apart, i, j, cls)
            else:
                low, high = np.minimum(cls[i], cls[j]), np.maximum(cls[i], cls[j])
                kept = [p[1:] for p in _forest(list(zip(apart[i, j].tolist(), low.tolist(), high.tolist())))]
            a += [p[0] for p in kept]
            b += [p[1] for p in kept]
            if len(kept) < len(i):
                again.append(start + np.unique(np.concatenate([i, j])))
        at = np.concatenate(again)
        columns = [pa.array(a + [None] * len(at), pa.int64()), pa.array(b + [None] * len(at), pa.int64())]
        for c in ("node", "cls", "n", "b1", "b2"):
            own = pa.array(rows[c][at])
            columns.append(pa.concat_arrays([pa.nulls(len(a), own.type), own]))
        yield pa.RecordBatch.from_arrays(columns, ["a", "b", "node", "cls", "n", "b1", "b2"])


def _cross_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All near pairs of small nodes between different components; of a node with many, its smallest class and each member."""
    for rows in _sorted_groups(batches):
        a, b, family = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, bool)]
        bounds = _bounds(rows)
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            part = {c: v[start:end] for c, v in rows.items()}
            _, i, j = _near_pairs(part)
            cls, root = part["cls"], part["root"]
            i, j = i[root[i] != root[j]], j[root[i] != root[j]]
            many = len(i) > PAIRS_EACH * len(cls)
            a.append(np.full(len(cls), cls.min()) if many else np.minimum(cls[i], cls[j]))
            b.append(cls if many else np.maximum(cls[i], cls[j]))
            family.append(np.full(len(b[-1]), many))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b, family)], ["a", "b", "family"])


def _apart(left: str, right: str) -> Column:
    """Bits in which two sketches differ."""
    return F.bit_count(F.col(f"{left}b1").bitwiseXOR(F.col(f"{right}b1"))) + F.bit_count(F.col(f"{left}b2").bitwiseXOR(F.col(f"{right}b2")))


def _near(left: str, right: str) -> Column:
    """Are two rows' sketches and sizes near?"""
    n, m = F.col(f"{left}n").cast("long"), F.col(f"{right}n").cast("long")
    return (_apart(left, right) <= NEAR_BITS) & (100 * F.least(n, m) >= 80 * F.greatest(n, m))


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


class _Tree:
    """What the walk down the trees has found."""

    def __init__(self) -> None:
        self.pairs: list[DataFrame] = []
        self.small: list[DataFrame] = []  # rows of small nodes with near pairs not given out
        self.families: list[DataFrame] = []  # (pivot, cls)

    def walk(self, classes: DataFrame) -> None:
        level = settle(classes.select("cls", "n", "b1", "b2", "sig").mapInArrow(_first_level, _ROW), "level")
        depth, small = FIRST_DEPTH, SMALL
        while True:
            # Per node: members, and the pivot, which is the smallest class.
            large = settle(level.groupBy("node").agg(F.count(F.lit(1)).alias("members"), F.min("cls").alias("pivot")).filter(F.col("members") > small), "large")
            if large.isEmpty():
                self._small(level)
                return
            self._small(level.join(shuffled(large), "node", "left_anti"))
            sketches = classes.select(F.col("cls").alias("pivot"), *[F.col(c).alias(f"pivot_{c}") for c in ("n", "b1", "b2")])
            pivots = large.join(sketches, "pivot").drop("members")
            rows = level.join(shuffled(pivots), "node").withColumns({"near": _near("", "pivot_"), "apart": _apart("", "pivot_")})
            rows = settle(rows.select("node", "cls", "n", "b1", "b2", "pivot", "near", "apart"), "large-rows")
            self.pairs.append(rows.filter("near AND cls <> pivot").select(*_pair("cls", "pivot")))
            deep = depth >= DEEP
            self.families.append(rows.filter(F.col("apart") <= (DEEP_FAMILY_BITS if deep else FAMILY_BITS)).select("pivot", "cls"))
            going = rows.filter(F.col("apart") > NEAR_BITS if deep else ~F.col("near")).select("node", "cls", "n", "b1", "b2")
            if going.isEmpty():
                return
            level = settle(going.join(classes.select("cls", "sig"), "cls").mapInArrow(_next_level, _ROW), "level")
            depth, small = depth + STEP, SMALL * LATER

    def _small(self, rows: DataFrame) -> None:
        found = settle(rows.repartition("node").sortWithinPartitions("node").mapInArrow(_small_nodes, _FOUND), "small")
        self.pairs.append(found.filter("b IS NOT NULL").select("a", "b"))
        self.small.append(found.filter("b IS NULL").drop("a", "b"))

    def cross_pairs(self, roots: DataFrame) -> DataFrame:
        """Near pairs between different components in small nodes that did not give out all their pairs.

        Rows of ``family`` are a pivot and a member instead.
        """
        rows = _rooted(reduce(DataFrame.unionByName, self.small), roots)
        return rows.repartition("node").sortWithinPartitions("node").mapInArrow(_cross_pairs, "a long, b long, family boolean").distinct()


def family_links(families: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> list[DataFrame]:
    """Links ``(a, b)`` between roots: what joins members of a family outside its main component to any member.

    Members are dealt to blocks. A round compares those still outside with some blocks that they have not been
    compared with; then its links are worked in, so that fewer are outside in the next.
    """
    rows = settle(_rooted(families, roots), "family-roots")
    sizes = rows.groupBy("pivot", "root").agg(F.count(F.lit(1)).alias("c"))
    sizes = sizes.groupBy("pivot").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.sum("c").alias("all"), F.max("c").alias("most"))
    parts = lambda n: F.ceil(n / BLOCK).cast("int")
    mixed = settle(sizes.filter("most < all").select("pivot", "main", parts(F.col("all")).alias("blocks")), "mixed-families")
    last = mixed.agg(F.max("blocks")).first()[0] or 0
    members = rows.join(mixed, "pivot").withColumn("j", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    members, found, first, width = settle(members.select("pivot", "main", "cls", "root", "blocks", "j"), "members"), [], 0, 1
    while first < last:
        left = members.filter((F.col("root") != F.col("main")) & (F.col("blocks") > first))
        counts = settle(left.groupBy("pivot").agg(parts(F.count(F.lit(1))).alias("p")), "outside")
        if counts.isEmpty():
            break
        end = F.least(F.col("blocks"), F.lit(first + width)) - 1
        outside = left.join(counts, "pivot").withColumn("i", F.pmod(F.xxhash64(F.lit(first), "cls"), F.col("p")).cast("int"))
        outside = outside.withColumn("j", F.explode(F.sequence(F.lit(first), end)))
        others = members.filter(F.col("j").between(first, first + width - 1)).join(counts, "pivot").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("p") - 1)))
        grid, columns = ["pivot", "i", "j"], ["pivot", "i", "j", "cls", "root", "set"]
        # Both sides come from the same tables: new columns tell them apart.
        both = [side.join(sets, "cls").select(*columns).toDF(*columns).groupBy(*grid) for side in (outside, others)]
        links = settle(both[0].cogroup(both[1]).applyInArrow(_block_links(percent), "a long, b long").distinct(), "family-links")
        first, width = first + width, width * ROUND_GROWTH
        if links.isEmpty():
            continue
        found.append(links)
        if first < last:
            moved = components(links)
            for c in ("root", "main"):
                to = moved.select(F.col("node").alias("_of"), F.col("root").alias("_to"))
                members = members.join(to, F.col(c) == F.col("_of"), "left").withColumn(c, F.coalesce("_to", c)).drop("_of", "_to")
            members = settle(members, "members")
    return found


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows with the root of their class, which is the class itself where it has no link."""
    of = roots.select(F.col("node").alias("_of"), "root")
    return rows.join(of, F.col("cls") == F.col("_of"), "left").withColumn("root", F.coalesce("root", "cls")).drop("_of")


def _incidence(sets: list[np.ndarray], vocabulary: np.ndarray) -> np.ndarray:
    """One row per set, one column per shingle of the vocabulary."""
    out = np.zeros((len(sets), len(vocabulary)), np.float32)
    for row, values in zip(out, sets):
        at = np.minimum(np.searchsorted(vocabulary, values), len(vocabulary) - 1)
        row[at[vocabulary[at] == values]] = 1
    return out


def _block_links(percent: int):
    def compare(outside: pa.Table, members: pa.Table) -> pa.Table:
        a, b = [], []
        # A side without rows may come with its key columns only.
        if all(t.num_rows and "set" in t.column_names for t in (outside, members)):
            x, y = ([np.frombuffer(v, np.uint64) for v in t.column("set").to_pylist()] for t in (outside, members))
            root_x, root_y = (t.column("root").to_numpy() for t in (outside, members))
            size_x, size_y = (np.array([len(v) for v in s]) for s in (x, y))
            both = np.zeros((len(x), len(y)), np.float32)
            # Shingles that several of the outside members have come in parts, so that no matrix is large.
            vocabulary = np.unique(np.concatenate(x))
            for at in range(0, len(vocabulary), 8192):
                part = vocabulary[at : at + 8192]
                both += _incidence(x, part) @ _incidence(y, part).T
            linked = (root_x[:, None] != root_y) & (100 * both >= percent * (size_x[:, None] + size_y - both))
            i, j = np.nonzero(linked)
            joined = np.unique(np.stack([np.minimum(root_x[i], root_y[j]), np.maximum(root_x[i], root_y[j])], axis=1), axis=0)
            kept = _forest([(0, x, y) for x, y in joined.tolist()])
            a, b = [x for _, x, _ in kept], [y for _, _, y in kept]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compare


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hasher()
        for batch in batches:
            sets = [shingles(text, size, known).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(sets, pa.binary())], ["cls", "set"])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            chosen = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([chosen.column("a"), chosen.column("b")], ["a", "b"])

    return run


def _full_sets(wanted: DataFrame, classes: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """``(cls, set)`` of the wanted classes, from the texts."""
    keys = settle(classes.join(wanted, "cls", "left_semi").select("cls", "id", "k1", "k2"), "wanted")
    rows = texts.join(shuffled(keys), ["id", "k1", "k2"]).select("cls", "text")
    return settle(rows.mapInArrow(_sets(size), "cls long, set binary"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` whose full sets are similar."""
    side = lambda c: sets.select(F.col("cls").alias(c), F.col("set").alias(f"set_{c}"))
    return settle(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_confirm(percent), "a long, b long"), "links")


def _components(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, k1, k2, n, component)`` of every row; ``LAST_ID`` stands for no id."""
    if percent < 80:
        raise ValueError("the trees and sketches are made for 80 per cent or more")
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), text_of(text_col).alias("text")).select("id", *_keys(F.col("text")), "text")
    summaries = settle(texts.mapInArrow(_summaries(size), _SUMMARY).withColumn("row", F.monotonically_increasing_id()), "summaries")
    sets = ["n", "s1", "s2"]
    # Of equal sets the smallest id stands for all; its first row carries the set.
    first = summaries.filter("n > 0").groupBy(*sets).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("rows"))
    groups = settle(first, "set-groups")
    own = summaries.filter("n > 0").join(groups.select(*sets, "id"), [*sets, "id"], "left_semi")
    rows = own.groupBy(*sets).agg(F.min("row").alias("cls"))
    classes = settle(summaries.join(rows.select("cls"), F.col("row") == F.col("cls"), "left_semi").withColumnRenamed("row", "cls"), "classes")

    tree = _Tree()
    tree.walk(classes)
    pairs = settle(reduce(DataFrame.unionByName, tree.pairs).distinct(), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls"))
    families = None
    if tree.families:
        families = settle(reduce(DataFrame.unionByName, tree.families).distinct(), "families")
        wanted = wanted.unionByName(families.select("cls"))
    full = _full_sets(wanted.distinct(), classes, texts, size)
    links = _confirmed(pairs, full, percent)
    roots = components(links)
    cross = settle(tree.cross_pairs(roots), "cross-pairs")
    found = [_confirmed(cross.filter("NOT family").select("a", "b").join(pairs, ["a", "b"], "left_anti"), full, percent)]
    many = cross.filter("family").select(F.col("a").alias("pivot"), F.col("b").alias("cls"))
    if not many.isEmpty():
        families = many if families is None else families.unionByName(many).distinct()
    if families is not None:
        found += family_links(families, roots, full, percent)
    # What is connected already is a star around its root; only new links can change it.
    stars = roots.select(F.col("root").alias("a"), F.col("node").alias("b"))
    roots = components(reduce(DataFrame.unionByName, [stars, *found]))
    members = roots.join(classes.select(F.col("cls").alias("node"), *sets, "id"), "node")
    least = members.groupBy("root").agg(F.min("id").alias("component"))
    named = settle(members.join(least, "root").select(*sets, "component"), "named")

    own_id = groups.select(*sets, F.col("id").alias("alone")).join(named, sets, "left").select(*sets, F.coalesce("component", "alone").alias("component"))
    named = settle(own_id, "set-components")
    return summaries.select("id", "k1", "k2", *sets).join(named, sets, "left").withColumn("component", F.coalesce("component", "id"))


def near_groups(docs: DataFrame, size: int, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``(id_col, n_shingles, component_id, kept)``.

    Texts are linked if the intersection of their sets of ``size``-word shingles is at least ``percent`` per cent of
    the union (80 at least); ``component_id`` is the smallest id that links reach. Upper-case A-Z counts as lower
    case. Null, empty and blank texts have no shingles and are linked with nothing, not even one another. Null ids
    come after all others; a component of null ids only has a null id. Repeated rows are in one component. An empty
    table gives no rows.
    """
    real = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    return _components(docs, size, percent, id_col, text_col).select(
        real("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), real("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept")
    )


def without_near_copies(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, with all their columns."""
    gone = _components(docs, size, percent, id_col, text_col).filter("id <> component").select("id", "k1", "k2").distinct()
    gone = settle(gone, "near-copies").select(*[F.col(c).alias(f"_lakesift_{c}") for c in ("id", "k1", "k2")])
    k1, k2 = _keys(text_of(text_col))
    marked = docs.withColumns({"_lakesift_x": k1, "_lakesift_y": k2})
    same = (F.coalesce(docs[id_col].cast("long"), F.lit(LAST_ID)) == gone["_lakesift_id"]) & (F.col("_lakesift_x") == gone["_lakesift_k1"]) & (F.col("_lakesift_y") == gone["_lakesift_k2"])
    return marked.join(shuffled(gone), same, "left_anti").drop("_lakesift_x", "_lakesift_y")
