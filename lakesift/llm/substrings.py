"""Repeated passages by seed and extension on winnowed anchors.

Seeds: of every ``window`` words the run of ``ANCHOR`` words with the smallest hash is the anchor (winnowing), so
equal windows have equal anchors at equal places. Documents are joined on anchors that occur more than once.
Extension: around each such anchor the windows that it stands for are compared, from the first that still holds it
at its right end to the last that holds it at its left. Windows found in an earlier document are removed; those that
touch make up the maximal repeats, from ``window`` words on.

Only anchors (about one in seven words) and windows around repeated anchors are shuffled. Whole copies of a text are
settled before by a key of their words, and counts are taken before the shuffle, so a passage of very many
documents is one row per task and window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesift.llm.common import settle
from lakesift.llm.words import LAST_ID, hasher, mixed, run_hashes, sequence_key, word_hashes

WINDOW = 20
ANCHOR = 8


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents by id and words; null ids come last."""
    text = F.col(text_col).cast("string").alias("text")
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), *sequence_key(text_col), text)


def _anchor_places(hashes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each anchor run, and for every window the place of its anchor (the first of the smallest)."""
    runs = run_hashes(hashes, anchor)
    per = window - anchor + 1
    if len(runs) < per:
        return runs, np.empty(0, np.int64)
    place = np.arange(len(runs))
    value, reach = runs, 1
    while reach < per:  # minimum of ranges by doubling
        step = min(reach, per - reach)
        n = len(value) - step
        right = value[step:] < value[:n]
        place = np.where(right, place[step:], place[:n])
        value = np.where(right, value[step:], value[:n])
        reach += step
    return runs, place


def _repeats_inside(windows: np.ndarray) -> np.ndarray:
    """True where a window has come before in the same document."""
    again = np.ones(len(windows), bool)
    again[np.unique(windows, return_index=True)[1]] = False
    return again


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(kind.to_pandas_dtype(), copy=False)))


def _seeds(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hasher()
        for batch in batches:
            anchors, inside = [], []
            for text in batch.column("text").to_pylist():
                hashes = word_hashes((text or "").encode().split(), known)
                runs, place = _anchor_places(hashes, window, anchor)
                anchors.append(np.unique(runs[place]).view(np.int64))
                inside.append(np.flatnonzero(_repeats_inside(run_hashes(hashes, window))).astype(np.int32))
            columns = [batch.column(c) for c in ("id", "k1", "k2")]
            yield pa.RecordBatch.from_arrays([*columns, _lists(anchors, pa.int64()), _lists(inside, pa.int32())], ["id", "k1", "k2", "anchors", "inside"])

    return run


def _extended(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hasher()
        for batch in batches:
            found: list[list[np.ndarray]] = [[], [], []]
            seeds = batch.column("seeds")
            for i, text in enumerate(batch.column("text").to_pylist()):
                hashes = word_hashes((text or "").encode().split(), known)
                runs, place = _anchor_places(hashes, window, anchor)
                windows = run_hashes(hashes, window)
                wanted = seeds[i].values.to_numpy().view(np.uint64)
                at = np.flatnonzero(np.isin(runs[place], wanted) & ~_repeats_inside(windows))
                tags = (run_hashes(mixed(hashes), window)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                for out, values in zip(found, (windows[at].view(np.int64), tags, at.astype(np.int32))):
                    out.append(values)
            columns = [batch.column(c) for c in ("id", "k1", "k2")]
            lists = [_lists(v, t) for v, t in zip(found, (pa.int64(), pa.int32(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([*columns, *lists], ["id", "k1", "k2", "windows", "tags", "starts"])

    return run


def repeated_starts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``(id, k1, k2, copy, starts)`` of every document of which words are to be removed.

    ``starts`` are the places of windows that occur earlier; ``copy`` marks documents that are, word for word, one
    with a smaller id: all their windows occur earlier.
    """
    keyed = _keyed(docs, id_col, text_col)
    seeds = settle(keyed.mapInArrow(_seeds(window, anchor), "id long, k1 long, k2 long, anchors array<long>, inside array<int>"), "anchors")
    key = ["id", "k1", "k2"]
    groups = settle(seeds.groupBy("k1", "k2").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last"), "word-copies")
    copies = seeds.select(*key).join(groups, ["k1", "k2"]).filter("id > first").select(*key).distinct()
    copies = settle(copies, "later-copies")
    firsts = settle(seeds.join(copies, key, "left_anti"), "first-copies")

    anchors = firsts.select(*key, F.explode("anchors").alias("anchor"))
    shared = settle(anchors.groupBy("anchor").count().filter("count > 1").select("anchor"), "shared-anchors")
    wanted = settle(anchors.join(shared, "anchor").groupBy(*key).agg(F.collect_list("anchor").alias("seeds")), "seeds")
    schema = "id long, k1 long, k2 long, windows array<long>, tags array<int>, starts array<int>"
    extended = settle(keyed.join(wanted, key).select(*key, "text", "seeds").mapInArrow(_extended(window, anchor), schema), "windows")
    windows = extended.select(*key, F.explode(F.arrays_zip("windows", "tags", "starts")).alias("w")).select(*key, "w.windows", "w.tags", "w.starts")
    earliest = settle(
        windows.groupBy("windows", "tags").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").drop("last"),
        "earliest",
    )
    later = windows.join(earliest, ["windows", "tags"]).filter("id > first").groupBy(*key).agg(F.collect_list("starts").alias("later"))
    later = settle(later, "later-windows")
    local = firsts.filter(F.size("inside") > 0).select(*key, "inside").dropDuplicates(key)
    none = F.array().cast("array<int>")
    both = local.join(later, key, "full").select(
        *key, F.lit(False).alias("copy"), F.concat(F.coalesce("inside", none), F.coalesce("later", none)).alias("starts")
    )
    return settle(both.unionByName(copies.select(*key, F.lit(True).alias("copy"), none.alias("starts"))), "repeats")


def kept_words(words: list[bytes], starts: np.ndarray | None, copy: bool, window: int) -> list[bytes]:
    """The words that no repeated window covers."""
    n = len(words)
    if copy and n >= window:
        return []
    if starts is None or not len(starts):
        return words
    cover = np.zeros(n + 1, np.int32)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    keep = np.cumsum(cover[:n]) == 0
    return [words[i] for i in np.flatnonzero(keep)]


def _cleaned(window: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, out = [], [], []
            starts, copy = batch.column("_starts"), batch.column("_copy").to_pylist()
            for i, text in enumerate(batch.column("_text").to_pylist()):
                words = (text or "").encode().split()
                kept = kept_words(words, starts[i].values.to_numpy() if starts[i].is_valid else None, bool(copy[i]), window)
                n.append(len(words))
                removed.append(len(words) - len(kept))
                joined = b" ".join(kept)
                out.append(hashlib.sha256(joined).hexdigest() if digest else text if len(kept) == len(words) else joined.decode())
            names = [c for c in batch.schema.names if c not in ("_starts", "_copy", "_text")]
            columns = [*map(batch.column, names), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(out, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "_n_words", "_n_removed", "_out"])

    return run


def _applied(docs: DataFrame, keep: list[str], id_col: str, text_col: str, window: int, anchor: int, digest: bool) -> DataFrame:
    """Columns by place, so that no name can clash: ``_c0…`` kept, and what was counted and kept of the text."""
    repeats = repeated_starts(docs, id_col, text_col, window, anchor)
    repeats = repeats.select(*[F.col(c).alias(f"_{c}") for c in ("id", "k1", "k2", "copy", "starts")])
    k1, k2 = sequence_key(text_col)
    rows = docs.select(
        *[F.col(c).alias(f"_c{k}") for k, c in enumerate(keep)], F.col(text_col).cast("string").alias("_text"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_id"), k1.alias("_k1"), k2.alias("_k2"),
    )
    rows = rows.join(repeats, ["_id", "_k1", "_k2"], "left").drop("_id", "_k1", "_k2")
    schema = rows.drop("_text", "_copy", "_starts").schema.add("_n_words", "long").add("_n_removed", "long").add("_out", "string")
    return rows.mapInArrow(_cleaned(window, digest), schema)


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``(id_col, n_words, n_removed, kept_sha256)`` of every row.

    A word goes if a window of ``window`` words around it occurs in a document with a smaller id, or earlier in its
    own. Windows are judged on the input. Null text has no words; texts below ``window`` words lose none. A null id
    comes after all others. Rows with the same id are one age: neither loses words to the other, but each to itself.
    An empty table gives no rows.
    """
    out = _applied(docs, [id_col], id_col, text_col, window, anchor, digest=True)
    return out.select(F.col("_c0").alias(id_col), F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), F.col("_out").alias("kept_sha256"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` with repeated words taken out of the text, all other columns and rows as they are.

    Texts that lose nothing stay as they are, white space included; the words of others are joined by one space.
    """
    keep = [c for c in docs.columns if c != text_col]
    out = _applied(docs, keep, id_col, text_col, window, anchor, digest=False)
    named = {c: F.col(f"_c{k}") for k, c in enumerate(keep)} | {text_col: F.col("_out")}
    return out.select(*[named[c].alias(c) for c in docs.columns])
