"""Order-preserving packing of documents into sequences by dynamic programming.

The tokens of the documents, in stored order, form one stream that is cut into windows of at most ``window``
tokens. Cuts may fall at document ends, after sentences, and inside sentences that are long. A cut costs a
truncation penalty (none at a document's end), a window its padding: none at a power of two, else what is missing
to ``window``. The cheapest sequence of cuts is found exactly. As padding is linear in a window's length, the best
earlier cut for each cut is the minimum of a sliding range, kept in a monotone queue; windows of a power of two are
tried besides. Work is linear in the number of possible cuts.

A cut inside a sentence costs ``HARD_CUT``, so no window of the optimum carries more padding than about that. The last
window's worth of a block may be cut anywhere, so that short blocks are padded little, too.

Documents are packed where they lie: a task packs blocks of about ``BLOCK_TOKENS`` tokens one after the other, each
ended at a document's end. Nothing is shuffled and memory is bounded by a block and the longest document.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 2048
BLOCK_TOKENS = 1_000_000
#: Penalties in tokens of padding: for a cut after a sentence, and inside one.
SENTENCE_CUT = 8
HARD_CUT = 16
#: Distance of possible cuts inside a sentence.
HARD_STEP = 64
#: Sequence ids: the task's number in the upper bits.
TASK_BITS = 40

#: Fixed value: how byte-level tokenizers cut text into pieces.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def best_cuts(at: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> list[int]:
    """Positions of the cheapest cuts among ``at`` (rising, the last is the stream's end).

    ``penalty`` is the price of each cut; neighbouring positions are at most ``window`` apart.
    """
    powers = [1 << b for b in range(window.bit_length()) if 1 << b < window]
    cost: dict[int, int] = {0: 0}
    before: dict[int, int] = {}
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (position, cost there + position), both rising
    for end, price in zip(at.tolist(), penalty.tolist()):
        while queue[0][0] < end - window:
            queue.popleft()
        start, value = queue[0]
        least = value + window - end
        for p in powers:
            c = cost.get(end - p)
            if c is not None and c < least:
                least, start = c, end - p
        least += price
        cost[end], before[end] = least, start
        value = least + end
        while queue and queue[-1][1] >= value:
            queue.pop()
        queue.append((end, value))
    cuts = [int(at[-1])]
    while cuts[-1]:
        cuts.append(before[cuts[-1]])
    return cuts[::-1]


def possible_cuts(doc_ends: np.ndarray, sentence_ends: np.ndarray, step: int = HARD_STEP, fine: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All possible cuts of a block with their penalties; long stretches get cuts ``step`` apart.

    In the last ``fine`` tokens every position is one, so that what is left at a block's end falls into powers of two.
    """
    at = np.union1d(doc_ends, sentence_ends)
    at = at[at > 0]
    gaps = np.diff(at, prepend=0)
    inside = [np.arange(end - gap + step, end, step) for end, gap in zip(at[gaps > step], gaps[gaps > step])]
    inside.append(np.arange(max(at[-1] - fine, 1), at[-1]))
    whole = np.union1d(at, np.concatenate(inside))
    penalty = np.full(len(whole), HARD_CUT)
    penalty[np.searchsorted(whole, at)] = SENTENCE_CUT
    penalty[np.searchsorted(whole, doc_ends)] = 0
    return whole, penalty


class _Ids:
    """Ids of texts, and the places where sentences end.

    The ranks file holds the vocabulary of the tokenizer file; texts with the string of a special token go through
    the tokenizer file itself, which alone knows them.
    """

    def __init__(self, path: str, ranks: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        specials = [t.content for t in library.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as f:
            words = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=PIECE, mergeable_ranks=words, special_tokens={})
        self.special = re.compile("|".join(map(re.escape, specials)) or "(?!)")
        self.plain = fast.encode_ordinary
        self.whole = lambda text: library.encode(text, add_special_tokens=False).ids
        self.ender = np.zeros(library.get_vocab_size(), bool)
        self.ender[[rank for word, rank in words.items() if word[-1:] in b".!?\n"]] = True

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array((self.whole if self.special.search(text) else self.plain)(text), "<u4")
        return ids, np.flatnonzero(self.ender[ids]) + 1


def _pack(path: str, ranks: str, end_id: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = _Ids(path, ranks), np.array([end_id], "<u4")
        sequence = TaskContext.get().partitionId() << TASK_BITS
        block: list[tuple] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, sentences = encode(text or "")
                block.append((doc_id, np.concatenate([ids, end]), sentences))
                size += len(ids) + 1
                if size >= BLOCK_TOKENS:
                    out, sequence = _block(block, sequence, window)
                    yield out
                    block, size = [], 0
        if block:
            yield _block(block, sequence, window)[0]

    return run


def _block(block: list[tuple], sequence: int, window: int) -> tuple[pa.RecordBatch, int]:
    """The pieces of one block, and the next free sequence id."""
    lengths = np.array([len(ids) for _, ids, _ in block], np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    sentences = np.concatenate([s + first for (_, _, s), first in zip(block, starts.tolist())])
    cuts = best_cuts(*possible_cuts(ends, sentences, fine=window), window)
    # A piece ends at a window's or a document's end.
    bounds = np.union1d(cuts, ends)
    bounds = bounds[bounds > 0]
    firsts = np.concatenate([[0], bounds[:-1]])
    doc = np.searchsorted(ends, firsts, side="right")
    seq = np.searchsorted(np.array(cuts), firsts, side="right") - 1
    start = firsts - starts[doc]
    length = bounds - firsts
    crc = [zlib.crc32(block[d][1][s : s + n].data) for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist())]
    columns = [
        pa.array([block[d][0] for d in doc.tolist()], pa.int64()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
        pa.array(lengths[doc]), pa.array(seq + sequence), pa.array(firsts - np.array(cuts)[seq]),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PIECES.split(", ")]), sequence + len(cuts) - 1


def pack(docs: DataFrame, path: str, ranks: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per piece: ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.

    A document is the ids of its whole text by the byte-level tokenizer file ``path``, whose vocabulary ``ranks``
    holds as ranks, and ``end_id``; null and empty texts are ``end_id`` alone. Every id lies in exactly one piece, and the pieces of a sequence follow one another
    from offset 0. Rows are packed one by one in stored order, whatever their ids; repeated rows are packed as
    often as they come. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_pack(path, ranks, end_id, window), PIECES)
