"""Language model scores by Brown's class-based n-grams.

Every word of the training texts has a class; a word's probability after another is that of its class after the
other's class, times that of the word in its class. Classes are found by exchange: words move to the class that raises
the likelihood of the training texts most, given the classes of their neighbours.

Texts are coded once: a *chunk* holds some documents as numbers of its own dictionary. Words are dealt to *buckets* by
their hash; a bucket knows its words' counts and classes. A sweep sends the classes of its words to every chunk, counts
there with which classes they stand, and sends the counts back to the buckets, where words move. So no task needs the
whole vocabulary. In each sweep one of ``PARTS`` parts of all words may move, so that neighbours do not all move at once.

* Words start in the class of their ending (a hash of the last two bytes). The end of a text is a class of its own.
* Words seen once make up the class of rare words, which unknown words belong to as well. How much of it is unknown is
  estimated by the numbers of words seen once and twice (Good and Turing).
* Class transitions are smoothed by class frequencies. Probabilities of all words and one unknown word sum to one at most.

Words count as equal by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesift.llm.common import settle

CLASSES = 64
END, RARE = CLASSES - 2, CLASSES - 1
PARTS = 3
ROUNDS = 2
#: Weight of class frequencies in a transition, in tokens.
SMOOTHING = 16.0
CHUNK_TOKENS = 2_000_000
CHUNK_BYTES = 32_000_000
#: Text of the corpus for each bucket of words.
BUCKET_BYTES = 32_000_000
NONE = np.uint32(2**32 - 1)

_END_WORD = b" "  # no word has a space
_CHUNK = "chunk long, ids array<long>, held array<boolean>, lengths array<int>, codes binary, hashes binary, first binary, trained binary"
_LINK = "bucket int, chunk long, slots binary, idx binary, counts binary, cls binary, total long, distinct long, ones long, twos long"
_ANSWER = "chunk long, bucket int, slots binary, idx binary, cls binary, counts binary"
_CONTEXT = "bucket int, idx binary, ctx binary, n binary, pairs array<long>"
_STATE = "bucket int, counts binary, cls binary"
_COUNTED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, emitted double, classes binary"


class _Codes(dict):
    """Numbers of words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _planes(x: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, all lowest bytes first: high bytes are mostly alike and take little space stored."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def _arrow(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<boolean>": pa.list_(pa.bool_())}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.table({name: pa.array(c, kinds[kind]) for (name, kind), c in zip(fields, columns)})


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32

    def fresh():
        words = _Codes()
        words[_END_WORD]
        return words, [], [], [], 0

    def chunk():
        codes = np.concatenate(parts)
        learn = np.repeat(~np.array(held, bool), [len(p) for p in parts])
        keys = list(words)
        first = np.frombuffer(bytes((w[-1] * 31 + (w[-2] if len(w) > 1 else 0)) * 131 % 251 % END for w in keys), np.uint8).copy()
        first[0] = END
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        trained = np.bincount(codes[learn], minlength=len(keys))
        return _arrow(_CHUNK, [(number, ids, held, [len(p) for p in parts], _planes(codes), hashes.tobytes(), first.tobytes(), _planes(trained))]).to_batches()

    words, parts, ids, held, size = fresh()
    tokens = 0
    for batch in batches:
        for i, out, text in zip(*(c.to_pylist() for c in batch.columns)):
            found = text.encode().lower().split()
            parts.append(np.fromiter(map(words.__getitem__, found), np.uint32, len(found)))
            parts[-1] = np.append(parts[-1], np.uint32(0))
            ids.append(i)
            held.append(out)
            size += len(text)
            tokens += len(found) + 1
            if tokens >= CHUNK_TOKENS or size >= CHUNK_BYTES:
                yield from chunk()
                number += 1
                words, parts, ids, held, size = fresh()
                tokens = 0
    if parts:
        yield from chunk()


def _pieces(buckets: int):
    """Each chunk's dictionary, split by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, hashes, first, trained in zip(*(c.to_pylist() for c in batch.columns)):
                hashes, first, trained = np.frombuffer(hashes, np.uint64), np.frombuffer(first, np.uint8), _numbers(trained)
                bucket = hashes % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                bounds = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
                rows = []
                for b, (x, y) in enumerate(zip(bounds[:-1], bounds[1:])):
                    if x < y:
                        at = order[x:y]
                        rows.append((b, chunk, _planes(at), hashes[at].tobytes(), first[at].tobytes(), _planes(trained[at])))
                yield from _arrow("bucket int, chunk long, slots binary, hashes binary, first binary, trained binary", rows).to_batches()

    return run


def _vocabulary(pieces: pa.Table) -> pa.Table:
    """A bucket's words that the training texts have, and where each chunk's words are among them."""
    bucket = pieces.column("bucket")[0].as_py()
    hashes = [np.frombuffer(h, np.uint64) for h in pieces.column("hashes").to_pylist()]
    trained = np.concatenate([_numbers(t) for t in pieces.column("trained").to_pylist()])
    first = np.concatenate([np.frombuffer(f, np.uint8) for f in pieces.column("first").to_pylist()])
    every, at, where = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    counts = np.bincount(where, trained, len(every)).astype(np.int64)
    place = np.where(counts > 0, np.cumsum(counts > 0) - 1, int(NONE)).astype(np.uint32)
    cls = first[at].copy()
    cls[(counts == 1) & (cls != END)] = RARE
    idx, start, rows = place[where], 0, []
    for chunk, slots, h in zip(pieces.column("chunk").to_pylist(), pieces.column("slots").to_pylist(), hashes):
        rows.append((bucket, chunk, slots, _planes(idx[start : start + len(h)]), None, None, 0, 0, 0, 0))
        start += len(h)
    known = counts > 0
    kept = counts[known]
    rare = cls[known] == RARE
    rows.append((bucket, None, None, None, kept.tobytes(), cls[known].tobytes(), int(kept.sum()), len(kept), int(rare.sum()), int((kept == 2).sum())))
    return _arrow(_LINK, rows)


def _answers(links: pa.Table, state: pa.Table) -> pa.Table:
    """Classes and counts of each chunk's words."""
    if not links.num_rows or not state.num_rows:
        return _arrow(_ANSWER, [])
    counts = np.append(np.frombuffer(state.column("counts")[0].as_py(), np.int64), 0)
    cls = np.append(np.frombuffer(state.column("cls")[0].as_py(), np.uint8), np.uint8(RARE))
    rows = []
    for bucket, chunk, slots, idx in zip(*(links.column(c).to_pylist() for c in ("bucket", "chunk", "slots", "idx"))):
        at = np.minimum(_numbers(idx), len(cls) - 1)
        rows.append((chunk, bucket, slots, idx, cls[at].tobytes(), counts[at].tobytes()))
    return _arrow(_ANSWER, rows)


def _read(chunk: pa.Table, answers: pa.Table) -> tuple[np.ndarray, ...]:
    """A chunk's tokens, the classes before them, its learning tokens, and what is known of its words."""
    row = {c: chunk.column(c)[0].as_py() for c in ("ids", "held", "lengths", "codes")}
    codes = _numbers(row["codes"])
    size = int(codes.max()) + 1
    cls, counts = np.empty(size, np.uint8), np.zeros(size, np.int64)
    bucket, idx = np.empty(size, np.int32), np.empty(size, np.uint32)
    for b, slots, at, c, n in zip(*(answers.column(c).to_pylist() for c in ("bucket", "slots", "idx", "cls", "counts"))):
        slots = _numbers(slots)
        bucket[slots], idx[slots], cls[slots], counts[slots] = b, _numbers(at), np.frombuffer(c, np.uint8), np.frombuffer(n, np.int64)
    return row, codes, cls, counts, bucket, idx


def _contexts(part: int, buckets: int):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        """How often words of the part that moves stand after and before words of each class; class pairs of all words."""
        if not chunk.num_rows or not answers.num_rows:
            return _arrow(_CONTEXT, [])
        row, codes, cls, _, bucket, idx = _read(chunk, answers)
        lengths = np.array(row["lengths"], np.int64)
        learn = np.repeat(~np.array(row["held"], bool), lengths)
        of = cls[codes]
        before = np.concatenate([[np.uint8(END)], of[:-1]])
        pairs = np.bincount(before[learn].astype(np.int64) * CLASSES + of[learn], minlength=CLASSES**2)
        moving = (idx != NONE) & (idx % PARTS == part) & (cls < END)
        keys = []
        here = learn & moving[codes]
        keys.append(codes[here].astype(np.int64) * (2 * CLASSES) + before[here])
        here = (learn & moving[codes])[:-1]  # a text's last token is its end, which does not move
        keys.append(codes[:-1][here].astype(np.int64) * (2 * CLASSES) + CLASSES + of[1:][here])
        key, n = np.unique(np.concatenate(keys), return_counts=True)
        word, ctx = key // (2 * CLASSES), (key % (2 * CLASSES)).astype(np.uint8)
        order = np.lexsort((idx[word], bucket[word]))
        word, ctx, n = word[order], ctx[order], n[order]
        bounds = np.searchsorted(bucket[word], np.arange(buckets + 1))
        rows = [(-1, None, None, None, pairs.tolist())]
        for b, (x, y) in enumerate(zip(bounds[:-1], bounds[1:])):
            if x < y:
                steps = np.diff(idx[word[x:y]], prepend=np.uint32(0))
                rows.append((b, _planes(steps), ctx[x:y].tobytes(), _planes(n[x:y]), None))
        return _arrow(_CONTEXT, rows)

    return run


def moved(cls: np.ndarray, counts: np.ndarray, idx: np.ndarray, ctx: np.ndarray, n: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Classes after one exchange of the words ``idx``, which stand ``n`` times with context ``ctx``.

    Contexts below ``CLASSES`` are classes before the word, others classes after it. A word goes where the likelihood
    grows most; for its own class, its own share of the counts is taken out first. Ties go to the smaller class.
    """
    cls = cls.copy()
    key, where = np.unique(idx.astype(np.int64) * (2 * CLASSES) + ctx, return_inverse=True)
    n = np.bincount(where, n, len(key))
    if not len(key):
        return cls
    idx, ctx = key // (2 * CLASSES), key % (2 * CLASSES)
    # (context, class) with one more token in every class, spread as contexts are over all words: an empty class attracts nothing.
    share = np.concatenate([pairs.sum(axis=1), pairs.sum(axis=0)]) / max(pairs.sum(), 1) + 1e-9
    table = np.concatenate([pairs, pairs.T])[:, :END] + share[:, None]
    total = pairs.sum(axis=0)[:END] + 1.0
    log_table, log_total = np.log(table).astype(np.float32), np.log(total)
    words, starts = np.unique(idx, return_index=True)
    ends = np.append(starts[1:], len(idx))
    step = 1 + (1 << 22) // CLASSES
    at = 0
    while at < len(words):
        last = max(at + 1, int(np.searchsorted(ends, starts[at] + step, side="right")))
        part = slice(starts[at], ends[last - 1])
        weight = n[part].astype(np.float32)
        first = starts[at:last] - starts[at]
        gain = np.add.reduceat(log_table[ctx[part]] * weight[:, None], first, axis=0)
        w = words[at:last]
        gain -= 2 * counts[w, None] * log_total
        own = cls[w].astype(np.int64)
        mine = np.repeat(own, ends[at:last] - starts[at:last])
        left = np.maximum(table[ctx[part], mine] - n[part], share[ctx[part]])
        stay = np.add.reduceat(n[part] * np.log(left), first) - 2 * counts[w] * np.log(np.maximum(total[own] - counts[w], 1))
        gain[np.arange(len(w)), own] = stay
        cls[w] = gain.argmax(axis=1)
        at = last
    return cls


def _exchange(pairs: np.ndarray):
    def run(contexts: pa.Table, state: pa.Table) -> pa.Table:
        if not state.num_rows:
            return _arrow(_STATE, [])
        bucket, counts, cls = (state.column(c)[0].as_py() for c in ("bucket", "counts", "cls"))
        if contexts.num_rows and "idx" in contexts.column_names:
            idx = np.concatenate([np.cumsum(_numbers(x), dtype=np.int64) for x in contexts.column("idx").to_pylist()])
            ctx = np.concatenate([np.frombuffer(x, np.uint8) for x in contexts.column("ctx").to_pylist()])
            n = np.concatenate([_numbers(x) for x in contexts.column("n").to_pylist()])
            cls = moved(np.frombuffer(cls, np.uint8), np.frombuffer(counts, np.int64), idx, ctx, n, pairs).tobytes()
        return _arrow(_STATE, [(bucket, counts, cls)])

    return run


@dataclass(frozen=True)
class Model:
    """What all texts share: token and word counts, and counts of class pairs (``CLASSES`` squared)."""

    tokens: int
    words: int
    ones: int
    twos: int
    pairs: np.ndarray | None = None

    def emission(self, counts: np.ndarray, cls: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """log10 of each word's probability in its class."""
        unknown = (self.ones + 1) / (self.ones + 2 * self.twos + 2)
        p = counts / np.maximum(totals[cls], 1)
        p = np.where(cls == RARE, np.where(counts > 0, (1 - unknown) / max(self.ones, 1), unknown), p)
        return np.log10(np.where(cls == END, 1.0, p))

    def transition(self) -> np.ndarray:
        """log10 of each class's probability after each class."""
        share = (self.pairs.sum(axis=0) + 1) / (self.pairs.sum() + CLASSES)
        return np.log10((self.pairs + SMOOTHING * share) / (self.pairs.sum(axis=1, keepdims=True) + SMOOTHING))


def likelihood(pairs: np.ndarray) -> float:
    """What exchange raises: the classes' part of the training texts' log likelihood."""
    f = lambda x: float((x * np.log(np.maximum(x, 1))).sum())
    return f(pairs) - f(pairs.sum(axis=0)) - f(pairs.sum(axis=1))


def _counted(model: Model, totals: np.ndarray):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        """Per text what does not depend on transitions, and its classes."""
        if not chunk.num_rows or not answers.num_rows:
            return _arrow(_COUNTED, [])
        row, codes, cls, counts, _, _ = _read(chunk, answers)
        base = np.log10((counts + 1) / (model.tokens + model.words + 1))
        emitted = model.emission(counts, cls, totals)
        ends = np.cumsum(row["lengths"])
        starts = ends - row["lengths"]
        known, base, emitted = (np.add.reduceat(x[codes], starts) for x in ((counts > 0).astype(np.int64), base, emitted))
        classes = cls[codes].tobytes()
        return _arrow(_COUNTED, [(i, h, n, int(k), b, e, classes[s : s + n]) for i, h, n, k, b, e, s in zip(row["ids"], row["held"], row["lengths"], known.tolist(), base.tolist(), emitted.tolist(), starts.tolist())])

    return run


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class pairs of the learning texts of a task."""
    out = np.zeros(CLASSES**2, np.int64)
    for batch in batches:
        for classes in batch.column(0).to_pylist():
            of = np.frombuffer(classes, np.uint8).astype(np.int64)
            out += np.bincount(np.append(END, of[:-1]) * CLASSES + of, minlength=CLASSES**2)
    yield from _arrow("pairs array<long>", [(out.tolist(),)]).to_batches()


def _scored(model: Model):
    table = model.transition()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = []
            for emitted, classes in zip(batch.column("emitted").to_pylist(), batch.column("classes").to_pylist()):
                of = np.frombuffer(classes, np.uint8)
                score.append(emitted + float(table[np.append(np.uint8(END), of[:-1]), of].sum()))
            known = [batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known", "base_score")]
            tokens = pa.array([model.tokens] * batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*known[:4], tokens, known[4], pa.array(score, pa.float64())], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def _matrix(rows: DataFrame) -> np.ndarray:
    """The sum of arrays of class pairs: at most ``CLASSES`` squared numbers come to the driver."""
    sums = rows.select(F.posexplode("pairs").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).filter("n > 0")
    out = np.zeros(CLASSES**2, np.int64)
    for r in sums.collect():
        out[r.at] = r.n
    return out.reshape(CLASSES, CLASSES)


def class_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", watch: Callable[[float], None] | None = None) -> DataFrame:
    """One row per input row: ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``.

    Words are separated by white space, A-Z counts as lower case, and every text is followed by an end, which is a
    token too. The model learns from the rows for which ``held_out`` is not true. ``score`` is the log10 probability
    of the text, ``base_score`` that by add-one word frequencies. Null texts are empty; empty texts are their end.
    Repeated rows count, and are scored, as often as they come. Null ids stay null. An empty table gives no rows; if
    nothing is left to learn from, all words are unknown. ``watch`` is called with the classes' likelihood before
    every sweep.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    buckets = 1 + size // BUCKET_BYTES
    chunks = settle(rows.mapInArrow(_coded, _CHUNK), "chunks")
    pieces = chunks.select("chunk", "hashes", "first", "trained").mapInArrow(_pieces(buckets), "bucket int, chunk long, slots binary, hashes binary, first binary, trained binary")
    linked = settle(pieces.groupBy("bucket").applyInArrow(_vocabulary, _LINK), "words")
    state = linked.filter("chunk IS NULL").select("bucket", "counts", "cls")
    links = linked.filter("chunk IS NOT NULL").select("bucket", "chunk", "slots", "idx")
    sums = linked.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "distinct", "ones", "twos")]).first()
    model = Model(sums.total, sums.distinct, sums.ones, sums.twos)
    coded = chunks.select("chunk", "ids", "held", "lengths", "codes")

    def at_chunks(run, schema: str, label: str) -> DataFrame:
        answers = links.groupBy("bucket").cogroup(state.groupBy("bucket")).applyInArrow(_answers, _ANSWER)
        return settle(coded.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema), label)

    for sweep in range(PARTS * ROUNDS):
        contexts = at_chunks(_contexts(sweep % PARTS, buckets), _CONTEXT, "contexts")
        pairs = _matrix(contexts.filter("bucket < 0"))
        if watch:
            watch(likelihood(pairs))
        counted = contexts.filter("bucket >= 0").select("bucket", "idx", "ctx", "n")
        state = settle(counted.groupBy("bucket").cogroup(state.groupBy("bucket")).applyInArrow(_exchange(pairs), _STATE), "classes")
    totals = _class_totals(state)
    texts = at_chunks(_counted(model, totals), _COUNTED, "texts")
    pairs = _matrix(texts.filter("NOT held_out").select("classes").mapInArrow(_pair_counts, "pairs array<long>"))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.mapInArrow(_scored(Model(model.tokens, model.words, model.ones, model.twos, pairs)), schema)


def _class_totals(state: DataFrame) -> np.ndarray:
    """Tokens of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(CLASSES, np.int64)
        for batch in batches:
            for counts, cls in zip(*(c.to_pylist() for c in batch.columns)):
                np.add.at(out, np.frombuffer(cls, np.uint8), np.frombuffer(counts, np.int64))
        yield from _arrow("pairs array<long>", [(out.tolist(),)]).to_batches()

    return _matrix(state.select("counts", "cls").mapInArrow(run, "pairs array<long>"))[0]
