"""Toxicity by a classifier chain.

The categories are predicted one after the other by linear models over words; each model also gets the
probabilities of the categories before it. For training these come from models that have not seen the row (out of
fold), as the probabilities of rows seen in training would be too sure.

Fitted on the driver from a bounded sample of labelled rows (``TRAIN_ROWS``), of which only hashed words are
collected, and of the words only those that tell a category best are kept. All texts are scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesift.llm.bpe import Words
from lakesift.llm.labelled import fold, sampled, with_text
from lakesift.llm.linear import logistic, predict

TRAIN_ROWS = 6_000
FOLDS = 5
BUCKETS = 1 << 20
#: Words per category, and in how many texts of the sample a word has to occur.
WORDS_PER_CATEGORY = 150
LEAST_TEXTS = 5
#: Lengths of the beginnings of words.
STEMS = (3, 4, 5, 6)
THRESHOLD = 0.3

_WORD = re.compile(r"[^\W\d_]+")


def _buckets(word: str) -> tuple[int, ...]:
    """Buckets of a word and of its beginnings, which words of one stem share."""
    parts = [word, *("^" + word[:n] for n in STEMS if n <= len(word))]
    return tuple([xxhash.xxh64_intdigest(p) % BUCKETS for p in parts])


def _buckets_of(text: str, known: Words) -> np.ndarray:
    return np.array(sorted(set(chain.from_iterable(map(known.__getitem__, set(_WORD.findall(text.lower())))))), np.int32)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = Words(_buckets)
    for batch in batches:
        words = [_buckets_of(t or "", known) for t in batch.column("text").to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *words])))
        rest = [batch.column(c) for c in batch.schema.names if c != "text"]
        names = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*rest, lists], [*names, "words"])


@dataclass(frozen=True)
class Chain:
    """Fitted models: the word buckets of each category's model, and its weights (words, earlier categories, bias)."""

    categories: tuple[str, ...]
    words: tuple[tuple[int, ...], ...]
    weights: tuple[tuple[float, ...], ...]

    def score(self, seen: list[np.ndarray]) -> np.ndarray:
        """Probabilities (texts, categories). ``seen[k]`` marks which words of category k each text has."""
        out = np.empty((len(seen[0]), 0))
        for x, w in zip(seen, self.weights):
            out = np.column_stack([out, predict(np.array(w), np.column_stack([x, out]))])
        return out


def _telling(y: np.ndarray, rows: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Buckets that tell a category best by the chi-squared of their presence."""
    found, at = np.unique(buckets, return_inverse=True)
    n = np.bincount(at, minlength=len(found)).astype(float)
    hits = np.bincount(at, weights=y[rows], minlength=len(found))
    total, share = max(len(y), 1), y.mean() if len(y) else 0.0
    gap = hits - n * share
    chi = gap**2 / np.maximum(n * share * (1 - share) * (1 - n / total), 1e-9)
    chi[n < LEAST_TEXTS] = 0
    order = np.lexsort((found, -chi))[:WORDS_PER_CATEGORY]
    return np.sort(found[order][chi[order] > 10.8])  # chance in a thousand


def _marks(n: int, rows: np.ndarray, buckets: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    x = np.zeros((n, len(chosen)), np.float32)
    if len(chosen):
        at = np.minimum(np.searchsorted(chosen, buckets), len(chosen) - 1)
        hit = chosen[at] == buckets
        x[rows[hit], at[hit]] = 1
    return x


def fit_chain(sizes: np.ndarray, buckets: np.ndarray, labels: np.ndarray, folds: np.ndarray, categories: list[str]) -> Chain:
    """Fit the models in order, feeding each the out-of-fold probabilities of those before.

    ``buckets`` are those of all texts, one text after the other, ``sizes`` of each.
    """
    texts = len(sizes)
    rows = np.repeat(np.arange(texts), sizes)
    earlier = np.empty((texts, 0))
    chosen_all, weights = [], []
    for k in range(len(categories)):
        y = labels[:, k].astype(float)
        out_of_fold = np.zeros(texts)
        for f in range(FOLDS):
            train, test = folds != f, folds == f
            at = train[rows]
            where = np.cumsum(train) - 1
            chosen = _telling(y[train], where[rows[at]], buckets[at])
            x = np.column_stack([_marks(texts, rows, buckets, chosen), earlier])
            out_of_fold[test] = predict(logistic(x[train], y[train]), x[test])
        chosen = _telling(y, rows, buckets)
        x = np.column_stack([_marks(texts, rows, buckets, chosen), earlier])
        weights.append(tuple(logistic(x, y).tolist()))
        chosen_all.append(tuple(chosen.tolist()))
        earlier = np.column_stack([earlier, out_of_fold])
    return Chain(tuple(categories), tuple(chosen_all), tuple(weights))


def train(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id", text_col: str = "text", limit: int = TRAIN_ROWS) -> Chain:
    """Fit a chain on at most ``limit`` labelled rows.

    ``labels`` has the id and one 0/1 column per category, in the order of the chain. Rows with a null id or label
    take no part; of a repeated id one row does. Without any row every category has probability one half.
    """
    usable = labels.select(F.col(id_col).cast("long").alias(id_col), *[F.col(c).cast("int").alias(c) for c in categories]).dropna().dropDuplicates([id_col])
    sample = with_text(docs, sampled(usable, id_col, limit), id_col, text_col).withColumn("fold", fold(id_col, FOLDS))
    schema = sample.drop("text").schema.add("words", T.ArrayType(T.IntegerType()))
    rows = sample.mapInArrow(_hashed, schema).toArrow().sort_by(id_col)
    target = np.array([rows.column(c).to_pylist() for c in categories], float).T.reshape(-1, len(categories))
    words = rows.column("words").combine_chunks()
    sizes = words.value_lengths().to_numpy(zero_copy_only=False)
    return fit_chain(sizes, words.flatten().to_numpy(), target, rows.column("fold").to_numpy(), categories)


def _scores(models: Chain, threshold: float, decisive: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[int, list[tuple[int, int]]] = {}
        for k, chosen in enumerate(models.words):
            for j, bucket in enumerate(chosen):
                places.setdefault(bucket, []).append((k, j))
        # Most words are in no model: they are looked up once and skipped.
        known = Words(lambda w: tuple([b for b in _buckets(w) if b in places]))
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            seen = [np.zeros((len(texts), len(c)), np.float32) for c in models.words]
            for i, text in enumerate(texts):
                for bucket in set(chain.from_iterable(map(known.__getitem__, set(_WORD.findall((text or "").lower()))))):
                    for k, j in places[bucket]:
                        seen[k][i, j] = 1
            p = models.score(seen)
            rest = [batch.column(c) for c in batch.schema.names if c != "_text"]
            names = [c for c in batch.schema.names if c != "_text"]
            columns = [pa.array(p[:, k]) for k in range(p.shape[1])] + [pa.array((p[:, decisive] >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*rest, *columns], [*names, *[f"_p{k}" for k in range(p.shape[1])], "_toxic"])

    return run


def _scored(docs: DataFrame, models: Chain, decisive: str, threshold: float, text_col: str, keep: list[str]) -> DataFrame:
    """Columns by place, so that no name can clash: ``_c0…`` kept, ``_p0…`` probabilities, ``_toxic``."""
    rows = docs.select(*[docs[c].alias(f"_c{k}") for k, c in enumerate(keep)], docs[text_col].cast("string").alias("_text"))
    schema = rows.drop("_text").schema
    for k in range(len(models.categories)):
        schema = schema.add(f"_p{k}", "double")
    return rows.mapInArrow(_scores(models, threshold, models.categories.index(decisive)), schema.add("_toxic", "integer"))


def score(docs: DataFrame, models: Chain, keep: list[str], decisive: str = "toxic", threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The columns ``keep``, ``p_<category>`` for each category, and ``toxic`` (0 or 1).

    ``toxic`` is 1 where the decisive category's probability reaches the threshold. Null and empty texts have no
    words and get the score of such. Every row is scored by itself, so repeated rows get equal scores. An empty
    table gives no rows.
    """
    out = _scored(docs, models, decisive, threshold, text_col, keep)
    return out.select(
        *[F.col(f"_c{k}").alias(c) for k, c in enumerate(keep)], *[F.col(f"_p{k}").alias(f"p_{c}") for k, c in enumerate(models.categories)], F.col("_toxic").alias("toxic")
    )


def without_toxic(docs: DataFrame, models: Chain, decisive: str = "toxic", threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all their columns."""
    out = _scored(docs, models, decisive, threshold, text_col, docs.columns).filter("_toxic = 0")
    return out.select(*[F.col(f"_c{k}").alias(c) for k, c in enumerate(docs.columns)])


#: The chain of the test tables, whose ``labels`` mark junk (quality 0) and toxic texts: junk, abuse, abuse in good prose.
CATEGORIES = ["junk", "toxic", "toxic_prose"]


def table_labels(labels: DataFrame) -> DataFrame:
    """The chain's categories from ``labels (doc_id, quality, toxic)``."""
    return labels.select(
        "doc_id", (1 - F.col("quality")).alias("junk"), F.col("toxic"), (F.col("toxic") * F.col("quality")).alias("toxic_prose")
    )
