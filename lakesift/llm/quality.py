"""Quality by positive-unlabelled learning.

A linear model is fitted on trusted positives and unlabelled texts by minimising the non-negative unbiased risk:
with class prior p, the risk of negatives is that of the unlabelled texts minus p times that of the positives taken
as negatives; where a step would push it below zero, the step goes the other way. Labels of negatives are not used.

The prior is estimated from positives and unlabelled texts alone: a model that tells the two apart is fitted on one half
of each; above any threshold, the share of the other half's unlabelled texts over that of its positives bounds the
prior from above. The threshold with the least bound, allowing for chance, is taken.

Features describe a text as a whole and its worst stretches: shares of capitals, marks, symbols, digits, repeated and
short words. They are computed on whole texts. The fit is on the driver, on bounded samples (``POSITIVES``,
``UNLABELLED``), of which only the features are collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesift.llm.labelled import fold, sampled, with_text
from lakesift.llm.linear import descend, sigmoid

POSITIVES = 4_000
UNLABELLED = 12_000
FOLDS = 5
THRESHOLD = 0.3
#: Characters and words of a stretch.
STRETCH_CHARS = 240
STRETCH_WORDS = 40

_MARKS = np.zeros(0x110000, np.uint8)
_MARKS[[ord(c) for c in "!?"]] = 1
_MARKS[[ord(c) for c in "|#$%&*@^~<>{}[]=+_\\/"]] = 2
_MARKS[[ord(c) for c in "0123456789"]] = 3
_MARKS[[ord(c) for c in " \t\n\r\f\v"]] = 4
_MARKS[ord("A") : ord("Z") + 1] = 5
_MARKS[0xC0:0xDF] = 5
_MARKS[0xD7] = 0
_KINDS = 5


def _stretches(flags: np.ndarray, length: int) -> np.ndarray:
    """Share of flags in each stretch; a last short one is joined to the one before."""
    n = len(flags)
    bounds = np.arange(0, max(n - length // 2, 1), length)
    sizes = np.diff(np.append(bounds, n))
    return np.add.reduceat(flags.astype(np.float64), bounds) / np.maximum(sizes, 1)


def features(text: str) -> np.ndarray:
    """Description of a whole text; zeros for a text without words."""
    words = text.split()
    if not words:
        return np.zeros(N_FEATURES)
    kinds = _MARKS[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    chars = len(kinds)
    out: list[float] = []
    for kind in range(1, _KINDS + 1):
        share = _stretches(kinds == kind, STRETCH_CHARS)
        out += [float((kinds == kind).mean()), float(share.max()), float((share > 0.1).mean())]
    seen: dict[str, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    same = np.zeros(len(ids), bool)
    for back in (1, 2):
        same[back:] |= ids[back:] == ids[:-back]
    share = _stretches(same, STRETCH_WORDS)
    # Words of which an equal one stood at the same distance before the word ahead: phrases that are repeated.
    again = np.zeros(len(ids), bool)
    last: dict[int, int] = {}
    pairs = ids[:-1] * (len(seen) + 1) + ids[1:] if len(ids) > 1 else np.empty(0, np.int64)
    if len(pairs):
        _, first = np.unique(pairs, return_index=True)
        again[:-1] = True
        again[first] = False
    phrase = _stretches(again, STRETCH_WORDS)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    out += [float(same.mean()), float(share.max()), float((share > 0.3).mean())]
    out += [float(again.mean()), float(phrase.max()), float((phrase > 0.5).mean())]
    out += [float(lengths.mean()), float((lengths == 1).mean()), float((lengths > 20).mean())]
    out += [np.log1p(len(words)), np.log1p(chars), len(seen) / len(words), 1.0 / len(words)]
    return np.array(out)


N_FEATURES = 3 * _KINDS + 6 + 3 + 4


@dataclass(frozen=True)
class Model:
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(expanded((x - np.array(self.mean)) / np.array(self.scale)) @ np.array(self.weights))


def expanded(z: np.ndarray) -> np.ndarray:
    """Standardised features, bounded, with their squares and a constant."""
    z = np.clip(z, -4, 4)
    return np.column_stack([z, z * z, np.ones(len(z))])


def _loss_slope(z: np.ndarray, label: int) -> np.ndarray:
    """Derivative of the logistic loss by the score, for a label of 1 or -1."""
    return sigmoid(z) - (label > 0)


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, penalty: float = 1e-3, steps: int = 1500, rate: float = 0.03) -> Model:
    """Minimise the non-negative risk of a linear model. Without positives or unlabelled texts every score is the prior."""
    both = np.concatenate([positive, unlabelled])
    mean, scale = (both.mean(0), both.std(0) + 1e-6) if len(both) else (np.zeros(N_FEATURES), np.ones(N_FEATURES))
    start = np.zeros(2 * N_FEATURES + 1)
    prior = min(max(prior, 0.01), 0.99)
    start[-1] = np.log(prior / (1 - prior))
    if not len(positive) or not len(unlabelled):
        return Model(tuple(mean), tuple(scale), tuple(start), prior)
    xp, xu = (expanded((x - mean) / scale) for x in (positive, unlabelled))
    shrink = np.r_[np.full(2 * N_FEATURES, penalty), 0.0]

    def gradient(w: np.ndarray) -> np.ndarray:
        zp, zu = xp @ w, xu @ w
        as_positive = prior * (xp.T @ _loss_slope(zp, 1)) / len(xp)
        negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        as_negative = xu.T @ _loss_slope(zu, -1) / len(xu) - prior * (xp.T @ _loss_slope(zp, -1)) / len(xp)
        return (as_positive + as_negative if negative_risk >= 0 else -as_negative) + shrink * w

    return Model(tuple(mean), tuple(scale), tuple(descend(gradient, start, steps, rate)), prior)


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.1, penalty: float = 1e-3, steps: int = 400, rate: float = 0.05) -> float:
    """Share of positives among the unlabelled; one half where there are too few rows to halve.

    Thresholds keep at least the share ``least`` of positives.
    """
    if len(positive) < 4 or len(unlabelled) < 4:
        return 0.5
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(0), both.std(0) + 1e-6
    half = lambda x, k: expanded((x[k::2] - mean) / scale)
    xp, xu = half(positive, 0), half(unlabelled, 0)
    shrink = np.r_[np.full(2 * N_FEATURES, penalty), 0.0]

    def gradient(w: np.ndarray) -> np.ndarray:
        return (xp.T @ _loss_slope(xp @ w, 1) / len(xp) + xu.T @ _loss_slope(xu @ w, -1) / len(xu)) / 2 + shrink * w

    w = descend(gradient, np.zeros(2 * N_FEATURES + 1), steps, rate)
    zp, zu = np.sort(half(positive, 1) @ w), np.sort(half(unlabelled, 1) @ w)
    chance = np.sqrt(np.log(40) / 2 / len(zu)) + np.sqrt(np.log(40) / 2 / len(zp))
    at = zp[np.unique(np.linspace(0, (1 - least) * (len(zp) - 1), 46).astype(int))]
    above = lambda z: 1 - np.searchsorted(z, at) / len(z)
    ratio = above(zu) / above(zp)
    return float(np.clip(ratio[np.argmin(ratio + chance / above(zp))], 0.01, 0.99))


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [features(t or "").tolist() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(x, pa.list_(pa.float64()))], ["_id", "x"])


def _collected(rows: DataFrame, id_col: str) -> np.ndarray:
    out = rows.select(F.col(id_col).alias("_id"), "text").mapInArrow(_described, "_id long, x array<double>").toArrow().sort_by("_id")
    return np.array(out.column("x").to_pylist(), float).reshape(-1, N_FEATURES)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fit on the folds that are not held out: on texts labelled positive, and on unlabelled texts from all documents.

    Null ids and labels are not used; of a repeated id the largest label is, and every row with that id is a positive. Without
    labels or documents every score is one half.
    """
    usable = labels.select(F.col(id_col).cast("long").alias(id_col), F.col(label_col).cast("int").alias("label")).dropna().groupBy(id_col).agg(F.max("label").alias("label"))
    usable = usable.filter(fold(id_col, FOLDS) != 0)
    positives = with_text(docs, sampled(usable.filter("label = 1").select(id_col), id_col, POSITIVES), id_col, text_col)
    ids = docs.select(F.col(id_col).cast("long").alias(id_col)).dropna().filter(fold(id_col, FOLDS) != 0)
    unlabelled = with_text(docs, sampled(ids, id_col, UNLABELLED), id_col, text_col)
    x, u = _collected(positives, id_col), _collected(unlabelled, id_col)
    return fit_nnpu(x, u, estimated_prior(x, u))


def _scores(model: Model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t or "") for t in batch.column("text").to_pylist()]).reshape(-1, N_FEATURES)
            p = model.score(x)
            columns = [batch.column("id"), batch.column("held_out"), pa.array(p), pa.array((p >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "held_out", "score", "predicted"])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(id_col, held_out, score, predicted)`` of every row.

    The score depends on the text alone, so repeated rows have one score. Null and empty texts have the score of a text
    without words. Null ids are not held out. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(fold(id_col, FOLDS) == 0, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scores(model, threshold), "id long, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)
