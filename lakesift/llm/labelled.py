"""Bounded training samples of labelled texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sampled(rows: DataFrame, id_col: str, limit: int) -> DataFrame:
    """At most ``limit`` rows, those with the smallest hash of their id: the same on every run."""
    return rows.orderBy(F.xxhash64(F.lit(7), id_col), id_col).limit(limit)


def with_text(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The texts of a bounded sample; the sample is sent to the documents, so that no text is shuffled."""
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(sample), F.col("_id") == sample[id_col]).drop("_id")


def fold(id_col: str, folds: int) -> Column:
    """A text's fold by its id; 0 is held out where the contract says so."""
    return F.crc32(F.col(id_col).cast("string")) % folds
