"""Stages that turn ``documents`` into training sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesift.llm import blocknames, neardup, packing, substrings, toxicity
from lakesift.llm.common import prepare, settle, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not find toxic; it is fitted on the labelled ones."""
    prepare(spark)
    labels = toxicity.table_labels(table(spark, sf_dir.rstrip("/"), "labels"))
    return toxicity.without_toxic(docs, toxicity.train(docs, labels, toxicity.CATEGORIES))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts."""
    return blocknames.without_copies(_ready(spark, docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of similar texts, by shingles of five words."""
    return neardup.without_near_copies(_ready(spark, docs), size=5)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without words in passages that occur before."""
    out = substrings.without_repeats(_ready(spark, docs))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences."""
    files = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
    return packing.pack(_ready(spark, docs), *files, end_id=1)


def _ready(spark: SparkSession, docs: DataFrame) -> DataFrame:
    prepare(spark)
    return docs


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("packing", pack),
]

#: The fitted chain and the packing are not SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written and read again."""
    prepare(spark)
    docs = table(spark, sf_dir.rstrip("/"), "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
