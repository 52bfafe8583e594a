"""Queries of the fitted scores."""

from __future__ import annotations

from lakesift.llm import brown, quality, toxicity
from lakesift.llm.common import query, table
from lakesift.llm.labelled import fold


@query("op2_toxicity_chain")
def op2(spark, folder):
    """Every document with its probability of each category and the verdict."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    chain = toxicity.train(docs, toxicity.table_labels(labels), toxicity.CATEGORIES)
    return toxicity.score(docs, chain, keep=["doc_id"])


@query("op3_pu_quality")
def op3(spark, folder):
    """Every document with the probability that its quality is good, learned without the held-out fold."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality.score(docs, quality.train(docs, labels))


@query("op13_brown_classes")
def op13(spark, folder):
    """Every document with its log10 probability by class bigrams, learned from six of seven folds."""
    docs = table(spark, folder, "documents")
    return brown.class_scores(docs, fold("doc_id", 7) == 2)
