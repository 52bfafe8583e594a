"""Grouping of spelling variants by asymmetric q-chunks.

Two words are near if one edit (an inserted, deleted or replaced character) makes one of the other. The shorter word
(of equal lengths: the one that sorts first) contributes two disjoint chunks, its halves. One edit leaves one of them
whole, so it is a positional gram of the other word: at the same place, or shifted by one where a character before it
was inserted. Of the other word's grams of a chunk's length only those can match, so only those are made. What is left
beside a whole chunk again differs by one edit and is split in the same way: words are joined on a whole half and a
whole quarter of the rest, and verified.

Variants follow their most frequent near word, if it is much more frequent, and that one's in turn, to a root.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesift.llm.common import settle

#: Fixed by the contract: what words consist of.
RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 6
LEAST_COUNT = 5
#: How many times as frequent a form is as its variant.
RATIO = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(word: Column) -> Column:
    """A-Z as lower case, other letters as they are."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def runs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, run)``: every run of letters of every text, lower-cased."""
    every = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(RUN), F.lit(0))).alias("run"))
    return every.select("id", lower_ascii(F.col("run")).alias("run"))


def damaged(rows: DataFrame, every: int) -> DataFrame:
    """Runs with one character deleted where ``every`` divides the CRC-32 of ``<id>:<run>``, which also picks the character."""
    h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return rows.withColumn("h", h).withColumn("run", F.when(F.col("h") % every == 0, cut).otherwise(F.col("run"))).drop("h")


def counted(rows: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)`` of the distinct runs that are long and frequent enough."""
    words = rows.filter(F.char_length("run") >= least_length).groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return words.filter(F.col("n") >= least_count)


def _keys(word: str, length: Column, extra: int) -> Column:
    """Chunks of a word of ``length``, or the grams of a word longer by ``extra`` that such chunks can equal.

    A half and a quarter of the rest each; ``length`` and places come with them, so that only like chunks meet.
    """
    w = F.col(word)
    half = (length / 2).cast("int")
    out = []
    for part in (0, 1):
        rest_length = length - half if part == 0 else half
        quarter = (rest_length / 2).cast("int")
        whole = F.substring(w, F.lit(1), half) if part == 0 else F.substring(w, half + (1 + extra), length - half)
        rest_at = half if part == 0 else F.lit(0)
        for sub in (0, 1):
            piece = F.substring(w, rest_at + 1, quarter) if sub == 0 else F.substring(w, rest_at + quarter + (1 + extra), rest_length - quarter)
            out.append(F.concat_ws(" ", length, F.lit(2 * part + sub), whole, piece))
    return F.array(*out)


def near_pairs(words: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``(a, b)``: all pairs of distinct words that one edit apart, each once."""
    sized = words.select("word", F.char_length("word").alias("size"))
    chunks = sized.select(F.col("word").alias("a"), F.col("size").alias("size_a"), F.explode(_keys("word", F.col("size"), 0)).alias("key"))
    same, longer = _keys("word", F.col("size"), 0), _keys("word", F.col("size") - 1, 1)
    grams = sized.select(F.col("word").alias("b"), F.col("size").alias("size_b"), F.explode(F.when(F.col("size") > least_length, F.concat(same, longer)).otherwise(same)).alias("key"))
    candidates = chunks.join(grams.hint("merge"), "key").filter("size_a < size_b OR a < b")
    return candidates.filter(F.levenshtein("a", "b", 1) == 1).select("a", "b").distinct()


def variants(words: DataFrame, ratio: int = RATIO, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every row of ``words (word, n)``; words are distinct.

    ``form`` is the near word of largest ``n`` (of equal ones the first in code-point order) if that is at least
    ``ratio`` times the word's own, else null. ``root`` follows forms to the last; a word without form is its root.
    Words shorter than ``least_length`` (6 at least) are not expected. No words give no rows.
    """
    if least_length < 6:
        raise ValueError("halves and quarters of words of fewer than six characters are too short")
    words = settle(words, "words")
    pairs = settle(near_pairs(words, least_length), "near-words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    # The smallest of (-n, word) is the most frequent, then the first.
    best = both.join(others, "b").groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("m"), F.col("b").alias("w"))).alias("best"))
    followed = -F.col("best.m") >= ratio * F.col("n")
    formed = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(followed, F.col("best.w")).alias("form"), F.when(followed, -F.col("best.m")).alias("form_n"))
    formed = settle(formed, "forms")
    # Forms grow more frequent at every step, so there is no circle, and chains are short.
    roots = settle(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        going = roots.join(step, "root", "left")
        if going.filter("further IS NOT NULL").isEmpty():
            break
        roots = settle(going.select("word", F.coalesce("further", "root").alias("root")), "roots")
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def document_words(docs: DataFrame, damage_every: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)`` of whole texts. Null and empty texts have no words; a null id counts as empty; repeated rows count
    as often as they come. With ``damage_every`` some occurrences are misspelt on purpose; see ``damaged``.
    """
    rows = runs(docs, id_col, text_col)
    return counted(damaged(rows, damage_every) if damage_every else rows)
