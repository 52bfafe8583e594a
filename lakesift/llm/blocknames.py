"""Exact duplicates by deterministic block naming.

Texts are cut into blocks of a fixed number of characters. The distinct blocks are sorted and numbered; the
number is the block's name. Adjacent names are then paired, the distinct pairs numbered in turn, and so on until
one name is left per text: two texts have the same name at the same level exactly if they are equal. No hash
decides equality. A 128-bit key carries names back to the blocks, after a check that it is injective on them.

Only names and keys are shuffled more than once; text is shuffled once, with copies merged before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesift.llm.common import one_space, shuffled, text_of
from lakesift.session import materialize

BLOCK_CHARS = 4096


def _blocks(text: Column, block_chars: int) -> Column:
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    return F.when(text == "", F.array(F.lit(""))).otherwise(cut)


def _keys(block: Column, seed: int) -> list[Column]:
    return [F.xxhash64(block).alias("k1"), F.xxhash64(F.lit(seed), block).alias("k2")]


def _numbered(distinct: DataFrame, *by: str) -> DataFrame:
    """Sorted distinct rows with an integer name each; written, so that the names are fixed."""
    return distinct.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())


def _named_blocks(texts: DataFrame, block_chars: int) -> tuple[DataFrame, int]:
    """The names of all distinct blocks by key, and the seed with which the key is injective."""
    seed = 0
    while True:
        blocks = texts.select(F.explode(_blocks(F.col("_text"), block_chars)).alias("block"))
        distinct = blocks.select(*_keys(F.col("block"), seed), "block").distinct()
        names = materialize(_numbered(distinct, "k1", "k2", "block").drop("block"), "block-names")
        if names.groupBy("k1", "k2").count().filter("count > 1").isEmpty():
            return names, seed
        seed += 1


def name_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Identity of every row's text: ``(row_id, id, text_sha256, level, name)``.

    Rows with equal ``(level, name)`` have equal normalised texts, and the other way round. White space runs
    count as one space; null text counts as empty, and all empty texts are equal. Ids may be null or repeated:
    ``row_id`` tells the rows apart. Other columns are not read.
    """
    texts = docs.select(F.col(id_col).alias("id"), one_space(text_of(text_col)).alias("_text"))
    names, seed = _named_blocks(texts, block_chars)
    keyed = materialize(
        texts.select(
            F.monotonically_increasing_id().alias("row_id"),
            "id",
            F.sha2(F.col("_text"), 256).alias("text_sha256"),
            F.transform(_blocks(F.col("_text"), block_chars), lambda b: F.struct(*_keys(b, seed))).alias("keys"),
        ),
        "block-keys",
    )
    rows = (
        keyed.select("row_id", F.size("keys").alias("n"), F.posexplode("keys").alias("pos", "key"))
        .select("row_id", "n", "pos", F.col("key.k1"), F.col("key.k2"))
        .join(names, ["k1", "k2"])
        .select("row_id", "n", "pos", "name")
    )
    longest = keyed.agg(F.max(F.size("keys"))).first()[0] or 1
    done, level = [], 0
    while longest > 1:
        rows = materialize(rows, f"names-{level}")
        done.append(rows.filter("n = 1").select("row_id", F.lit(level).alias("level"), "name"))
        rows, longest, level = _paired(rows.filter("n > 1"), level), (longest + 1) // 2, level + 1
    done.append(rows.select("row_id", F.lit(level).alias("level"), "name"))
    return keyed.drop("keys").join(reduce(DataFrame.unionAll, done), "row_id")


def _paired(rows: DataFrame, level: int) -> DataFrame:
    """Adjacent names of each text replaced by the name of their pair; a last single one pairs with -1."""
    side = lambda odd: F.max(F.when(F.col("pos") % 2 == odd, F.col("name")))
    pairs = rows.groupBy("row_id", "n", F.expr("pos div 2").cast("int").alias("half")).agg(
        side(0).alias("a"), F.coalesce(side(1), F.lit(-1)).alias("b")
    )
    pairs = materialize(pairs, f"pairs-{level}")
    names = materialize(_numbered(pairs.select("a", "b").distinct(), "a", "b"), f"pair-names-{level}")
    return pairs.join(names, ["a", "b"]).select(
        "row_id", ((F.col("n") + 1) / 2).cast("int").alias("n"), F.col("half").alias("pos"), "name"
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input row: ``(id_col, keep_id, group_size, kept, text_sha256)``.

    Of rows with equal texts the one with the smallest id stays; of repeated rows with that id, one. A null id
    stays only where the whole group has none. An empty table gives no rows.
    """
    named = materialize(name_texts(docs, id_col, text_col, block_chars), "text-names")
    groups = materialize(
        named.groupBy("level", "name")
        .agg(
            F.min("id").alias("keep_id"),
            F.count(F.lit(1)).alias("group_size"),
            F.coalesce(F.min_by("row_id", "id"), F.min("row_id")).alias("keep_row"),
        )
        .filter("group_size > 1"),
        "text-groups",
    )
    return named.join(groups, ["level", "name"], "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("row_id") == F.col("keep_row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Ids are expected to tell rows apart; rows that repeat an id are settled by id and normalised text.
    """
    groups = materialize(exact_groups(docs, id_col, text_col), "exact-groups")
    id_text = [groups[id_col].alias("_id"), groups["text_sha256"].alias("_sha")]
    dropped = groups.filter(~F.col("kept")).select(*id_text).distinct()
    stays = groups.filter("kept").select(*id_text)
    # A repeated row is dropped once and kept once: one of its copies has to stay.
    split = materialize(dropped.join(stays, (dropped["_id"].eqNullSafe(stays["_id"])) & (dropped["_sha"] == stays["_sha"]), "left_semi"), "repeated-rows")
    gone = dropped.join(split, (dropped["_id"].eqNullSafe(split["_id"])) & (dropped["_sha"] == split["_sha"]), "left_anti")
    marked = docs.withColumn("_lakesift_sha", F.sha2(one_space(text_of(text_col)), 256))

    def on(other: DataFrame) -> Column:
        return marked[id_col].eqNullSafe(other["_id"]) & (marked["_lakesift_sha"] == other["_sha"])

    kept = marked.join(shuffled(gone), on(gone), "left_anti")
    if not split.isEmpty():
        once = marked.join(split, on(split), "left_semi").dropDuplicates([id_col, "_lakesift_sha"])
        kept = kept.join(split, kept[id_col].eqNullSafe(split["_id"]) & (kept["_lakesift_sha"] == split["_sha"]), "left_anti").unionByName(once)
    return kept.drop("_lakesift_sha")
