"""Vector search, tokens and packing against plain versions and the libraries."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Library

from lakesift.llm import bpe, packing, topk
from lakesift.llm.common import prepare

WORD, BYTE, RANKS = map(public_tokenizers.path, ("word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))


def odd_texts(n, seed=1):
    rnd = random.Random(seed)
    spaces = ["\t", "\n", " ", "  ", "\r", "\x85", "\xa0", " ", "\x1c"]
    ranges = [(33, 127), (160, 0x530), (0x300, 0x370), (0x3040, 0x30A0), (0x1F600, 0x1F640)]
    char = lambda: rnd.choice(spaces) if rnd.random() < 0.2 else chr(rnd.randrange(*rnd.choice(ranges)))
    texts = ["".join(char() for _ in range(rnd.randrange(60))) for _ in range(n)]
    texts += ["".join(rnd.choice("aabcdehinrst ") for _ in range(rnd.randrange(200))) for _ in range(n)]
    return texts + ["", " ", "a" * 3000, "ab" * 900, "it's WE'LL 's", "x<|endoftext|>y <|startoftext|>", "ΣΑΣ İ ﬁ", "ȩ́"]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder_and_decoder_equal_the_library(path):
    own, library = bpe.Tokenizer(path), Library.from_file(path)
    for text in odd_texts(400):
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)
    for piece in list(own.ids)[::37]:
        i = own.ids[piece]
        raw = own.tokens([i])[0]
        if path == BYTE:
            assert own.encode_word(raw) == [i]


def test_round_trip_of_bytes(spark):
    prepare(spark)
    texts = [t for t in odd_texts(30) if "<|" not in t]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    back = bpe.decode(bpe.encode(docs, BYTE), BYTE).collect()
    assert sorted((r.doc_id, r.text) for r in back) == list(enumerate(texts))


def test_digests_equal_the_library(spark):
    prepare(spark)
    library = Library.from_file(WORD)
    rows = [*enumerate(odd_texts(150, 5)), (7, None), (None, "null id"), (7, "again"), (7, "again")]
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        want.append((i, len(ids), *sha))
    got = bpe.encoded_digests(spark.createDataFrame(rows, "doc_id long, text string"), WORD)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_a_full_table_of_words_changes_nothing():
    words = bpe.Words(len, limit=3)
    assert [words[w] for w in ("a", "bb", "ccc", "dddd", "a", "bb", "eeeee", "a")] == [1, 2, 3, 4, 1, 2, 5, 1]
    assert len(words) <= 3


def test_long_words_are_not_kept():
    words = bpe.Words(len)
    assert [words["w" * n] for n in (5_000, 64, 5_000)] == [5_000, 64, 5_000] and list(words) == ["w" * 64]


def search_by_hand(rows, k, every):
    good, queries = [], {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            f = [int(np.floor(256 * float(x))) for x in v]
            good.append((i, f))
            queries[i] = min(queries.get(i, f), f)
    out = []
    for q, f in queries.items():
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(f, v)), i) for i, v in good if i != q and len(v) == len(f))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("cells", [(10**6, 10**6), (40, 24)])
def test_search(spark, monkeypatch, cells):
    prepare(spark)
    monkeypatch.setattr(topk, "SHARD_CELLS", cells[0])
    monkeypatch.setattr(topk, "TILE_CELLS", cells[1])
    monkeypatch.setattr(topk, "FAN_IN", 3)
    rnd = random.Random(2)
    rows = [(i, [rnd.choice([0.5, -0.25, 0.1, 1.0]) for _ in range(4)]) for i in range(120)]
    rows += [(200, None), (201, [0.1, None, 0.2, 0.3]), (202, [float("nan")] * 4), (203, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4)]
    rows += [(205, [1.0, 2.0]), (210, [3.0, -1.0]), (10, rows[10][1]), (20, [9.0] * 4), (21, [9.0] * 4), (21, [9.0] * 4), (215, []), (220, [])]
    vectors = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    vectors = vectors.filter(topk.usable("embedding")).select(F.col("vec_id").alias("id"), topk.scaled("embedding", 256).alias("vec"))
    got = topk.search(vectors.filter("id % 5 = 0"), vectors, 5).collect()
    assert sorted(map(tuple, got)) == search_by_hand([(i, v and [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows], 5, 5)
    assert topk.search(vectors.filter("id < 0"), vectors, 5).collect() == []


def test_very_large_products_are_exact():
    a, b = np.array([[2.0**40, 1.0]]), np.array([[2.0**20, 3.0], [2.0**20, 4.0]])
    assert topk._products(a, b).tolist() == [[2**60 + 3, 2**60 + 4]]


def cuts_by_hand(at, penalty, window):
    cost = {0: 0}
    for end, price in zip(at, penalty):
        cost[end] = price + min(c + (0 if (end - s) & (end - s - 1) == 0 else window - end + s) for s, c in cost.items() if 0 < end - s <= window)
    return cost[at[-1]]


def test_cuts_are_the_cheapest():
    rnd = random.Random(4)
    for window in (8, 16, 64):
        for _ in range(60):
            ends = np.cumsum([rnd.randrange(1, window * 2) for _ in range(rnd.randrange(1, 12))])
            sentences = np.array(sorted({rnd.randrange(1, ends[-1] + 1) for _ in range(20)}))
            at, penalty = packing.possible_cuts(ends, sentences, step=window // 4)
            cuts = packing.best_cuts(at, penalty, window)
            price = dict(zip(at.tolist(), penalty.tolist()))
            sizes = np.diff(cuts)
            assert cuts[0] == 0 and cuts[-1] == ends[-1] and sizes.min() > 0 and sizes.max() <= window
            cost = sum(price[c] for c in cuts[1:]) + sum(0 if n & (n - 1) == 0 else window - n for n in sizes.tolist())
            assert cost == cuts_by_hand(at.tolist(), penalty.tolist(), window)


@pytest.mark.parametrize("tokens", [1000, 2500, 5000, 20_000])
def test_short_blocks_are_padded_little(tokens):
    rnd = random.Random(tokens)
    padding = total = 0
    for _ in range(20):
        ends = np.cumsum([rnd.randrange(1, 600) for _ in range(max(2, tokens // 300))])
        sentences = np.array(sorted({rnd.randrange(1, ends[-1]) for _ in range(tokens // 20)}))
        sizes = np.diff(packing.best_cuts(*packing.possible_cuts(ends, sentences)))
        padding += sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes.tolist())
        total += int(ends[-1])
    assert padding < 0.01 * total


def test_packing(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(packing, "BLOCK_TOKENS", 5000)
    library = Library.from_file(BYTE)
    rnd = random.Random(6)
    texts = [" ".join(rnd.choice(["the", "and.", "Tion\n", "of"]) for _ in range(rnd.randrange(0, 1500))) for _ in range(40)]
    rows = [*enumerate(texts), (100, None), (101, ""), (102, "x" * 30_000), (103, "a<|endoftext|>b"), (None, "no id"), (3, "twice"), (3, "twice"), *enumerate(odd_texts(20), 200)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, sequence_id int").coalesce(2)
    pieces = packing.pack(docs, BYTE, RANKS, end_id=1).collect()
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 1])
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for i, all_ids in ids.items():
        assert sum(p.length for p in by_doc[i]) == sum(map(len, all_ids))
        if len(all_ids) == 1:
            at = 0
            for p in sorted(by_doc[i], key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(all_ids[0])
                part = np.array(all_ids[0][at : at + p.length], "<u4").tobytes()
                assert p.ids_crc32 == zlib.crc32(part)
                at += p.length
            assert at == len(all_ids[0])
    padding = total = 0
    for s in by_sequence.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
        total += at
    assert padding <= 0.02 * total
    assert packing.pack(docs.limit(0), BYTE, RANKS, end_id=1).collect() == []
