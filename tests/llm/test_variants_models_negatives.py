"""Hard negatives, spelling variants and language model scores against plain versions."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lakesift.llm import brown, rtree, spelling
from lakesift.llm.common import prepare
from lakesift.llm.labelled import fold


# -- hard negatives ------------------------------------------------------------


def negatives_by_hand(rows, positives, negatives, low, high, every):
    rows = [r for r in rows if None not in r]
    out = []
    for i, label, vec in rows:
        if i % every:
            continue
        scored = sorted((-sum(int(a) * int(b) for a, b in zip(vec, v)), j, m) for j, m, v in rows if j != i and len(v) == len(vec))
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(i, p, rank, n, -s, -t) for rank, (t, n, _) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("dims, n", [(3, 900), (12, 2500)])
def test_negatives(spark, monkeypatch, dims, n):
    prepare(spark)
    for name in ("PACK_CELLS", "TILE_CELLS", "GROUP_CELLS"):
        monkeypatch.setattr(rtree, name, 4_000)
    rnd = random.Random(n)
    vec = lambda: [float(rnd.randrange(-4, 9)) for _ in range(dims)]
    rows = [(i, rnd.randrange(4), vec()) for i in range(n)]
    hot = vec()
    rows += [(n + i, 2, hot) for i in range(n // 2)]  # a third of all rows is alike
    rows += [(40, 1, vec()), (40, 1, rows[40][2]), (41, 3, vec()), (None, 1, vec()), (80, None, vec()), (120, 1, None)]
    rows += [(5000, 1, [1.0, 2.0]), (5040, 1, [3.0, 1.0]), (5080, 2, [1.0, 1.0]), (5120, 2, []), (5160, 3, []), (5200, 3, [])]
    df = spark.createDataFrame(rows, "id long, label long, vec array<double>").withColumn("anchor", df_lit())
    got = rtree.hard_negatives(df, (df.id % 40) == 0, 5, 10, 30, 90)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == negatives_by_hand(rows, 5, 10, 30, 90, 40)
    assert rtree.hard_negatives(df.filter("id < 0"), df.id % 40 == 0, 5, 10, 30, 90).collect() == []


def df_lit():
    from pyspark.sql import functions as F

    return F.lit("a column of the table")


def test_tree_prunes_and_finds_the_same(monkeypatch):
    """Few rows of a packed tree are looked at where boxes are apart; what is found equals a plain search."""
    monkeypatch.setattr(rtree, "LEAF_ROWS", 8)
    monkeypatch.setattr(rtree, "FANOUT", 3)
    monkeypatch.setattr(rtree, "BATCH", 2)
    rng = np.random.default_rng(5)
    for n in (1, 7, 9, 700):
        vecs = rng.integers(-50, 50, (n, 2)).astype(float)
        labels, ids = rng.integers(0, 3, n), rng.permutation(n)
        order, sizes = rtree._pack_order(vecs, labels)
        assert sorted(order.tolist()) == list(range(n)) and max(sizes) <= 8
        tree = rtree.Tree(2, ids[order].tobytes(), labels[order].tobytes(), vecs[order].tobytes(), np.array(sizes).tobytes())
        looked = 0
        original = rtree._products

        def counted(a, b):
            nonlocal looked
            looked += len(b)
            return original(a, b)

        monkeypatch.setattr(rtree, "_products", counted)
        for _ in range(20):
            q = rng.integers(-50, 50, (1, 2)).astype(float)
            low, high = tree.bounds(q)
            scores = (vecs @ q[0]).astype(int)
            assert low[0][tree.root] <= scores.min() and high[0][tree.root] >= scores.max()
            for same in (True, False):
                windows = [(-(2**60), 2**60), (0, 500), (100, 100)]
                got = [rtree.NOTHING] * 3
                tree.search(q[0], 1, 3, low[0], high[0], windows, 4, same, got)
                for (a, b), (found, at) in zip(windows, got):
                    want = sorted((-s, i) for s, i, m in zip(scores.tolist(), ids.tolist(), labels.tolist()) if a <= s <= b and (m == 1) == same and i != 3)[:4]
                    assert [(-s, i) for i, s in zip(found.tolist(), at.tolist())] == want
        monkeypatch.setattr(rtree, "_products", original)
        assert n < 700 or looked < 40 * n / 2


# -- spelling variants -----------------------------------------------------------


def variants_by_hand(rows, every):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    form, n_near = {}, {}
    for w, n in words.items():
        others = [x for x in words if near(w, x)]
        n_near[w] = len(others)
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n, n_near[w], words.get(form[w])) for w, n in words.items())


def test_variants(spark):
    prepare(spark)
    rnd = random.Random(9)
    base = ["".join(rnd.choice("abcd\u00e9\u00d7") for _ in range(rnd.randrange(6, 12))) for _ in range(40)]

    def edited(w):
        k = rnd.randrange(len(w) + 1)
        return rnd.choice([w[:k] + w[k + 1 :], w[:k] + "e" + w[k:], w[:k] + "\u00ff" + w[k + 1 :], w.upper(), w + w[-1]])

    rows = []
    for i in range(600):
        words = [rnd.choice(base[:12]) if rnd.random() < 0.8 else edited(rnd.choice(base)) for _ in range(rnd.randrange(0, 30))]
        rows.append((rnd.choice([i, i, None]), rnd.choice([" ", "\n", "-1"]).join(words)))
    rows += [(7, None), (8, ""), (9, "chains " * 5), (10, "chainss " * 30), (11, "chainsss " * 200), (12, "abc " * 50), (7, rows[7][1])]
    docs = spark.createDataFrame([(i, t, "w", 5) for i, t in rows], "doc_id long, text string, word string, n int")
    got = spelling.variants(spelling.document_words(docs, damage_every=19))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = variants_by_hand(rows, 19)
    assert sorted([tuple(r) for r in got.collect()]) == want
    assert any(f for _, f, *_ in want) and any(f and r != f for _, f, r, *_ in want)
    assert spelling.variants(spelling.document_words(docs.filter("doc_id < 0"))).collect() == []


def test_near_words_are_found_wherever_the_edit_is(spark):
    prepare(spark)
    for w in ("abcdef", "abcdefg", "abcdefgh", "aaaaaa", "abababababa"):
        edits = {w[:k] + w[k + 1 :] for k in range(len(w))} | {w[:k] + "x" + w[k:] for k in range(len(w) + 1)} | {w[:k] + "x" + w[k + 1 :] for k in range(len(w))} | {w[:k] + w[k : k + 1] + w[k:] for k in range(len(w))}
        edits = {e for e in edits if len(e) >= 6} - {w}
        pairs = spelling.near_pairs(spark.createDataFrame([(x, 5) for x in [w, *edits]], "word string, n long")).collect()
        assert {b if a == w else a for a, b in pairs if w in (a, b)} == edits
        assert len({frozenset(p) for p in pairs}) == len(pairs)


# -- language model ---------------------------------------------------------------


def tokens_of(text):
    return [*re.sub("[A-Z]", lambda m: m[0].lower(), text or "").split(), None] if text else [None]


def test_class_scores(spark):
    prepare(spark)
    rnd = random.Random(4)
    verbs, nouns, marks = ([f"{k}{i}" for i in range(30)] for k in ("verb", "noun", "mark"))
    sentence = lambda: " ".join(x for _ in range(rnd.randrange(1, 9)) for x in (rnd.choice(nouns), rnd.choice(verbs), rnd.choice(marks)))
    rows = [(i, sentence().title()) for i in range(700)]
    rows += [(3, rows[3][1]), (800, None), (801, ""), (802, " \t"), (None, "noun1 verb1"), (803, "never seen words " * 3), (804, "z" * 5000)]
    docs = spark.createDataFrame([(i, t, 1, True) for i, t in rows], "doc_id long, text string, n_tokens int, held boolean")
    seen = []
    got = brown.class_scores(docs, fold("doc_id", 7) == 2, watch=seen.append)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted(map(tuple, got.collect()), key=repr)
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(t for (_, text), held in zip(rows, out) if not held for t in tokens_of(text))
    total, words = sum(counts.values()), len(counts)
    want = []
    for (i, text), held in zip(rows, out):
        tokens = tokens_of(text)
        base = sum(math.log10((counts[t] + 1) / (total + words + 1)) for t in tokens)
        want.append((i, held, len(tokens), sum(counts[t] > 0 for t in tokens), total, base))
    assert [g[:5] for g in got] == [w[:5] for w in sorted(want, key=repr)]
    for g, w in zip(got, sorted(want, key=repr)):
        assert g[5] == pytest.approx(w[5]) and g[6] < 0
    # Every part of the words has had its turns, and the likelihood has grown.
    assert len(seen) == brown.PARTS * brown.ROUNDS and seen[-1] > seen[0]
    held = [g for g in got if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held) + 0.1 * sum(g[2] for g in held)
    assert brown.class_scores(docs.limit(0), fold("doc_id", 7) == 2).collect() == []
    nothing = brown.class_scores(docs.filter("doc_id = 803"), fold("doc_id", 7) < 7).collect()
    assert len(nothing) == 1 and nothing[0].n_known == 0 and nothing[0].train_tokens == 0 and math.isfinite(nothing[0].score)


def test_probabilities_of_all_words_sum_to_one():
    rng = np.random.default_rng(1)
    counts = np.r_[rng.integers(2, 50, 300), np.ones(40, np.int64), 90]
    cls = np.r_[rng.integers(0, brown.END, 300), np.full(40, brown.RARE), brown.END].astype(np.uint8)
    totals = np.bincount(cls, counts, brown.CLASSES).astype(np.int64)
    pairs = rng.integers(0, 9, (brown.CLASSES, brown.CLASSES))
    model = brown.Model(int(counts.sum()), len(counts), 40, int((counts == 2).sum()), pairs)
    within = np.bincount(np.r_[cls, brown.RARE], 10 ** model.emission(np.r_[counts, 0], np.r_[cls, np.uint8(brown.RARE)], totals), brown.CLASSES)
    after = 10 ** model.transition()
    assert np.allclose(after.sum(axis=1), 1)
    assert np.allclose(within[totals > 0], 1) and (after @ within <= 1 + 1e-9).all()


def test_exchange_takes_words_to_their_like():
    """Two kinds of words that alternate; one word of the first kind stands in the second's class."""
    pairs = np.zeros((brown.CLASSES, brown.CLASSES), np.int64)
    pairs[0, 1] = pairs[1, 0] = 500
    pairs[1, 1] = 20
    cls, counts = np.array([1], np.uint8), np.array([10])
    assert brown.moved(cls, counts, np.array([0, 0]), np.array([1, brown.CLASSES + 1]), np.array([10, 10]), pairs).tolist() == [0]
    assert brown.moved(cls, counts, np.array([], np.int64), np.array([], np.int64), np.array([]), pairs).tolist() == [1]
