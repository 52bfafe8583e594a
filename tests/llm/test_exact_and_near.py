"""Exact and near duplicates, components and repeated passages against plain versions."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from lakesift.llm import blocknames, components, neardup, substrings
from lakesift.llm.common import prepare

SCHEMA = "doc_id long, text string, level int, name string, keep_id string, n int"


@pytest.fixture
def docs(spark):
    prepare(spark)

    def make(rows):
        return spark.createDataFrame([(i, t, 1, "x", None, 2) for i, t in rows], SCHEMA)

    return make


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


EDGES = [
    (5, "one two  three"), (3, "one\ttwo three"), (9, None), (2, ""), (4, " "), (None, "one two three"), (None, "alone"),
    (7, "One two three"), (8, "x" * 10_000), (1, "x" * 10_000), (6, "x" * 9_999 + "y"), (7, "One two three"), (11, "é　 ü"),
]


def exact_by_hand(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(plain(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[plain(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), hashlib.sha256(plain(t).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_exact_groups(docs, block):
    rows = EDGES if block > 1 else [(i, t and t[:40]) for i, t in EDGES]
    got = blocknames.exact_groups(docs(rows), block_chars=block).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == exact_by_hand(rows)
    kept = [(r.text_sha256, r.doc_id) for r in got if r.kept]
    assert len(kept) == len({k for k, _ in kept}) == len({r.text_sha256 for r in got})


def test_exact_stage_keeps_one_of_each_with_all_columns(docs):
    got = blocknames.without_copies(docs(EDGES))
    assert got.columns == ["doc_id", "text", "level", "name", "keep_id", "n"]
    assert sorted(plain(r.text) for r in got.collect()) == sorted({plain(t) for _, t in EDGES})
    assert {r.doc_id for r in got.collect()} == {3, 2, 4, None, 7, 1, 6, 11}


def test_exact_of_nothing(docs):
    assert blocknames.exact_groups(docs([])).collect() == []
    assert blocknames.without_copies(docs([])).collect() == []


def test_components(spark):
    prepare(spark)
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(200)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    assert got == {x: root(x) for x in parent}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def near_by_hand(rows, size, percent=80):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + size]) for i in range(max(len(w) - size, 0) + 1)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        k = find(i)
        least[k] = min(least.get(k, 2**63), 2**63 - 1 if d is None else d)
    return sorted([(d, len(sets[i]), None if least[find(i)] == 2**63 - 1 else least[find(i)]) for i, (d, _) in enumerate(rows)], key=repr)


def varied(rnd, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"w{rnd.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("small, size", [(64, 5), (6, 2)])
def test_near_groups(docs, monkeypatch, small, size):
    """Also with nodes so small that most of a large group of near copies goes through pivots and deeper levels."""
    monkeypatch.setattr(neardup, "SMALL", small)
    rnd = random.Random(size)
    rows = [(100 + i, " ".join(f"w{rnd.randrange(500)}" for _ in range(rnd.randrange(5, 80)))) for i in range(60)]
    hot = [f"h{i}" for i in range(90)]
    rows += [(1000 + i, varied(rnd, hot, rnd.randrange(0, 4))) for i in range(80)]
    loose = [f"v{i}" for i in range(60)]
    rows += [(2000 + i, varied(rnd, loose, rnd.randrange(0, 7))) for i in range(60)]
    rows += [(1, None), (2, ""), (3, "  \t"), (4, "one"), (5, "ONE"), (6, "one two"), (None, "One  two"), (7, "é"), (6, "one two"), (None, "nobody else")]
    rnd.shuffle(rows)
    got = neardup.near_groups(docs(rows), size).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=repr) == near_by_hand(rows, size)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def near_by_matrix(rows, size):
    """Components as ``near_by_hand`` finds them, for many texts of few words."""
    texts = [t.split() for _, t in rows]
    sets = [{tuple(w[i : i + size]) for i in range(len(w) - size + 1)} for w in texts]
    column = {s: i for i, s in enumerate(sorted(set().union(*sets)))}
    there = np.zeros((len(sets), len(column)), np.float32)
    for row, s in zip(there, sets):
        row[[column[x] for x in s]] = 1
    both = there @ there.T
    n = there.sum(axis=1)
    near = 100 * both >= 80 * (n[:, None] + n - both)
    root = np.array([i for i, _ in rows])
    while True:
        least = np.where(near, root, 2**62).min(axis=1)
        if (least == root).all():
            return dict(zip([i for i, _ in rows], root.tolist()))
        root = least


def test_links_of_a_family_grow_with_its_members(docs, monkeypatch):
    """Copies of one text with up to four edits: many are near the main part of the family, but not near its pivot."""
    counts, original = [], neardup.family_links

    def counted(*args):
        found = original(*args)
        counts.append(sum(f.count() for f in found))
        return found

    monkeypatch.setattr(neardup, "family_links", counted)
    monkeypatch.setattr(neardup, "BLOCK", 128)
    base = [f"b{i}" for i in range(200)]
    for n in (600, 1200, 2400):
        rnd = random.Random(n)
        rows = [(i, varied(rnd, base, rnd.randrange(1, 5))) for i in range(n)]
        got = {r.doc_id: r.component_id for r in neardup.near_groups(docs(rows), 5).collect()}
        assert got == near_by_matrix(rows, 5)
    assert counts[0] > 0 and counts[2] <= 6 * counts[0] and all(c <= n for c, n in zip(counts, (600, 1200, 2400)))


def test_loosely_related_texts_part_in_few_levels(docs, monkeypatch):
    """Texts that share a bit less than half of their shingles, some with near copies."""
    levels, original = [], neardup.settle

    def counted(df, label):
        out = original(df, label)
        if label == "level":
            levels.append(out.count())
        return out

    monkeypatch.setattr(neardup, "settle", counted)
    rnd, base = random.Random(4), [f"b{i}" for i in range(200)]
    texts = [varied(rnd, base, 22) for _ in range(300)]
    texts += [varied(rnd, t.split(), 3) for t in texts[::10]]
    rows = list(enumerate(texts))
    assert {r.doc_id: r.component_id for r in neardup.near_groups(docs(rows), 2).collect()} == near_by_matrix(rows, 2)
    assert 2 <= len(levels) <= 4 and sum(levels[1:]) <= 2 * levels[0]


@pytest.mark.parametrize("later, each", [(1, 16), (16, 0)])
def test_near_groups_of_small_nodes_and_of_families(docs, monkeypatch, later, each):
    """Nodes that are as small at every depth, and nodes whose pairs between components are left to families."""
    for name, value in (("SMALL", 6), ("LATER", later), ("PAIRS_EACH", each)):
        monkeypatch.setattr(neardup, name, value)
    rnd, loose = random.Random(9), [f"v{i}" for i in range(60)]
    rows = [(i, varied(rnd, loose, rnd.randrange(0, 7))) for i in range(80)] + [(None, None), (7, "")]
    got = neardup.near_groups(docs(rows), 2).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=repr) == near_by_hand(rows, 2)


def test_forests_of_many_and_of_few_pairs_agree():
    rnd = np.random.default_rng(3)
    cls = rnd.permutation(40).astype(np.int64) * 7
    apart = np.triu(rnd.integers(0, 9, (40, 40)), 1).astype(np.uint8)
    apart += apart.T
    # The last five are near one another only.
    there = np.triu((apart < 5) & ((np.arange(40) < 35)[:, None] == (np.arange(40) < 35)), 1)
    i, j = np.nonzero(there)
    pairs = list(zip(apart[i, j].tolist(), np.minimum(cls[i], cls[j]).tolist(), np.maximum(cls[i], cls[j]).tolist()))
    assert sorted(neardup._dense_forest(apart, i, j, cls)) == sorted(p[1:] for p in neardup._forest(pairs))


def test_near_stage(docs):
    hot = " ".join(f"h{i}" for i in range(60))
    rows = [(3, hot), (2, hot + " end"), (None, "start " + hot), (None, "other words here"), (4, ""), (5, None)]
    got = neardup.without_near_copies(docs(rows))
    assert got.columns == ["doc_id", "text", "level", "name", "keep_id", "n"]
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=repr) == sorted([(2, hot + " end"), (None, "other words here"), (4, ""), (5, None)], key=repr)
    assert neardup.near_groups(docs([]), 5).collect() == []
    with pytest.raises(ValueError):
        neardup.near_groups(docs(rows), 5, percent=70)


def repeats_by_hand(rows, window):
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda i: rows[i][0] if rows[i][0] is not None else 2**63)
    ages = {}
    for i in order:
        ages.setdefault(rows[i][0], []).append(i)
    for group in ages.values():  # rows of one id are one age
        own_all = set()
        for i in group:
            words = re.findall(r"[^\x20\x09-\x0D]+", rows[i][1] or "")
            own, gone = set(), set()
            for s in range(len(words) - window + 1):
                w = tuple(words[s : s + window])
                if w in seen or w in own:
                    gone |= set(range(s, s + window))
                own.add(w)
            own_all |= own
            kept = " ".join(w for k, w in enumerate(words) if k not in gone)
            out.append((rows[i][0], len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
        seen |= own_all
    return sorted(out, key=repr)


@pytest.mark.parametrize("window, anchor", [(20, 8), (6, 3)])
def test_repeats(docs, window, anchor):
    rnd = random.Random(window)
    word = lambda: f"w{rnd.randrange(4000)}"
    passages = [[word() for _ in range(rnd.randrange(window - 1, 4 * window))] for _ in range(6)]
    rows = []
    for i in range(120):
        words = [word() for _ in range(rnd.randrange(0, 50))]
        for _ in range(rnd.randrange(0, 3)):
            at = rnd.randrange(len(words) + 1)
            words[at:at] = rnd.choice(passages)[rnd.randrange(3) :]
        rows.append((i, rnd.choice([" ", "\n", "  "]).join(words)))
    rows += [(500, rows[7][1]), (501, rows[7][1].replace(" ", "\t")), (400, "a " * 60), (None, rows[3][1]), (None, "b " * 40), (8, rows[8][1]), (600, None), (601, "")]
    rnd.shuffle(rows)
    got = substrings.repeat_digests(docs(rows), window=window, anchor=anchor).collect()
    assert sorted([tuple(r) for r in got], key=repr) == repeats_by_hand(rows, window)


def test_repeats_stage(docs):
    text = " ".join(f"w{i}" for i in range(40))
    got = substrings.without_repeats(docs([(1, text + "\n end"), (2, "own " + text), (3, "a\n b"), (4, None)]))
    assert got.columns == ["doc_id", "text", "level", "name", "keep_id", "n"]
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(1, text + "\n end"), (2, "own"), (3, "a\n b"), (4, None)]
    assert substrings.repeat_digests(docs([])).collect() == []
