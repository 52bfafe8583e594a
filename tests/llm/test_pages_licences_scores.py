"""Page texts, licences and the fitted scores."""

from __future__ import annotations

import os
import re
import subprocess
import sys
import textwrap
import zlib

import numpy as np
import pytest

from lakesift.llm import licences, pagetext, quality, toxicity
from lakesift.llm.common import prepare

SF = "/root/testdata/sf0.01"

ARTICLE = "<h1>Title &amp; more</h1><p>First block &lt;b&gt; with\n some <b>words</b>.<br>More<p>Second block, unclosed"
BLOCKS = "Title & more\nFirst block <b> with some words. More\nSecond block, unclosed"
LONG = "Words that go on and on in a paragraph of the article, with some more of them. " * 4


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("  \n", ""), ("just text &amp; more", "just text & more"), ("<p>a<p>b", "a\nb"),
        (f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><a href=x>Home</a></nav><article>{ARTICLE}</article><footer>c</footer>", BLOCKS),
        (f"<body><header><p>Site</p></header><div class='side-bar'>{LONG}</div><div id='main-text'>{ARTICLE}</div><div id=comments><p>{LONG}</p></div>", BLOCKS),
        (f"<body><article>{ARTICLE}</p><aside>x</aside><form><input><p>mail</p></form><div class=ad>Buy</div><script>var t='</p>';</script></article>", BLOCKS),
        (f"<body><div class=cookie-notice>We use cookies. {LONG}</div><main><section><p>{LONG}</section><section><p>{LONG}</section></main>", f"{LONG.strip()}\n{LONG.strip()}"),
        (f"<body><div><p>{LONG}</p></div><div><p>{LONG}</p><p>{LONG}</p></div><div><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div>", "\n".join([LONG.strip()] * 3)),
        ("<article><table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>x<!-- <p>no</p> -->y</article>", "a b\nc\nxy"),
        ('<article><p class="a>b" data-x=\'<p>\'>in</p><p hidden>no</p></article><p broken="x', "in"),
        ("<article><p>unterminated <script>x", "unterminated"), ("<article>a &nbsp;&#8212;&nbsp; b&#xe9;</article>", "a — bé"),
    ],
)
def test_main_text(page, text):
    assert pagetext.main_text(page or "") == text


PARTS = [[f"Part {k}, block {b}. {LONG}".strip() for b in range(5)] for k in range(3)]


def _part(blocks):
    return "".join(f"<p>{b}</p>" for b in blocks)


@pytest.mark.parametrize(
    "page, kept",
    [
        ("<body><main>" + "".join(f"<article>{_part(b)}</article>" for b in PARTS) + "</main>", PARTS),
        ("<body>" + "".join(f"<div><article>{_part(b)}</article></div>" for b in PARTS), PARTS),
        (f"<body><article><h1>Short</h1><div>{_part(PARTS[0])}</div><ul><li>brief</ul></article><div>x</div>", [["Short"], PARTS[0], ["brief"]]),
        (f"<body><main><h1>Short</h1><div>{_part(PARTS[0])}</div><div><p>Tiny</p><p>bit</p></div></main><div>{_part(PARTS[2][:2])}</div>", [["Short"], PARTS[0]]),
        (f"<body>{LONG}<article>{_part(PARTS[0])}</article><div><p>{LONG}</p></div>", PARTS[:1]),
    ],
)
def test_content_is_chosen_by_density_inside_the_bounds(page, kept):
    assert pagetext.main_text(page) == "\n".join(b for blocks in kept for b in blocks)


@pytest.mark.parametrize("name", ["content has-sidebar", "page no-sidebar", "layout layout-sidebar-right", "post-content with-related", "commentary", "sidebar-content", "site-header-and-all"])
def test_names_do_not_drop_the_whole_text(name):
    page = f"<body><div class='{name}'><div class='entry-header'><h1>Title</h1></div>{_part(PARTS[0])}</div><div class='sidebar'><p>Side</p></div>"
    assert pagetext.main_text(page).split("\n")[-5:] == PARTS[0]
    page = f"<body><div class='{name}'><article><div class='entry-header'><h1>Title</h1></div>{_part(PARTS[0])}</article></div><div id=comments>{_part(PARTS[1] + PARTS[2])}</div>"
    assert pagetext.main_text(page) == "\n".join(["Title", *PARTS[0]])


ARTICLE_3, SIDE_8 = _part(PARTS[0][:3]), _part([f"Remark {k}. {LONG}" for k in range(8)])
COMMENTS = _part([f"Comment {k}. {LONG}" for k in range(5)])


@pytest.mark.parametrize(
    "page, kept",
    [
        # Reader comments, footers and side matter longer than the article.
        (f"<body><article>{ARTICLE_3}<div class=comment-list>{COMMENTS}</div></article>", PARTS[0][:3]),
        (f"<body><main>{ARTICLE_3}<section id=comments>{SIDE_8}</section></main>", PARTS[0][:3]),
        (f"<body><div class=post>{ARTICLE_3}</div><div class=comments>{COMMENTS}</div>", PARTS[0][:3]),
        (f"<body><div class=post>{ARTICLE_3}</div><div class=responses>{COMMENTS}</div>", PARTS[0][:3]),
        (f"<body><article>{ARTICLE_3}<div class=responses>{COMMENTS}</div></article>", PARTS[0][:3]),
        (f"<body><article>{ARTICLE_3}</article><div class=footer>{SIDE_8}</div>", PARTS[0][:3]),
        (f"<body><article>{ARTICLE_3}</article><div class=related>{SIDE_8}</div>", PARTS[0][:3]),
        (f"<body><div class=sidebar>{COMMENTS}</div><div>{ARTICLE_3}</div>", PARTS[0][:3]),
        # Comments as articles inside the article; parts of a page as articles.
        (f"<body><article>{ARTICLE_3}<article><p>Well said. {LONG}</article><article><p>I agree. {LONG}</article></article>", PARTS[0][:3]),
        ("<body><article>" + "".join(f"<article>{_part(b)}</article>" for b in PARTS) + "</article>", [x for b in PARTS for x in b]),
        # Wrappers with a name of side matter.
        (f"<body><div class=widget>{ARTICLE_3}</div><p>Copyright of the site, all rights reserved", PARTS[0][:3]),
        (f"<body><div class=overlay><article>{ARTICLE_3}</article></div><div class=comments>{COMMENTS}</div>", PARTS[0][:3]),
        (f"<body><article><h1>Title</h1><div class=modal>{ARTICLE_3}</div><div class=share>Tell others about it all</div></article>", ["Title", *PARTS[0][:3]]),
        # Titles before the content, and headings between its parts.
        (f"<body><h1>Title</h1><article>{ARTICLE_3}</article>", ["Title", *PARTS[0][:3]]),
        (f"<body><div><h1>Title</h1><div>{ARTICLE_3}</div></div><div><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div>", ["Title", *PARTS[0][:3]]),
        (f"<body><div>{_part(PARTS[0])}</div><div class=row><h2>Between</h2></div><div>{_part(PARTS[1])}</div>", [*PARTS[0], "Between", *PARTS[1]]),
        # A table as layout.
        (f"<body><table><tr><td><a>Home</a><br><a>News</a></td><td>{_part(PARTS[0])}</td></tr></table>", PARTS[0]),
    ],
)
def test_side_matter_is_told_from_wrappers_by_position(page, kept):
    assert pagetext.main_text(page) == "\n".join(b.strip() for b in kept)


def test_density_sums_against_a_plain_version():
    """Densities and their sums by the formula, node by node, over a page of nested divisions."""
    rnd = np.random.default_rng(3)

    def division(depth):
        inner = "".join(division(depth + 1) if depth < 4 and rnd.random() < 0.6 else f"<p>{'x' * int(rnd.integers(1, 90))}<a>{'y' * int(rnd.integers(1, 40))}</a></p>" for _ in range(3))
        return f"<div>{inner}</div>"

    for _ in range(20):
        nodes = pagetext._tree(f"<body>{division(0)}")
        pagetext._densities(nodes)

        def plain(node):
            texts = [i for i in node.items if isinstance(i, str)]
            parts = [plain(i) for i in node.items if not isinstance(i, str)]
            return [sum(len(t) for t in texts) + sum(p[0] for p in parts), sum(p[1] + 1 for p in parts), sum(t.count("y") for t in texts) + sum(p[2] for p in parts), sum(t.count("y") > 0 for t in texts) + sum(p[3] for p in parts)]

        chars, _, linked, _ = plain(nodes[0])

        def density(node):
            c, t, lc, lt = plain(node)
            base = np.log(c / max(c - lc, 1) * lc + linked / chars * c + np.e)
            return c / (t or 1) * np.log(max(c / (lc or 1) * (t or 1) / (lt or 1), 1.0)) / np.log(max(base, 1.1))

        for node in nodes:
            assert node.density == pytest.approx(density(node))
            assert node.total == pytest.approx(sum(density(i) for i in node.items if not isinstance(i, str)))


def test_small_parts_are_dropped_by_attribute_and_menu_only_as_such():
    link = "<a href=x>A long title of a source that the article quotes, by its author</a>"
    page = f"<article><p title='A hidden gem'>Gem</p><p hidden>no</p><p aria-hidden='true'>no</p><p style='display: none'>no</p>{_part(PARTS[0])}<ul><li>{link}<li>{link}</ul><p><a>One</a> <a>two</a></p><ul><li><a>One</a><li><a>Two</a></ul><p>an <span class=share>Tweet</span> end</p></article>"
    text = "A long title of a source that the article quotes, by its author"
    assert pagetext.main_text(page) == "\n".join(["Gem", *PARTS[0], text, text, "One two", "an end"])


def test_deep_and_broken_pages_end():
    assert pagetext.main_text("<div>" * 20_000 + "deep" + "</x>" * 20_000) == "deep"
    assert pagetext.main_text("<" * 20_000 + "<a b='" * 2_000) is not None


def test_pages_table(spark):
    prepare(spark)
    rows = [(1, "u", "<p>a", 1), (1, "u", "<p>a", 1), (None, None, None, None)]
    got = pagetext.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert sorted(map(tuple, got), key=repr) == [(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)]


def licence_by_hand(line, threshold=0.8):
    def bigrams(text):
        words = re.findall(r"[^\W_]+", text.lower())
        return set(zip(words, words[1:]))

    best = (0, None)
    for name, text in licences.templates():
        a, b = bigrams(line), bigrams(text)
        dice = 2 * len(a & b) / (len(a) + len(b)) if a or b else 0
        if dice >= threshold and (-dice, name) < (-best[0], best[1] or "~"):
            best = (dice, name)
    return best[1], round(best[0], 6) if best[1] else None


def test_licences(spark):
    prepare(spark)
    lines = [text for _, text in licences.templates()[::7]] + ["Released under the MIT licence", "under the", "", "word", "Some prose about the Apache License, Version 2.0 and more of it here."]
    rows = [*enumerate(lines), (900, None), (901, ""), (None, "Released under the MIT License."), (902, "x\nReleased under the MIT License.\nReleased under the ISC License.\n")]
    rows += [(903, "Permission is hereby granted"), (903, "Released under the ISC License."), (904, "word " * 50_000)]
    got = licences.document_licences(spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, licence string")).collect()
    found = {r.doc_id: (r.licence, r.dice) for r in got}
    assert len(got) == len(rows)
    for i, line in enumerate(lines):
        assert found[i] == licence_by_hand(line), line
    assert found[900] == found[901] == found[904] == (None, None) and found[None] == ("MIT", 1.0) and found[902] == ("ISC", 1.0) and found[903] == ("ISC", 1.0)
    assert next(r.n_lines for r in got if r.doc_id == 902) == 2
    # The whole text of several lines is compared too.
    wrapped = licences.TEXTS["MIT"][0].replace(" ", "\n", 30)
    whole = licences.scan(spark.createDataFrame([(1, wrapped)], "doc_id long, text string")).collect()
    assert [(r.line, r.licence, r.dice) for r in whole] == [(-1, "MIT", 1.0)]
    assert licences.document_licences(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_a_text_of_very_many_lines_fits_a_small_heap(tmp_path):
    """200,000 lines, one of which names a licence, in a JVM of 1 GB."""
    code = """
from pyspark.sql import SparkSession
from lakesift.llm import licences
from lakesift.llm.common import prepare
spark = SparkSession.builder.master("local[1]").config("spark.driver.memory", "1g").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
prepare(spark)
lines = [f"line {i} has some words of its own" for i in range(200_000)]
lines[1234] = "Licensed under the MIT License."
docs = spark.createDataFrame([(1, chr(10).join(lines)), (2, "MIT License"), (3, None)], "doc_id long, text string")
print(sorted((r.doc_id, r.licence, r.n_lines) for r in licences.document_licences(docs).collect()))
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", code], env={**os.environ, "PYTHONPATH": root}, cwd=tmp_path, capture_output=True, text=True, timeout=280)
    assert "[(1, 'MIT', 1), (2, 'MIT', 1), (3, None, 0)]" in done.stdout, done.stderr[-2000:]


def test_licences_inside_longer_texts(spark):
    prepare(spark)
    whole = dict(licences.whole_texts())
    prose = "The harbour was quiet and the boats had not come back before the evening. " * 40
    wrapped = textwrap.fill(licences.TEXTS["GPL-3.0"][0], 60, initial_indent=" * ", subsequent_indent=" * ")
    cases = [(name, f"{prose}\n\nCopyright 2020 A. Person\n\n{whole[name]}\n{prose}") for name in whole]
    cases += [("GPL-3.0", f"{prose}\n/*\n{wrapped}\n */\n{prose}"), ("MIT", f"{prose} This work is licensed under the MIT License. Copyright 2020. {prose}")]
    cases += [("AGPL-3.0", f"{prose}\n{textwrap.fill(licences.HEADERS['AGPL-3.0'][0], 70)}\n{prose}"), ("MIT", f"{prose}\nMIT License\n{prose}")]
    cases += [("Apache-2.0", f"{prose}\n# SPDX-License-Identifier: Apache-2.0\n{prose}"), ("Apache-2.0", f"{prose}\n{textwrap.fill(' '.join(licences.TEXTS['Apache-2.0']), 72)}\n{prose}")]
    cases += [(None, f"{prose} The MIT License is discussed here. {prose}"), (None, f"{prose} Permission is hereby granted. {prose}"), (None, prose)]
    cases += [("MIT", f"{prose}\n{whole['MIT']}\n" * 20), ("ISC", "Released\nunder the\nISC License"), ("ISC", "a b c Released under the ISC License")]
    docs = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(cases)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in licences.document_licences(docs).collect()}
    assert {i: got[i].licence for i in got} == {i: name for i, (name, _) in enumerate(cases)}
    assert all(got[i].dice == 1.0 for i, (name, text) in enumerate(cases) if name in whole and whole[name] in text)


def test_runs_against_plain_windows(spark):
    prepare(spark)
    rng = np.random.default_rng(5)
    pairs = [(f"L{k}", " ".join(rng.choice(list("abcdef"), size))) for k, size in enumerate([3, 5, 9, 20])]
    texts = [" ".join(rng.choice(list("abcdefxy"), size)) for size in rng.integers(1, 60, 80)]

    def runs(text):
        words, found = text.split(), []
        seq = list(zip(words, words[1:]))
        for name, t in pairs:
            want = list(zip(t.split(), t.split()[1:]))
            m = len(set(want))
            for s in range(len(seq) - len(want) + 1):
                run = seq[s : s + len(want)]
                c = len(set(run) & set(want))
                dice = 2 * c / (c + sum(b not in set(want) for b in run) + m)
                if dice >= 0.6:
                    found.append((-round(dice, 6), name))
        return min(found, default=None)

    got = licences.scan(spark.createDataFrame(enumerate(texts), "doc_id long, text string"), threshold=0.6, pairs=pairs).filter("line = -1").collect()
    want = {i: best for i, text in enumerate(texts) if (best := runs(text))}
    assert {r.doc_id: (-r.dice, r.licence) for r in got} == want and len(want) > 10


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_chain_finds_toxic_documents_it_has_not_seen(spark):
    prepare(spark)
    docs, labels = tables(spark)
    seen = toxicity.table_labels(labels).filter("crc32(cast(doc_id as string)) % 5 <> 0")
    got = toxicity.score(docs, toxicity.train(docs, seen, toxicity.CATEGORIES), keep=["doc_id", "source"])
    assert got.columns == ["doc_id", "source", "p_junk", "p_toxic", "p_toxic_prose", "toxic"]
    hidden = got.join(labels.filter("crc32(cast(doc_id as string)) % 5 = 0").withColumnRenamed("toxic", "truth"), "doc_id").collect()
    assert np.mean([r.toxic == r.truth for r in hidden]) >= 0.9


def test_chain_feeds_earlier_categories_out_of_fold():
    rng = np.random.default_rng(1)
    n = 600
    first = rng.random(n) < 0.4
    second = first ^ (rng.random(n) < 0.05)
    buckets = np.array([10 if f else 20 for f in first])
    chain = toxicity.fit_chain(np.ones(n, int), buckets, np.column_stack([first, second]), np.arange(n) % 5, ["a", "b"])
    assert len(chain.weights[1]) == len(chain.words[1]) + 2  # words, the first category, the bias
    assert chain.weights[1][-2] > 0.5
    p = chain.score([toxicity._marks(2, np.arange(2), np.array([10, 20]), np.array(w)) for w in chain.words])
    assert p[0].min() > 0.8 and p[1].max() < 0.2


def test_chain_without_labels_and_odd_rows(spark):
    prepare(spark)
    docs = spark.createDataFrame([(1, None, 5), (None, "", 6), (1, "word " * 20_000, 7), (1, "word", 7)], "doc_id long, text string, toxic int")
    none = spark.createDataFrame([(None, 1), (2, None)], "doc_id long, toxic int")
    chain = toxicity.train(docs, none, ["toxic"])
    got = toxicity.score(docs, chain, keep=["doc_id"]).collect()
    assert [r.p_toxic for r in got] == [0.5] * 4
    left = toxicity.without_toxic(docs, chain, threshold=0.6)
    assert left.columns == ["doc_id", "text", "toxic"] and left.count() == 4
    assert toxicity.without_toxic(docs, chain, threshold=0.4).count() == 0


def test_quality_of_the_held_out_fold(spark):
    prepare(spark)
    docs, labels = tables(spark)
    got = quality.score(docs, quality.train(docs, labels))
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    hidden = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in hidden]) >= 0.95
    odd = spark.createDataFrame([(1, None), (None, ""), (2, "word"), (2, "é" * 5000)], "doc_id long, text string")
    assert len(quality.score(odd, quality.train(odd, labels)).collect()) == 4
    assert quality.score(odd, quality.train(odd, labels.limit(0))).select("score").distinct().count() == 1


def test_prior_from_positives_and_unlabelled_texts():
    """Near the share of good labels, which it does not see; and that of a mixture of known parts."""
    rng = np.random.default_rng(2)
    for share in (0.2, 0.5, 0.8):
        good = rng.normal(1, 1, (1500, quality.N_FEATURES))
        n = int(3000 * share)
        mixed = np.concatenate([rng.normal(1, 1, (n, quality.N_FEATURES)), rng.normal(-1, 1, (3000 - n, quality.N_FEATURES))])
        assert abs(quality.estimated_prior(good, rng.permutation(mixed)) - share) < 0.06
    assert quality.estimated_prior(good[:3], mixed) == quality.estimated_prior(good, mixed[:0]) == 0.5


def test_prior_is_near_the_share_of_good_labels(spark):
    prepare(spark)
    docs, labels = tables(spark)
    share = labels.selectExpr("avg(quality)").first()[0]
    assert abs(quality.train(docs, labels).prior - share) < 0.06
    only_good = labels.filter("quality = 1")
    assert quality.train(docs, only_good).prior == quality.train(docs, labels).prior


def test_empty_tables_give_no_rows(spark):
    prepare(spark)
    docs, labels = tables(spark)
    none = docs.limit(0)
    assert quality.score(none, quality.train(none, labels)).collect() == []
    chain = toxicity.train(none, toxicity.table_labels(labels), toxicity.CATEGORIES)
    assert toxicity.score(none, chain, keep=["doc_id"]).collect() == []
    assert pagetext.page_texts(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
    twice = docs.limit(5).unionByName(docs.limit(5))
    scores = quality.score(twice, quality.train(docs, labels)).collect()
    assert len(scores) == 10 and len({(r.doc_id, r.score) for r in scores}) == 5


def test_risk_does_not_fall_below_zero():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 1, (400, quality.N_FEATURES)), rng.normal(-1, 1, (200, quality.N_FEATURES))
    mixed = np.concatenate([rng.normal(1, 1, (400, quality.N_FEATURES)), rng.normal(-1, 1, (200, quality.N_FEATURES))])
    model = quality.fit_nnpu(good, mixed, 2 / 3)
    assert (model.score(good) > 0.5).mean() > 0.95 and (model.score(bad) < 0.5).mean() > 0.95
