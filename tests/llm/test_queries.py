"""The registered queries against their SQL, and the pipeline against plain versions of its stages."""

from __future__ import annotations

import hashlib
import os

import duckdb
import public_tokenizers
import pytest
from test_exact_and_near import near_by_hand, plain, repeats_by_hand
from tokenizers import Tokenizer as Library

import corpus_pipeline
from lakesift.llm import toxicity
from lakesift.llm.common import table
from lakesift.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")


def _sorted(arrow):
    names = sorted(arrow.column_names)
    return sorted(zip(*[arrow.column(n).to_pylist() for n in names]), key=repr)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, key):
    query = QUERIES[key]
    got = query.run(spark, FOLDER).toArrow()
    assert got.num_rows
    if query.sql:
        con = duckdb.connect()
        for n in ("documents", "embeddings"):
            con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{FOLDER}/{n}.parquet')")
        want = con.sql(query.sql).to_arrow_table()
        assert sorted(got.column_names) == sorted(want.column_names)
        assert _sorted(got) == _sorted(want)


@pytest.mark.parametrize("key", ["op1_", "op4_"])
def test_native_main_paths_have_no_python(spark, key):
    plan = next(q for k, q in QUERIES.items() if k.startswith(key)).run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pipeline_stages(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    # Planted: exact and near copies and a passage of more than fifty words in two documents.
    texts = {r.doc_id: r.text for r in docs.collect()}
    long = max(texts.values(), key=lambda t: len(t.split()))
    words = long.split()
    passage = " ".join(f"pass{i}" for i in range(60))
    own, other = (" ".join(f"{w}{i}" for i in range(80)) for w in ("own", "other"))
    planted = [(10_001, " ".join(words)), (10_002, " ".join(["new", *words, "end"])), (10_003, f"{own} {passage}"), (10_004, f"{passage} {other}")]
    docs = docs.unionByName(spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in planted], docs.schema))
    rows = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "near_dedup", "substring_dedup", "packing"]

    def run(name, before):
        out = stages[name](spark, before, FOLDER)
        if name != "packing":
            assert out.columns == before.columns
        out.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    clean = run("toxicity", docs)
    chain = toxicity.train(docs, toxicity.table_labels(table(spark, FOLDER, "labels")), toxicity.CATEGORIES)
    toxic = {r.doc_id for r in toxicity.score(docs, chain, keep=["doc_id"]).collect() if r.toxic}
    kept = {r.doc_id: r.text for r in clean.collect()}
    assert kept == {i: t for i, t in rows.items() if i not in toxic} and toxic

    once = run("exact_dedup", clean)
    first = {}
    for i, t in sorted(kept.items()):
        first.setdefault(plain(t), i)
    kept = {i: kept[i] for i in first.values()}
    assert {r.doc_id: r.text for r in once.collect()} == kept and 10_001 not in kept

    apart = run("near_dedup", once)
    kept = {i: kept[i] for i, _, least in near_by_hand(list(kept.items()), 5) if i == least}
    assert {r.doc_id: r.text for r in apart.collect()} == kept and 10_002 not in kept

    cut = run("substring_dedup", apart)
    digests = sorted([(r.doc_id, hashlib.sha256(" ".join(r.text.split()).encode()).hexdigest()) for r in cut.collect()])
    assert digests == sorted([(i, sha) for i, _, _, sha in repeats_by_hand(list(kept.items()), 20)])
    final = {r.doc_id: r.text for r in cut.collect()}
    assert final[10_004] == other and final[10_003] == rows[10_003]
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    pieces = run("packing", cut).collect()
    library = Library.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {}
    for p in pieces:
        tokens[p.doc_id] = tokens.get(p.doc_id, 0) + p.length
    assert tokens == {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in final.items()}
