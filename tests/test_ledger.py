"""The ledger of ingested files: new, changed, known, broken off."""

from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import types as T

from lakesift.sources import catalog as C
from lakesift.sources import ledger as G

REGISTRY = {t: {"k": T.IntegerType(), "v": T.StringType()} for t in ("a", "b", "c")}


@pytest.fixture
def lake(spark, tmp_path):
    folder, space = tmp_path / "landing", "ledger_" + uuid.uuid4().hex[:8]
    folder.mkdir()
    C.create_namespace(spark, space, str(tmp_path / "space"))

    def put(name, text, time):
        (folder / name).write_text(text)
        os.utime(folder / name, (time, time))

    def run():
        found = G.ingest_new(spark, str(folder), REGISTRY, space, str(tmp_path / "ledger")).collect()
        return {r["file"]: (r["state"], r["decision"], r["rows_loaded"]) for r in found}

    return put, run, space, str(tmp_path / "ledger"), str(folder)


def test_a_second_run_loads_new_and_changed_files_only(spark, lake):
    put, run, space, ledger, folder = lake
    put("a.csv", "k,v\n1,x\n2,y\n", 1000)
    put("b.csv", "k,w\n1,x\n", 1000)
    put("notes.txt", "no table", 1000)
    assert run() == {"a.csv": ("new", "processed", 2), "b.csv": ("new", "quarantine", None)}
    assert run() == {"a.csv": ("known", "skipped", None), "b.csv": ("known", "skipped", None)}
    put("a.csv", "k,v\n1,x\n2,z\n", 2000)
    put("b.csv", "k,v\n1,x\n", 2000)
    put("c.csv", "k,v\n7,c\n", 2000)
    assert run() == {"a.csv": ("changed", "processed", 2), "b.csv": ("changed", "processed", 1), "c.csv": ("new", "processed", 1)}
    assert sorted(r["v"] for r in spark.table(f"{space}.a").collect()) == ["x", "z"]
    entries = G.read_ledger(spark, ledger)
    assert entries.count() == 5 and G.latest_entries(entries).count() == 3
    before = {r["file"]: r["digest"] for r in G.latest_entries(entries).collect()}
    put("a.csv", "k,v\n2,z\n1,x\n", 3000)  # the same rows in another order
    assert run()["a.csv"] == ("changed", "processed", 2)
    after = {r["file"]: r["digest"] for r in G.latest_entries(G.read_ledger(spark, ledger)).collect()}
    assert after["a.csv"] == before["a.csv"] and before["a.csv"] != before["b.csv"]


def test_what_a_broken_off_run_left_is_taken_up(spark, lake, monkeypatch):
    put, run, space, ledger, folder = lake
    put("a.csv", "k,v\n1,x\n", 1000)
    put("c.csv", "k,v\n1,x\n", 1000)
    original = G.ingest_file

    def ended(spark, path, file, *rest):
        if file == "c.csv":
            raise KeyboardInterrupt
        return original(spark, path, file, *rest)

    monkeypatch.setattr(G, "ingest_file", ended)
    with pytest.raises(KeyboardInterrupt):
        run()
    monkeypatch.undo()
    states = {r["file"]: r["state"] for r in G.pending(spark, folder, REGISTRY, ledger).collect()}
    assert states["c.csv"] == "new"
    assert run()["c.csv"] == ("new", "processed", 1)
    assert {s for s, _, _ in run().values()} == {"known"}
