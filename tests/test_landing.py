from __future__ import annotations

import math
import os

import pytest
from conftest import rows
from pyspark.sql import types as T

from lakesift.sources import catalog as C
from lakesift.sources import landing as L

REGISTRY = {"t": {"i": T.IntegerType(), "f": T.FloatType(), "s": T.StringType()}}
SCHEMA = L.schema_for(REGISTRY, "t")


@pytest.fixture
def land(tmp_path):
    def write(name, *lines):
        path = tmp_path / "landing" / name
        os.makedirs(path.parent, exist_ok=True)
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    return write


def test_schema_is_ordered_and_nullable():
    assert SCHEMA.names == ["i", "f", "s"]
    assert all(f.nullable for f in SCHEMA)
    with pytest.raises(KeyError):
        L.schema_for(REGISTRY, "unknown")


def test_null_token_never_becomes_nan(spark, land):
    path = land("t.csv", "i,f,s", "1,NA,NA", "NA,2.5,x", "3,,")
    got = L.read_typed_csv(spark, path, SCHEMA).collect()
    assert [tuple(r) for r in got] == [(1, None, None), (None, 2.5, "x"), (3, None, None)]
    nan = L.read_typed_csv(spark, land("n.csv", "i,f,s", "1,NaN,x"), SCHEMA).first()
    assert nan["f"] is None or math.isnan(nan["f"])


@pytest.mark.parametrize("bad", ["BAD,2,x", "1,2", "1,2,x,y", "99999999999,2,x"])
def test_malformed_rows(spark, land, bad):
    path = land("t.csv", "i,f,s", "1,1.5,a", bad)
    with pytest.raises(L.READ_ERRORS):
        L.read_typed_csv(spark, path, SCHEMA).collect()
    kept = L.read_typed_csv(spark, path, SCHEMA, mode="PERMISSIVE", corrupt_col="_c").collect()
    assert [r["_c"] for r in kept] == [None, bad]


def test_header_is_compared_with_the_file(spark, land):
    good, swapped = land("a.csv", "i,f,s", "1,2,x"), land("b.csv", "f,i,s", "1,2,x")
    assert L.check_headers(spark, good, SCHEMA)
    assert not L.check_headers(spark, swapped, SCHEMA)
    with pytest.raises(L.READ_ERRORS):
        L.read_typed_csv(spark, swapped, SCHEMA).collect()


def test_types_and_rows(spark, land):
    df = L.read_typed_csv(spark, land("t.csv", "i,f,s"), SCHEMA)
    assert L.check_types(df, SCHEMA)
    assert not L.check_types(df.withColumn("i", df.i.cast("string")), SCHEMA)
    assert not L.require_rows(df)


def test_inferred_and_text_scans(spark, land):
    path = land("t.csv", "i,f,s", "1,1.5,a", "NA,2,b")
    assert [t for _, t in L.read_inferred_csv(spark, path).dtypes] == ["int", "double", "string"]
    assert {t for _, t in L.read_inferred_csv(spark, path, infer=False).dtypes} == {"string"}


def test_admission(frame):
    files = frame([("t.csv",), ("t.txt",), ("other.csv",), ("t.csv.csv",)], "file string")
    assert rows(L.admit(files, REGISTRY)) == [("t.csv", "t")]


def test_triage_names_the_first_failed_step(spark):
    good = L.FileStatus("a.csv", "a", True, True, True, True, True, True)
    bad = L.FileStatus("b.csv", "b", True, False, None)
    got = {r["file"]: (r["decision"], r["failed_step"]) for r in L.triage(L.status_frame(spark, [good, bad])).collect()}
    assert got == {"a.csv": ("processed", None), "b.csv": ("quarantine", "header_ok")}


def test_ingest_folder(spark, land, tmp_path):
    land("t.csv", "i,f,s", "1,1.5,a", "1,1.5,a", "2,NA,b")
    land("u.csv", "i,f,s", "BAD,1,x", "1,1,x")
    land("v.csv", "i,f,s")
    land("w.csv", "f,i,s", "1,1,x")
    land("notes.txt", "hello")
    land("unknown.csv", "a", "1")
    registry = {n: REGISTRY["t"] for n in "tuvw"}
    space = C.create_namespace(spark, "staging_ingest", str(tmp_path / "ns"))
    got = {r["file"]: r for r in L.ingest_folder(spark, str(tmp_path / "landing"), registry, space).collect()}
    assert set(got) == {"t.csv", "u.csv", "v.csv", "w.csv"}
    assert got["t.csv"]["decision"] == "processed"
    assert (got["t.csv"]["rows_read"], got["t.csv"]["rows_loaded"]) == (3, 2)
    failed = {f: r["failed_step"] for f, r in got.items() if r["decision"] == "quarantine"}
    assert failed == {"u.csv": "parsed", "v.csv": "not_empty", "w.csv": "header_ok"}
    assert got["u.csv"]["malformed_rows"] == 1
    assert C.list_tables(spark, space) == ["t"]
    loaded = C.load_namespace(spark, space)["t"]
    assert rows(loaded, "i", "f", "s") == [(1, 1.5, "a"), (2, None, "b")]
    assert loaded.select("index").distinct().count() == 2


def test_single_namespace():
    assert C.single_namespace(["a", "a"]) == "a"
    for names in ([], ["a", "b"]):
        with pytest.raises(ValueError):
            C.single_namespace(names)


def test_landing_text_is_compressed_in_small_parts(spark, frame, tmp_path, monkeypatch):
    """Text with quotes, line breaks and nulls comes back as it was, from parts that a task each can read."""
    from lakesift.probes import ingest

    monkeypatch.setattr(ingest, "ROWS_PER_PART", 3, raising=False)
    texts = ['a "b"', "two\nlines", "e", None, " x ", "c,d"]
    df = frame([(i, texts[i % 6]) for i in range(10)], "k int, v string").coalesce(1)
    path = ingest.land(df, str(tmp_path / "t.csv"))
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path").collect()
    assert len(parts) == 4 and all(p.path.endswith(".csv.gz") for p in parts)
    assert rows(L.read_typed_csv(spark, path, df.schema, multi_line=True)) == rows(df)
