from __future__ import annotations

import os
import subprocess
import sys
from types import SimpleNamespace

import pytest
from conftest import rows

from lakesift import session as S


class _Conf(dict):
    def set(self, key, value):
        self[key] = value


def _stub(master, **conf):
    return SimpleNamespace(conf=_Conf(conf), sparkContext=SimpleNamespace(master=master, applicationId="app-1"))


def test_scratch_is_the_folder_the_cluster_names():
    spark = _stub("yarn", **{"spark.checkpoint.dir": "hdfs://x/tmp/"})
    a, b = S.scratch(spark, "k"), S.scratch(spark, "k")
    assert a.startswith("hdfs://x/tmp/k-") and a != b


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        S.scratch_root(_stub("yarn"))


def test_a_local_master_gets_a_folder_of_its_own():
    spark = _stub("local[2]")
    assert S.scratch_root(spark) == S.scratch_root(spark) and "spark.checkpoint.dir" not in spark.conf


def test_a_plain_local_session_stores_steps(tmp_path):
    """Without any configured folder; options of the cluster cannot be set on a running session."""
    code = (
        "from pyspark.sql import SparkSession\n"
        "from lakesift.session import materialize\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "print('rows', materialize(spark.range(7), 'a').union(materialize(spark.range(5), 'b')).count())\n"
    )
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    done = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert "rows 12" in done.stdout, done.stderr[-2000:]


def test_materialized_frames_keep_schema_and_rows(frame):
    for data in ([(1, "a"), (None, None)], []):
        df = frame(data, "k int, v string")
        stored = S.materialize(df, "t")
        assert stored.schema.names == df.schema.names
        assert rows(stored) == rows(df)


def test_broadcast_check_follows_the_threshold(spark, conf):
    df = spark.range(1000)
    assert S.fits_broadcast(df)
    conf("spark.sql.autoBroadcastJoinThreshold", "100")
    assert not S.fits_broadcast(df)


def test_partition_count():
    assert S.shuffle_partitions_for(10) == 8
    assert S.shuffle_partitions_for(100 * 1024**4) == 819200
