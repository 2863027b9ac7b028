"""Where intermediate tables go."""

import os
from types import SimpleNamespace

import pytest

from starkit.session import fresh_path, shared_dir, stage, staging


def _session(**settings):
    named = {name.replace("__", "."): value for name, value in settings.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: named.get(name, default)))


def test_the_named_folder_is_used():
    assert shared_dir(_session(spark__checkpoint__dir="hdfs://x/y/", spark__master="yarn")) == "hdfs://x/y"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        shared_dir(_session(spark__master="spark://host:7077"))


def test_local_mode_gets_one_folder_per_application():
    one = _session(spark__master="local[2]", spark__app__id="a")
    assert shared_dir(one) == shared_dir(one) and os.path.isdir(shared_dir(one))
    assert shared_dir(one) != shared_dir(_session(spark__master="local[2]", spark__app__id="b"))
    assert fresh_path(one, "x") != fresh_path(one, "x")


def test_staged_rows_are_read_back(spark):
    staged = stage(spark.range(5).selectExpr("id", "CAST(NULL AS STRING) AS t"), "numbers")
    assert staged.count() == 5 and staged.dtypes == [("id", "bigint"), ("t", "string")]
    assert shared_dir(spark) in staged.inputFiles()[0]
    assert stage(spark.range(0), "nothing").count() == 0


def test_staged_tables_go_with_their_scope(spark):
    with staging(spark):
        inner = stage(spark.range(3), "scoped")
        folder = os.path.dirname(inner.inputFiles()[0].removeprefix("file://"))
        assert inner.count() == 3 and os.path.isdir(folder)
        with staging(spark):
            stage(spark.range(1), "nested")
    assert not os.path.exists(folder)


def test_a_local_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        shared_dir(_session(spark__master="local-cluster[3,2,1024]"))
