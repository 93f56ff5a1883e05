"""Scratch folder rules and size checks."""

import types

import pytest

from placestats.session import SETTINGS, _paths, materialize, observed, release, scratch_dir, spread


def fake(**conf):
    keys = {k.replace("_", "."): v for k, v in conf.items()}
    return types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda k, d=None: keys.get(k, d)))


def test_scratch_dir_follows_the_session():
    assert scratch_dir(fake(spark_checkpoint_dir="/shared/x/")) == "/shared/x"
    own = scratch_dir(fake(spark_master="local[2]", spark_app_id="a"))
    assert own == scratch_dir(fake(spark_master="local[2]", spark_app_id="a"))
    with pytest.raises(ValueError):
        scratch_dir(fake(spark_master="spark://host:7077"))


def test_materialize_cuts_the_plan(spark):
    df = materialize(spark.range(10).selectExpr("id", "id % 3 as k").groupBy("k").count())
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and sorted(map(tuple, df.collect())) == [(0, 4), (1, 3), (2, 3)]


def test_sizes(spark):
    assert spread(spark.range(10), 10).rdd.getNumPartitions() == 1
    assert spread(spark.range(10), 10**9).rdd.getNumPartitions() == 5000
    assert SETTINGS["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_writes_tell_what_they_wrote_and_files_go(spark):
    from pyspark.sql import functions as F

    df, told = observed(spark.range(10), n=F.count(F.lit(1)), most=F.max("id"))
    assert told == {"n": 10, "most": 9} and df.count() == 10
    path = _paths[id(df)]
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    disk = files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert disk.exists(files)
    release(df)
    assert not disk.exists(files)
