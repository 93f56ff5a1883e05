"""Session settings, lineage cuts and size checks.

No operator hints a broadcast. Small sides are broadcast by Spark's own size check
(`spark.sql.autoBroadcastJoinThreshold`, from file sizes when planning and from true
sizes in adaptive execution); larger ones shuffle on their keys, and adaptive skew
joins split the hot keys.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_own_dirs: dict[str, str] = {}
_cleared: set[str] = set()
_paths: dict[int, str] = {}
on_plan: Callable[[DataFrame], None] | None = None  # tests look at every plan that is written through here


def build_session(app: str = "placestats", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators assume; `extra` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Only a local session may fall back to a folder of its own: on a cluster the
    executors must all see it, so a missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="placestats-")
    return _own_dirs[app]


def _folder(spark: SparkSession) -> str:
    """This application's own part of the scratch folder, removed when the application ends."""
    path = f"{scratch_dir(spark)}/placestats/{spark.sparkContext.applicationId}"
    if path not in _cleared:
        _cleared.add(path)
        atexit.register(_remove, spark, path)
    return path


def new_folder(spark: SparkSession) -> str:
    """A folder of its own on the scratch storage, for files a step leaves to the next."""
    return f"{_folder(spark)}/{uuid.uuid4().hex}"


def _remove(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is None or context._gateway is None:  # stopped: nothing can reach the folder any more
        return
    try:
        where = context._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)
    except Py4JError:
        pass  # the engine ended first


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` to the shared scratch folder and read it back.

    This cuts the lineage of iterative work, survives lost executors, and gives
    the optimizer true file sizes, so small results are broadcast by its own rule.
    The files live until `release` or the end of the application.
    """
    return observed(df)[0]


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query are deleted as soon as it ends; for queries whose result is written."""
    kept = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if kept is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, kept)


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """`materialize`, with aggregates that the write itself computes: no extra job reads the rows."""
    spark = df.sparkSession
    path = new_folder(spark)
    if on_plan is not None:
        on_plan(df)
    told: dict = {}
    with dropping_shuffles(spark):
        if metrics:
            watch = Observation()
            df.observe(watch, *[c.alias(k) for k, c in metrics.items()]).write.parquet(path)
            told = watch.get
        else:
            df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    _paths[id(back)] = path
    weakref.finalize(back, _paths.pop, id(back), None)
    return back, told


def release(*frames: DataFrame) -> None:
    """Delete the files of materialized frames that nothing reads any more."""
    for df in frames:
        if path := _paths.pop(id(df), None):
            _remove(df.sparkSession, path)


def spread(df: DataFrame, rows: int, *keys: str, per_task: int = 200_000, least: int = 500) -> DataFrame:
    """Repartition ahead of compute-heavy work on rows that are small in bytes.

    Sizes in bytes would pack such rows into too few tasks. Uses all cores as soon as
    each gets `least` rows, and more partitions once a task would get over `per_task`.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(min(cores, -(-rows // least)), -(-rows // per_task), 1), *keys)
