"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    active = context.getCheckpointDir()
    if configured:
        if active is None:
            context.setCheckpointDir(configured)
        return configured
    if active is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="shelfwise-"))
        active = context.getCheckpointDir()
    return active


_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)
_keeps: ContextVar[bool] = ContextVar("keeps", default=False)


def scratch_path(spark: SparkSession, name: str) -> str:
    folder = _run_folder.get() or scratch_root(spark)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_run(spark: SparkSession, key: str | None = None) -> Iterator[None]:
    """Keep the scratch tables of one run in a folder, and delete it at the end.

    Frames made inside must be written before the run ends. A run with a ``key`` that fails leaves
    its folder, and the next run of that key finds there what was written with ``keep``. Only one
    run of a key may be under way.
    """
    folder = f"{scratch_root(spark).rstrip('/')}/run-{key}" if key else scratch_path(spark, "run")
    mark, kept_mark = _run_folder.set(folder), _keeps.set(key is not None)
    done = False
    try:
        yield
        done = True
    finally:
        _run_folder.reset(mark)
        _keeps.reset(kept_mark)
        if done or key is None:
            scratch_delete(spark.sparkContext, folder)


def scratch_delete(context: SparkContext, folder: str) -> None:
    """Delete a scratch table that is read no more, or a run's folder."""
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def kept(spark: SparkSession, name: str) -> DataFrame | None:
    """What an earlier run of the same key wrote in full under ``name``."""
    if not _keeps.get():
        return None
    path = f"{_run_folder.get()}/kept-{name}"
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark):
        return None
    return spark.read.parquet(path)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Like ``materialize``; in a run with a key, where its next try finds it."""
    if not _keeps.get():
        return materialize(df, name)
    path = f"{_run_folder.get()}/kept-{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and gives the planner the
    real size of the table for its join choices.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def build_session(app: str = "shelfwise", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
