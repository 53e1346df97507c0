"""Session defaults and the shared folders a job may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "newslake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on.

    The time zone is fixed to UTC, and adaptive execution is on: it sizes the
    reduce side, splits skewed join partitions, and turns a join into a
    broadcast only after the side's real size is known.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    It is the one the cluster names in ``spark.checkpoint.dir``.  Only a local
    session may fall back to a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="newslake-"))
    return context.getCheckpointDir()


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of an executor."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def set_down(df: DataFrame, name: str) -> DataFrame:
    """Write a table to a new shared folder and read it back, for steps that read it several times.

    Made once, whatever columns the steps need; each reads only its own.
    """
    return _set_down(df, work_dir(df.sparkSession, name))


def _set_down(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def held(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The same for a while: the folder goes once the steps that read it are through."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    try:
        yield _set_down(df, path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
