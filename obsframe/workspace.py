"""Intermediate tables in the folder all executors share."""

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local session without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="obsframe-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


_run: ContextVar[str | None] = ContextVar("run", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder, below the run that is open, if one is."""
    return f"{_run.get() or shared_folder(spark).rstrip('/') + '/obsframe'}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run(spark: SparkSession) -> Iterator[str]:
    """A folder of its own for all that is materialized inside, which goes at the end, also after a failure. What a
    run returns is to be written elsewhere before that; runs inside a run are part of it.

    A driver that is lost leaves its folder; :func:`open_runs` lists such ones, :func:`close_run` deletes one."""
    if _run.get():
        yield _run.get()
        return
    folder = f"{_runs(spark)}/{uuid.uuid4().hex}"
    mark = _run.set(folder)
    try:
        yield folder
    finally:
        _run.reset(mark)
        close_run(spark, folder)


def _runs(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/obsframe-runs"


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def open_runs(spark: SparkSession) -> list[str]:
    """Folders of runs that have not ended, here or elsewhere."""
    at, system = _files(spark, _runs(spark))
    return [f"{_runs(spark)}/{s.getPath().getName()}" for s in system.listStatus(at)] if system.exists(at) else []


def close_run(spark: SparkSession, folder: str) -> None:
    at, system = _files(spark, folder)
    system.delete(at, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table and read it back.

    It cuts the lineage, so a lost executor costs a re-read and not a recomputation, and it pins values
    that depend on how rows were laid out (row ids, partition ids).
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
