"""Small documents by version in a shared folder: what was written last is what holds."""

import json

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another run has committed the same version."""


def names(spark: SparkSession, folder: str) -> list[str]:
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in system.listStatus(at)] if system.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def last_commit(spark: SparkSession, folder: str) -> tuple[int, dict | None]:
    """The last version in ``folder`` that was written whole, and its document; (0, None) where there is none."""
    whole = [int(v) for v in sorted(names(spark, folder), key=int, reverse=True)]
    for version in whole:
        if "_SUCCESS" in names(spark, f"{folder}/{version}"):
            return version, json.loads("".join(r[0] for r in spark.read.text(f"{folder}/{version}").collect()))
    return 0, None


def commit(spark: SparkSession, folder: str, version: int, document: dict) -> None:
    """Write ``document`` as ``version``; fails if there is one. The last two versions are kept."""
    if str(version) in names(spark, folder):
        if "_SUCCESS" in names(spark, f"{folder}/{version}"):
            raise Conflict(f"version {version} of {folder} exists")
        delete(spark, f"{folder}/{version}")  # of a run that failed while writing it
    spark.createDataFrame([(json.dumps(document),)], "value string").coalesce(1).write.text(f"{folder}/{version}")
    for old in names(spark, folder):
        if int(old) < version - 1:
            delete(spark, f"{folder}/{old}")
