"""Versioned rows and keyed inserts."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark cuts every key to one row per task before it shuffles, so a key with very many versions costs
    one row per task.
    """
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return rows.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == 1).drop("_rank")


def latest_forecasts(daily: DataFrame) -> DataFrame:
    """The newest version of each place and day. Versions of the same moment are told apart by what the table
    has of id, batch and shard; ids of the two shards overlap."""
    ties = [c for c in ("id", "batch_id", "shard") if c in daily.columns]
    return latest(daily, ["time", "locationID"], [F.desc(c) for c in ("time_created", *ties)])


def insert_ignore(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """The rows of ``new`` to append: one per key, none whose key exists."""
    others = [F.col(c) for c in new.columns if c != key]
    return latest(new, [key], others).join(existing.select(key), key, "left_anti")
