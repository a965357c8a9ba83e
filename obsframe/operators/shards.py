"""Two shards of one stream of places."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.operators.position import with_position

# Names the two shards go by.
TOPICS = {1: "weather_1", 2: "weather_2"}
SHARD_TABLES = {1: {"current": "current", "daily": "daily"}, 2: {"current": "current_2", "daily": "daily_2"}}
# End of fixed values.


def split_shards(places: DataFrame, key: str = "id") -> DataFrame:
    """Add ``shard``: 1 for the first half of the places in key order, 2 for the rest; and ``seat``, the
    0-based position within the shard. With an odd number of places the second shard has one more."""
    half = F.floor(F.col("total") / 2)
    shard = F.when(F.col("position") < half, 1).otherwise(2)
    return with_position(places, [key]).select(
        *places.columns, "position",
        shard.alias("shard"),
        F.when(shard == 1, F.col("position")).otherwise(F.col("position") - half).alias("seat"),
    )


def shard_sizes(sharded: DataFrame, key: str = "id") -> DataFrame:
    return sharded.groupBy("shard").agg(F.count("*").alias("places"), F.min(key).alias("first_id"))


def union_shards(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both shards, marked with the shard they come from."""
    return first.withColumn("shard", F.lit(1)).unionByName(second.withColumn("shard", F.lit(2)))


def topic_of(shard: Column) -> Column:
    return F.when(shard == 1, TOPICS[1]).when(shard == 2, TOPICS[2]).otherwise(_unknown("shard", shard))


def shard_of(topic: Column) -> Column:
    return F.when(topic == TOPICS[1], 1).when(topic == TOPICS[2], 2).otherwise(_unknown("topic", topic).cast("int"))


def table_of(shard: Column, kind: str) -> Column:
    return F.when(shard == 1, SHARD_TABLES[1][kind]).when(shard == 2, SHARD_TABLES[2][kind]).otherwise(_unknown("shard", shard))


def _unknown(what: str, value: Column) -> Column:
    """A row of no shard fails the job."""
    return F.raise_error(F.concat(F.lit(f"unknown {what}: "), F.coalesce(value.cast("string"), F.lit("NULL")))).cast("string")
