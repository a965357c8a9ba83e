"""Message streams: (topic, value)."""

from pyspark.sql import DataFrame, SparkSession

from obsframe.operators.shards import TOPICS


def kafka_options(servers: str, topics: list[str] | None = None, **more: str) -> dict[str, str]:
    """From the earliest message on; progress is kept in the query's checkpoint."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics or TOPICS.values()),
        "startingOffsets": "earliest",
        **more,
    }


def kafka_messages(spark: SparkSession, servers: str, topics: list[str] | None = None, **more: str) -> DataFrame:
    """One stream over both topics."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topics, **more)).load()
    return stream.select("topic", "value")


def stored_messages(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The same columns from a folder of Parquet files, as they arrive."""
    return spark.readStream.schema("topic string, value binary").options(**options).parquet(path)
