"""Messages to Kafka."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def send_messages(messages: DataFrame, servers: str) -> None:
    """Send (topic, value) rows, as of ``operators.envelope.encode_messages`` or ``tag_records``."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def stream_messages(messages: DataFrame, servers: str, checkpoint: str) -> StreamingQuery:
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("checkpointLocation", checkpoint).start()
    )
