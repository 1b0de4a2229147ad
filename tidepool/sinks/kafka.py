"""Message-queue sink: rows -> (key, JSON value) -> Kafka topic.

Needs the Spark Kafka connector on the classpath; the encoding
(:func:`tidepool.functions.json.to_messages`) works and is tested without it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.json import to_messages


def write_kafka(df: DataFrame, servers: str, topic: str, key_col: str | None = None,
                checkpoint: str | None = None, timestamp_format: str | None = None):
    msgs = to_messages(df, key_col, timestamp_format)
    if df.isStreaming:
        return (msgs.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
                .option("topic", topic).option("checkpointLocation", checkpoint).start())
    msgs.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    return None


__all__ = ["write_kafka"]
