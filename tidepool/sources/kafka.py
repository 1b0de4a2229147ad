"""Message-queue (Kafka) source.  Needs the Spark Kafka connector on the
classpath; decoding is separate (:func:`tidepool.functions.json.decode`) so
it can be used and tested on any ``value`` column without a broker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import decode


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str | None = "earliest", group_id: str | None = None,
                 streaming: bool = True) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if starting_offsets:
        reader = reader.option("startingOffsets", starting_offsets)
    if group_id:
        reader = reader.option("kafka.group.id", group_id)
    return reader.load()


def decode_messages(raw: DataFrame, schema, with_metadata: bool = True,
                    mode: str = "PERMISSIVE") -> DataFrame:
    """Kafka rows -> typed columns (+ read-only ``partition``/``offset``)."""
    if with_metadata:
        raw = raw.withColumn("partition", F.col("partition").cast("bigint")) \
                 .withColumn("offset", F.col("offset").cast("bigint"))
        return decode(raw, schema, "value", keep=["partition", "offset"], mode=mode)
    return decode(raw, schema, "value", mode=mode)


__all__ = ["kafka_stream", "decode_messages"]
