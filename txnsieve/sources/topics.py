"""Topics as DataFrames. Kafka in production, files where no broker is at hand."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnsieve.schemas import TOPIC_RECORD


@dataclass(frozen=True)
class Topic:
    """Where records live: ``location`` is the topic name for Kafka, else a folder."""

    location: str
    format: str = "kafka"
    options: dict[str, str] = field(default_factory=dict)


def read_topic(spark: SparkSession, topic: Topic) -> DataFrame:
    """Stream of ``key, value, headers, timestamp, partition, offset``, from the earliest record on.

    The last two are the place of a record in its source. Files hold them where they keep records of a
    broker; elsewhere they are null.
    """
    if topic.format != "kafka":
        return spark.readStream.schema(TOPIC_RECORD).options(**topic.options).format(topic.format).load(
            topic.location
        )
    stream = (
        spark.readStream.format("kafka")
        .option("subscribe", topic.location)
        .option("startingOffsets", "earliest")
        .option("includeHeaders", "true")
        .options(**topic.options)
        .load()
    )
    return stream.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "headers", "timestamp", "partition", "offset",
    )
