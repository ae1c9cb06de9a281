"""Records to topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnsieve.operators.parsing import PLACE
from txnsieve.operators.triage import ATTEMPT_HEADER, ERROR_HEADER, PLACE_HEADER, UNKNOWN_ERROR
from txnsieve.sinks.tables import NO_RUN, append_batch, run_id
from txnsieve.sources.topics import Topic


def header(name: str, text: Column) -> Column:
    """A record's headers with one entry."""
    return F.array(F.struct(F.lit(name).alias("key"), F.encode(text, "UTF-8").alias("value")))


def dead_letter_records(rejects: DataFrame, *carried: str) -> DataFrame:
    """Rejected payloads as records: key, raw value and error header, with the ``carried`` columns.

    A second header names the place in the source (partition and offset) where that is known.
    """
    headers = header(ERROR_HEADER, F.coalesce("error_message", F.lit(UNKNOWN_ERROR)))
    if set(PLACE) <= set(rejects.columns):
        place = header(PLACE_HEADER, F.concat_ws(":", *[F.col(c).cast("string") for c in PLACE]))
        headers = F.when(F.col(PLACE[1]).isNull(), headers).otherwise(F.concat(headers, place))
    return rejects.select(
        F.col("transaction_id").alias("key"),
        F.col("original_payload").alias("value"),
        headers.alias("headers"),
        *carried,
    )


def replay_records(replays: DataFrame) -> DataFrame:
    """Replayed payloads as records that carry their attempt number."""
    attempt = header(ATTEMPT_HEADER, F.col("attempt").cast("string"))
    return replays.select("key", "value", attempt.alias("headers"))


def write_topic(records: DataFrame, topic: Topic, batch_id: int, run: str = NO_RUN) -> None:
    """Send the records of one batch. A folder topic replaces a repeated batch; Kafka may repeat."""
    if topic.format == "kafka":
        records.write.format("kafka").option("topic", topic.location).option(
            "includeHeaders", "true"
        ).options(**topic.options).save()
    else:
        append_batch(records.withColumn("timestamp", F.current_timestamp()), topic.location, batch_id, run=run)


def stream_to_topic(records: DataFrame, topic: Topic, checkpoint: str, **trigger: object) -> StreamingQuery:
    writer = records.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger)
    if topic.format == "kafka":
        return writer.format("kafka").option("topic", topic.location).options(**topic.options).start()
    run = run_id(records.sparkSession, checkpoint)
    return writer.foreachBatch(lambda batch, batch_id: write_topic(batch, topic, batch_id, run)).start()
