"""Outbox relay and request totals as streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from txnsieve.config import Quota
from txnsieve.operators.outbox import outbox_records, publish, topic_records, unpublished
from txnsieve.session import staged
from txnsieve.sinks.tables import NO_RUN, append_batch, of_earlier_batches, run_id
from txnsieve.sinks.topics import stream_to_topic, write_topic
from txnsieve.sources.tables import read_or_empty
from txnsieve.sources.topics import Topic

LEDGER = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()), T.StructField("status", T.StringType()),
        T.StructField("published_at", T.TimestampNTZType()), T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def relay(transactions: DataFrame, topic: Topic, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Send each stored transaction to the topic once; the checkpoint is the published mark."""
    trigger = trigger or {"processingTime": "1 second"}
    return stream_to_topic(topic_records(outbox_records(transactions)), topic, checkpoint, **trigger)


def relay_pending(
    outbox: DataFrame, topic: Topic, ledger: str, published_at: Column, batch_id: int = 0, run: str = NO_RUN
) -> DataFrame:
    """Send the records that the ledger does not hold, then add them to it; returns those of this batch.

    A batch that is cut off between the two is sent again: a folder topic replaces it, a broker may hold it
    twice. Running a finished batch again sends and adds the same records.
    """
    spark = outbox.sparkSession
    held = read_or_empty(spark, ledger, LEDGER).where(of_earlier_batches(batch_id, run))
    sent = staged(publish(unpublished(outbox, held), published_at).select("transaction_id", "payload", "status", "published_at"), "relay")
    write_topic(topic_records(sent), topic, batch_id, run)
    append_batch(sent.drop("payload"), ledger, batch_id, run=run)
    return sent


def stream_quota_totals(
    requests: DataFrame, quota: Quota = Quota(), time: str = "event_ts", lateness: str = "2 minutes"
) -> DataFrame:
    """Requests, admitted and rejected requests per identifier and tumbling window.

    The state of a window ends once the watermark has passed it.
    """
    return (
        requests.withWatermark(time, lateness)
        .groupBy(F.window(time, f"{quota.window_s} seconds"), "identifier")
        .agg(F.count("*").alias("requests"))
        .select(
            "identifier",
            F.col("window.start").alias("window_start"),
            "requests",
            F.least("requests", F.lit(quota.limit).cast("long")).alias("admitted"),
            F.greatest(F.lit(0).cast("long"), F.col("requests") - quota.limit).alias("rejected"),
        )
    )


def keep_quota_totals(totals: DataFrame, path: str, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Write the totals that a batch has changed, so neither state nor writes grow with the windows of the past."""
    run = run_id(totals.sparkSession, checkpoint)
    writer = totals.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(**trigger)
    return writer.foreachBatch(lambda batch, batch_id: append_batch(batch, path, batch_id, run=run)).start()


def latest_quota_totals(spark: SparkSession, path: str) -> DataFrame:
    """The last total of each identifier and window; a later batch of a window counts all its requests."""
    last = F.max_by(F.struct("requests", "admitted", "rejected"), F.struct("requests", "batch_id"))
    found = spark.read.parquet(path).groupBy("identifier", "window_start").agg(last.alias("last"))
    return found.select("identifier", "window_start", "last.*")
