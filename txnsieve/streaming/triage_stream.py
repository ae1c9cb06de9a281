"""Dead letters as a stream: record, route, replay.

Recorded failures lie in buckets by the hash of their key, so a batch reads the buckets of its own keys only,
and the folders of committed batches of a bucket are merged every few batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from txnsieve.config import Triage
from txnsieve.operators.dedupe import ID
from txnsieve.operators.ranking import WHOLE_ROWS, key_cell
from txnsieve.operators.triage import dead_letters, replays, triage_attempts, triage_first
from txnsieve.schemas import FAILED_EVENTS
from txnsieve.session import remove_folder, run_folder, staged
from txnsieve.sinks.retention import batch_folders, read_current, retain
from txnsieve.sinks.tables import NO_RUN, append_batch, of_earlier_batches, run_id
from txnsieve.sinks.topics import replay_records, write_topic
from txnsieve.sources.topics import Topic

BUCKET = "key_bucket"
RECORDED = T.StructType(
    [
        *FAILED_EVENTS.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


@dataclass(frozen=True)
class TriageJob:
    """Where a triage stream records failures and replays them."""

    failed_events: str
    scoring_topic: Topic
    triage: Triage = field(default_factory=Triage)
    key: Column | None = None
    #: Count every failure of an id and quarantine after the last retry; else only its first failure counts.
    attempts: bool = False
    #: Parts of the recorded failures, by the hash of their key; fixed for a table.
    buckets: int = 32
    #: Merge the folders of committed batches every so many batches; 0 never does.
    retain_every: int = 0

    def bucket(self) -> Column:
        """The bucket of a failure. Attempts count per id, first failures per key."""
        key = F.col(ID) if self.key is None or self.attempts else self.key
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")


def recorded_failures(spark: SparkSession, job: TriageJob, buckets: Sequence[int] | None = None) -> DataFrame | None:
    """The failures recorded so far, all or those of some buckets; None before the first."""
    among = None if buckets is None else [str(b) for b in buckets]
    return read_current(spark, job.failed_events, BUCKET, RECORDED, among=among)


def _batch_spread(failures: DataFrame) -> tuple[list[int], list[int]]:
    """The buckets of a batch, and the cells whose ids have too many failures there for one task; one job."""
    cells = failures.groupBy(BUCKET, key_cell([ID]).alias("cell")).agg(F.count("*").alias("rows"))
    found = cells.groupBy(BUCKET).agg(F.collect_set(F.when(F.col("rows") > WHOLE_ROWS, F.col("cell"))).alias("hot")).collect()
    return [r[BUCKET] for r in found], sorted({c for r in found for c in r["hot"]})


def _written(spark: SparkSession, job: TriageJob, batch_id: int, run: str) -> DataFrame | None:
    """What a batch has recorded, read back from its own folders; None if nothing."""
    folders = [f.path for f in batch_folders(spark, job.failed_events, BUCKET) if (f.run, f.batch) == (run, batch_id)]
    return spark.read.schema(RECORDED).option("basePath", job.failed_events).parquet(*folders) if folders else None


def triage_batch(records: DataFrame, batch_id: int, job: TriageJob, run: str = NO_RUN) -> None:
    """Record the new failures of a micro-batch, then replay the transient ones.

    The routed failures are dealt by bucket and written once; adaptive execution cuts a bucket that is too big for
    one task. The replays are read back from there.
    """
    spark = records.sparkSession
    folder = run_folder(spark, "triage")
    try:
        failures = staged(
            dead_letters(records).withColumn("created_at", F.col("timestamp")).withColumn(BUCKET, job.bucket()), "failures", folder
        )
        buckets, hot = _batch_spread(failures)
        if job.retain_every and batch_id % job.retain_every == 0:
            retain(spark, job.failed_events, BUCKET, RECORDED)
        recorded = recorded_failures(spark, job, buckets)
        if recorded is not None:
            recorded = recorded.where(of_earlier_batches(batch_id, run)).drop(BUCKET)
        order = ("created_at", "original_payload", "error_message")
        if job.attempts:
            routed = triage_attempts(failures, None, job.triage, order, recorded=recorded, hot=hot)
        else:
            routed = triage_first(failures, recorded, job.triage, job.key, order)
        append_batch(routed.select(*FAILED_EVENTS.names, BUCKET).hint("rebalance", BUCKET), job.failed_events, batch_id, [BUCKET], run)
        triaged = _written(spark, job, batch_id, run)
        if triaged is not None:
            write_topic(replay_records(replays(triaged)), job.scoring_topic, batch_id, run)
    finally:
        remove_folder(spark, folder)


def triage_stream(records: DataFrame, job: TriageJob, checkpoint: str, **trigger: object) -> StreamingQuery:
    run = run_id(records.sparkSession, checkpoint)
    return (
        records.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: triage_batch(batch, batch_id, job, run))
        .trigger(**trigger)
        .start()
    )
