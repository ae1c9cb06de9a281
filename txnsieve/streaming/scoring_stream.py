"""Score a payload stream: the batch operators over micro-batches and their history."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from txnsieve.config import DAY_MS, Scoring
from txnsieve.operators.dedupe import ID, claim_first, claim_replays
from txnsieve.operators.hard_rules import REASON, with_hard_reason
from txnsieve.operators.parsing import LAST_MS, PLACE, parse_payloads, reject_impossible_times, rejected_records, valid_events
from txnsieve.operators.rules import load_rules
from txnsieve.operators.triage import header_attempt
from txnsieve.operators.velocity import MS
from txnsieve.plans.scoring import score_events
from txnsieve.session import remove_folder, run_folder, staged
from txnsieve.sinks.retention import read_current, retain
from txnsieve.sinks.tables import NO_RUN, append_batch, of_earlier_batches, run_id
from txnsieve.sinks.topics import dead_letter_records, write_topic
from txnsieve.sources.topics import Topic

DATE = "event_date"


@dataclass(frozen=True)
class ScoringJob:
    """Where a scoring stream reads its rules and keeps its results.

    ``rules`` and ``reputation`` are read again for every micro-batch, so a changed rule table takes
    effect with the next batch. ``replays_pass`` lets replayed records be scored although the claim
    of their id still holds; without it they are skipped as duplicates. ``order`` breaks ties of equal event
    times, such as the place in the source. Every ``retain_every`` batches, days of history that neither a
    window, a claim nor an event up to ``lateness_ms`` late can reach are dropped, and the folders of
    committed batches are merged by day.
    """

    rules: Callable[[], DataFrame]
    reputation: Callable[[], DataFrame]
    decisions: str
    history: str
    dead_letters: Topic
    scoring: Scoring = field(default_factory=Scoring)
    decided_at: Column | None = None
    replays_pass: bool = False
    order: tuple[str, ...] = ("seq",)
    retain_every: int = 0
    lateness_ms: int = DAY_MS

    def reach_ms(self) -> int:
        """How far before an event its windows and its claim reach."""
        return max([self.scoring.claim_ttl_ms, *[s.window_ms for s in self.scoring.signals]])

    def history_columns(self) -> list[str]:
        return list(dict.fromkeys(c for s in self.scoring.signals for c in (s.key, s.member) if c))

    def history_schema(self) -> T.StructType:
        texts = [T.StructField(c, T.StringType()) for c in (ID, *self.history_columns())]
        return T.StructType(
            [*texts, T.StructField(MS, T.LongType()), T.StructField("survived", T.BooleanType()),
             T.StructField(DATE, T.StringType()), T.StructField("run_id", T.StringType()),
             T.StructField("batch_id", T.LongType())]
        )


def _day(ms: int) -> str:
    """The day of a time; the first or the last day there is for times beyond them."""
    return (datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(milliseconds=min(max(ms, 0), LAST_MS))).strftime("%Y-%m-%d")


def _earlier(spark: SparkSession, job: ScoringJob, bounds: Row, batch_id: int, run: str) -> DataFrame | None:
    """Events of earlier batches that a window or a claim of this batch can reach; None without any.

    A late repeat may lie before the row that won its claim, so claims reach forward as well: of the days
    that exist, those from the oldest reach to one claim after the newest event are read.
    """
    oldest = bounds["first"] - job.reach_ms()
    history = read_current(
        spark, job.history, DATE, job.history_schema(), _day(oldest), _day(bounds["last"] + job.scoring.claim_ttl_ms)
    )
    return None if history is None else history.where(of_earlier_batches(batch_id, run) & (F.col(MS) > oldest))


def _retain(spark: SparkSession, job: ScoringJob, bounds: Row) -> None:
    needed = min(bounds["first"], bounds["last"] - job.lateness_ms) - job.reach_ms()
    retain(spark, job.history, DATE, job.history_schema(), _day(needed))


def score_batch(payloads: DataFrame, batch_id: int, job: ScoringJob, run: str = NO_RUN) -> None:
    """Score one micro-batch (``value``, ``event_ms``, ``seq``, optional ``attempt``) and write its results.

    Every write replaces the partitions of this run and batch, and history is read from other runs and
    earlier batches only, so a repeated batch gives the same tables and a new checkpoint adds to them.
    """
    spark = payloads.sparkSession
    folder = run_folder(spark, "scoring-batch")
    try:
        _score_batch(payloads, batch_id, job, run, folder)
    finally:
        remove_folder(spark, folder)


def _claimed(valid: DataFrame, claims: DataFrame | None, job: ScoringJob, folder: str) -> DataFrame:
    if not job.replays_pass or "attempt" not in valid.columns:
        return claim_first(valid.drop("attempt"), job.scoring.claim_ttl_ms, job.order, claims, folder)
    first = claim_first(valid.where("attempt = 0"), job.scoring.claim_ttl_ms, job.order, claims, folder)
    return first.unionByName(claim_replays(valid, (MS, *job.order))).drop("attempt")


def _score_batch(payloads: DataFrame, batch_id: int, job: ScoringJob, run: str, folder: str) -> None:
    spark = payloads.sparkSession
    parsed = staged(reject_impossible_times(parse_payloads(payloads)), "parsed", folder)
    valid = valid_events(parsed)
    write_topic(dead_letter_records(rejected_records(parsed)), job.dead_letters, batch_id, run)
    bounds = valid.agg(F.min(MS).alias("first"), F.max(MS).alias("last")).first()
    if bounds["first"] is None:
        return
    if job.retain_every and batch_id % job.retain_every == 0:
        _retain(spark, job, bounds)
    earlier = _earlier(spark, job, bounds, batch_id, run)
    claims = None if earlier is None else earlier.select(ID, MS)
    events = staged(_claimed(valid, claims, job, folder), "events", folder)
    decisions = score_events(
        events,
        load_rules(job.rules()),
        job.reputation(),
        job.scoring,
        history=None if earlier is None else earlier.where(F.col("survived") & (F.col(MS) <= bounds["last"])),
        decided_at=job.decided_at,
    )
    append_batch(decisions, job.decisions, batch_id, run=run)
    kept = with_hard_reason(events, job.scoring.hard_rules).select(
        ID, *job.history_columns(), MS, F.col(REASON).isNull().alias("survived"),
        F.date_format(F.timestamp_millis(MS), "yyyy-MM-dd").alias(DATE),
    )
    append_batch(kept, job.history, batch_id, [DATE], run)


def score_stream(payloads: DataFrame, job: ScoringJob, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Start scoring a stream of ``value, event_ms, seq``."""
    run = run_id(payloads.sparkSession, checkpoint)
    return (
        payloads.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: score_batch(batch, batch_id, job, run))
        .trigger(**trigger)
        .start()
    )


#: Records of equal event time arrive in the order of their source; the hash decides where that is not known.
ARRIVAL = (*PLACE, "seq")


def topic_payloads(records: DataFrame) -> DataFrame:
    """Topic records as scoring input; the record time is the event time.

    ``source_partition`` and ``source_offset`` are the place in the source: the records of an id share a
    partition, so of those of equal time the lower offset came first. The hash of the record breaks ties
    the same way in every run where the source has no places. A job takes all three as ``order=ARRIVAL``.
    """
    partition, offset = (F.col(c) if c in records.columns else F.lit(None) for c in ("partition", "offset"))
    return records.select(
        "value",
        F.unix_millis("timestamp").alias(MS),
        partition.cast("int").alias(PLACE[0]),
        offset.cast("long").alias(PLACE[1]),
        F.xxhash64("key", "value").alias("seq"),
        header_attempt(F.col("headers")).alias("attempt"),
    )


def claim_within_watermark(events: DataFrame, ttl: str = "24 hours", time: str = "event_ts") -> DataFrame:
    """Claims held in the state store instead of the history table.

    Constant work per row, but a repeat after ``ttl`` is accepted only once the watermark has passed
    it, and rows later than ``ttl`` behind the watermark are dropped; use it where neither can occur.
    """
    return events.withWatermark(time, ttl).dropDuplicatesWithinWatermark([ID])
