"""Dead-letter classification, routing and retry state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnsieve.config import POISON_PILL, QUARANTINED, RESOLVED, RETRYING, TRANSIENT, Triage
from txnsieve.functions.text import contains_any, is_blank
from txnsieve.operators.dedupe import new_failures
from txnsieve.operators.lookups import shuffled
from txnsieve.operators.ranking import rank_up_to

# Fixed value: error text of a record without the header.
UNKNOWN_ERROR = "Unknown error"
ERROR_HEADER = "error-message"
# Header of our own: the attempt number of a replayed record.
ATTEMPT_HEADER = "retry-attempt"
# Header of our own: partition and offset of the record that failed.
PLACE_HEADER = "source-place"


def header_text(headers: Column, name: str) -> Column:
    """Text of the first header of a name, null when it is missing."""
    return F.get(F.filter(headers, lambda h: h["key"] == name), F.lit(0))["value"].cast("string")


def header_error(headers: Column) -> Column:
    """Text of the error header, or the default when it is missing."""
    return F.coalesce(header_text(headers, ERROR_HEADER), F.lit(UNKNOWN_ERROR))


def header_attempt(headers: Column) -> Column:
    """Attempt number of a replayed record, 0 for a first delivery."""
    return F.coalesce(header_text(headers, ATTEMPT_HEADER).try_cast("long"), F.lit(0).cast("long"))


def dead_letters(records: DataFrame) -> DataFrame:
    """Topic records (key, value, headers) to failures."""
    return records.withColumns(
        {
            "transaction_id": F.col("key"),
            "original_payload": F.col("value"),
            "error_message": header_error(F.col("headers")),
        }
    ).drop("key", "value", "headers")


def classify(error: Column, triage: Triage = Triage()) -> Column:
    """Transient words win over poison words; blank and unknown text is a poison pill."""
    text = F.lower(error)
    return (
        F.when(is_blank(error), F.lit(POISON_PILL))
        .when(contains_any(text, triage.transient_words), F.lit(TRANSIENT))
        .when(contains_any(text, triage.poison_words), F.lit(POISON_PILL))
        .otherwise(F.lit(POISON_PILL))
    )


def _routed(failures: DataFrame, retry: Column, retry_count: Column, at: str) -> DataFrame:
    return (
        failures.withColumn("status", F.when(retry, F.lit(RETRYING)).otherwise(F.lit(QUARANTINED)))
        .withColumn("retry_count", retry_count.cast("long"))
        .withColumn("last_retried_at", F.when(retry, F.col(at)))
        .withColumn("resolved_at", F.when(~retry, F.col(at)))
    )


def triage_first(
    failures: DataFrame,
    recorded: DataFrame | None = None,
    triage: Triage = Triage(),
    key: Column | None = None,
    order: Sequence[str] = ("event_ms", "seq"),
    at: str = "created_at",
) -> DataFrame:
    """Record the first failure per id and route it: one retry or quarantine, repeats are dropped."""
    fresh = new_failures(failures, recorded, key, order).withColumn(
        "failure_type", classify(F.col("error_message"), triage)
    )
    retry = F.col("failure_type") == TRANSIENT
    return _routed(fresh, retry, F.when(retry, 1).otherwise(0), at)


def triage_attempts(
    failures: DataFrame,
    decisions: DataFrame | None = None,
    triage: Triage = Triage(),
    order: Sequence[str] = ("event_ms", "seq"),
    at: str = "created_at",
    recorded: DataFrame | None = None,
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """Record every failure, count attempts per id, and quarantine after the last retry.

    A retried id that has a decision by now is resolved, at the time of the decision (``decided_at``) if
    that is given. ``recorded`` holds failures of earlier batches, whose attempts count on. Only the
    first ``max_retries`` failures per id need a number. ``hot`` are the cells of ids with very many failures
    (``rank_up_to``); the failures of all others are shuffled once, by their id.
    """
    typed = failures.withColumn("failure_type", classify(F.col("error_message"), triage))
    ranked = rank_up_to(
        typed.where(F.col("failure_type") == TRANSIENT), ["transaction_id"], order, triage.max_retries, "_attempt", hot
    )
    if recorded is not None:
        before = recorded.where(F.col("failure_type") == TRANSIENT).groupBy("transaction_id").agg(F.count("*").alias("_before"))
        counted = F.coalesce("_before", F.lit(0)) + F.col("_attempt")
        ranked = ranked.join(shuffled(before), "transaction_id", "left").withColumn(
            "_attempt", F.when(counted <= triage.max_retries, counted)
        ).drop("_before")
    poison = typed.where(F.col("failure_type") == POISON_PILL).withColumn(
        "_attempt", F.lit(None).cast("long")
    )
    all_failures = ranked.unionByName(poison)
    attempt = F.col("_attempt")
    used_up = F.when(F.col("failure_type") == TRANSIENT, triage.max_retries).otherwise(0)
    routed = _routed(all_failures, attempt.isNotNull(), F.coalesce(attempt, used_up), at).drop("_attempt")
    if decisions is None:
        return routed
    when = F.min("decided_at") if "decided_at" in decisions.columns else F.lit(None).cast("timestamp")
    decided = decisions.groupBy("transaction_id").agg(F.lit(True).alias("_decided"), when.alias("_decided_at"))
    resolved = (F.col("status") == RETRYING) & F.coalesce("_decided", F.lit(False))
    resolved_at = F.when(resolved, F.coalesce("_decided_at", at)).otherwise(F.col("resolved_at"))
    return (
        routed.join(shuffled(decided), "transaction_id", "left")
        .withColumn("resolved_at", resolved_at)
        .withColumn("status", F.when(resolved, F.lit(RESOLVED)).otherwise(F.col("status")))
        .drop("_decided", "_decided_at")
    )


def replays(triaged: DataFrame) -> DataFrame:
    """Records for the scoring topic, with the attempt that lets them pass the claim."""
    return triaged.where(F.col("status") == RETRYING).select(
        F.col("transaction_id").alias("key"),
        F.col("original_payload").alias("value"),
        F.col("retry_count").alias("attempt"),
    )


def quarantined(triaged: DataFrame) -> DataFrame:
    return triaged.where(F.col("status") == QUARANTINED)
