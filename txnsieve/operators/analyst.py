"""Analyst queries over stored transactions, decisions and failures."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnsieve.config import MAX_BROADCAST_ROWS, NEEDS_REVIEW
from txnsieve.operators.decisions import latest_decisions
from txnsieve.operators.lookups import lookup_join
from txnsieve.session import staged
from txnsieve.sources.tables import partition_values

# Fixed value: the folder name of rows without a day; the last one in falling order.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"

# Columns of the analyst views.
TRANSACTION_VIEW = (
    "id", "user_id", "card_fingerprint", "amount", "currency", "merchant_id", "merchant_category_code",
    "merchant_risk_tier", "device_fingerprint", "ip_address", "ip_country", "billing_country", "status",
    "created_at",
)
DECISION_VIEW = (
    "transaction_id", "decision", "risk_score", "decision_reason", "processing_stage", "decided_at",
)
REVIEW_VIEW = (
    "transaction_id", "risk_score", "decided_at", "amount", "currency", "merchant_id", "ip_country",
    "billing_country",
)
FAILURE_VIEW = (
    "id", "transaction_id", "failure_type", "status", "retry_count", "error_message", "created_at",
)


def get_transaction(transactions: DataFrame, transaction_id: str) -> DataFrame:
    return transactions.where(F.col("transaction_id") == transaction_id).select(*TRANSACTION_VIEW)


def get_decision(decisions: DataFrame, transaction_id: str, ties: Sequence[str] = ()) -> DataFrame:
    """The latest decision of one transaction."""
    mine = decisions.where(F.col("transaction_id") == transaction_id)
    return latest_decisions(mine, ties).select(*DECISION_VIEW)


def _newest(rows: DataFrame, time: str, limit: int, ties: Sequence[str]) -> DataFrame:
    return rows.orderBy(*[F.col(c).desc() for c in (time, *ties)]).limit(limit)


def days_of(spark: SparkSession, path: str, day: str = "decided_on") -> list[str]:
    """The days of a table that is stored by day, newest first, from the names of its folders."""
    return sorted(partition_values(spark, path, day), key=lambda d: (d != NO_DAY, d), reverse=True)


def _newest_by_day(
    table: DataFrame, days: Sequence[str] | None, day: str, time: str, limit: int, ties: Sequence[str],
    keep: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The newest rows that ``keep`` leaves, read from the newest days backwards until there are enough.

    Twice as many days are read in each step, and no day twice, so the steps grow with the logarithm of the
    days that are needed. Without ``days`` the whole table is one step.
    """
    if not days:
        return _newest(keep(table), time, limit, ties)
    kind = table.schema[day].dataType
    found, missing, at, span = [], limit, 0, 1
    while missing > 0 and at < len(days):
        listed = F.col(day).isin(*[F.lit(d).cast(kind) for d in days[at : at + span] if d != NO_DAY])
        if NO_DAY in days[at : at + span]:
            listed = listed | F.col(day).isNull()
        found.append(staged(_newest(keep(table.where(listed)), time, missing, ties), "newest"))
        missing -= found[-1].count()
        at, span = at + span, span * 2
    return _newest(reduce(DataFrame.unionByName, found), time, limit, ties)


#: Decisions that first look for their transaction; 32 times as many in each further round.
FIRST_ASKED = 1000


def _newest_with_details(asked: DataFrame, details: DataFrame, limit: int, ties: Sequence[str], first: int) -> DataFrame:
    """Rows of ``asked`` joined to their details, among them the newest ``limit`` that have any.

    The newest rows are joined first, and all of them only while too few have details, so the details are mostly
    scanned once against a broadcast of ``first`` rows. Without rows nothing is scanned.
    """
    asked = staged(asked, "asked")
    waiting = asked.count()
    while True:
        some = asked if first >= waiting else _newest(asked, "decided_at", first, ties)
        found = lookup_join(details, some, ["transaction_id"], "inner", fits=min(first, waiting) <= MAX_BROADCAST_ROWS)
        if first >= waiting:
            return found
        found = staged(_newest(found, "decided_at", limit, ties), "asked")
        if found.count() >= limit:
            return found
        first *= 32


def pending_review(
    decisions: DataFrame,
    transactions: DataFrame,
    limit: int = 20,
    ties: Sequence[str] = ("transaction_id",),
    days: Sequence[str] | None = None,
    day: str = "decided_on",
    first: int = FIRST_ASKED,
) -> DataFrame:
    """Newest decisions that wait for an analyst, with their transaction; those without one are left out.

    ``days`` (newest first) lists the days of a table stored by day, of which only those are read that are needed.
    """
    details = transactions.select("transaction_id", *REVIEW_VIEW[3:])

    def waiting(rows: DataFrame) -> DataFrame:
        asked = rows.where(F.col("decision") == NEEDS_REVIEW).select("transaction_id", "risk_score", "decided_at")
        return _newest_with_details(asked, details, limit, ties, first).select(*REVIEW_VIEW)

    return _newest_by_day(decisions, days, day, "decided_at", limit, ties, waiting)


def list_failures(
    failures: DataFrame, limit: int = 20, status: str | None = None, ties: Sequence[str] = ("id",)
) -> DataFrame:
    """Newest failed events, optionally of one status."""
    shown = failures if status is None else failures.where(F.col("status") == status)
    return _newest(shown, "created_at", limit, ties).select(*FAILURE_VIEW)


def audit_tail(
    decisions: DataFrame,
    limit: int = 40,
    ties: Sequence[str] = ("transaction_id",),
    days: Sequence[str] | None = None,
    day: str = "decided_on",
) -> DataFrame:
    """The newest decisions; ``days`` as for ``pending_review``."""
    shown = list(dict.fromkeys([*DECISION_VIEW, *ties]))
    return _newest_by_day(decisions, days, day, "decided_at", limit, ties, lambda rows: rows.select(*shown)).select(*DECISION_VIEW)


def decision_breakdown(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("decision").agg(F.count("*").alias("decisions"))


def stage_share(decisions: DataFrame) -> DataFrame:
    """Decisions per stage and reason, and their share of all.

    The total is a window over the few groups left after aggregation.
    """
    counts = decisions.groupBy("processing_stage", "decision_reason").agg(F.count("*").alias("decisions"))
    return counts.withColumn("share", F.col("decisions") / F.sum("decisions").over(Window.partitionBy()))


def _numbered(listed: DataFrame, order: list[Column], lines: list[Column]) -> DataFrame:
    """Number a limited list and render each row as text."""
    number = F.row_number().over(Window.orderBy(*order))
    return listed.withColumn("position", number.cast("long")).withColumn(
        "text", F.concat(F.col("position").cast("string"), F.lit(". "), F.concat_ws("\n", *lines))
    )


def render_review(listed: DataFrame, ties: Sequence[str] = ("transaction_id",)) -> DataFrame:
    text = [F.col(c).cast("string").alias(c) for c in REVIEW_VIEW]
    tx, score, at, amount, currency, merchant, ip, billing = text
    return _numbered(
        listed,
        [F.col(c).desc() for c in ("decided_at", *ties)],
        [
            F.concat(F.lit("Transaction: "), tx),
            F.concat(F.lit("   Score: "), score, F.lit(" | Amount: "), amount, F.lit(" "), currency),
            F.concat(
                F.lit("   Merchant: "), merchant, F.lit(" | IP Country: "), ip,
                F.lit(" | Billing Country: "), billing,
            ),
            F.concat(F.lit("   Flagged At: "), at),
        ],
    )


def render_failures(listed: DataFrame, ties: Sequence[str] = ("id",)) -> DataFrame:
    return _numbered(
        listed,
        [F.col(c).desc() for c in ("created_at", *ties)],
        [
            F.concat(F.lit("Transaction: "), "transaction_id"),
            F.concat(
                F.lit("   Failure Type: "), "failure_type", F.lit(" | Status: "), "status",
                F.lit(" | Retries: "), F.col("retry_count").cast("string"),
            ),
            F.concat(F.lit("   Error: "), F.coalesce("error_message", F.lit("none"))),
            F.concat(F.lit("   Created At: "), F.col("created_at").cast("string")),
        ],
    )
