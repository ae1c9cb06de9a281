"""Decision records, their latest state, and analyst overrides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnsieve.config import APPROVED, AUTO_REJECTED, PENDING, SLICE_MS, Cutoffs
from txnsieve.functions.scores import decide
from txnsieve.operators.levels import slice_start
from txnsieve.operators.lookups import lookup_join, shuffled
from txnsieve.operators.ranking import first_per_key
from txnsieve.session import exists, remove_folder, staged

# Reason and stage of a scored row, stage of a hard rejection.
RULE_ENGINE = "RULE_ENGINE"
FINAL_STAGE = "STAGE_4"
HARD_STAGE = "HARD_RULES"

RECORD = (
    "transaction_id", "decision", "risk_score", "decision_reason", "processing_stage", "decided_at",
    "behavioral_score", "rule_score", "enrichment_score",
)

# Decisions an analyst may set.
OVERRIDE_DECISIONS = (APPROVED, AUTO_REJECTED)
APPLIED = "APPLIED"
NOOP = "NOOP"
NOT_FOUND = "NOT_FOUND"
INVALID = "INVALID"

OVERRIDE_FIELDS = (
    T.StructField("override_reason", T.StringType()),
    T.StructField("override_by", T.StringType()),
    T.StructField("overridden_at", T.TimestampNTZType()),
)
# Merged partitions wait here, below the table, until they replace the old ones; readers skip such a name.
PENDING_MERGE = "_pending_merge"


def hard_decisions(hits: DataFrame, score: int, decided_at: Column) -> DataFrame:
    unscored = [F.lit(None).cast("long").alias(c) for c in RECORD[6:]]
    return hits.select(
        "transaction_id",
        F.lit(AUTO_REJECTED).alias("decision"),
        F.lit(score).cast("long").alias("risk_score"),
        F.col("hard_reason").alias("decision_reason"),
        F.lit(HARD_STAGE).alias("processing_stage"),
        decided_at.alias("decided_at"),
        *unscored,
    )


def scored_decisions(scored: DataFrame, cutoffs: Cutoffs, decided_at: Column) -> DataFrame:
    total = F.col("behavioral_score") + F.col("rule_score") + F.col("enrichment_score")
    return scored.select(
        "transaction_id",
        decide(total, cutoffs).alias("decision"),
        total.alias("risk_score"),
        F.lit(RULE_ENGINE).alias("decision_reason"),
        F.lit(FINAL_STAGE).alias("processing_stage"),
        decided_at.alias("decided_at"),
        *RECORD[6:],
    )


def latest_decisions(decisions: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """The newest decision row per transaction; ``ties`` order rows of equal time, highest first."""
    order = [F.col(c).desc() for c in ("decided_at", *ties)]
    return first_per_key(decisions, ["transaction_id"], order)


def current_transactions(transactions: DataFrame, decisions: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Transactions whose status follows their latest decision, pending while undecided."""
    latest = latest_decisions(decisions, ties).select("transaction_id", "decision")
    return (
        transactions.drop("status")
        .join(shuffled(latest), "transaction_id", "left")
        .withColumn("status", F.coalesce("decision", F.lit(PENDING)))
        .drop("decision")
    )


def _previous(rows: DataFrame, value: str, order: Sequence[str], name: str, slice_ms: int) -> DataFrame:
    """Add the value of the previous row of the transaction, time slice by time slice."""
    sliced = rows.withColumn("_slice", slice_start(F.unix_millis(F.col(order[0]).cast("timestamp")), slice_ms))
    in_slice = Window.partitionBy("transaction_id", "_slice").orderBy(*order)
    over_slices = Window.partitionBy("transaction_id").orderBy("_slice")
    ends = (
        sliced.groupBy("transaction_id", "_slice")
        .agg(F.max_by(value, F.struct(*order)).alias("_end"))
        .select("transaction_id", "_slice", F.lag("_end").over(over_slices).alias("_carried"))
    )
    return (
        sliced.withColumn(name, F.lag(value).over(in_slice))
        .join(shuffled(ends), ["transaction_id", "_slice"])
        .withColumn(name, F.coalesce(name, "_carried"))
        .drop("_slice", "_carried")
    )


def override_outcomes(
    overrides: DataFrame,
    decisions: DataFrame,
    order: Sequence[str] = ("requested_at", "override_id"),
    ties: Sequence[str] = (),
    slice_ms: int = SLICE_MS,
) -> DataFrame:
    """Outcome of every override request, taken in order per transaction.

    After any accepted request the decision equals the requested one, also when nothing had to
    change, so the decision a request meets is the previous valid request or else the latest
    decision row.
    """
    valid = F.col("new_decision").isin(*OVERRIDE_DECISIONS)
    requests = _previous(overrides.where(valid), "new_decision", order, "_previous", slice_ms).unionByName(
        overrides.where(~F.coalesce(valid, F.lit(False))).withColumn("_previous", F.lit(None).cast("string"))
    )
    latest = latest_decisions(decisions, ties).select("transaction_id", F.col("decision").alias("_latest"))
    met = F.when(F.col("_latest").isNotNull(), F.coalesce("_previous", "_latest"))
    outcome = (
        F.when(~F.coalesce(valid, F.lit(False)), F.lit(INVALID))
        .when(F.col("_latest").isNull(), F.lit(NOT_FOUND))
        .when((met == APPROVED) & (F.col("new_decision") == APPROVED), F.lit(NOOP))
        .otherwise(F.lit(APPLIED))
    )
    return (
        requests.join(shuffled(latest), "transaction_id", "left")
        .withColumn("outcome", outcome)
        .withColumn("previous_decision", F.when(F.col("outcome") != INVALID, met))
        .drop("_previous", "_latest")
    )


def _applied(outcomes: DataFrame, order: Sequence[str]) -> DataFrame:
    """The last applied override per transaction."""
    newest = [F.col(c).desc() for c in order]
    return first_per_key(outcomes.where(F.col("outcome") == APPLIED), ["transaction_id"], newest).select(
        "transaction_id",
        "new_decision",
        F.col("reason").alias("override_reason"),
        F.col("analyst_id").alias("override_by"),
        F.col(order[0]).alias("overridden_at"),
    )


def apply_overrides(
    decisions: DataFrame, outcomes: DataFrame, order: Sequence[str] = ("requested_at", "override_id")
) -> DataFrame:
    """Decision rows with the last applied override of their transaction, on all its rows."""
    return (
        decisions.join(shuffled(_applied(outcomes, order)), "transaction_id", "left")
        .withColumn("decision", F.coalesce("new_decision", "decision"))
        .drop("new_decision")
    )


def stored_schema(schema: T.StructType, day: str) -> T.StructType:
    """The schema of a decisions table by day, with the columns of overrides, which files from before them lack."""
    added = [f for f in OVERRIDE_FIELDS if f.name not in schema.names]
    own = [f for f in schema.fields if f.name != day]
    return T.StructType([*own, *added, T.StructField(day, T.DateType())])


def _finish_merge(spark: SparkSession, path: str, day: str, schema: T.StructType) -> None:
    """Puts the merged partitions, once they are complete, in the place of the old ones."""
    pending = f"{path}/{PENDING_MERGE}"
    if exists(spark, f"{pending}/_SUCCESS"):
        merged = spark.read.schema(schema).option("basePath", pending).parquet(pending)
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    remove_folder(spark, pending)


def merge_overrides(
    spark: SparkSession,
    path: str,
    outcomes: DataFrame,
    day: str = "decided_on",
    order: Sequence[str] = ("requested_at", "override_id"),
) -> list[str]:
    """Writes applied overrides into a decisions table stored by day; returns the days that were rewritten.

    Only days that hold a touched transaction are read whole and written; the files of all others stay as
    they are. The new partitions are written beside the table first and replace the old ones then; a merge
    that is cut off in between is finished by the next call, so no partition is lost and none is half new.
    One merge at a time may run on a table.
    """
    schema = stored_schema(spark.read.parquet(path).schema, day)
    _finish_merge(spark, path, day, schema)
    stored = spark.read.schema(schema).parquet(path)
    applied = staged(_applied(outcomes, order), "applied")
    touched = lookup_join(stored.select("transaction_id", day), applied.select("transaction_id"), ["transaction_id"], "left_semi")
    days = sorted(r[0] for r in touched.select(day).distinct().collect())
    if not days:
        return []
    new = applied.withColumnsRenamed({f.name: f"_{f.name}" for f in OVERRIDE_FIELDS})
    taken = F.col("new_decision").isNotNull()
    merged = lookup_join(stored.where(F.col(day).isin(days)), new, ["transaction_id"], "left", spread_by=["decided_at"])
    merged = merged.withColumns(
        {
            "decision": F.coalesce("new_decision", "decision"),
            **{f.name: F.when(taken, F.col(f"_{f.name}").cast(f.dataType)).otherwise(F.col(f.name)) for f in OVERRIDE_FIELDS},
        }
    )
    merged.select(*schema.names).write.partitionBy(day).parquet(f"{path}/{PENDING_MERGE}")
    _finish_merge(spark, path, day, schema)
    return [d.isoformat() for d in days]
