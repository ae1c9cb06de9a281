"""Requests to stored rows, stored rows to outbox records, and the relay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnsieve.config import PENDING, PUBLISHED
from txnsieve.functions.payload import serialize_payload
from txnsieve.operators.lookups import shuffled
from txnsieve.schemas import FIELD_COLUMNS, REQUEST


def transaction_id(key: Sequence[Column | str], hex_digits: int = 32) -> Column:
    """Repeatable id from a business key that tells requests apart.

    Eight digits, as on the wire today, collide after some ten thousand rows; the default does not.
    """
    parts = [F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in key]
    return F.concat(F.lit("txn_"), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, hex_digits))


def store_requests(requests: DataFrame, id_column: Column, created_at: Column | None = None) -> DataFrame:
    """Rows of the transactions table: renamed fields, whole amount, status pending."""
    fields = {f.name: FIELD_COLUMNS[f.name] for f in REQUEST.fields}
    return requests.select(
        id_column.alias("transaction_id"),
        *[
            (F.col(n).cast("long") if n == "amount" else F.col(n)).alias(c)
            for n, c in fields.items()
        ],
        F.lit(PENDING).alias("status"),
        (F.localtimestamp() if created_at is None else created_at).alias("created_at"),
    )


def outbox_records(transactions: DataFrame) -> DataFrame:
    """One pending outbox record per stored transaction."""
    return transactions.select(
        "transaction_id",
        serialize_payload().alias("payload"),
        F.lit(PENDING).alias("status"),
        "created_at",
    )


def unpublished(outbox: DataFrame, ledger: DataFrame) -> DataFrame:
    """Outbox records that the published ledger does not hold."""
    return outbox.join(shuffled(ledger.select("transaction_id")), "transaction_id", "left_anti")


def publish(pending: DataFrame, published_at: Column) -> DataFrame:
    return pending.withColumn("status", F.lit(PUBLISHED)).withColumn("published_at", published_at)


def topic_records(outbox: DataFrame) -> DataFrame:
    return outbox.select(F.col("transaction_id").alias("key"), F.col("payload").alias("value"))


def stuck(pending: DataFrame, as_of: Column, limit: str) -> DataFrame:
    """Records that have been pending for longer than ``limit``, such as ``5 minutes``."""
    return pending.where(F.col("created_at") < as_of - F.expr(f"interval {limit}"))
