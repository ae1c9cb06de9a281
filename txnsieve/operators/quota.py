"""Fixed-window request quota per client."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnsieve.config import Quota
from txnsieve.functions.text import blank_to
from txnsieve.operators.ranking import rank_up_to


def quota_identifier(user: Column, address: Column) -> Column:
    """The user id if it is given, else the remote address."""
    return blank_to(user, address)


def admit(
    requests: DataFrame,
    quota: Quota = Quota(),
    identifier: str = "identifier",
    ms: str = "event_ms",
    order: Sequence[str] = ("seq",),
) -> DataFrame:
    """Add ``admitted`` and the response headers of each request.

    Requests count per identifier and time bucket, rejected ones too. Only the first ``limit`` of a
    bucket need a number, so a hot client is cut down before the shuffle.
    """
    epoch_s = F.floor(F.col(ms) / 1000)
    bucketed = requests.withColumn("bucket", F.floor(epoch_s / quota.window_s))
    ranked = rank_up_to(bucketed, [identifier, "bucket"], [ms, *order], quota.limit, "_number")
    admitted = F.col("_number").isNotNull()
    return (
        ranked.withColumn("admitted", admitted)
        .withColumn("rate_limit", F.lit(quota.limit).cast("long"))
        .withColumn(
            "remaining", F.greatest(F.lit(0), F.lit(quota.limit) - F.coalesce("_number", F.lit(quota.limit)))
        )
        .withColumn("retry_after", F.when(~admitted, quota.window_s - F.pmod(epoch_s, F.lit(quota.window_s))))
        .drop("_number")
    )


def quota_totals(requests: DataFrame, quota: Quota = Quota(), identifier: str = "identifier", ms: str = "event_ms") -> DataFrame:
    """Requests, admitted and rejected requests per identifier and bucket."""
    bucket = F.floor(F.floor(F.col(ms) / 1000) / quota.window_s)
    return (
        requests.groupBy(identifier, bucket.alias("bucket"))
        .agg(F.count("*").alias("requests"))
        .withColumn("admitted", F.least("requests", F.lit(quota.limit).cast("long")))
        .withColumn("rejected", F.col("requests") - F.col("admitted"))
    )
