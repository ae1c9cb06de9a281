"""First-stage rejections: blocked card, amount cap, sanctioned country."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnsieve.config import HardRules
from txnsieve.operators.lookups import lookup_join

# Reasons in order of precedence.
BLOCKLIST_HIT = "BLOCKLIST_HIT"
AMOUNT_EXCEEDS_CAP = "AMOUNT_EXCEEDS_CAP"
SANCTIONED_COUNTRY = "SANCTIONED_COUNTRY"

REASON = "hard_reason"


def with_hard_reason(
    rows: DataFrame, rules: HardRules = HardRules(), blocked_cards: DataFrame | None = None
) -> DataFrame:
    """Add ``hard_reason``: the first rule hit, null for survivors.

    ``blocked_cards`` (column ``card_fingerprint``) replaces the configured list when given.
    """
    if blocked_cards is None:
        flagged = rows.withColumn("_blocked", F.col("card_fingerprint").isin(*rules.blocked_cards))
    else:
        listed = blocked_cards.select("card_fingerprint").distinct().withColumn("_blocked", F.lit(True))
        flagged = lookup_join(rows, listed, ["card_fingerprint"], spread_by=["transaction_id"])
    amount = F.col("amount")
    # NaN sorts above every number here, but must pass the cap.
    over_cap = (amount > rules.amount_cap) & ~F.isnan(amount.cast("double"))
    sanctioned = reduce(
        lambda a, b: a | b, [F.col(c).isin(*rules.sanctioned_countries) for c in rules.sanction_columns]
    )
    reason = (
        F.when(F.col("_blocked"), F.lit(BLOCKLIST_HIT))
        .when(over_cap, F.lit(AMOUNT_EXCEEDS_CAP))
        .when(sanctioned, F.lit(SANCTIONED_COUNTRY))
    )
    return flagged.withColumn(REASON, reason).drop("_blocked")


def survivors(rows: DataFrame) -> DataFrame:
    """Rows without a hit. Hits never reach the velocity windows, so they do not count there."""
    return rows.where(F.col(REASON).isNull()).drop(REASON)


def hits(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(REASON).isNotNull())
