"""Reputation of the IP address by longest matching prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnsieve.operators.prefixes import prefix_intervals, with_longest_prefix

# Result of an address without an entry, and of a failed lookup.
CLEAN = "CLEAN"
DEFAULT_SOURCE = "simulated"
FALLBACK_SOURCE = "fallback"


def with_reputation(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Add ``reputation``, ``enrichment_score`` and ``enrichment_source``.

    ``table`` holds ``prefix, reputation, score, source, unavailable``. The longest prefix of the address
    counts, by one range join; an unavailable entry takes the harmless fallback.
    """
    entry_of = F.struct("unavailable", "reputation", "score", "source")
    result = with_longest_prefix(rows, prefix_intervals(table, entry_of), "ip_address", "_entry", ("transaction_id",))
    entry = F.col("_entry")
    failed = F.coalesce(entry["unavailable"], F.lit(False))
    return result.withColumns(
        {
            "reputation": F.when(failed, F.lit(CLEAN)).otherwise(
                F.coalesce(entry["reputation"], F.lit(CLEAN))
            ),
            "enrichment_score": F.when(failed, F.lit(0)).otherwise(
                F.coalesce(entry["score"], F.lit(0))
            ).cast("long"),
            "enrichment_source": F.when(failed, F.lit(FALLBACK_SOURCE)).otherwise(
                F.coalesce(entry["source"], F.lit(DEFAULT_SOURCE))
            ),
        }
    ).drop("_entry")
