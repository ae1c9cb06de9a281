"""Score and decision columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnsieve.config import APPROVED, AUTO_REJECTED, NEEDS_REVIEW, Cutoffs


def tier_score(count: Column, tiers: tuple[tuple[int, int], ...]) -> Column:
    """Score of the highest tier reached, 0 for none or for a null count."""
    score = F.lit(0)
    for at_least, points in sorted(tiers):
        score = F.when(count >= at_least, F.lit(points)).otherwise(score)
    return score.cast("long")


def decide(score: Column, cutoffs: Cutoffs = Cutoffs()) -> Column:
    return (
        F.when(score >= cutoffs.reject, F.lit(AUTO_REJECTED))
        .when(score >= cutoffs.review, F.lit(NEEDS_REVIEW))
        .otherwise(F.lit(APPROVED))
    )
