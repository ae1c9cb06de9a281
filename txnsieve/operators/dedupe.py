"""Idempotent claims, failure dedupe and the duplicate audit."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnsieve.config import DAY_MS, MAX_BROADCAST_ROWS
from txnsieve.operators.lookups import lookup_join, shuffled
from txnsieve.operators.parsing import UNKNOWN_ID
from txnsieve.operators.ranking import first_per_key
from txnsieve.session import staged

ID = "transaction_id"
MS = "event_ms"


#: Ids of at most so many uses are folded in one row; the others take one round per claim.
FOLD_TIMES = 100_000


def _unclaimed(rows: DataFrame, claims: DataFrame, ttl_ms: int) -> DataFrame:
    last = claims.groupBy(ID).agg(F.max(MS).alias("_claimed"))
    joined = lookup_join(rows, last, [ID], "left", spread_by=[MS])
    return joined.where(F.col("_claimed").isNull() | (F.col(MS) >= F.col("_claimed") + ttl_ms)).drop("_claimed")


def _folded(times: DataFrame, ttl_ms: int) -> DataFrame:
    """Claims after the first one, by one pass over the sorted times of each id."""
    none = F.array().cast("array<bigint>")
    sorted_times = F.array_sort(F.collect_set(MS))

    def step(state: Column, ms: Column) -> Column:
        wins = ms >= state["last"] + ttl_ms
        return F.struct(
            F.when(wins, ms).otherwise(state["last"]).alias("last"),
            F.when(wins, F.concat(state["claims"], F.array(ms))).otherwise(state["claims"]).alias("claims"),
        )

    found = times.groupBy(ID).agg(sorted_times.alias("_times")).select(
        ID, F.aggregate("_times", F.struct(F.col("_times")[0].alias("last"), none.alias("claims")), step, lambda s: s["claims"]).alias("_claims")
    )
    return found.select(ID, F.explode("_claims").alias(MS))


def _by_rounds(uses: DataFrame, ttl_ms: int, folder: str | None) -> list[DataFrame]:
    """Claims after the first one of ids with very many times, one DataFrame per round.

    Each round finds the next claim of every such id with a minimum per id, so a hot id is reduced
    before each shuffle, and the rounds are bounded by the time span over the lifetime. What a round finds is stored,
    else one task would run the aggregates of all rounds at once.
    """
    expires = F.col("_claimed") + ttl_ms

    def spans(candidates: DataFrame) -> DataFrame:
        return candidates.groupBy(ID).agg(F.min(MS).alias("_claimed"), F.max(MS).alias("_last"))

    open_ids = staged(spans(uses).where(F.col("_last") >= expires).select(ID, "_claimed"), "claims", folder)
    candidates, rounds = uses, []
    while waiting := open_ids.count():
        fits = waiting <= MAX_BROADCAST_ROWS
        after = lookup_join(candidates, open_ids, [ID], "inner", spread_by=[MS], fits=fits)
        candidates = staged(after.where(F.col(MS) >= expires).select(ID, MS).distinct(), "claims", folder)
        found = staged(spans(candidates), "claims", folder)
        rounds.append(found.select(ID, F.col("_claimed").alias(MS)))
        open_ids = found.where(F.col("_last") >= expires).select(ID, "_claimed")
    return rounds


def _later_claims(uses: DataFrame, ttl_ms: int, folder: str | None) -> list[DataFrame]:
    """Claims after the first one. Only ids whose uses span the lifetime take part.

    One stored aggregate finds them and says whether they fit a broadcast and a fold. The number of jobs does
    not depend on the time span, but for ids of more than ``FOLD_TIMES`` distinct times. Those are counted where an id
    has more uses than that, as its uses may share few times.
    """
    ends = uses.groupBy(ID).agg(F.min(MS).alias("first"), F.max(MS).alias("last"), F.count("*").alias("uses"))
    spanning = staged(ends.where(F.col("last") - F.col("first") >= ttl_ms).select(ID, "uses"), "claims", folder)
    found = spanning.agg(F.count("*").alias("ids"), F.count_if(F.col("uses") > FOLD_TIMES).alias("many")).first()
    if not found["ids"]:
        return []
    fits = found["ids"] <= MAX_BROADCAST_ROWS
    times = lookup_join(uses, spanning, [ID], "inner", spread_by=[MS], fits=fits)
    few = times.where(F.col("uses") <= FOLD_TIMES).select(ID, MS).distinct()
    if not found["many"]:
        return [_folded(few, ttl_ms)]
    busy = staged(times.where(F.col("uses") > FOLD_TIMES).select(ID, MS).distinct(), "claims", folder)
    counted = staged(busy.groupBy(ID).agg(F.count("*").alias("_times")), "claims", folder)
    over = counted.where(F.col("_times") > FOLD_TIMES).select(ID)
    ids = over.count()
    if not ids:
        return [_folded(few.unionByName(busy), ttl_ms)]
    fits = ids <= MAX_BROADCAST_ROWS
    folded = _folded(few.unionByName(lookup_join(busy, over, [ID], "left_anti", fits=fits)), ttl_ms)
    many = lookup_join(busy, over, [ID], "left_semi", fits=fits)
    return [folded, *_by_rounds(many, ttl_ms, folder)]


def claim_first(
    rows: DataFrame,
    ttl_ms: int = DAY_MS,
    order: Sequence[str] = ("seq",),
    claims: DataFrame | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Keep the rows that win the claim of their transaction id.

    A claim lasts ``ttl_ms`` from the winning row; rows within it are duplicates, and the first row
    after it wins again. ``order`` breaks ties of equal time. ``claims`` (``transaction_id``,
    ``event_ms``) are claims won earlier, which still hold. ``folder`` takes intermediate tables.
    """
    if claims is not None:
        rows = _unclaimed(rows, claims, ttl_ms)
    winners = first_per_key(rows, [ID], [MS, *order])
    later = _later_claims(rows.select(ID, MS), ttl_ms, folder)
    if not later:
        return winners
    again = rows.join(shuffled(reduce(DataFrame.unionByName, later)), [ID, MS], "left_semi")
    return winners.unionByName(first_per_key(again, [ID, MS], list(order)))


def claim_replays(rows: DataFrame, order: Sequence[str] = (MS, "seq")) -> DataFrame:
    """Retried rows (``attempt`` above 0) pass the claim of their id, each attempt once."""
    return first_per_key(rows.where(F.col("attempt") > 0), [ID, "attempt"], list(order))


def failure_key(payload: str = "original_payload") -> Column:
    """Key that tells unparsed messages apart; the plain id keeps only the first of them."""
    return F.when(F.col(ID) == UNKNOWN_ID, F.sha2(F.col(payload), 256)).otherwise(F.col(ID))


def new_failures(
    failures: DataFrame,
    recorded: DataFrame | None = None,
    key: Column | None = None,
    order: Sequence[str] = (MS, "seq"),
) -> DataFrame:
    """The first failure per key that is not recorded yet. ``key`` defaults to the transaction id."""
    key = F.col(ID) if key is None else key
    first = first_per_key(failures.withColumn("_key", key), ["_key"], list(order))
    if recorded is not None:
        first = first.join(shuffled(recorded.select(key.alias("_key"))), "_key", "left_anti")
    return first.drop("_key")


def duplicate_audit(decisions: DataFrame) -> DataFrame:
    """Transactions with more than one decision row."""
    return decisions.groupBy(ID).agg(F.count("*").alias("decision_count")).where("decision_count > 1")
