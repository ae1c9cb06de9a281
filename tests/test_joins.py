"""Sides that grow with the input are never broadcast, however small Catalyst takes them to be."""

from __future__ import annotations

from checks import plan_text

from txnsieve.operators import analyst, dedupe
from txnsieve.operators.decisions import apply_overrides, current_transactions, override_outcomes
from txnsieve.operators.dedupe import claim_first
from txnsieve.operators.lookups import lookup_join
from txnsieve.operators.velocity import with_velocity
from txnsieve.session import staged


def test_claims_beyond_the_broadcast_limit_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "MAX_BROADCAST_ROWS", 0)
    rows = spark.createDataFrame([("a", 0, 1), ("a", 90_000_000, 2), ("a", 90_000_001, 3)], "transaction_id string, event_ms long, seq long")
    claimed = claim_first(staged(rows, "rows"))
    assert "Broadcast" not in plan_text(claimed)
    assert sorted(r.seq for r in claimed.collect()) == [1, 2]


def test_a_table_beyond_the_limit_is_shuffled(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    table = staged(spark.createDataFrame([("a", 7)], "k string, w long"), "table")
    for spread_by in ((), ("v",)):
        joined = lookup_join(rows, table, ["k"], spread_by=spread_by, fits=False)
        assert "Broadcast" not in plan_text(joined)
        assert sorted(joined.select("k", "w").collect()) == [("a", 7), ("b", None)]


def test_signals_are_joined_without_broadcast(spark):
    schema = "transaction_id string, event_ms long, card_fingerprint string, device_fingerprint string, ip_address string"
    rows = staged(spark.createDataFrame([("t", 0, "c", "d", "1.2.3.4"), ("u", 1, "c", "d", "1.2.3.4")], schema), "rows")
    counted = with_velocity(rows)
    assert "Broadcast" not in plan_text(counted)
    assert sorted(counted.select("transaction_id", "card_1m", "device_cards_24h").collect()) == [("t", 1, 1), ("u", 2, 1)]


def test_decisions_meet_overrides_and_transactions_without_broadcast(spark):
    taken = staged(spark.sql("select 't' as transaction_id, 'NEEDS_REVIEW' as decision, timestamp_ntz'2024-01-01 00:00:00' as decided_at"), "taken")
    request = "select 't' as transaction_id, 'APPROVED' as new_decision, 'r' as reason, 'a' as analyst_id, 1L as override_id"
    requests = staged(spark.sql(f"{request}, timestamp_ntz'2024-01-02 00:00:00' as requested_at"), "requests")
    outcomes = override_outcomes(requests, taken)
    applied = apply_overrides(taken, outcomes)
    current = current_transactions(staged(spark.sql("select 't' as transaction_id, 'x' as status"), "transactions"), taken)
    for df in (outcomes, applied, current):
        assert "Broadcast" not in plan_text(df)
    assert applied.first().decision == "APPROVED" and current.first().status == "NEEDS_REVIEW"


def test_review_joins_the_newest_rows_first(spark, monkeypatch):
    """Of 300 waiting decisions only some have a transaction; few rows are joined where they are enough."""
    joined = []

    def counted(rows, table, *given, **named):
        joined.append(table.count())
        return lookup_join(rows, table, *given, **named)

    monkeypatch.setattr(analyst, "lookup_join", counted)
    taken = spark.range(300).selectExpr(
        "concat('t', id) as transaction_id", "'NEEDS_REVIEW' as decision", "id as risk_score", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id as int)) as decided_at"
    )
    stored = spark.range(300).selectExpr(
        "concat('t', id) as transaction_id", "id as amount", "'USD' as currency", "'m' as merchant_id", "'US' as ip_country", "'US' as billing_country"
    )
    for kept, sizes in (("amount >= 0", [10]), ("amount < 100", [10, 300]), ("amount < 3", [10, 300])):
        joined.clear()
        found = analyst.pending_review(taken, stored.where(kept), limit=5, first=10).collect()
        ids = [r.amount for r in stored.where(kept).orderBy("amount", ascending=False).limit(5).collect()]
        assert [r.risk_score for r in found] == ids and joined == sizes
