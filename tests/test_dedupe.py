from __future__ import annotations

import random

import pytest
from checks import plan_text

from txnsieve.config import DAY_MS
from txnsieve.operators import lookups
from txnsieve.session import staged
from txnsieve.operators.dedupe import _by_rounds, claim_first, duplicate_audit, failure_key, new_failures

COLUMNS = "transaction_id string, event_ms long, seq long"


def frame(spark, rows):
    return spark.createDataFrame([(t, ms, i) for i, (t, ms) in enumerate(rows)], COLUMNS)


def claimed(df):
    return sorted((r.transaction_id, r.event_ms, r.seq) for r in df.collect())


def fold(rows, ttl=DAY_MS, held=()):
    last, kept = dict(held), []
    for seq, (t, ms) in sorted(enumerate(rows), key=lambda r: (r[1][1], r[0])):
        if t not in last or ms >= last[t] + ttl:
            last[t] = ms
            kept.append((t, ms, seq))
    return sorted(kept)


def test_claim_runs_from_the_winning_row(spark):
    times = [0, 1000, DAY_MS, DAY_MS + 1, 2 * DAY_MS + 1]
    rows = [("t", ms) for ms in times]
    assert [ms for _, ms, _ in claimed(claim_first(frame(spark, rows)))] == [0, DAY_MS, 2 * DAY_MS + 1]


def test_first_of_equal_times_wins(spark):
    rows = [("t", 5), ("t", 5), ("u", 7)]
    assert claimed(claim_first(frame(spark, rows))) == [("t", 5, 0), ("u", 7, 2)]


@pytest.mark.parametrize("max_rows", [100_000, 0])
def test_matches_a_fold_with_a_hot_id(spark, monkeypatch, max_rows):
    monkeypatch.setattr("txnsieve.operators.dedupe.MAX_BROADCAST_ROWS", max_rows)
    rng = random.Random(5)
    ids = ["hot"] * 5 + [f"t{i}" for i in range(10)]
    rows = [(rng.choice(ids), rng.randrange(0, 5 * DAY_MS, DAY_MS // 7)) for _ in range(300)]
    assert claimed(claim_first(frame(spark, rows))) == fold(rows)


@pytest.mark.parametrize("fold_times", [100_000, 20])
def test_many_claims_per_id(spark, monkeypatch, fold_times):
    """Folded in one row, or round by round for ids of many times; the jobs do not follow the days."""
    monkeypatch.setattr("txnsieve.operators.dedupe.FOLD_TIMES", fold_times)
    jobs = []
    for days in (5, 30):
        rng = random.Random(days)
        rows = [(rng.choice(["a", "b", "c", "d"]), rng.randrange(0, days * DAY_MS)) for _ in range(days * 8)]
        rows += [("e", DAY_MS * i // 3) for i in range(15)]
        written = []
        monkeypatch.setattr("txnsieve.operators.dedupe.staged", lambda df, *a, **k: written.append(1) or staged(df, *a, **k))
        assert claimed(claim_first(frame(spark, rows))) == fold(rows)
        jobs.append(len(written))
    assert fold_times < 1000 or jobs[0] == jobs[1]


def test_repeated_times_are_folded_and_rounds_are_stored(spark, monkeypatch):
    """An id of many uses at few times is folded; what the rounds of another find is read, not computed again."""
    monkeypatch.setattr("txnsieve.operators.dedupe.FOLD_TIMES", 20)
    few = [("few", DAY_MS * (i % 8) // 2) for i in range(100)]
    folded = claim_first(frame(spark, few))
    assert claimed(folded) == fold(few)
    rounds = []
    monkeypatch.setattr("txnsieve.operators.dedupe._by_rounds", lambda *a: rounds.append(1) or _by_rounds(*a))
    claim_first(frame(spark, few))
    assert not rounds
    plans = []
    for days in (10, 20):
        many = few + [("many", DAY_MS * i // 4) for i in range(4 * days)]
        taken = claim_first(frame(spark, many))
        assert claimed(taken) == fold(many)
        plans.append(plan_text(taken).count("HashAggregate"))
    assert len(rounds) == 2 and plans[0] == plans[1]


def test_earlier_claims_still_hold(spark):
    held = {"a": 0, "b": -2 * DAY_MS}
    rows = [("a", DAY_MS - 1), ("a", DAY_MS + 5), ("b", 3), ("c", 4)]
    claims = spark.createDataFrame(list(held.items()), "transaction_id string, event_ms long")
    assert claimed(claim_first(frame(spark, rows), claims=claims)) == fold(rows, held=held)


def test_hot_id_is_cut_before_the_shuffle(spark):
    plan = plan_text(claim_first(frame(spark, [("t", 1), ("t", 2)])))
    before_exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[before_exchange:]


def failures(spark, rows):
    return spark.createDataFrame(
        [(t, p, i, i) for i, (t, p) in enumerate(rows)],
        "transaction_id string, original_payload string, event_ms long, seq long",
    )


def test_failures_are_kept_once_per_id(spark):
    rows = [("a", "1"), ("a", "2"), ("UNKNOWN", "x"), ("UNKNOWN", "y"), ("UNKNOWN", "x"), ("b", "3")]
    recorded = spark.createDataFrame([("b", "3")], "transaction_id string, original_payload string")
    plain = new_failures(failures(spark, rows), recorded)
    assert sorted(r.seq for r in plain.collect()) == [0, 2]
    by_payload = new_failures(failures(spark, rows), recorded, failure_key())
    assert sorted(r.seq for r in by_payload.collect()) == [0, 2, 3]


def test_duplicate_audit(spark):
    found = duplicate_audit(frame(spark, [("a", 1), ("b", 1), ("a", 2)])).collect()
    assert [(r.transaction_id, r.decision_count) for r in found] == [("a", 2)]


def test_lookup_join_gives_the_same_with_and_without_broadcast(spark):
    rows = frame(spark, [("a", 1), ("a", 2), ("b", 1), ("c", 9)])
    table = spark.createDataFrame([("a", "x"), ("b", "y")], "transaction_id string, v string")
    for how in ("left", "inner", "left_semi", "left_anti"):
        small = lookups.lookup_join(rows, table, ["transaction_id"], how, ["seq"])
        big = lookups.lookup_join(rows, table, ["transaction_id"], how, ["seq"], max_rows=1)
        assert sorted(map(str, small.collect())) == sorted(map(str, big.collect()))
        assert "Broadcast" in plan_text(small)
