from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from checks import plan_text
from pyspark.sql import functions as F

from txnsieve.config import HardRules
from txnsieve.functions.scores import decide
from txnsieve.functions.search import count_at_most
from txnsieve.operators import analyst, prefixes
from txnsieve.operators.decisions import (
    apply_overrides, current_transactions, latest_decisions, merge_overrides, override_outcomes, stored_schema,
)
from txnsieve.operators.enrichment import with_reputation
from txnsieve.operators.hard_rules import survivors, with_hard_reason
from txnsieve.plans import fixtures, queries
from txnsieve.plans.queries import QUERIES
from txnsieve.schemas import REPUTATION

T0 = datetime(2024, 1, 1)


@pytest.mark.parametrize(
    ("score", "decision"),
    [
        (0, "APPROVED"), (10, "APPROVED"), (19, "APPROVED"), (20, "NEEDS_REVIEW"), (35, "NEEDS_REVIEW"),
        (59, "NEEDS_REVIEW"), (60, "AUTO_REJECTED"), (75, "AUTO_REJECTED"), (100, "AUTO_REJECTED"),
        (200, "AUTO_REJECTED"),
    ],
)
def test_thresholds(spark, score, decision):
    assert spark.range(1).select(decide(F.lit(score))).first()[0] == decision


def hard(spark, rows, **kwargs):
    df = spark.createDataFrame(
        [(str(i), *r) for i, r in enumerate(rows)],
        "transaction_id string, card_fingerprint string, amount double, ip_country string, billing_country string",
    )
    return with_hard_reason(df, **kwargs)


def test_hard_rules_in_order(spark):
    rows = [
        ("fpr_BLOCKED_001", 15000.0, "RU", "US"), ("fpr_blocked_001", 50.0, "US", "US"),
        ("c", 15000.0, "RU", "US"), ("c", 10000.0, "US", "US"), ("c", float("nan"), "US", "US"),
        ("c", 75.0, "RU", "US"), ("c", 75.0, "ru", "RU"),
    ]
    flagged = hard(spark, rows)
    found = [r.hard_reason for r in flagged.orderBy("transaction_id").collect()]
    assert found == ["BLOCKLIST_HIT", None, "AMOUNT_EXCEEDS_CAP", None, None, "SANCTIONED_COUNTRY", None]
    assert survivors(flagged).count() == 4


def test_hard_rules_with_billing_country_and_card_table(spark):
    rows = [("c", 1.0, "US", "IR"), ("x", 1.0, "US", "US"), ("y", 1.0, "US", "US")]
    rules = HardRules(sanction_columns=("ip_country", "billing_country"))
    cards = spark.createDataFrame([("x",), ("x",)], "card_fingerprint string")
    found = [r.hard_reason for r in hard(spark, rows, rules=rules, blocked_cards=cards).orderBy("transaction_id").collect()]
    assert found == ["SANCTIONED_COUNTRY", "BLOCKLIST_HIT", None]


def test_reputation_by_longest_prefix(spark):
    table = spark.createDataFrame(
        [*fixtures.REPUTATION_ROWS, ("10.9.", "CLEAN", 0, "partner", False)], REPUTATION
    )
    ips = ["10.0.0.1", "10.9.0.1", "172.16.0.1", "fail.1", "slow.1", "8.8.8.8", "1", "", None]
    df = spark.createDataFrame([(str(i), ip) for i, ip in enumerate(ips)], "transaction_id string, ip_address string")
    found = with_reputation(df, table).orderBy("transaction_id").collect()
    assert [(r.reputation, r.enrichment_score, r.enrichment_source) for r in found] == [
        ("MALICIOUS", 40, "simulated"), ("CLEAN", 0, "partner"), ("SUSPICIOUS", 20, "simulated"),
        ("CLEAN", 0, "fallback"), ("CLEAN", 0, "fallback"), *[("CLEAN", 0, "simulated")] * 4,
    ]
    assert with_reputation(df, table.limit(0)).where("enrichment_score = 0").count() == len(ips)


def decisions(spark, rows):
    return spark.createDataFrame(
        [(t, d, T0 + timedelta(hours=h), 10) for t, d, h in rows],
        "transaction_id string, decision string, decided_at timestamp, risk_score long",
    )


def overrides(spark, rows):
    return spark.createDataFrame(
        [(i, t, d, f"r{i}", "ann", T0 + timedelta(hours=h)) for i, (t, d, h) in enumerate(rows)],
        "override_id long, transaction_id string, new_decision string, reason string, analyst_id string, "
        "requested_at timestamp",
    )


def test_latest_decision_and_current_status(spark):
    taken = decisions(spark, [("a", "APPROVED", 1), ("a", "NEEDS_REVIEW", 2), ("b", "APPROVED", 1)])
    assert {r.transaction_id: r.decision for r in latest_decisions(taken).collect()} == {
        "a": "NEEDS_REVIEW", "b": "APPROVED",
    }
    transactions = spark.createDataFrame([("a", "PENDING"), ("c", "PENDING")], "transaction_id string, status string")
    current = current_transactions(transactions, taken).collect()
    assert {r.transaction_id: r.status for r in current} == {"a": "NEEDS_REVIEW", "c": "PENDING"}


def test_override_outcomes_follow_each_other(spark):
    taken = decisions(spark, [("a", "AUTO_REJECTED", 1), ("a", "NEEDS_REVIEW", 2), ("b", "APPROVED", 1)])
    asked = overrides(
        spark,
        [
            ("a", "APPROVED", 3), ("a", "APPROVED", 4), ("a", "MAYBE", 5), ("a", "AUTO_REJECTED", 30),
            ("a", "AUTO_REJECTED", 31), ("a", "APPROVED", 31), ("b", "APPROVED", 3), ("ghost", "APPROVED", 3),
        ],
    )
    outcomes = override_outcomes(asked, taken)
    found = [(r.outcome, r.previous_decision) for r in outcomes.orderBy("override_id").collect()]
    assert found == [
        ("APPLIED", "NEEDS_REVIEW"), ("NOOP", "APPROVED"), ("INVALID", None), ("APPLIED", "APPROVED"),
        ("APPLIED", "AUTO_REJECTED"), ("APPLIED", "AUTO_REJECTED"), ("NOOP", "APPROVED"), ("NOT_FOUND", None),
    ]
    applied = apply_overrides(taken, outcomes).collect()
    assert {(r.transaction_id, r.decision, r.override_reason) for r in applied} == {
        ("a", "APPROVED", "r5"), ("b", "APPROVED", None),
    }
    assert len(applied) == 3


def test_pending_review_is_newest_first(spark):
    taken = decisions(spark, [(f"t{i}", "NEEDS_REVIEW", i) for i in range(5)] + [("x", "APPROVED", 9)])
    stored = taken.select(
        "transaction_id", F.lit(5).alias("amount"), F.lit("USD").alias("currency"), F.lit("m").alias("merchant_id"),
        F.lit("US").alias("ip_country"), F.lit("US").alias("billing_country"),
    ).where("transaction_id <> 't3'")
    listed = analyst.pending_review(taken, stored, limit=2)
    assert [r.transaction_id for r in listed.collect()] == ["t4", "t2"]
    text = analyst.render_review(listed).orderBy("position").first().text
    assert text.startswith("1. Transaction: t4\n   Score: 10 | Amount: 5 USD\n")


# Counts of the queries' SQL over the sample rules of the fixtures.
EXPECTED = {
    "decisions_true_windows": {
        ("APPROVED", "RULE_ENGINE"): (36, 60), ("NEEDS_REVIEW", "RULE_ENGINE"): (313, 8755),
        ("AUTO_REJECTED", "RULE_ENGINE"): (301, 33385), ("AUTO_REJECTED", "BLOCKLIST_HIT"): (206, 20600),
        ("AUTO_REJECTED", "AMOUNT_EXCEEDS_CAP"): (23, 2300), ("AUTO_REJECTED", "SANCTIONED_COUNTRY"): (121, 12100),
    },
    "decisions_scaled_windows": {
        ("APPROVED", "RULE_ENGINE"): (12, 40), ("NEEDS_REVIEW", "RULE_ENGINE"): (284, 10345),
        ("AUTO_REJECTED", "RULE_ENGINE"): (354, 41275), ("AUTO_REJECTED", "BLOCKLIST_HIT"): (206, 20600),
        ("AUTO_REJECTED", "AMOUNT_EXCEEDS_CAP"): (23, 2300), ("AUTO_REJECTED", "SANCTIONED_COUNTRY"): (121, 12100),
    },
}


@pytest.mark.parametrize("name", list(EXPECTED))
def test_decision_counts(spark, sf_dir, name):
    found = QUERIES[name](spark, sf_dir).groupBy("decision", "decision_reason").agg(
        F.count("*").alias("n"), F.sum("risk_score").alias("s")
    )
    assert {(r.decision, r.decision_reason): (r.n, r.s) for r in found.collect()} == EXPECTED[name]


def longest_prefix(text, prefixes):
    found = [p for p in prefixes if text is not None and text.startswith(p)]
    return max(found, key=len, default=None)


@pytest.mark.parametrize("held", [10_000, 0])
@pytest.mark.parametrize("width", [16, 2])
def test_prefix_intervals_equal_a_search(spark, monkeypatch, held, width):
    """On the driver and on Spark, with one bin and with many."""
    monkeypatch.setattr(prefixes, "DRIVER_PREFIXES", held)
    monkeypatch.setattr(prefixes, "BIN", width)
    rng = random.Random(width)
    signs = ["a", "b", "1", "é", "\ud7ff", "\U0010ffff"]
    known = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 4))) for _ in range(40)] + ["\U0010ffff", "b\U0010ffff"]
    known += [""] if width == 2 else []
    table = spark.createDataFrame([(p, f"entry {p}") for p in known] + [("a", "other"), (None, "none")], "prefix string, name string")
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 6))) for _ in range(300)] + [None, "", *known]
    rows = spark.createDataFrame(list(enumerate(texts)), "transaction_id long, text string")
    found = prefixes.with_longest_prefix(rows, prefixes.prefix_intervals(table, F.col("name")), "text", "entry")
    plan = plan_text(found)
    assert plan.count("Join") == 1 and "NestedLoop" not in plan and "Cartesian" not in plan
    for r in found.collect():
        longest = longest_prefix(r.text, known)
        assert r.entry == (None if longest is None else f"entry {longest}"), r.text
    assert found.columns == ["transaction_id", "text", "entry"] and found.count() == len(texts)


def test_one_join_whatever_the_prefix_lengths(spark):
    lengths = spark.createDataFrame(
        [("1" * n, "MALICIOUS", n, "s", False) for n in range(1, 30)],
        "prefix string, reputation string, score long, source string, unavailable boolean",
    )
    rows = spark.createDataFrame([("t", "1" * 25 + "2")], "transaction_id string, ip_address string")
    scored = with_reputation(rows, lengths)
    assert plan_text(scored).count("BroadcastHashJoin") == 1 and scored.first().enrichment_score == 25


@pytest.mark.parametrize("bounds", [[], [5], [1, 3, 3, 8], list(range(0, 2000, 7))])
def test_count_at_most(spark, bounds):
    values = [-1, 0, 1, 3, 4, 5, 8, 9, 700, 1998, 5000]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    found = [r[0] for r in df.select(count_at_most(bounds, F.col("v"))).collect()]
    assert found == [sum(b <= v for b in bounds) for v in values] + [0]


def stored_by_day(spark, folder, days=4, rows=25):
    taken = spark.range(days * rows).select(
        F.concat(F.lit("t"), "id").alias("transaction_id"),
        F.when(F.col("id") % 5 < 4, "NEEDS_REVIEW").otherwise("APPROVED").alias("decision"),
        (F.col("id") % 60).alias("risk_score"),
        F.lit("RULE_ENGINE").alias("decision_reason"),
        F.lit("STAGE_4").alias("processing_stage"),
        (F.lit(T0) + F.make_dt_interval(F.floor(F.col("id") / rows).cast("int"), F.lit(0), F.lit(0), F.col("id") % rows)).cast("timestamp_ntz").alias("decided_at"),
    )
    taken.withColumn("decided_on", F.to_date("decided_at")).write.partitionBy("decided_on").parquet(folder)
    return spark.read.parquet(folder)


def details_of(taken, where="true"):
    return taken.where(where).select(
        "transaction_id", F.lit(10).alias("amount"), F.lit("USD").alias("currency"), F.lit("m").alias("merchant_id"),
        F.lit("US").alias("ip_country"), F.lit("CA").alias("billing_country"),
    )


def test_newest_rows_read_only_the_days_they_need(spark, tmp_path):
    """The older days cannot even be read."""
    taken = stored_by_day(spark, f"{tmp_path}/t")
    transactions = spark.createDataFrame(details_of(taken).collect(), details_of(taken).schema)
    days = analyst.days_of(spark, f"{tmp_path}/t")
    assert days == ["2024-01-04", "2024-01-03", "2024-01-02", "2024-01-01"]
    want = analyst.pending_review(taken, transactions, 20).collect()
    for day in days[1:]:
        for file in (tmp_path / "t" / f"decided_on={day}").glob("*.parquet"):
            file.write_bytes(b"not a table")
    assert analyst.pending_review(taken, transactions, 20, days=days).collect() == want and len(want) == 20
    assert [r.transaction_id for r in analyst.audit_tail(taken, 25, days=days).collect()][:2] == ["t99", "t98"]


def test_newest_rows_go_back_until_there_are_enough(spark, tmp_path):
    taken = stored_by_day(spark, f"{tmp_path}/t")
    days = analyst.days_of(spark, f"{tmp_path}/t")
    few = spark.createDataFrame(details_of(taken, "transaction_id IN ('t3', 't30', 't31', 't90')").collect(), details_of(taken).schema)
    for limit in (1, 2, 20):
        found = [r.transaction_id for r in analyst.pending_review(taken, few, limit, days=days).collect()]
        assert found == ["t90", "t31", "t30", "t3"][:limit]
    assert analyst.pending_review(taken, few.limit(0), 5, days=days).count() == 0
    assert analyst.pending_review(taken.limit(0), few, 5, days=[]).count() == 0


def test_many_newest_decisions_without_a_transaction(spark, tmp_path, monkeypatch):
    """A hundred thousand of them; the number of jobs does not follow them."""
    new = spark.range(100_000).select(
        F.concat(F.lit("gone"), "id").alias("transaction_id"), F.lit("NEEDS_REVIEW").alias("decision"), F.lit(5).cast("long").alias("risk_score"),
        F.lit("r").alias("decision_reason"), F.lit("s").alias("processing_stage"),
        F.lit(T0 + timedelta(days=30)).cast("timestamp_ntz").alias("decided_at"),
    )
    stored_by_day(spark, f"{tmp_path}/t")
    new.withColumn("decided_on", F.to_date("decided_at")).write.mode("append").partitionBy("decided_on").parquet(f"{tmp_path}/t")
    taken = spark.read.parquet(f"{tmp_path}/t")
    transactions = spark.createDataFrame(details_of(taken, "transaction_id LIKE 't%'").collect(), details_of(taken).schema)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("newest", "newest")
    found = analyst.pending_review(taken, transactions, 20, days=analyst.days_of(spark, f"{tmp_path}/t")).collect()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [r.transaction_id for r in found][:2] == ["t98", "t97"] and len(found) == 20
    assert len(tracker.getJobIdsForGroup("newest")) <= 40


def override_schema(spark, table):
    return stored_schema(spark.read.parquet(f"{table}/decided_on=2024-01-01").schema, "decided_on")


def test_override_merge_rewrites_touched_days_only(spark, tmp_path):
    table = f"{tmp_path}/t"
    stored_by_day(spark, table)
    asked = spark.createDataFrame(
        [(1, "t30", "APPROVED", "fine", "ann", T0), (2, "t31", "MAYBE", "?", "ann", T0), (3, "ghost", "APPROVED", "x", "bob", T0)],
        "override_id long, transaction_id string, new_decision string, reason string, analyst_id string, requested_at timestamp_ntz",
    )

    def files():
        return {str(f.relative_to(tmp_path)) for f in (tmp_path / "t").rglob("*.parquet")}

    before = files()
    outcomes = override_outcomes(asked, spark.read.parquet(table))
    assert merge_overrides(spark, table, outcomes) == ["2024-01-02"]
    kept = {f for f in before if "2024-01-02" not in f}
    assert kept <= files() and not any("2024-01-02" in f for f in before & files())
    merged = {r.transaction_id: r for r in spark.read.schema(override_schema(spark, table)).parquet(table).collect()}
    assert len(merged) == 100
    assert (merged["t30"].decision, merged["t30"].override_by, merged["t30"].override_reason) == ("APPROVED", "ann", "fine")
    assert merged["t31"].decision == "NEEDS_REVIEW" and merged["t31"].override_by is None
    again = asked.limit(1).withColumns({"new_decision": F.lit("AUTO_REJECTED"), "analyst_id": F.lit("cy"), "transaction_id": F.lit("t32")})
    assert merge_overrides(spark, table, override_outcomes(again, spark.read.parquet(table))) == ["2024-01-02"]
    merged = {r.transaction_id: r for r in spark.read.schema(override_schema(spark, table)).parquet(table).collect()}
    assert merged["t30"].override_by == "ann" and merged["t32"].override_by == "cy" and len(merged) == 100
    assert merge_overrides(spark, table, override_outcomes(again.where("false"), spark.read.parquet(table))) == []


def test_a_merge_that_was_cut_off_is_finished_by_the_next(spark, tmp_path):
    table = f"{tmp_path}/t"
    taken = stored_by_day(spark, table)
    day = taken.where("decided_on = DATE'2024-01-02'").withColumns(
        {"decision": F.lit("APPROVED"), "override_reason": F.lit("r"), "override_by": F.lit("a"), "overridden_at": F.lit(T0).cast("timestamp_ntz")}
    )
    day.write.partitionBy("decided_on").parquet(f"{table}/_pending_merge")
    for file in (tmp_path / "t" / "decided_on=2024-01-02").glob("*"):
        file.unlink()  # the old partition is gone and the new one has not come
    none = spark.createDataFrame([], "transaction_id string, new_decision string, reason string, analyst_id string, requested_at timestamp_ntz, override_id long, outcome string")
    assert merge_overrides(spark, table, none) == []
    merged = spark.read.schema(override_schema(spark, table)).parquet(table)
    assert merged.count() == 100 and merged.where("override_by = 'a'").count() == 25
    assert not (tmp_path / "t" / "_pending_merge").exists()


def test_the_stored_table_has_one_file_a_day(spark, sf_dir):
    """Not one per task and day: the driver lists them, and each query on the table opens them."""
    files = queries._stored_payload_decisions(spark, sf_dir).inputFiles()
    assert len(files) == len({f.rsplit("/", 1)[0] for f in files}) > 20
