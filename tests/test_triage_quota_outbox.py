from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from checks import plan_text
from pyspark.sql import functions as F

from txnsieve.config import Quota
from txnsieve.operators import analyst, outbox, quota, ranking, triage
from txnsieve.sinks.topics import dead_letter_records
from txnsieve.sources.requests import read_requests

TRANSIENT = [
    "ledger lost its connection", "a Timeout, again", "host UNAVAILABLE", "peer refused", "redis gone", "datasource is full",
    "it could not execute", "nullpointer after the connection broke",
]
POISON = [
    "nullpointer in step 9", "numberformat of field seven", "illegal argument in the batch", "could not deserialize row 12",
    "constraint violation on insert", None, "   ", "", "nobody knows", "plain words",
]


@pytest.mark.parametrize(("texts", "kind"), [(TRANSIENT, "TRANSIENT"), (POISON, "POISON_PILL")])
def test_classify(spark, texts, kind):
    df = spark.createDataFrame([(t,) for t in texts], "e string")
    assert {r[0] for r in df.select(triage.classify(F.col("e"))).collect()} == {kind}


def failures(spark, rows):
    t0 = datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(i, t, f"p{i}", e, i, i, t0 + timedelta(seconds=i)) for i, (t, e) in enumerate(rows)],
        "id long, transaction_id string, original_payload string, error_message string, event_ms long, seq long, "
        "created_at timestamp",
    )


def test_first_failure_is_routed_and_repeats_are_dropped(spark):
    routed = triage.triage_first(failures(spark, [("a", "timeout"), ("a", "timeout"), ("b", None)]))
    found = {r.transaction_id: (r.status, r.retry_count, r.resolved_at is None) for r in routed.collect()}
    assert found == {"a": ("RETRYING", 1, True), "b": ("QUARANTINED", 0, False)}
    assert [(r.key, r.value, r.attempt) for r in triage.replays(routed).collect()] == [("a", "p0", 1)]
    assert [r.transaction_id for r in triage.quarantined(routed).collect()] == ["b"]


def test_attempts_run_out_and_decided_ids_are_resolved(spark):
    rows = [("a", "timeout")] * 5 + [("b", "refused"), ("c", "bad")]
    decided = spark.createDataFrame([("b",)], "transaction_id string")
    found = triage.triage_attempts(failures(spark, rows), decided).orderBy("id").collect()
    assert [(r.status, r.retry_count) for r in found] == [
        ("RETRYING", 1), ("RETRYING", 2), ("RETRYING", 3), ("QUARANTINED", 3), ("QUARANTINED", 3),
        ("RESOLVED", 1), ("QUARANTINED", 0),
    ]


def test_attempts_shuffle_failures_once_unless_an_id_is_hot(spark):
    """Ids of few failures, all ids spread, and one hot id among others give the same attempts."""
    rows = [(f"x{i % 7}" if i % 5 else "hot", "timeout" if i % 3 else "bad") for i in range(60)] + [(None, "timeout")] * 5
    table = failures(spark, rows)
    cell = table.where("transaction_id = 'hot'").select(ranking.key_cell(["transaction_id"])).first()[0]
    recorded = spark.createDataFrame([("hot", "TRANSIENT")] * 2 + [("x1", "TRANSIENT")], "transaction_id string, failure_type string")
    for before in (None, recorded):
        found = [
            {(r.id, r.status, r.retry_count) for r in triage.triage_attempts(table, recorded=before, hot=hot).collect()}
            for hot in (None, [], [cell])
        ]
        assert found[0] == found[1] == found[2] and len(found[0]) == 65
    assert plan_text(triage.triage_attempts(table, hot=[])).count("Exchange hashpartitioning") == 1
    assert plan_text(triage.triage_attempts(table, recorded=recorded, hot=[])).count("Exchange hashpartitioning") == 2


def test_header_round_trip(spark):
    rejects = spark.createDataFrame(
        [("a", "p", "timeout"), ("b", "q", None)], "transaction_id string, original_payload string, error_message string"
    )
    records = dead_letter_records(rejects)
    found = {r.transaction_id: r.error_message for r in triage.dead_letters(records).collect()}
    assert found == {"a": "timeout", "b": "Unknown error"}
    bare = records.withColumn("headers", F.lit(None).cast("array<struct<key:string,value:binary>>"))
    assert {r.error_message for r in triage.dead_letters(bare).collect()} == {"Unknown error"}


def test_failure_list_filters_and_renders(spark):
    routed = triage.triage_first(failures(spark, [("a", "timeout"), ("b", None), ("c", "x")]))
    assert [r.transaction_id for r in analyst.list_failures(routed, 1, "QUARANTINED").collect()] == ["c"]
    text = analyst.render_failures(analyst.list_failures(routed, 2)).orderBy("position").collect()[1].text
    assert text.startswith("2. Transaction: b\n   Failure Type: POISON_PILL | Status: QUARANTINED | Retries: 0\n   Error: none")


def requests(spark, rows):
    return spark.createDataFrame([(i, ms, n) for n, (i, ms) in enumerate(rows)], "identifier string, event_ms long, seq long")


def test_quota_admits_the_first_of_each_bucket(spark):
    rows = [("u", 1_000), ("u", 2_000), ("u", 2_000), ("u", 59_999), ("u", 60_000), ("v", 3_000)]
    found = quota.admit(requests(spark, rows), Quota(limit=3, window_s=60)).orderBy("seq").collect()
    assert [(r.admitted, r.remaining, r.retry_after) for r in found] == [
        (True, 2, None), (True, 1, None), (True, 0, None), (False, 0, 1), (True, 2, None), (True, 2, None),
    ]
    totals = quota.quota_totals(requests(spark, rows), Quota(limit=3, window_s=60)).orderBy("identifier", "bucket")
    assert [(r.requests, r.admitted, r.rejected) for r in totals.collect()] == [(4, 3, 1), (1, 1, 0), (1, 1, 0)]


def test_quota_identifier(spark):
    df = spark.createDataFrame([("u", "1"), (" ", "2"), (None, "3")], "u string, a string")
    assert [r[0] for r in df.select(quota.quota_identifier(F.col("u"), F.col("a"))).collect()] == ["u", "2", "3"]


def test_hot_client_is_cut_before_the_shuffle(spark):
    plan = plan_text(quota.admit(requests(spark, [("u", 1)])))
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("limit", [3, 5000])
def test_equal_requests_and_missing_clients_count_once_each(spark, limit):
    rows = [("u", 1_000)] * 4 + [("u", 2_000)] * 2 + [(None, 1_000)] * 5
    same = spark.createDataFrame([(i, ms, 0) for i, ms in rows], "identifier string, event_ms long, seq long")
    found = quota.admit(same, Quota(limit=limit, window_s=60))
    assert found.count() == len(rows)
    admitted = {r.identifier: r.n for r in found.groupBy("identifier").agg(F.count_if("admitted").alias("n")).collect()}
    assert admitted == {"u": min(limit, 6), None: min(limit, 5)}


def test_large_limits_are_cut_before_the_shuffle_by_client(spark):
    plan = plan_text(quota.admit(requests(spark, [("u", 1)]), Quota(limit=5000)))
    assert "_salt" in plan


def test_resolved_rows_carry_the_time_of_the_decision(spark):
    at = datetime(2024, 5, 1)
    decided = spark.createDataFrame([("b", at)], "transaction_id string, decided_at timestamp")
    rows = triage.triage_attempts(failures(spark, [("a", "timeout"), ("b", "refused")]), decided).orderBy("id").collect()
    assert [(r.status, r.resolved_at) for r in rows] == [("RETRYING", None), ("RESOLVED", at)]


def test_requests_to_outbox_to_topic(spark, tmp_path):
    body = {
        "userId": "u", "cardFingerprint": "c", "amount": 149.99, "currency": "USD", "merchantId": "m",
        "merchantCategoryCode": "5411", "merchantRiskTier": "low", "deviceFingerprint": "d", "ipAddress": "1.1.1.1",
        "ipCountry": "US", "billingCountry": "US",
    }
    (tmp_path / "r.json").write_text("\n".join(json.dumps({**body, "userId": u}) for u in ("u1", "u2")))
    read = read_requests(spark, str(tmp_path))
    stored = outbox.store_requests(read, outbox.transaction_id(["userId"]), F.lit(datetime(2024, 1, 1)))
    first = stored.orderBy("user_id").first()
    assert (first.amount, first.status, first.user_agent) == (149, "PENDING", None)
    assert first.transaction_id.startswith("txn_") and len(first.transaction_id) == 36
    records = outbox.outbox_records(stored)
    ledger = records.where(F.col("payload").contains("userId:u1"))
    pending = outbox.unpublished(records, ledger)
    assert pending.count() == 1
    sent = outbox.publish(pending, F.lit(datetime(2024, 1, 2))).first()
    assert (sent.status, sent.published_at) == ("PUBLISHED", datetime(2024, 1, 2))
    assert outbox.topic_records(pending).columns == ["key", "value"]
    assert outbox.stuck(pending, F.lit(datetime(2024, 1, 1, 0, 5)), "5 minutes").count() == 0
    assert outbox.stuck(pending, F.lit(datetime(2024, 1, 1, 0, 6)), "5 minutes").count() == 1
