from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from txnsieve.config import CARD_1M, DEVICE_CARDS_24H, HOUR_MS, Quota, Scoring, scaled_signals
from txnsieve.operators.parsing import parse_payloads, valid_events
from txnsieve.operators.rules import load_rules
from txnsieve.operators.triage import PLACE_HEADER, dead_letters, header_text
from txnsieve.plans import fixtures
from txnsieve.plans.scoring import score_payloads
from txnsieve.schemas import TOPIC_RECORD, TRANSACTIONS
from txnsieve.sinks.retention import batch_folders, read_current, retain
from txnsieve.sinks.tables import append_batch
from txnsieve.sinks.topics import dead_letter_records
from txnsieve.sources.tables import stream_table
from txnsieve.sources.topics import Topic, read_topic
from txnsieve.streaming.relay import relay, stream_quota_totals
from txnsieve.streaming.scoring_stream import (
    ARRIVAL, ScoringJob, claim_within_watermark, score_batch, score_stream, topic_payloads,
)
from txnsieve.streaming.triage_stream import BUCKET, TriageJob, recorded_failures, triage_batch, triage_stream
from txnsieve.streaming.velocity_state import PROVIDER, by_transaction, velocity_state


def job(spark, folder, **changes):
    settings = {
        "rules": lambda: fixtures.rules_table(spark),
        "reputation": lambda: fixtures.reputation_table(spark),
        "decisions": f"{folder}/decisions",
        "history": f"{folder}/history",
        "dead_letters": Topic(f"{folder}/dead_letters", "parquet"),
        "scoring": fixtures.SCALED,
        "decided_at": F.timestamp_millis("event_ms"),
    }
    return ScoringJob(**{**settings, **changes})


def rows(df):
    return sorted(map(str, df.select(*sorted(c for c in df.columns if c not in ("batch_id", "run_id"))).collect()))


@pytest.fixture(scope="module")
def payloads(spark, sf_dir):
    kept = fixtures.payloads(spark, sf_dir).where("event_ms < 1704499200000").orderBy("event_ms").cache()
    yield kept
    kept.unpersist()


@pytest.fixture(scope="module")
def batch_run(spark, payloads):
    return score_payloads(
        payloads, load_rules(fixtures.rules_table(spark)), fixtures.reputation_table(spark), fixtures.SCALED,
        decided_at=F.timestamp_millis("event_ms"),
    )


def test_batches_in_time_order_equal_one_run(spark, payloads, batch_run, tmp_path):
    """Also when a batch is run again."""
    scoring = job(spark, tmp_path)
    times = [r.event_ms for r in payloads.select("event_ms").orderBy("event_ms").collect()]
    cuts = [0, times[len(times) // 3], times[2 * len(times) // 3], times[-1] + 1]
    for batch_id, (low, high) in enumerate(zip(cuts, cuts[1:])):
        part = payloads.where((F.col("event_ms") >= low) & (F.col("event_ms") < high))
        score_batch(part, batch_id, scoring)
        if batch_id == 1:
            score_batch(part, batch_id, scoring)
    assert rows(spark.read.parquet(scoring.decisions)) == rows(batch_run.decisions)
    letters = spark.read.parquet(scoring.dead_letters.location)
    assert letters.count() == batch_run.rejects.count()


def test_late_row_is_scored_and_changes_no_earlier_decision(spark, payloads, tmp_path):
    scoring = job(spark, tmp_path)
    once = payloads.groupBy("value").agg(F.count("*").alias("n"), F.min("seq").alias("seq")).where(
        (F.col("n") == 1) & F.col("value").startswith("transactionId") & F.col("value").contains("|amount:")
    )
    late = payloads.where(F.col("seq") == once.agg(F.min("seq")).first()[0])
    first = payloads.exceptAll(late)
    score_batch(first, 0, scoring)
    before = rows(spark.read.parquet(scoring.decisions))
    score_batch(late, 1, scoring)
    after = spark.read.parquet(scoring.decisions)
    assert rows(after.where("batch_id = 0")) == before
    assert after.where("batch_id = 1").count() == 1


def test_a_late_repeat_across_midnight_is_a_duplicate(spark, payloads, tmp_path):
    scoring = job(spark, tmp_path)
    one = payloads.where(F.col("value").startswith("transactionId") & F.col("value").contains("|amount:1")).limit(1)
    midnight = 1_704_585_600_000
    score_batch(one.withColumn("event_ms", F.lit(midnight + 60_000)), 0, scoring)
    score_batch(one.withColumn("event_ms", F.lit(midnight - 60_000)), 1, scoring)
    assert spark.read.parquet(scoring.decisions).count() == 1


def test_a_new_checkpoint_adds_to_the_tables(spark, payloads, tmp_path):
    """And still knows the claims of the run before."""
    scoring = job(spark, tmp_path)
    some = payloads.where(F.col("value").startswith("transactionId") & F.col("value").contains("|amount:")).where("seq % 3 = 0")
    low = some.agg(F.min("seq")).first()[0]
    first, second = some.where(F.col("seq") == low), some.where(F.col("seq") <= low + 300)
    for n, rows_in in enumerate((first, second)):
        rows_in.write.parquet(f"{tmp_path}/in{n}")
        source = spark.readStream.schema(rows_in.schema).parquet(f"{tmp_path}/in{n}")
        score_stream(source, scoring, f"{tmp_path}/checkpoint{n}", availableNow=True).awaitTermination()
    stored = spark.read.parquet(scoring.decisions)
    assert stored.select("run_id").distinct().count() == 2
    ids = valid_events(parse_payloads(second)).select("transaction_id").distinct().count()
    assert stored.count() == stored.select("transaction_id").distinct().count() == ids


def test_rules_are_read_again_for_each_batch(spark, payloads, tmp_path):
    current = [fixtures.rules_table(spark).where("id = 1")]
    scoring = job(spark, tmp_path, rules=lambda: current[0])
    score_batch(payloads.where("seq % 2 = 0"), 0, scoring)
    current[0] = fixtures.rules_table(spark).where("id = 2")
    score_batch(payloads.where("seq % 2 = 1"), 1, scoring)
    versions = spark.read.parquet(scoring.decisions).select("batch_id", "rules_version").distinct().collect()
    assert len({r.rules_version for r in versions}) == len(versions) == 2


def test_replays_are_duplicates_unless_they_may_pass(spark, payloads, tmp_path):
    texts = payloads.where(F.col("value").startswith("transactionId")).where("seq % 3 = 0").limit(2)
    first = texts.withColumn("attempt", F.lit(0).cast("long"))
    again = first.withColumn("attempt", F.lit(1).cast("long")).withColumn("event_ms", F.col("event_ms") + 5)
    both = [first.unionByName(again), first.unionByName(again).unionByName(again)]
    for name, passes, factor in (("parity", False, 1), ("passing", True, 2)):
        scoring = job(spark, tmp_path / name, replays_pass=passes)
        score_batch(both[passes], 0, scoring)
        valid = spark.read.parquet(scoring.decisions)
        assert valid.count() == factor * valid.select("transaction_id").distinct().count()


def test_topic_stream_end_to_end(spark, payloads, tmp_path):
    """Topic files in, decisions and dead letters out."""
    records = payloads.select(
        F.lit(None).cast("string").alias("key"), "value",
        F.lit(None).cast(TOPIC_RECORD["headers"].dataType).alias("headers"),
        F.timestamp_millis("event_ms").alias("timestamp"),
    )
    records.repartition(2).write.parquet(f"{tmp_path}/topic")
    stream = read_topic(spark, Topic(f"{tmp_path}/topic", "parquet", {"maxFilesPerTrigger": "1"}))
    scoring = job(spark, tmp_path)
    score_stream(topic_payloads(stream), scoring, f"{tmp_path}/checkpoint", availableNow=True).awaitTermination()
    assert spark.read.parquet(scoring.decisions).select("batch_id").distinct().count() == 2
    assert spark.read.parquet(scoring.dead_letters.location).where("key = 'UNKNOWN'").count() > 0


def test_triage_stream_remembers_recorded_failures(spark, sf_dir, tmp_path):
    failures = fixtures.failures(spark, sf_dir).limit(60).withColumn("timestamp", F.col("created_at").cast("timestamp"))
    records = dead_letter_records(failures, "timestamp").repartition(3)
    records.write.parquet(f"{tmp_path}/topic")
    triage_job = TriageJob(f"{tmp_path}/failed_events", Topic(f"{tmp_path}/replays", "parquet"))
    stream = read_topic(spark, Topic(f"{tmp_path}/topic", "parquet", {"maxFilesPerTrigger": "1"}))
    triage_stream(stream, triage_job, f"{tmp_path}/checkpoint", availableNow=True).awaitTermination()
    recorded = spark.read.parquet(triage_job.failed_events)
    assert recorded.count() == failures.select("transaction_id").distinct().count()
    replayed = spark.read.parquet(triage_job.scoring_topic.location)
    assert replayed.count() == recorded.where("status = 'RETRYING'").count()


def test_relay_sends_each_stored_row_once(spark, sf_dir, tmp_path):
    stored = fixtures.stored_transactions(spark, sf_dir).withColumn("user_agent", F.lit(None).cast("string"))
    stored = stored.select(*TRANSACTIONS.names)
    topic = Topic(f"{tmp_path}/topic", "parquet")
    for low, high in ((0, 500), (500, 1000)):
        stored.where(f"id >= {low} and id < {high}").write.mode("append").parquet(f"{tmp_path}/transactions")
        source = stream_table(spark, f"{tmp_path}/transactions", TRANSACTIONS)
        relay(source, topic, f"{tmp_path}/checkpoint", availableNow=True).awaitTermination()
    sent = spark.read.parquet(topic.location)
    assert sent.count() == sent.select("key").distinct().count() == 1000


def _stream_of(spark, df, folder):
    df.repartition(1).write.parquet(folder)
    return spark.readStream.schema(df.schema).parquet(folder)


def test_quota_totals_by_tumbling_window(spark, tmp_path):
    requests = spark.createDataFrame(
        [("u", s) for s in (0, 1, 2, 59, 60)] + [("v", 5)], "identifier string, s long"
    ).select("identifier", F.timestamp_seconds("s").alias("event_ts"))
    totals = stream_quota_totals(_stream_of(spark, requests, f"{tmp_path}/in"), Quota(limit=3, window_s=60))
    totals.writeStream.format("memory").queryName("totals").outputMode("complete").trigger(
        availableNow=True
    ).start().awaitTermination()
    found = spark.table("totals").orderBy("identifier", "window_start").collect()
    assert [(r.identifier, r.requests, r.admitted, r.rejected) for r in found] == [
        ("u", 4, 3, 1), ("u", 1, 1, 0), ("v", 1, 1, 0),
    ]


def test_claims_in_the_state_store(spark, tmp_path):
    events = spark.createDataFrame([("a", 0), ("a", 5), ("b", 7)], "transaction_id string, s long").select(
        "transaction_id", F.timestamp_seconds("s").alias("event_ts")
    )
    claimed = claim_within_watermark(_stream_of(spark, events, f"{tmp_path}/in"))
    claimed.writeStream.format("memory").queryName("claimed").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.transaction_id for r in spark.table("claimed").collect()) == ["a", "b"]


def _batches(payloads, count):
    times = [r.event_ms for r in payloads.select("event_ms").orderBy("event_ms").collect()]
    cuts = [times[len(times) * i // count] for i in range(count)] + [times[-1] + 1]
    return [payloads.where((F.col("event_ms") >= low) & (F.col("event_ms") < high)) for low, high in zip(cuts, cuts[1:])]


def _days_and_folders(folder):
    return len(list(folder.glob("event_date=*"))), len(list(folder.glob("event_date=*/run_id=*/batch_id=*")))


def test_retention_changes_no_decision_and_leaves_fewer_folders(spark, sf_dir, tmp_path):
    """Windows of two hours, so that whole days of history end while the stream runs on."""
    short = Scoring(hard_rules=fixtures.HARD_RULES, signals=scaled_signals(2, 1, 2), claim_ttl_ms=HOUR_MS)
    payloads = fixtures.payloads(spark, sf_dir).where("seq % 5 = 0 AND event_ms < 1704844800000").cache()
    found = {}
    for name, every in (("kept", 0), ("retained", 2)):
        scoring = job(spark, tmp_path / name, scoring=short, retain_every=every, lateness_ms=HOUR_MS)
        for batch_id, part in enumerate(_batches(payloads, 7)):
            score_batch(part, batch_id, scoring)
            if batch_id == 4:
                score_batch(part, batch_id, scoring)  # a batch that runs again
        found[name] = (rows(spark.read.parquet(scoring.decisions)), _days_and_folders(tmp_path / name / "history"))
    payloads.unpersist()
    assert found["kept"][0] == found["retained"][0]
    assert found["retained"][1][0] < found["kept"][1][0] and found["retained"][1][1] < found["kept"][1][1]


def test_a_merged_folder_stands_for_its_batches(spark, tmp_path):
    schema = spark.createDataFrame([], "n long, day string, run_id string, batch_id long").schema
    table = f"{tmp_path}/table"
    for batch in range(4):
        append_batch(spark.createDataFrame([(batch, "d1"), (10 + batch, "d2")], "n long, day string"), table, batch, ["day"], "r")
    append_batch(spark.createDataFrame([(99, "d1")], "n long, day string"), table, 0, ["day"], "other")

    def numbers():
        return sorted(r["n"] for r in read_current(spark, table, "day", schema).collect())

    want = [0, 1, 2, 3, 10, 11, 12, 13, 99]
    assert numbers() == want
    retain(spark, table, "day", schema)
    assert numbers() == want  # the replaced folders are still there, but count no more
    assert len(batch_folders(spark, table, "day")) == 11
    retain(spark, table, "day", schema)
    assert numbers() == want
    assert sorted((f.value, f.run, f.batch) for f in batch_folders(spark, table, "day")) == [
        ("d1", "merged-r", 2), ("d1", "other", 0), ("d1", "r", 3), ("d2", "merged-r", 2), ("d2", "r", 3),
    ]
    append_batch(spark.createDataFrame([(33, "d1")], "n long, day string"), table, 3, ["day"], "r")  # the newest batch again
    assert numbers() == [0, 1, 2, 10, 11, 12, 13, 33, 99]
    for batch in (4, 5):
        append_batch(spark.createDataFrame([(batch, "d1")], "n long, day string"), table, batch, ["day"], "r")
    retain(spark, table, "day", schema, keep_from="d1")
    cut_off = tmp_path / "table/day=d1/run_id=merged-r/batch_id=4"
    (cut_off / "_SUCCESS").unlink()  # as if the merge had been stopped half way
    assert numbers() == [0, 1, 2, 4, 5, 10, 11, 12, 13, 33, 99]
    retain(spark, table, "day", schema, keep_from="d2")
    assert numbers() == [10, 11, 12, 13]


def test_impossible_times_are_dead_letters(spark, payloads, tmp_path):
    scoring = job(spark, tmp_path)
    good = payloads.where(F.col("value").startswith("transactionId") & F.col("value").contains("|amount:1")).where("seq % 3 = 0").limit(3)
    far = good.withColumn("event_ms", F.lit(9_000_000_000_000_000)).unionByName(good.withColumn("event_ms", F.lit(-5).cast("long")))
    score_batch(good.unionByName(far), 0, scoring)
    score_batch(good.withColumn("event_ms", F.lit(200_000_000_000_000)), 1, scoring)  # a year far ahead, but possible
    assert spark.read.parquet(scoring.decisions).where("batch_id = 0").count() == valid_events(parse_payloads(good)).count()
    letters = dead_letters(spark.read.parquet(scoring.dead_letters.location))
    assert letters.where("error_message LIKE 'Impossible event time%'").count() == 2 * good.count() > 0


def test_lower_offset_wins_among_equal_times(spark, sf_dir, tmp_path):
    """Through a topic, the parse, the claim and the decision; the reject names its place."""
    records = fixtures.equal_time_records(spark, sf_dir).limit(400).unionByName(
        spark.createDataFrame([(None, "junk", None, datetime(2024, 1, 1), 3, 77)], fixtures.equal_time_records(spark, sf_dir).schema)
    )
    records.repartition(3).write.parquet(f"{tmp_path}/topic")
    scoring = job(spark, tmp_path, order=ARRIVAL)
    stream = topic_payloads(read_topic(spark, Topic(f"{tmp_path}/topic", "parquet")))
    score_stream(stream, scoring, f"{tmp_path}/checkpoint", availableNow=True).awaitTermination()
    first = records.groupBy("key").agg(F.min_by("value", "offset").alias("value")).where("key IS NOT NULL")
    high = first.where(F.col("value").contains("|amount:20000|")).select(F.col("key").alias("transaction_id"))
    taken = spark.read.parquet(scoring.decisions)
    capped = taken.where("decision_reason = 'AMOUNT_EXCEEDS_CAP'").select("transaction_id")
    blocked = taken.where("decision_reason = 'BLOCKLIST_HIT'").select("transaction_id")
    assert taken.count() == first.count()
    assert rows(capped) == rows(high.subtract(blocked)) and capped.count() > 20
    letter = spark.read.parquet(scoring.dead_letters.location).select(header_text(F.col("headers"), PLACE_HEADER).alias("place")).first()
    assert letter.place == "3:77"


def test_triage_reads_only_the_buckets_of_its_batch(spark, sf_dir, tmp_path):
    triage_job = TriageJob(f"{tmp_path}/failed", Topic(f"{tmp_path}/replays", "parquet"), attempts=True, retain_every=2)
    failures = fixtures.failures(spark, sf_dir).where("seq < 120")
    records = dead_letter_records(failures.withColumn("timestamp", F.col("created_at").cast("timestamp")), "timestamp", "seq")
    for batch_id in range(5):
        triage_batch(records.where(F.col("seq") % 5 == batch_id).drop("seq"), batch_id, triage_job)
    everything = recorded_failures(spark, triage_job)
    assert everything.count() == 120
    folders = batch_folders(spark, triage_job.failed_events, BUCKET)
    assert any(f.merged_run for f in folders)
    some = recorded_failures(spark, triage_job, [3, 4])
    assert {f.split("/key_bucket=")[1].split("/")[0] for f in some.inputFiles()} <= {"3", "4"}
    counted = everything.where("failure_type = 'TRANSIENT'").groupBy("transaction_id").agg(
        F.count("*").alias("n"), F.max("retry_count").alias("most"), F.count_if(F.col("status") == "RETRYING").alias("tries")
    )
    assert counted.where("tries != least(n, 3) OR most != least(n, 3)").count() == 0 and counted.count() > 5


@pytest.mark.parametrize("most", [200_000, 5])
def test_a_triage_batch_writes_each_bucket_once(spark, sf_dir, tmp_path, monkeypatch, most):
    """One file per bucket and batch, whatever the number of tasks; hot ids and others replay the same."""
    monkeypatch.setattr("txnsieve.streaming.triage_stream.WHOLE_ROWS", most)
    triage_job = TriageJob(f"{tmp_path}/failed", Topic(f"{tmp_path}/replays", "parquet"), attempts=True)
    failures = fixtures.failures(spark, sf_dir).withColumn("timestamp", F.col("created_at").cast("timestamp"))
    records = dead_letter_records(failures, "timestamp", "seq").repartition(6)
    for batch_id in (0, 1, 1):
        triage_batch(records.where(F.col("seq") % 2 == batch_id).drop("seq"), batch_id, triage_job)
    files = spark.read.parquet(triage_job.failed_events).inputFiles()
    assert len(files) == len({f.rsplit("/", 1)[0] for f in files}) == 64
    counted = recorded_failures(spark, triage_job).groupBy("transaction_id").agg(
        F.count_if(F.col("failure_type") == "TRANSIENT").alias("n"), F.count_if(F.col("status") == "RETRYING").alias("tries")
    )
    assert counted.where("tries != least(n, 3)").count() == 0
    sent = spark.read.parquet(triage_job.scoring_topic.location).groupBy("key").agg(F.count("*").alias("sent"))
    assert sent.join(counted, F.col("key") == F.col("transaction_id")).where("sent = tries").count() == sent.count() > 100


def test_keyed_state_forgets_and_restarts(spark, tmp_path):
    """Counts over restarts, a late event, and an empty store once the watermark has passed everything."""
    day = 86_400_000
    parts = [
        [("a", "d1", day), ("b", "d1", day + 10), ("c", "d2", day + 20)],
        [("a", "d1", day + 59_999), ("e", "d1", day + 60_010), ("late", "d1", day + 5)],
        [("far", "d9", 40 * day)],
        [("end", "d9", 40 * day + 1)],
    ]
    signals = (CARD_1M, DEVICE_CARDS_24H)
    kept = spark.conf.get(PROVIDER[0])
    spark.conf.set(*PROVIDER)
    try:
        for n, part in enumerate(parts):
            df = spark.createDataFrame(
                [(f"t{n}-{i}", c, d, ms) for i, (c, d, ms) in enumerate(part)],
                "transaction_id string, card_fingerprint string, device_fingerprint string, event_ms long",
            )
            df.repartition(1).write.mode("append").parquet(f"{tmp_path}/in")
            stream = velocity_state(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), signals, HOUR_MS)
            stream.writeStream.option("checkpointLocation", f"{tmp_path}/cp").option("path", f"{tmp_path}/out").format("parquet").trigger(
                availableNow=True
            ).start().awaitTermination()
    finally:
        spark.conf.set(PROVIDER[0], kept)
    found = {r.transaction_id: (r.card_1m, r.device_cards_24h) for r in by_transaction(spark.read.parquet(f"{tmp_path}/out"), signals).collect()}
    assert found == {
        "t0-0": (1, 1), "t0-1": (1, 2), "t0-2": (1, 1), "t1-0": (2, 3), "t1-1": (1, 4), "t1-2": (1, 2), "t2-0": (1, 1), "t3-0": (1, 2),
    }
    state = spark.read.format("statestore").option("stateVarName", "uses").load(f"{tmp_path}/cp")
    assert {r["key"]["key"] for r in state.select("key").distinct().collect()} <= {"far", "end", "d9"}
