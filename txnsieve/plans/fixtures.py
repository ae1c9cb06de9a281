"""Transactions, payloads, failures, overrides and requests derived from the given events table.

The column texts run unchanged in Spark SQL and in ANSI SQL engines, so the oracle queries share
them. Every event becomes one transaction; nothing is left out.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from txnsieve.config import HardRules, Quota, Scoring, scaled_signals
from txnsieve.schemas import REPUTATION, RULES, TOPIC_RECORD

BASE = {
    # The properties are always {"k": n}.
    "k": "cast(replace(substring(props, 7), '}', '') as int)",
}

TRANSACTION = {
    "transaction_id": "concat('txn_', cast(event_id as string))",
    "user_id": "concat('user_', cast(user_id as string))",
    "card_fingerprint": "concat('fpr_', cast(user_id as string))",
    "amount": "value * 60",
    "currency": "'USD'",
    "merchant_id": "concat('mch_', cast(k as string))",
    "merchant_category_code": (
        "case event_type when 'purchase' then '7995' when 'signup' then '5912' when 'click' then '5411' "
        "when 'view' then '5942' else '5999' end"
    ),
    "merchant_risk_tier": "case when k % 5 = 0 then 'high' when k % 5 < 3 then 'medium' else 'low' end",
    "device_fingerprint": "case when k % 25 = 7 then '' else concat('dev_', cast(k as string)) end",
    "ip_address": (
        "case k % 10 when 0 then concat('10.0.0.', cast(k as string)) "
        "when 1 then concat('172.16.0.', cast(k as string)) when 2 then '127.0.0.1' "
        "when 3 then concat('fail.', cast(k as string)) when 4 then concat('slow.', cast(k as string)) "
        "else concat('203.0.113.', cast(k as string)) end"
    ),
    "ip_country": (
        "case when user_id % 30 = 5 then 'RU' when user_id % 30 = 6 then 'KP' "
        "when user_id % 30 in (8, 9) then 'CN' else 'US' end"
    ),
    "billing_country": "case when user_id % 10 = 9 then 'CA' else 'US' end",
}

# Payload text with the defects the parser must handle, by event.
_FIELDS = (
    "concat('userId:', t_user_id, '|cardFingerprint:', t_card_fingerprint)",
    "concat('currency:', t_currency, '|merchantId:', t_merchant_id, '|merchantCategoryCode:', "
    "t_merchant_category_code, '|merchantRiskTier:', t_merchant_risk_tier, '|deviceFingerprint:', "
    "t_device_fingerprint, '|ipAddress:', t_ip_address)",
    "concat('ipCountry:', t_ip_country, '|billingCountry:', t_billing_country)",
)
_AMOUNT = "concat('amount:', cast(cast(t_amount as decimal(18, 2)) as string))"
_ID = "concat('transactionId:', t_transaction_id)"
PAYLOAD = (
    "case "
    "when event_id % 61 = 3 then '' "
    f"when event_id % 41 = 3 then concat_ws('|', {_ID}, {_FIELDS[0]}, {_FIELDS[1]}, {_FIELDS[2]}) "
    f"when event_id % 67 = 3 then concat_ws('|', {_FIELDS[0]}, {_AMOUNT}, {_FIELDS[1]}, {_FIELDS[2]}) "
    f"when event_id % 43 = 3 then concat_ws('|', {_ID}, {_FIELDS[0]}, 'amount:abc', {_FIELDS[1]}, {_FIELDS[2]}) "
    f"when event_id % 71 = 3 then concat_ws('|', {_ID}, {_FIELDS[0]}, 'amount:', {_FIELDS[1]}, {_FIELDS[2]}) "
    f"when event_id % 47 = 3 then concat_ws('|', {_ID}, {_FIELDS[0]}, {_AMOUNT}, {_FIELDS[1]}, {_FIELDS[2]}, "
    "'currency:EUR', 'extra', ':junk') "
    f"when event_id % 53 = 3 then concat_ws('|', {_FIELDS[2]}, {_FIELDS[1]}, concat(' ', {_AMOUNT}, ' '), "
    f"{_FIELDS[0]}, {_ID}) "
    f"when event_id % 59 = 3 then concat_ws('|', {_ID}, {_FIELDS[0]}, {_AMOUNT}, {_FIELDS[1]}, {_FIELDS[2]}, "
    "'userAgent: Mozilla:5.0', 'createdAt:2024-01-01') "
    f"else concat_ws('|', {_ID}, {_FIELDS[0]}, {_AMOUNT}, {_FIELDS[1]}, {_FIELDS[2]}) end"
)

# Deliveries of each payload, in milliseconds after the first: a repeat at once, and one after the
# claim has ended.
DELAYS = {0: (0, 1_000, 90_000_000), 1: (0, 1_000), 2: (0,)}

# One error text per word of the classification, some without, and two that hold words of both kinds.
ERROR_TEXTS = (
    "ledger lost its connection halfway",
    "Timeout while the scorer waited its turn",
    "lookup host is UNAVAILABLE, code 503",
    "the peer refused the handshake",
    "cache node (redis) went away",
    "no free slot in the datasource pool",
    "step 4 could not execute",
    "nullpointer in step 9",
    "numberformat of field seven is off",
    "an illegal argument came with the batch",
    "schema check could not deserialize row 12",
    "unique constraint violation on insert",
    "   ",
    "nobody knows what this is",
    "nullpointer after the connection was reset",
)
# Five failures in a row share an id, so retries run out; some have no id.
FAILURE = {
    "transaction_id": (
        "case when event_id % 29 = 0 then 'UNKNOWN' "
        "else concat('txn_', cast(event_id - event_id % 5 as string)) end"
    ),
    "original_payload": "concat('transactionId:txn_', cast(event_id as string), '|userId:', cast(user_id as string))",
    "error_message": (
        "case (event_id * 7 + user_id) % 16 "
        + " ".join(f"when {i} then '{text}'" for i, text in enumerate(ERROR_TEXTS))
        + " else null end"
    ),
}

# Requests to change a decision: one to three per event, some invalid, some for unknown ids.
OVERRIDE = {
    "transaction_id": "concat(case when k = 13 then 'ghost_' else 'txn_' end, cast(event_id as string))",
    "new_decision": (
        "case (event_id + n) % 4 when 2 then 'AUTO_REJECTED' when 3 then 'MAYBE' else 'APPROVED' end"
    ),
    "reason": "concat('reason ', cast(n as string))",
    "analyst_id": "concat('analyst_', cast(user_id % 7 as string))",
}

REQUESTER = "case when user_id % 7 = 0 then ' ' else cast(user_id as string) end"
ADDRESS = "concat('203.0.113.', cast(k as string))"

HARD_RULES = HardRules(blocked_cards=("fpr_3", "fpr_7", "fpr_11"))
TRUE_WINDOWS = Scoring(hard_rules=HARD_RULES)
# Longer windows, so that every tier is reached on sparse data: card windows 240 times, address 24.
SCALED = Scoring(hard_rules=HARD_RULES, signals=scaled_signals(240, 1, 24))
QUOTA = Quota(limit=3, window_s=21_600)

RULE_ROWS = [
    (1, "big_ticket", "amount > 420", 20, True, None, None),
    (2, "risky_shop", "merchantRiskTier == 'high'", 25, True, None, None),
    (3, "betting_shop", "merchantCategoryCode matches '799[0-9]'", 30, True, None, None),
    (4, "abroad", "!(ipCountry == billingCountry)", 15, True, None, None),
    (5, "big_and_risky", "amount between {250, 1e9} and merchantRiskTier.startsWith('hi')", 35, True, None, None),
    (6, "ring_amount", "(amount) gt 420", 0, True, "ring", "ALL"),
    (7, "ring_abroad", "ipCountry != billingCountry", 0, True, "ring", "ALL"),
    (8, "ring_score", "true", 60, True, "ring", "ALL"),
    (9, "watched_betting", "merchantCategoryCode == '7995'", 0, True, "watched", "ANY"),
    (10, "watched_drugs", "merchantCategoryCode == '5912'", 0, True, "watched", "ANY"),
    (11, "watched_score", "true", 25, True, "watched", "ANY"),
    (12, "broken", "amount is ?? large", 50, True, None, None),
    (13, "switched_off", "true", 99, False, None, None),
]
# Rules that only a reader that knows the kinds gets right; the names ending in _error cannot be rules.
PREDICATE_ROWS = [
    (1, "text_number_error", "merchantCategoryCode > 100", 1, True, None, None),
    (2, "bracket_error", "(merchantCategoryCode) > 100", 1, True, None, None),
    (3, "not_text_error", "!merchantRiskTier == 'high'", 1, True, None, None),
    (4, "unknown_error", "merchant.owner == 'x'", 1, True, None, None),
    (5, "text_number_equal", "lower(merchantCategoryCode) == 7995", 1, True, None, None),
    (6, "bracket_nan", "(amount) > 420", 1, True, None, None),
    (7, "product_nan", "amount * 2 > 840", 1, True, None, None),
    (8, "same_nan", "amount == amount", 1, True, None, None),
    (9, "not_above", "!(amount > 420)", 1, True, None, None),
    (10, "binding", "!(merchantRiskTier == 'high') && amount + 10 * 2 < 100 || ipCountry == 'RU'", 1, True, None, None),
    (11, "choice", "merchantRiskTier == 'high' ? amount > 100 : amount > 500", 1, True, None, None),
    (12, "pattern", "merchantCategoryCode matches '5[0-9]+' and not ipCountry.contains('U')", 1, True, None, None),
]
REPUTATION_ROWS = [
    ("10.", "MALICIOUS", 40, "simulated", False),
    ("172.", "SUSPICIOUS", 20, "simulated", False),
    ("fail.", "CLEAN", 0, "simulated", True),
    ("slow.", "CLEAN", 0, "simulated", True),
]


#: A rule per customer, on the merchant that the customer's number falls to, from an amount that its balance gives.
CUSTOMER_RULE = {
    "merchant": "concat('mch_', cast(c_custkey % 100 as string))",
    "least": "cast(floor(abs(c_acctbal)) as bigint)",
    "abroad": "c_custkey % 3 = 0",
}


def customer_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules derived from the customers: thousands of conjunctions."""
    merchant, least, abroad = (F.expr(CUSTOMER_RULE[c]) for c in ("merchant", "least", "abroad"))
    text = F.concat(F.lit("merchantId == '"), merchant, F.lit("' and amount > "), least.cast("string"))
    text = F.when(abroad, F.concat(text, F.lit(" and ipCountry != 'US'"))).otherwise(text)
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").cast("long").alias("id"), F.concat(F.lit("customer_"), F.col("c_custkey").cast("string")).alias("name"),
        text.alias("expression"), (F.col("c_custkey") % 7 + 1).cast("int").alias("score"), F.lit(True).alias("enabled"),
        F.lit(None).cast("string").alias("group_name"), F.lit(None).cast("string").alias("match_mode"),
    )


def _small_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    named = [dict(zip(schema.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(named, to_arrow_schema(schema)), schema)


def rules_table(spark: SparkSession) -> DataFrame:
    return _small_table(spark, RULE_ROWS, RULES)


def predicates_table(spark: SparkSession) -> DataFrame:
    return _small_table(spark, PREDICATE_ROWS, RULES)


def reputation_table(spark: SparkSession) -> DataFrame:
    return _small_table(spark, REPUTATION_ROWS, REPUTATION)


def _exprs(columns: dict[str, str], prefix: str = "") -> list:
    return [F.expr(text).alias(prefix + name) for name, text in columns.items()]


def from_events(events: DataFrame) -> DataFrame:
    """Events with the number in their properties and the time in milliseconds."""
    return events.select("*", *_exprs(BASE), F.unix_millis(F.col("ts").cast("timestamp")).alias("event_ms"))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per event.

    The generator keeps the derived texts from being inlined into every filter that names them;
    stored transactions would be plain columns.
    """
    row = F.struct(*_exprs(TRANSACTION), "event_ms", F.col("event_id").alias("seq"))
    return read_events(spark, sf_dir).select(F.inline(F.array(row)))


def stored_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions table at rest: whole amounts and a status."""
    columns = {**TRANSACTION, "amount": "cast(floor(value * 60) as bigint)"}
    return read_events(spark, sf_dir).select(
        F.col("event_id").alias("id"), *_exprs(columns), F.lit("PENDING").alias("status"),
        F.col("ts").alias("created_at"),
    )


def payloads_from(events: DataFrame) -> DataFrame:
    delays = F.when(F.col("k") % 3 == 0, F.array(*map(F.lit, DELAYS[0])))
    delays = delays.when(F.col("k") % 3 == 1, F.array(*map(F.lit, DELAYS[1]))).otherwise(F.array(F.lit(0)))
    base = from_events(events).select("event_id", "event_ms", "k", *_exprs(TRANSACTION, "t_"))
    return base.select(
        F.expr(PAYLOAD).alias("value"), "event_id", "event_ms", F.posexplode(delays).alias("n", "delay")
    ).select(
        "value",
        (F.col("event_ms") + F.col("delay")).alias("event_ms"),
        (F.col("event_id") * 3 + F.col("n")).alias("seq"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries of payload texts with defects and repeats."""
    return payloads_from(spark.read.parquet(f"{sf_dir}/events.parquet"))


#: Two records of one id and one time: which of the two amounts comes first differs from event to event.
TWO_AMOUNTS = "case when (event_id + n) % 2 = 0 then '75' else '20000' end"


def equal_time_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic records of which two have the same id and time; the lower offset arrived first."""
    base = read_events(spark, sf_dir).select("event_id", "ts", "k", *_exprs(TRANSACTION, "t_"))
    both = base.withColumn("n", F.explode(F.array(F.lit(1), F.lit(0))))
    value = f"concat_ws('|', {_ID}, {_FIELDS[0]}, concat('amount:', {TWO_AMOUNTS}), {_FIELDS[1]}, {_FIELDS[2]})"
    return both.select(
        F.col("t_transaction_id").alias("key"),
        F.expr(value).alias("value"),
        F.lit(None).cast(TOPIC_RECORD["headers"].dataType).alias("headers"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        (F.col("k") % 4).cast("int").alias("partition"),
        (F.col("event_id") * 2 + F.col("n")).cast("long").alias("offset"),
    )


def failures_from(events: DataFrame) -> DataFrame:
    return from_events(events).select(
        F.col("event_id").alias("id"), *_exprs(FAILURE), "event_ms", F.col("event_id").alias("seq"),
        F.col("ts").alias("created_at"),
    )


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failures_from(spark.read.parquet(f"{sf_dir}/events.parquet"))


def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = read_events(spark, sf_dir).withColumn("n", F.explode(F.sequence(F.lit(0), F.col("k") % 3)))
    return numbered.select(
        (F.col("event_id") * 3 + F.col("n")).alias("override_id"),
        *_exprs(OVERRIDE),
        (F.col("ts") + F.make_dt_interval(F.lit(1), F.col("n") * 2)).alias("requested_at"),
    )


def client_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_events(spark, sf_dir).select(
        F.expr(REQUESTER).alias("user"), F.expr(ADDRESS).alias("address"), "event_ms",
        F.col("event_id").alias("seq"),
    )
