"""The registered queries as ANSI SQL over the same tables, written from the semantics alone."""

from __future__ import annotations

from txnsieve.plans import fixtures
from txnsieve.plans.queries import AS_OF_MS, LOOKUP_ID, SNAPSHOT_SCALE

MS = "epoch_us(ts) // 1000"


def _columns(columns: dict[str, str], prefix: str = "") -> str:
    return ", ".join(f"{text} as {prefix}{name}" for name, text in columns.items())


def _list(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _tier(count: str, tiers: tuple[tuple[int, int], ...]) -> str:
    whens = " ".join(f"when {count} >= {at_least} then {score}" for at_least, score in tiers)
    return f"cast(case {whens} else 0 end as bigint)"


HARD = fixtures.HARD_RULES
CARD_1M, CARD_5M, CARD_1H, DEVICE, IP = fixtures.SCALED.signals


def _hard(extra_column: str = "", countries: tuple[str, ...] = HARD.sanctioned_countries, blocked: str = "") -> str:
    blocked = blocked or f"card_fingerprint in ({_list(HARD.blocked_cards)})"
    also = f" or {extra_column} in ({_list(countries)})" if extra_column else ""
    return (
        f"case when {blocked} then 'BLOCKLIST_HIT' when amount > 10000 then 'AMOUNT_EXCEEDS_CAP' "
        f"when ip_country in ({_list(countries)}){also} then 'SANCTIONED_COUNTRY' end"
    )


def _frame(key: str, window: int) -> str:
    return f"over (partition by {key} order by event_ms range between {window - 1} preceding and current row)"


def _counts(signals: tuple) -> str:
    card_1m, card_5m, card_1h, device, ip = signals
    return f"""
      count(*) {_frame("card_fingerprint", card_1m.window_ms)} as card_1m,
      count(*) {_frame("card_fingerprint", card_5m.window_ms)} as card_5m,
      count(*) {_frame("card_fingerprint", card_1h.window_ms)} as card_1h,
      case when trim(device_fingerprint) = '' then 0 else
        count(distinct card_fingerprint) {_frame("device_fingerprint", device.window_ms)} end as device_cards_24h,
      case when ip_address like '127.%' then 0 else
        count(distinct card_fingerprint) {_frame("ip_address", ip.window_ms)} end as ip_cards_1h"""


BEHAVIOUR = " + ".join(_tier(s.name, s.tiers) for s in fixtures.SCALED.signals)
UNGROUPED = (
    "(case when amount > 420 then 20 else 0 end + case when merchant_risk_tier = 'high' then 25 else 0 end "
    "+ case when regexp_full_match(merchant_category_code, '799[0-9]') then 30 else 0 end "
    "+ case when ip_country <> billing_country then 15 else 0 end "
    "+ case when amount >= 250 and merchant_risk_tier like 'hi%' then 35 else 0 end)"
)
ALL_GROUP = "(case when amount > 420 and ip_country <> billing_country then 60 else 0 end)"
ANY_GROUP = "(case when merchant_category_code in ('7995', '5912') then 25 else 0 end)"
RULES = f"({UNGROUPED} + {ALL_GROUP} + {ANY_GROUP})"
ENRICHMENT = "(case when ip_address like '10.%' then 40 when ip_address like '172.%' then 20 else 0 end)"
AT = "make_timestamp(event_ms * 1000)"

_DELAY_LIST = (
    "case k % 3 " + " ".join(f"when {r} then [{', '.join(map(str, d))}]" for r, d in fixtures.DELAYS.items()) + " end"
)
_PARSED_FIELDS = {
    "transaction_id": "transactionId", "user_id": "userId", "card_fingerprint": "cardFingerprint",
    "amount_text": "amount", "currency": "currency", "merchant_id": "merchantId",
    "merchant_category_code": "merchantCategoryCode", "merchant_risk_tier": "merchantRiskTier",
    "device_fingerprint": "deviceFingerprint", "ip_address": "ipAddress", "ip_country": "ipCountry",
    "billing_country": "billingCountry", "user_agent": "userAgent", "created_at": "createdAt",
}
_REQUIRED = list(_PARSED_FIELDS.items())[:12]
_MISSING = "coalesce(" + ", ".join(
    f"case when not list_contains(names, '{name}') then '{name}' end" for _, name in _REQUIRED
) + ")"
_EVENT = (
    "event_ms, seq, transaction_id, user_id, card_fingerprint, amount, currency, merchant_id, "
    "merchant_category_code, merchant_risk_tier, device_fingerprint, ip_address, ip_country, "
    "billing_country, coalesce(user_agent, '') as user_agent, coalesce(created_at, '') as created_at"
)

# Named parts; each may use the ones before it.
PARTS = {
    "e": f"select *, {_columns(fixtures.BASE)}, {MS} as event_ms from events",
    "tx": f"select {_columns(fixtures.TRANSACTION)}, event_ms, event_id as seq from e",
    "stored": (
        f"select event_id as id, {_columns({**fixtures.TRANSACTION, 'amount': 'cast(floor(value * 60) as bigint)'})}, "
        "'PENDING' as status, ts as created_at from e"
    ),
    "flagged": f"select *, {_hard()} as hard_reason from tx",
    "live": "select * exclude (hard_reason) from flagged where hard_reason is null",
    "counted": f"select *, {_counts(fixtures.SCALED.signals)} from live",
    "counted_true": f"select *, {_counts(fixtures.TRUE_WINDOWS.signals)} from live",
    # Payload deliveries
    "texts": f"select event_id, event_ms, k, {_columns(fixtures.TRANSACTION, 't_')} from e",
    "deliveries": f"""
      select value, event_ms + delays[n] as event_ms, event_id * 3 + n - 1 as seq from (
        select {fixtures.PAYLOAD} as value, event_ms, event_id, {_DELAY_LIST} as delays,
          unnest(range(1, 1 + len({_DELAY_LIST}))) as n
        from texts)""",
    "split": """
      select *, list_reverse(list_transform(parts, lambda p: trim(substr(p, 1, instr(p, ':') - 1)))) as names,
        list_reverse(list_transform(parts, lambda p: trim(substr(p, instr(p, ':') + 1)))) as contents
      from (select *, list_filter(string_split(value, '|'), lambda p: instr(p, ':') > 1) as parts
            from deliveries)""",
    "parsed": f"""
      select *, try_cast(amount_text as double) as amount from (
        select value, event_ms, seq, {_MISSING} as missing, """
    + ", ".join(f"contents[list_position(names, '{n}')] as {c}" for c, n in _PARSED_FIELDS.items())
    + " from split)",
    "valid": f"select {_EVENT} from parsed where missing is null and amount is not null",
    "rejected": """
      select 'UNKNOWN' as transaction_id, value as original_payload, event_ms, seq,
        case when missing is not null
             then concat('Missing required field ''', missing, ''' in payload: ', value)
             when amount_text = '' then 'empty String'
             else concat('For input string: "', amount_text, '"') end as error_message
      from parsed where missing is not null or amount is null""",
    "claims": """
      select transaction_id, min(event_ms) as event_ms from valid group by transaction_id
      union all
      select c.transaction_id, min(v.event_ms) from claims c join valid v
        on v.transaction_id = c.transaction_id and v.event_ms >= c.event_ms + 86400000
      group by c.transaction_id""",
    "claimed": """
      select v.* from valid v join claims c using (transaction_id, event_ms)
      qualify row_number() over (partition by v.transaction_id, v.event_ms order by v.seq) = 1""",
    "payload_flagged": f"select *, {_hard()} as hard_reason from claimed",
    "payload_live": "select * from payload_flagged where hard_reason is null",
    "payload_counted": f"select *, {_counts(fixtures.SCALED.signals)} from payload_live",
    # Dead letters
    "failures": (
        f"select event_id as id, {_columns(fixtures.FAILURE)}, event_ms, event_id as seq, ts as created_at from e"
    ),
    "typed": """
      select *, case when coalesce(trim(error_message), '') = '' then 'POISON_PILL'
        when regexp_matches(lower(error_message),
          'connection|timeout|unavailable|refused|redis|datasource|could not execute') then 'TRANSIENT'
        else 'POISON_PILL' end as failure_type
      from failures""",
    "first_failures": """
      select *, failure_type = 'TRANSIENT' as retry from typed
      qualify row_number() over (partition by transaction_id order by event_ms, seq) = 1""",
    "requests": f"""
      select case when trim(u) = '' then a else u end as identifier, event_ms, seq,
        event_ms // 1000 // {fixtures.QUOTA.window_s} as bucket
      from (select {fixtures.REQUESTER} as u, {fixtures.ADDRESS} as a, event_ms, event_id as seq from e)""",
    "admission": f"""
      select *, row_number() over (partition by identifier, bucket order by event_ms, seq) as number
      from requests""",
    "outbox": """
      select transaction_id, concat('transactionId:', transaction_id, '|userId:', user_id,
        '|cardFingerprint:', card_fingerprint, '|amount:', cast(amount as varchar), '|currency:', currency,
        '|merchantId:', merchant_id, '|merchantCategoryCode:', merchant_category_code,
        '|merchantRiskTier:', merchant_risk_tier, '|deviceFingerprint:', device_fingerprint,
        '|ipAddress:', ip_address, '|ipCountry:', ip_country, '|billingCountry:', billing_country) as payload,
        'PENDING' as status, created_at
      from stored""",
    "unpublished": """
      select * from outbox o where not exists (
        select 1 from stored s where s.transaction_id = o.transaction_id and s.amount < 3000)""",
    "overrides": f"""
      select event_id * 3 + n as override_id, {_columns(fixtures.OVERRIDE)},
        ts + interval 1 day + n * interval 2 hour as requested_at
      from (select *, unnest(range(0, k % 3 + 1)) as n from e)""",
}


def _decided(name: str, flagged: str, counted: str) -> None:
    total = f"{BEHAVIOUR} + {RULES} + {ENRICHMENT}"
    PARTS[name] = f"""
      select transaction_id, 'AUTO_REJECTED' as decision, cast(100 as bigint) as risk_score,
        hard_reason as decision_reason, 'HARD_RULES' as processing_stage, {AT} as decided_at,
        cast(null as bigint) as behavioral_score, cast(null as bigint) as rule_score,
        cast(null as bigint) as enrichment_score
      from {flagged} where hard_reason is not null
      union all
      select transaction_id,
        case when total >= 60 then 'AUTO_REJECTED' when total >= 20 then 'NEEDS_REVIEW' else 'APPROVED' end,
        cast(total as bigint), 'RULE_ENGINE', 'STAGE_4', {AT}, cast(behaviour as bigint),
        cast(rules as bigint), cast(enrichment as bigint)
      from (select *, {BEHAVIOUR} as behaviour, {RULES} as rules, {ENRICHMENT} as enrichment,
              {total} as total from {counted})"""


_decided("decisions", "flagged", "counted")
_decided("decisions_true", "flagged", "counted_true")
_decided("payload_decisions", "payload_flagged", "payload_counted")
PARTS["uses"] = "select 'u' || (user_id % 50) as transaction_id, event_ms, event_id as seq from e"
PARTS["won"] = """
      select transaction_id, min(event_ms) as event_ms from uses group by transaction_id
      union all
      select w.transaction_id, min(u.event_ms) from won w join uses u
        on u.transaction_id = w.transaction_id and u.event_ms >= w.event_ms + 86400000
      group by w.transaction_id"""
PARTS["payload_latest"] = """
      select * from payload_decisions
      qualify row_number() over (partition by transaction_id order by decided_at desc) = 1"""
PARTS["asked"] = """
      select o.*, new_decision in ('APPROVED', 'AUTO_REJECTED') as valid, d.decision as latest,
        last_value(case when new_decision in ('APPROVED', 'AUTO_REJECTED') then new_decision end ignore nulls)
          over (partition by o.transaction_id order by requested_at, override_id
                rows between unbounded preceding and 1 preceding) as earlier
      from overrides o left join decisions_true d on d.transaction_id = o.transaction_id"""
PARTS["outcomes"] = """
      select *, case when not valid then 'INVALID' when latest is null then 'NOT_FOUND'
          when coalesce(earlier, latest) = 'APPROVED' and new_decision = 'APPROVED' then 'NOOP'
          else 'APPLIED' end as outcome,
        case when valid and latest is not null then coalesce(earlier, latest) end as previous_decision
      from asked"""
PARTS["review"] = """
      select d.transaction_id, risk_score, decided_at, amount, currency, merchant_id, ip_country, billing_country
      from decisions_true d join stored s using (transaction_id) where decision = 'NEEDS_REVIEW'
      order by decided_at desc, transaction_id desc limit 20"""
PARTS["routed"] = """
      select id, transaction_id, failure_type, case when retry then 'RETRYING' else 'QUARANTINED' end as status,
        cast(retry as bigint) as retry_count, error_message, original_payload, created_at,
        case when retry then created_at end as last_retried_at,
        case when not retry then created_at end as resolved_at
      from first_failures"""

_ORDER = list(PARTS)


def _with(select: str) -> str:
    """``select`` with the parts it uses."""
    needed: set[str] = set()
    pending = [select]
    while pending:
        words = set(pending.pop().replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in _ORDER:
            if name in words and name not in needed:
                needed.add(name)
                pending.append(PARTS[name])
    parts = ",\n".join(f"{name} as ({PARTS[name]})" for name in sorted(needed, key=_ORDER.index))
    text = f"with recursive {parts}\n{select}"
    return text.replace(" as string)", " as varchar)")


_FINAL = (
    "transaction_id, decision, risk_score, decision_reason, processing_stage, decided_at, behavioral_score, "
    "rule_score, enrichment_score"
)
_VIEW = "transaction_id, decision, risk_score, decision_reason, processing_stage, decided_at"
_TRIAGED = "id, transaction_id, failure_type, status, retry_count, last_retried_at, resolved_at"
_SIGNALS = "card_1m, card_5m, card_1h, device_cards_24h, ip_cards_1h"


def _signal(signal) -> str:
    return (
        f"select transaction_id, {signal.name} as n, {_tier(signal.name, signal.tiers)} as {signal.name}_score "
        "from counted"
    )


def _rules(expression: str) -> str:
    return f"select transaction_id, cast({expression} as bigint) as rule_score from tx"


_HITS = """
  select transaction_id, 'big_ticket' as name, cast(null as varchar) as group_name, cast(20 as bigint) as score
    from tx where amount > 420
  union all select transaction_id, 'risky_shop', null, 25 from tx where merchant_risk_tier = 'high'
  union all select transaction_id, 'betting_shop', null, 30 from tx where regexp_full_match(merchant_category_code, '799[0-9]')
  union all select transaction_id, 'abroad', null, 15 from tx where ip_country <> billing_country
  union all select transaction_id, 'big_and_risky', null, 35 from tx
    where amount >= 250 and merchant_risk_tier like 'hi%'
  union all select transaction_id, 'ring', 'ring', 60 from tx
    where amount > 420 and ip_country <> billing_country
  union all select transaction_id, 'watched', 'watched', 25 from tx
    where merchant_category_code in ('7995', '5912')"""


def _rule_list() -> str:
    def text(value: str | None) -> str:
        return "null" if value is None else "'" + value.replace("'", "''") + "'"

    rows = ", ".join(
        f"({i}, {text(n)}, {text(x)}, {s}, {str(on).lower()}, {text(g)}, {text(m)})"
        for i, n, x, s, on, g, m in fixtures.RULE_ROWS
    )
    return f"""
      select cast(id as bigint) as id, r.name, r.group_name, match_mode, enabled,
        concat('Rule: ', r.name, ' | Score: ', r.score, ' | Enabled: ', enabled, chr(10), 'Expression: ', expression,
          chr(10), case when r.group_name is null then 'Group: none'
            else concat('Group: ', r.group_name, ' (', match_mode, ')') end) as text,
        coalesce(h.hits, 0) as hits
      from (values {rows}) r(id, name, expression, score, enabled, group_name, match_mode)
      left join (select name, count(*) as hits from ({_HITS}) group by name) h
        on h.name = coalesce(r.group_name, r.name)"""


_REPUTATION = (
    "case when ip_address like '10.%' then 'MALICIOUS' when ip_address like '172.%' then 'SUSPICIOUS' "
    "else 'CLEAN' end as reputation, "
    f"cast({ENRICHMENT} as bigint) as enrichment_score, "
    "case when ip_address like 'fail.%' or ip_address like 'slow.%' then 'fallback' else 'simulated' end "
    "as enrichment_source"
)

_NUMBER = "seq % 17 <> 0"  # the amount of other rows is no number
_PREDICATES = {
    "bracket_nan": f"amount > 420 and {_NUMBER}",
    "product_nan": f"amount * 2 > 840 and {_NUMBER}",
    "same_nan": _NUMBER,
    "not_above": f"not (amount > 420 and {_NUMBER})",
    "binding": f"merchant_risk_tier <> 'high' and amount + 20 < 100 and {_NUMBER} or ip_country = 'RU'",
    "choice": f"{_NUMBER} and case when merchant_risk_tier = 'high' then amount > 100 else amount > 500 end",
    "pattern": "regexp_full_match(merchant_category_code, '5[0-9]+') and ip_country not like '%U%'",
}

_SELECTS = {
    "rule_predicates": " union all ".join(
        f"select transaction_id, '{name}' as name from tx where {text}" for name, text in _PREDICATES.items()
    ),
    "rule_errors": f"""
      select * from (values {", ".join(
          f"({i}, '{n}', '{x.replace(chr(39), chr(39) * 2)}')" for i, n, x, *_ in fixtures.PREDICATE_ROWS if n.endswith("_error")
      )}) r(id, name, expression), (select count(*) as unchecked from tx)""",
    "parse_payload": "select * from valid",
    "reject_missing_field": "select * from rejected",
    "dead_letter_header": "select transaction_id, original_payload, error_message from rejected",
    "serialize_payload": "select * from outbox",
    "store_requests": f"""
      select concat('txn_', substr(sha256(cast(seq as varchar)), 1, 32)) as transaction_id, user_id,
        card_fingerprint, cast(trunc(amount) as bigint) as amount, currency, merchant_id,
        merchant_category_code, merchant_risk_tier, device_fingerprint, ip_address, ip_country,
        billing_country, cast(null as varchar) as user_agent, 'PENDING' as status, {AT} as created_at
      from tx""",
    "reject_requests": """
      select seq, case when seq % 31 = 3 or seq % 37 = 3 then 'malformed body'
        when seq % 43 = 3 then 'wrong type' else 'missing currency' end as reject_reason
      from tx where seq % 31 = 3 or seq % 37 = 3 or seq % 43 = 3 or seq % 41 = 3""",
    "append_requests": f"""
      select concat('txn_', substr(sha256(cast(seq as varchar)), 1, 32)) as transaction_id, user_id,
        cast(trunc(amount) as bigint) as amount, currency, 'PENDING' as status, {AT} as created_at
      from tx where not (seq % 31 = 3 or seq % 37 = 3 or seq % 43 = 3 or seq % 41 = 3)""",
    "hard_rule_reasons": "select transaction_id, hard_reason from flagged",
    "hard_rule_survivors": "select * from live",
    "blocklist_join": "select transaction_id, card_fingerprint, "
    + _hard(blocked="card_fingerprint in (select concat('fpr_', cast(c_custkey as varchar)) from customer where c_acctbal < 0)")
    + " as hard_reason from tx",
    "sanctions_both_countries": "select transaction_id, "
    + _hard("billing_country", ("RU", "KP", "IR", "BY", "SY", "CA")) + " as hard_reason from tx",
    "card_velocity_1m": _signal(CARD_1M),
    "card_velocity_5m": _signal(CARD_5M),
    "card_velocity_1h": _signal(CARD_1H),
    "device_distinct_24h": _signal(DEVICE),
    "ip_distinct_1h": _signal(IP),
    "behavioral_score": f"select transaction_id, {_SIGNALS}, {BEHAVIOUR} as behavioral_score from counted",
    "optional_velocity": f"""
      select *, {_tier("user_5m", ((9, 25),))} as user_5m_score, {_tier("device_1m", ((4, 20),))} as device_1m_score
      from (select transaction_id, count(*) {_frame("user_id", 240 * 300_000)} as user_5m,
              case when trim(device_fingerprint) = '' then 0
                else count(*) {_frame("device_fingerprint", 240 * 60_000)} end as device_1m
            from live)""",
    "velocity_snapshot": f"""
      select card_fingerprint,
        count(*) filter (event_ms >= {AS_OF_MS - 60_000 * SNAPSHOT_SCALE}) as count_1m,
        count(*) filter (event_ms >= {AS_OF_MS - 300_000 * SNAPSHOT_SCALE}) as count_5m,
        count(*) filter (event_ms >= {AS_OF_MS - 3_600_000 * SNAPSHOT_SCALE}) as count_1h,
        count(*) as total
      from live where event_ms <= {AS_OF_MS} group by card_fingerprint""",
    "velocity_snapshots": f"""
      select card_fingerprint, as_of_ms,
        count(*) filter (event_ms >= as_of_ms - {60_000 * SNAPSHOT_SCALE}) as count_1m,
        count(*) filter (event_ms >= as_of_ms - {300_000 * SNAPSHOT_SCALE}) as count_5m,
        count(*) filter (event_ms >= as_of_ms - {3_600_000 * SNAPSHOT_SCALE}) as count_1h,
        count(*) as total
      from live join (select distinct event_ms // 86400000 * 86400000 + 43200000 as as_of_ms from e) on event_ms <= as_of_ms
      group by card_fingerprint, as_of_ms""",
    "arrival_order": """
      select transaction_id, source_partition, source_offset, cast(amount as double) as amount
      from (select 'txn_' || event_id as transaction_id, cast(k % 4 as integer) as source_partition,
              event_id * 2 + n as source_offset, case when (event_id + n) % 2 = 0 then 75 else 20000 end as amount, event_ms
            from e, (values (0), (1)) copies(n))
      qualify row_number() over (partition by transaction_id order by event_ms, source_partition, source_offset) = 1""",
    "stream_velocity_state": f"select transaction_id, {_SIGNALS} from counted",
    "ungrouped_rules": _rules(UNGROUPED),
    "group_all": _rules(ALL_GROUP),
    "group_any": _rules(ANY_GROUP),
    "rule_score": _rules(RULES),
    "rule_index": f"""
      select t.transaction_id, count(c.merchant) as hits, cast(coalesce(sum(c.score), 0) as bigint) as rule_score
      from tx t left join (select c_custkey % 7 + 1 as score, {_columns(fixtures.CUSTOMER_RULE)} from customer) c
        on c.merchant = t.merchant_id and t.amount > c.least and (t.ip_country <> 'US' or not c.abroad)
      group by t.transaction_id""",
    "rule_hits": f"select * from ({_HITS})",
    "list_rules": _rule_list(),
    "ip_reputation": f"select transaction_id, ip_address, {_REPUTATION} from tx",
    "enrichment_fallback": f"""
      select enrichment_source, reputation, count(*) as lookups, cast(sum(enrichment_score) as bigint) as score
      from (select {_REPUTATION} from tx) group by enrichment_source, reputation""",
    "score_breakdown": f"""
      select transaction_id, {_SIGNALS}, {BEHAVIOUR} as behavioral_score, cast({RULES} as bigint) as rule_score,
        cast({ENRICHMENT} as bigint) as enrichment_score
      from counted""",
    "decisions_scaled_windows": f"select {_FINAL} from decisions",
    "decisions_true_windows": f"select {_FINAL} from decisions_true",
    "payload_decisions": f"select {_FINAL} from payload_decisions",
    "stream_decisions": f"select {_FINAL} from payload_decisions",
    "decision_breakdown": "select decision, count(*) as decisions from decisions_true group by decision",
    "stage_share": """
      select processing_stage, decision_reason, count(*) as decisions,
        count(*) / cast((select count(*) from tx) as double) as share
      from decisions_true group by processing_stage, decision_reason""",
    "transactions_current": """
      select s.transaction_id, coalesce(l.decision, 'PENDING') as status, amount
      from stored s left join payload_latest l on l.transaction_id = s.transaction_id""",
    "latest_decision": f"select {_VIEW} from payload_latest",
    "duplicate_audit": """
      select transaction_id, count(*) as decision_count from payload_decisions
      group by transaction_id having count(*) > 1""",
    "idempotent_dedupe": "select transaction_id, event_ms, seq from claimed",
    "idempotent_dedupe_days": """
      select u.* from uses u join won using (transaction_id, event_ms)
      qualify row_number() over (partition by u.transaction_id, u.event_ms order by u.seq) = 1""",
    "override_guard": """
      select override_id, transaction_id, new_decision, previous_decision, outcome from outcomes""",
    "override_apply": """
      select d.transaction_id, coalesce(a.new_decision, d.decision) as decision, risk_score,
        a.reason as override_reason, a.analyst_id as override_by, a.requested_at as overridden_at
      from decisions_true d left join (
        select * from outcomes where outcome = 'APPLIED'
        qualify row_number() over (partition by transaction_id order by requested_at desc, override_id desc) = 1
      ) a on a.transaction_id = d.transaction_id""",
    "get_transaction": f"select * exclude (transaction_id) from stored where transaction_id = '{LOOKUP_ID}'",
    "get_risk_decision": f"select {_VIEW} from decisions_true where transaction_id = '{LOOKUP_ID}'",
    "pending_review": "select * from review",
    "review_text": """
      select row_number() over (order by decided_at desc, transaction_id desc) as position,
        concat(row_number() over (order by decided_at desc, transaction_id desc), '. Transaction: ',
          transaction_id, chr(10), '   Score: ', risk_score, ' | Amount: ', amount, ' ', currency, chr(10),
          '   Merchant: ', merchant_id, ' | IP Country: ', ip_country, ' | Billing Country: ',
          billing_country, chr(10), '   Flagged At: ', rtrim(cast(decided_at as varchar), '0')) as text
      from review""",
    "audit_tail": f"select {_VIEW} from decisions_true order by decided_at desc, transaction_id desc limit 40",
    "quota_admission": f"""
      select identifier, bucket, seq, number <= {fixtures.QUOTA.limit} as admitted from admission""",
    "quota_large_limit": """
      select identifier, bucket, event_ms, count(*) as requests, count(*) filter (rank <= 1500) as admitted
      from (select *, row_number() over (partition by identifier, bucket order by event_ms) as rank
            from (select case when user_id % 5 > 0 then 'hot' end as identifier,
                    epoch_ms(ts) // 3600000 * 3600000 as event_ms,
                    epoch_ms(ts) // 3600000 * 3600000 // 1000 // 864000 as bucket from events))
      group by identifier, bucket, event_ms""",
    "quota_headers": f"""
      select seq, cast({fixtures.QUOTA.limit} as bigint) as rate_limit,
        greatest(0, {fixtures.QUOTA.limit} - number) as remaining,
        case when number > {fixtures.QUOTA.limit}
          then {fixtures.QUOTA.window_s} - event_ms // 1000 % {fixtures.QUOTA.window_s} end as retry_after
      from admission""",
    "quota_totals": f"""
      select identifier, bucket, count(*) as requests, least(count(*), {fixtures.QUOTA.limit}) as admitted,
        greatest(0, count(*) - {fixtures.QUOTA.limit}) as rejected
      from requests group by identifier, bucket""",
    "outbox_pending": "select transaction_id, payload, status, created_at from unpublished",
    "outbox_publish": """
      select transaction_id, 'PUBLISHED' as status, created_at + interval 1 second as published_at
      from unpublished""",
    "outbox_relay": """
      select o.transaction_id, 'PUBLISHED' as status, o.created_at + interval 1 second as published_at, payload as value,
        case when s.amount < 3000 then 0 else 1 end as batch_id
      from outbox o join stored s using (transaction_id)""",
    "outbox_stuck": f"""
      select transaction_id, created_at from unpublished
      where created_at < make_timestamp({AS_OF_MS} * 1000) - interval 5 minute""",
    "dlq_classify": "select id, error_message, failure_type from typed",
    "dlq_route": f"select {_TRIAGED} from routed",
    "dlq_route_unknown_by_payload": f"""
      select {_TRIAGED} from (
        select *, case when failure_type = 'TRANSIENT' then 'RETRYING' else 'QUARANTINED' end as status,
          cast(failure_type = 'TRANSIENT' as bigint) as retry_count,
          case when failure_type = 'TRANSIENT' then created_at end as last_retried_at,
          case when failure_type <> 'TRANSIENT' then created_at end as resolved_at
        from typed t
        where not exists (select 1 from stored s
          where s.transaction_id = t.transaction_id and s.amount >= 9000)
        qualify row_number() over (
          partition by case when transaction_id = 'UNKNOWN' then original_payload else transaction_id end
          order by event_ms, seq) = 1)""",
    "dlq_retry_state": """
      select t.id, t.transaction_id, failure_type,
        case when attempt > 3 or failure_type = 'POISON_PILL' then 'QUARANTINED'
             when f.transaction_id is not null then 'RESOLVED' else 'RETRYING' end as status,
        case when failure_type = 'POISON_PILL' then 0 else least(attempt, 3) end as retry_count,
        case when failure_type = 'TRANSIENT' and attempt <= 3 then created_at end as last_retried_at,
        case when failure_type = 'POISON_PILL' or attempt > 3 then created_at
             when f.transaction_id is not null then make_timestamp(f.event_ms * 1000) end as resolved_at
      from (select *, row_number() over (partition by transaction_id, failure_type order by event_ms, seq) as attempt
            from typed) t
      left join (select transaction_id, event_ms from flagged where hard_reason is not null) f
        on f.transaction_id = t.transaction_id""",
    "dlq_replay": """
      select transaction_id as key, original_payload as value, retry_count as attempt
      from routed where status = 'RETRYING'""",
    "dlq_list": """
      select id, transaction_id, failure_type, status, retry_count, error_message, created_at
      from routed where status = 'QUARANTINED' order by created_at desc, id desc limit 20""",
    "dlq_text": """
      select row_number() over (order by created_at desc, id desc) as position,
        concat(row_number() over (order by created_at desc, id desc), '. Transaction: ', transaction_id, chr(10),
          '   Failure Type: ', failure_type, ' | Status: ', status, ' | Retries: ', retry_count, chr(10),
          '   Error: ', coalesce(error_message, 'none'), chr(10),
          '   Created At: ', rtrim(cast(created_at as varchar), '0')) as text
      from routed order by created_at desc, id desc limit 20""",
    "stream_dead_letters": "select transaction_id, original_payload, error_message from rejected",
    "stream_relay": "select transaction_id as key, payload as value from outbox",
    "stream_quota": f"""
      select identifier, event_ms // {fixtures.QUOTA.window_s * 1000} * {fixtures.QUOTA.window_s * 1000} as window_ms,
        count(*) as requests, least(count(*), {fixtures.QUOTA.limit}) as admitted,
        greatest(0, count(*) - {fixtures.QUOTA.limit}) as rejected
      from requests group by all""",
    "stream_claims": "select distinct transaction_id from failures",
    "stream_dlq_attempts": """
      select transaction_id, original_payload, failure_type,
        case when failure_type = 'TRANSIENT' and attempt <= 3 then 'RETRYING' else 'QUARANTINED' end as status,
        case when failure_type = 'POISON_PILL' then 0 else least(attempt, 3) end as retry_count
      from (select *, row_number() over (
              partition by transaction_id, failure_type order by event_ms, seq) as attempt from typed)""",
    "stream_dlq": """
      select transaction_id, original_payload, failure_type, status, retry_count from routed""",
    "stream_replays": """
      select transaction_id as key, original_payload as value from routed where status = 'RETRYING'""",
}

_SELECTS["override_merge"] = _SELECTS["override_apply"]
ORACLES = {name: _with(select) for name, select in _SELECTS.items()}
