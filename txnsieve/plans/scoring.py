"""From events to decisions: one logical plan for batch runs and micro-batches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnsieve.config import Scoring
from txnsieve.operators.decisions import RECORD, hard_decisions, scored_decisions
from txnsieve.operators.dedupe import claim_first
from txnsieve.operators.enrichment import with_reputation
from txnsieve.operators.hard_rules import hits, survivors, with_hard_reason
from txnsieve.operators.parsing import parse_payloads, rejected_records, valid_events
from txnsieve.operators.rules import HITS, RuleSet, with_rules
from txnsieve.operators.velocity import MS, behavioral_score, with_velocity
from txnsieve.session import staged


def score_survivors(
    live: DataFrame,
    rules: RuleSet,
    reputation: DataFrame,
    scoring: Scoring = Scoring(),
    history: DataFrame | None = None,
) -> DataFrame:
    """Survivors of the hard rules with their signal counts and stage scores.

    Rules and reputation need no other row, so they run first and in place; the velocity joins then
    carry only keys and scores.
    """
    keys = dict.fromkeys(c for s in scoring.signals for c in (s.key, s.member) if c)
    enriched = with_reputation(with_rules(live, rules), reputation).select(
        "transaction_id", MS, "decided_at", *keys, HITS, "rule_score", "reputation",
        "enrichment_score", "enrichment_source",
    )
    counted = with_velocity(enriched, scoring.signals, uses=live, history=history)
    return counted.withColumn("behavioral_score", behavioral_score(scoring.signals))


def score_events(
    events: DataFrame,
    rules: RuleSet,
    reputation: DataFrame,
    scoring: Scoring = Scoring(),
    history: DataFrame | None = None,
    decided_at: Column | None = None,
    blocked_cards: DataFrame | None = None,
) -> DataFrame:
    """One decision per event. ``history`` holds earlier survivors within the longest window."""
    stamped = events.withColumn("decided_at", F.current_timestamp() if decided_at is None else decided_at)
    flagged = with_hard_reason(stamped, scoring.hard_rules, blocked_cards)
    at = F.col("decided_at")
    rejected = hard_decisions(hits(flagged), scoring.hard_rules.score, at)
    scored = score_survivors(survivors(flagged), rules, reputation, scoring, history)
    decided = scored_decisions(scored, scoring.cutoffs, at)
    return rejected.unionByName(decided).select(*RECORD, F.lit(rules.version).alias("rules_version"))


@dataclass(frozen=True)
class Scored:
    """Results of a run over payloads."""

    events: DataFrame
    decisions: DataFrame
    rejects: DataFrame


def score_payloads(
    payloads: DataFrame,
    rules: RuleSet,
    reputation: DataFrame,
    scoring: Scoring = Scoring(),
    raw: str = "value",
    decided_at: Column | None = None,
) -> Scored:
    """Parse, claim and score payload rows (``raw``, ``event_ms``, ``seq``).

    The parsed rows and the claimed events are written once each: claims and rejects share the
    parse, and every signal reads the events again.
    """
    parsed = staged(parse_payloads(payloads, raw), "parsed")
    events = staged(claim_first(valid_events(parsed, raw), scoring.claim_ttl_ms), "events")
    decisions = score_events(events, rules, reputation, scoring, decided_at=decided_at)
    return Scored(events, decisions, rejected_records(parsed, raw))
