"""Every threshold, window and word list of the scoring jobs, as parameters.

The defaults are fixed values: they must equal the published behaviour, so that decisions agree.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

SECOND_MS = 1_000
MINUTE_MS = 60 * SECOND_MS
HOUR_MS = 60 * MINUTE_MS
DAY_MS = 24 * HOUR_MS

# Decision, status and failure names.
APPROVED = "APPROVED"
NEEDS_REVIEW = "NEEDS_REVIEW"
AUTO_REJECTED = "AUTO_REJECTED"
PENDING = "PENDING"
PUBLISHED = "PUBLISHED"
RETRYING = "RETRYING"
RESOLVED = "RESOLVED"
QUARANTINED = "QUARANTINED"
TRANSIENT = "TRANSIENT"
POISON_PILL = "POISON_PILL"

# Topics.
SCORING_TOPIC = "transaction.received"
DEAD_LETTER_TOPIC = "transaction.scoring.failed"


@dataclass(frozen=True)
class HardRules:
    """First-stage rejections, checked in the order card, amount, country."""

    blocked_cards: tuple[str, ...] = ("fpr_BLOCKED_001", "fpr_BLOCKED_002", "fpr_BLOCKED_003")
    amount_cap: float = 10_000.0
    sanctioned_countries: tuple[str, ...] = ("RU", "KP", "IR", "BY", "SY")
    # ("ip_country", "billing_country") also screens the billing country.
    sanction_columns: tuple[str, ...] = ("ip_country",)
    score: int = 100


@dataclass(frozen=True)
class VelocitySignal:
    """One sliding-window signal over event time; the window is ``(t - window_ms, t]``.

    Without ``member`` the signal counts events per ``key``; with it, distinct members per ``key``.
    ``tiers`` are ``(at least, score)`` pairs, highest first.
    """

    name: str
    key: str
    window_ms: int
    tiers: tuple[tuple[int, int], ...]
    member: str | None = None
    skip_blank: bool = False
    skip_prefixes: tuple[str, ...] = ()

    def scaled(self, factor: int) -> VelocitySignal:
        return replace(self, window_ms=self.window_ms * factor)


CARD_1M = VelocitySignal("card_1m", "card_fingerprint", MINUTE_MS, ((5, 30), (3, 15)))
CARD_5M = VelocitySignal("card_5m", "card_fingerprint", 5 * MINUTE_MS, ((8, 25), (6, 15)))
CARD_1H = VelocitySignal("card_1h", "card_fingerprint", HOUR_MS, ((20, 20), (15, 10)))
DEVICE_CARDS_24H = VelocitySignal(
    "device_cards_24h", "device_fingerprint", DAY_MS, ((10, 40), (5, 20), (3, 10)),
    member="card_fingerprint", skip_blank=True,
)
IP_CARDS_1H = VelocitySignal(
    "ip_cards_1h", "ip_address", HOUR_MS, ((10, 40), (5, 25), (3, 10)),
    member="card_fingerprint", skip_blank=True, skip_prefixes=("127.",),
)
DEFAULT_SIGNALS = (CARD_1M, CARD_5M, CARD_1H, DEVICE_CARDS_24H, IP_CARDS_1H)

# Described in prose only, so off by default; "more than n" becomes "at least n + 1".
USER_5M = VelocitySignal("user_5m", "user_id", 5 * MINUTE_MS, ((9, 25),))
DEVICE_1M = VelocitySignal("device_1m", "device_fingerprint", MINUTE_MS, ((4, 20),), skip_blank=True)


def scaled_signals(card: int, device: int, ip: int) -> tuple[VelocitySignal, ...]:
    """The default signals with longer windows, for sparse data."""
    return (
        CARD_1M.scaled(card), CARD_5M.scaled(card), CARD_1H.scaled(card),
        DEVICE_CARDS_24H.scaled(device), IP_CARDS_1H.scaled(ip),
    )


@dataclass(frozen=True)
class Cutoffs:
    """Score cut-offs of the final decision."""

    reject: int = 60
    review: int = 20


@dataclass(frozen=True)
class Quota:
    """Fixed-window request quota."""

    limit: int = 100
    window_s: int = 60


@dataclass(frozen=True)
class Triage:
    """Dead-letter classification and retry limits; transient words are checked first."""

    transient_words: tuple[str, ...] = (
        "connection", "timeout", "unavailable", "refused", "redis", "datasource", "could not execute",
    )
    poison_words: tuple[str, ...] = (
        "nullpointer", "numberformat", "illegal argument", "could not deserialize", "constraint violation",
    )
    max_retries: int = 3


@dataclass(frozen=True)
class Scoring:
    """All parameters of a scoring run."""

    hard_rules: HardRules = field(default_factory=HardRules)
    signals: tuple[VelocitySignal, ...] = DEFAULT_SIGNALS
    cutoffs: Cutoffs = field(default_factory=Cutoffs)
    claim_ttl_ms: int = DAY_MS


# A side is broadcast only when its counted rows do not exceed this.
MAX_BROADCAST_ROWS = 100_000
# More enabled rules than these are not read to the driver: the executors read them from the shared folder.
MAX_DRIVER_RULES = 50_000
# Hot keys are spread over this many salts when a lookup side is too big to broadcast.
LOOKUP_SALTS = 16
# Length of the time slices that split the rows of one override target over tasks.
SLICE_MS = HOUR_MS
