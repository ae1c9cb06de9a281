"""Velocity in a stream with state per key: each event is counted against what the store holds for its key.

The scoring stream reads the history of its windows in every batch. Here the state store keeps, per signal
family and key, the uses of the last window, so a batch touches the keys of its own events only. State ends: uses
older than the longest window of the family plus the allowed lateness are removed when the key is used again, and a
timer on the watermark removes what is left once nothing can reach it. Checkpoints from before uses were kept in
chunks cannot be continued.

Counts equal those of the batch operator while events come in time order: windows are ``(t - w, t]``, events
of equal time in one batch count each other, and a late event is counted without revising earlier counts.
Events later than ``lateness`` behind the watermark are dropped, and the work of a key is one task per batch.
So the history form stays the default of the scoring stream; this one is for many keys of modest rates.
Rows whose key is null, or that a guard of the signal skips, give no count.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from txnsieve.config import DEFAULT_SIGNALS, DAY_MS, VelocitySignal
from txnsieve.operators.velocity import MS, signal_families, signal_guard
from txnsieve.session import ship_package

#: Fixed value: the store that keyed state with timers needs.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
#: Uses in one value of the store.
CHUNK = 100_000
COUNTS = "transaction_id string, event_ms long, signal string, n long"


def window_counts(times: np.ndarray, asked: np.ndarray, window_ms: int) -> np.ndarray:
    """Uses in ``(t - window, t]`` of each asked time; ``times`` ascend."""
    return np.searchsorted(times, asked, "right") - np.searchsorted(times, asked - window_ms, "right")


def window_members(times: np.ndarray, members: Sequence[str], asked: np.ndarray, window_ms: int) -> np.ndarray:
    """Distinct members with a use in ``(t - window, t]`` of each asked time; both times ascend."""
    inside: Counter[str] = Counter()
    counts, enter, leave = [], 0, 0
    for t in asked.tolist():
        while enter < len(times) and times[enter] <= t:
            inside[members[enter]] += 1
            enter += 1
        while leave < enter and times[leave] <= t - window_ms:
            inside[members[leave]] -= 1
            if not inside[members[leave]]:
                del inside[members[leave]]
            leave += 1
        counts.append(len(inside))
    return np.array(counts, dtype=np.int64)


class VelocityState(StatefulProcessor):
    """Counts the signals of a family for the events of one key.

    Every call to the store is a round trip, and keys of few events make most calls. So a key takes one read, one
    write and one timer per batch, and returns one frame; beyond ``CHUNK`` uses it takes a read and a write per chunk.
    """

    def __init__(self, families: list[list[VelocitySignal]], lateness_ms: int) -> None:
        self.families = families
        self.lateness_ms = lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.uses = handle.getMapState("uses", "chunk bigint", "times binary, members string, chunks bigint")

    def kept_ms(self, family: int) -> int:
        return max(s.window_ms for s in self.families[family]) + self.lateness_ms

    def held(self) -> tuple[np.ndarray, list[str], int]:
        """The uses of the key in order of time, and the number of their chunks."""
        first = self.uses.getValue((0,))
        if first is None:
            return np.empty(0, np.int64), [], 0
        chunks = [first, *[self.uses.getValue((i,)) for i in range(1, first[2])]]
        return np.concatenate([np.frombuffer(c[0], np.int64) for c in chunks]), [m for c in chunks for m in json.loads(c[1])], len(chunks)

    def hold(self, times: np.ndarray, members: list[str], before: int) -> None:
        chunks = -(-len(times) // CHUNK)
        for i in range(chunks):
            part = slice(i * CHUNK, (i + 1) * CHUNK)
            self.uses.updateValue((i,), (times[part].tobytes(), json.dumps(members[part]), chunks))
        for i in range(chunks, before):
            self.uses.removeKey((i,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        family = int(key[0])
        signals = self.families[family]
        frames = list(rows)
        asked = np.concatenate([f[MS].to_numpy(dtype=np.int64) for f in frames])
        order = np.argsort(asked, kind="stable")
        asked = asked[order]
        ids = np.concatenate([f["transaction_id"].to_numpy(dtype=object) for f in frames])[order]
        times, members, chunks = self.held()
        last = int(times[-1]) if len(times) else None
        limit = min(int(asked[0]), int(asked[-1]) - self.lateness_ms) - max(s.window_ms for s in signals)
        kept = int(np.searchsorted(times, limit, "right"))
        times = np.concatenate([times[kept:], asked])
        order_of_all = np.argsort(times, kind="stable")
        times = times[order_of_all]
        if signals[0].member:
            new = np.concatenate([f["member"].to_numpy(dtype=object) for f in frames])[order].tolist()
            both = members[kept:] + new
            members = [both[i] for i in order_of_all.tolist()]
        self.hold(times, members, chunks)
        if int(times[-1]) != last:
            if last is not None:
                self.handle.deleteTimer(last + self.kept_ms(family))
            self.handle.registerTimer(int(times[-1]) + self.kept_ms(family))
        counts = [
            window_members(times, members, asked, s.window_ms) if s.member else window_counts(times, asked, s.window_ms) for s in signals
        ]
        yield pd.DataFrame(
            {
                "transaction_id": np.tile(ids, len(signals)),
                MS: np.tile(asked, len(signals)),
                "signal": np.repeat([s.name for s in signals], len(asked)),
                "n": np.concatenate(counts),
            }
        )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Forgets a key that has not been used since the timer was set."""
        times, _, _ = self.held()
        if len(times) and int(times[-1]) + self.kept_ms(int(key[0])) <= expiredTimerInfo.getExpiryTimeInMs():
            self.uses.clear()
        return iter([])


def velocity_state(
    events: DataFrame, signals: tuple[VelocitySignal, ...] = DEFAULT_SIGNALS, lateness_ms: int = DAY_MS
) -> DataFrame:
    """Stream of ``transaction_id, event_ms, signal, n``: one row per event and signal that counts it.

    The session needs the state store of ``PROVIDER`` when the stream starts.
    """
    ship_package(events.sparkSession)
    families = signal_families(signals)
    counted = [
        F.when(
            signal_guard(f[0]),
            F.struct(
                F.lit(i).alias("family"), F.col(f[0].key).alias("key"),
                (F.col(f[0].member) if f[0].member else F.lit("")).alias("member"),
            ),
        )
        for i, f in enumerate(families)
    ]
    each = (
        events.select("transaction_id", MS, F.explode(F.filter(F.array(*counted), lambda c: c.isNotNull())).alias("c"))
        .select("transaction_id", MS, "c.family", "c.key", "c.member", F.timestamp_millis(MS).alias("_at"))
        .withWatermark("_at", f"{lateness_ms} milliseconds")
    )
    return each.groupBy("family", "key").transformWithStateInPandas(
        VelocityState(families, lateness_ms), COUNTS, "Append", "EventTime"
    )


def by_transaction(counts: DataFrame, signals: tuple[VelocitySignal, ...] = DEFAULT_SIGNALS) -> DataFrame:
    """One row per transaction with a column per signal; signals that skipped it count 0."""
    return counts.groupBy("transaction_id").agg(
        *[F.coalesce(F.max(F.when(F.col("signal") == s.name, F.col("n"))), F.lit(0)).alias(s.name) for s in signals]
    )
