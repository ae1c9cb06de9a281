from __future__ import annotations

import random

import pandas as pd
import pytest
from checks import plan_text
from pyspark.sql import functions as F

from txnsieve.config import (
    CARD_1H, CARD_1M, CARD_5M, DAY_MS, DEFAULT_SIGNALS, DEVICE_CARDS_24H, HOUR_MS, IP_CARDS_1H, MINUTE_MS,
)
from txnsieve.functions.scores import tier_score
from txnsieve.operators.levels import ASKED, AT, running_levels
from txnsieve.operators.velocity import (
    behavioral_score, event_uses, family_spread, slice_length, velocity_levels, velocity_snapshot, with_velocity,
)
from txnsieve.session import staged
from txnsieve.streaming.velocity_state import VelocityState

COLUMNS = "transaction_id string, card_fingerprint string, device_fingerprint string, ip_address string, event_ms long"
T0 = 1_700_000_000_000


def frame(spark, rows):
    return spark.createDataFrame([(f"t{i}", *row) for i, row in enumerate(rows)], COLUMNS)


def counts(spark, rows, signal, **kwargs):
    found = with_velocity(frame(spark, rows), (signal,), **kwargs).collect()
    return [r[signal.name] for r in sorted(found, key=lambda r: int(r.transaction_id[1:]))]


def brute(rows, signal):
    result = []
    keys = {"card_fingerprint": 0, "device_fingerprint": 1, "ip_address": 2}
    k = keys[signal.key]
    for row in rows:
        key = row[k]
        if signal.skip_blank and (key is None or not key.strip()) or key.startswith(signal.skip_prefixes or "\0"):
            result.append(0)
            continue
        inside = [r for r in rows if r[k] == key and row[3] - signal.window_ms < r[3] <= row[3]]
        result.append(len({r[0] for r in inside}) if signal.member else len(inside))
    return result


@pytest.mark.parametrize("signal", [CARD_1M, CARD_5M, CARD_1H])
def test_window_is_open_at_its_start(spark, signal):
    w = signal.window_ms
    rows = [("c", "d", "1.1.1.1", T0), ("c", "d", "1.1.1.1", T0 + w - 1), ("c", "d", "1.1.1.1", T0 + w)]
    assert counts(spark, rows, signal) == [1, 2, 2]


@pytest.mark.parametrize("signal", [DEVICE_CARDS_24H, IP_CARDS_1H])
def test_distinct_window_is_open_at_its_start(spark, signal):
    w = signal.window_ms
    inside = [("a", "d", "1.1.1.1", T0), ("b", "d", "1.1.1.1", T0 + w - 1)]
    outside = [("a", "d", "1.1.1.1", T0), ("b", "d", "1.1.1.1", T0 + w)]
    assert counts(spark, inside, signal) == [1, 2]
    assert counts(spark, outside, signal) == [1, 1]


def test_reuse_refreshes_a_member_and_counts_once(spark):
    rows = [("a", "d", "x", T0), ("a", "d", "x", T0 + DAY_MS - 1), ("b", "d", "x", T0 + 2 * DAY_MS - 2)]
    assert counts(spark, rows, DEVICE_CARDS_24H) == [1, 1, 2]


def test_equal_times_count_each_other(spark):
    rows = [("a", "d", "x", T0), ("a", "d", "x", T0), ("b", "d", "x", T0)]
    assert counts(spark, rows, CARD_1M) == [2, 2, 1]
    assert counts(spark, rows, DEVICE_CARDS_24H) == [2, 2, 2]


def test_guards_skip_rows(spark):
    rows = [("a", " ", "127.0.0.1", T0), ("b", "", "", T0 + 1), ("c", "d", "1.1.1.1", T0 + 2)]
    assert counts(spark, rows, DEVICE_CARDS_24H) == [0, 0, 1]
    assert counts(spark, rows, IP_CARDS_1H) == [0, 0, 1]


@pytest.mark.parametrize("span", [3 * MINUTE_MS, 3 * HOUR_MS, 4 * DAY_MS])
def test_hot_keys_match_brute_force(spark, span):
    """A third of the rows on one card, one device and one address, with ties and slice borders."""
    rng = random.Random(span)
    rows = []
    for _ in range(240):
        hot = rng.random() < 0.34
        at = T0 - T0 % DAY_MS + rng.choice([rng.randrange(span), rng.randrange(0, span, MINUTE_MS)])
        rows.append(
            (
                "hot" if hot else f"c{rng.randrange(9)}",
                "hot" if rng.random() < 0.34 else rng.choice(["", "d1", "d2"]),
                "hot" if rng.random() < 0.34 else rng.choice(["127.1.1.1", "9.9.9.9"]),
                at,
            )
        )
    found = with_velocity(frame(spark, rows), DEFAULT_SIGNALS).collect()
    found = sorted(found, key=lambda r: int(r.transaction_id[1:]))
    for signal in DEFAULT_SIGNALS:
        assert [r[signal.name] for r in found] == brute(rows, signal), signal.name


@pytest.mark.parametrize(("least", "most"), [(0, 10_000), (20, 10_000), (20, 1)])
def test_hot_and_other_slices_agree(spark, monkeypatch, least, most):
    """All slices in parts, the hot ones only, and all of them since the hot ones are too many to list."""
    monkeypatch.setattr("txnsieve.operators.velocity.HOT_EVENTS", least)
    monkeypatch.setattr("txnsieve.operators.velocity.MAX_HOT_SLICES", most)
    rng = random.Random(least)
    day = T0 - T0 % DAY_MS
    rows = [
        (rng.choice(["hot", "hot", "a", "b"]), rng.choice(["hot", "hot", "d", ""]), rng.choice(["hot", "9.9.9.9", "127.1.1.1"]), day + rng.randrange(0, 3 * HOUR_MS, 20_000))
        for _ in range(150)
    ]
    found = sorted(with_velocity(frame(spark, rows), DEFAULT_SIGNALS).collect(), key=lambda r: int(r.transaction_id[1:]))
    for signal in DEFAULT_SIGNALS:
        assert [r[signal.name] for r in found] == brute(rows, signal), signal.name


def test_events_that_no_window_carries_on_are_dealt_once(spark):
    """Over many slices of a whole family, an event is shuffled again only where a window reaches the next slice."""
    family = [CARD_1M, CARD_5M, CARD_1H]
    length = slice_length(family)
    start = T0 - T0 % length
    rows = frame(spark, [("c", "d", "x", start + i * (length // 40)) for i in range(400)])
    dealt = event_uses(rows, family, F.lit(1), length)
    assert 400 < dealt.count() <= 500
    crossing = [start + n * length + d for n in (1, 2, 3) for d in (-HOUR_MS, -HOUR_MS + 1, -1, 0, HOUR_MS - 1, HOUR_MS)]
    near = [("c", "d", "x", at) for at in crossing]
    found = sorted(with_velocity(frame(spark, near), tuple(family)).collect(), key=lambda r: int(r.transaction_id[1:]))
    for signal in family:
        assert [r[signal.name] for r in found] == brute(near, signal)


def test_hot_slices_are_found_by_one_scan(spark, monkeypatch):
    """Hot keys of two families, one with its events on both sides of a border; others in the same cells are not listed."""
    monkeypatch.setattr("txnsieve.operators.velocity.HOT_EVENTS", 20)
    monkeypatch.setattr("txnsieve.operators.velocity.CELLS", 1)
    day = T0 - T0 % DAY_MS
    rows = [("c", "hot", "9.9.9.9", day + i) for i in range(11)] + [(f"c{i}", f"d{i % 4}", "127.1.1.1", day + i) for i in range(40)]
    families = [[CARD_1H], [DEVICE_CARDS_24H], [IP_CARDS_1H]]
    table = staged(frame(spark, rows), "rows")
    card, device, ip = family_spread(table, families)
    length = slice_length(families[0])
    assert (card.events, device.events, ip.events) == (51, 51, 11)
    assert card.hot == [("c", day - day % length), ("c", day - day % length + length)]
    assert device.hot == [("hot", day), ("hot", day + DAY_MS)] and ip.hot == [("9.9.9.9", day), ("9.9.9.9", day + HOUR_MS)]


def test_changes_of_slices_that_are_not_hot_are_made_once_and_after_the_shuffle(spark):
    rows = staged(frame(spark, [("a", "d", "9.9.9.9", T0)]), "rows")
    for signals, readers in (((CARD_1M, CARD_5M, CARD_1H), 2), ((DEVICE_CARDS_24H,), 3)):
        plan = plan_text(with_velocity(rows, signals))
        assert plan.count("FileScan") == readers
        assert plan.count("Window") <= 2


def test_history_fills_windows_but_is_not_returned(spark):
    rows = [("a", "d", "1.1.1.1", T0), ("b", "d", "1.1.1.1", T0 + 10), ("a", "d", "1.1.1.1", T0 + 20)]
    whole = frame(spark, rows)
    late = whole.where(F.col("transaction_id") == "t2")
    found = with_velocity(late, DEFAULT_SIGNALS, history=whole.where(F.col("transaction_id") != "t2")).collect()
    assert len(found) == 1
    assert (found[0].card_1m, found[0].device_cards_24h, found[0].ip_cards_1h) == (2, 2, 2)


@pytest.mark.parametrize(
    ("signal", "scores"),
    [
        (CARD_1M, {2: 0, 3: 15, 4: 15, 5: 30}),
        (CARD_5M, {5: 0, 6: 15, 7: 15, 8: 25}),
        (CARD_1H, {14: 0, 15: 10, 19: 10, 20: 20}),
        (DEVICE_CARDS_24H, {2: 0, 3: 10, 5: 20, 9: 20, 10: 40}),
        (IP_CARDS_1H, {2: 0, 3: 10, 5: 25, 9: 25, 10: 40}),
    ],
)
def test_tiers(spark, signal, scores):
    df = spark.createDataFrame([(n,) for n in scores], "n long")
    found = {r.n: r.s for r in df.select("n", tier_score(F.col("n"), signal.tiers).alias("s")).collect()}
    assert found == scores


def test_highest_behavioural_score(spark):
    row = spark.createDataFrame([(99, 99, 99, 99, 99)], ", ".join(f"{s.name} long" for s in DEFAULT_SIGNALS))
    assert row.select(behavioral_score()).first()[0] == 155


def test_snapshot_counts_both_ends(spark):
    rows = [("a", "d", "x", T0 - age) for age in (0, MINUTE_MS, MINUTE_MS + 1, HOUR_MS, HOUR_MS + 1)]
    row = velocity_snapshot(frame(spark, rows), T0).first()
    assert (row.count_1m, row.count_5m, row.count_1h, row.total) == (2, 3, 4, 5)


def test_no_frame_visits_rows_again_and_rows_combine_before_the_shuffle(spark):
    plan = plan_text(with_velocity(frame(spark, [("a", "d", "x", T0)]), DEFAULT_SIGNALS))
    assert "RangeFrame" not in plan and "collect_set" not in plan
    assert "partial_sum" in plan and "partial_min" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("parts", [1, 7, 96])
def test_parts_of_a_slice_carry_what_came_before(spark, parts):
    rng = random.Random(parts)
    rows = [("hot" if rng.random() < 0.7 else "cold", rng.randrange(5000), rng.choice([1, -1]), 1) for _ in range(600)]
    changes = spark.createDataFrame(rows, f"k string, {AT} long, n long, {ASKED} long")
    found = {(r["k"], r[AT]): r["n"] for r in running_levels(changes, "k", ["n"], 1000, parts).collect()}
    for k, at in {(k, at) for k, at, _, _ in rows}:
        assert found.pop((k, at)) == sum(n for o, t, n, _ in rows if o == k and at - at % 1000 <= t <= at)
    assert not found


def test_a_hot_device_of_one_day_is_spread_over_tasks(spark):
    """Two hundred thousand events of one device in one slice."""
    day = T0 - T0 % DAY_MS
    rows = spark.range(200_000).selectExpr(
        "concat('t', id) transaction_id", "concat('c', id % 500) card_fingerprint", "'hot' device_fingerprint",
        "'1.1.1.1' ip_address", f"{day} + id * 400 event_ms",
    )
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        for signal, least in ((DEVICE_CARDS_24H, 500), (IP_CARDS_1H, 500)):
            levels = velocity_levels(rows, [signal])
            # The sum is asked for as well, else the optimizer drops the window.
            tasks = levels.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("rows"), F.max(signal.name)).collect()
            assert len(tasks) >= 16 and max(r["rows"] for r in tasks) <= 200_000 // 8
            whole = velocity_levels(rows, [signal], parts=1)
            tasks = whole.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("rows"), F.max(signal.name)).collect()
            assert len(tasks) <= 24
            assert levels.agg(F.max(signal.name)).first()[0] == least
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


class Store:
    """State of one key and its timers, with the number of calls."""

    def __init__(self):
        self.held, self.timers, self.calls = {}, set(), 0

    def getMapState(self, *names):
        return self

    def __getattr__(self, name):
        acts = {
            "getValue": lambda k: self.held.get(k), "updateValue": self.held.__setitem__, "removeKey": self.held.pop,
            "registerTimer": self.timers.add, "deleteTimer": self.timers.remove, "clear": self.held.clear,
        }

        def call(*given):
            self.calls += 1
            return acts[name](*given)

        return call


@pytest.mark.parametrize("chunk", [100_000, 3])
def test_a_key_of_a_stream_takes_few_calls_of_the_store(monkeypatch, chunk):
    monkeypatch.setattr("txnsieve.streaming.velocity_state.CHUNK", chunk)
    for family in ([CARD_1M, CARD_5M, CARD_1H], [DEVICE_CARDS_24H]):
        state, store, rng, seen = VelocityState([family], DAY_MS), Store(), random.Random(chunk), []
        state.init(store)
        span = family[-1].window_ms
        for batch in range(4):
            rows = [(f"c{rng.randrange(5)}", T0 + batch * span + rng.randrange(span)) for _ in range(30)]
            seen += rows
            store.calls = 0
            new = pd.DataFrame([(f"t{i}", at, card if family[0].member else "") for i, (card, at) in enumerate(rows)], columns=["transaction_id", "event_ms", "member"])
            frames = list(state.handleInputRows((0, "k"), iter([new[:10], new[10:]]), None))
            assert len(frames) == 1 and len(store.timers) == 1
            assert chunk < 1000 or store.calls <= 4
            found = {(r.transaction_id, r.signal): r.n for r in frames[0].itertuples()}
            for s in family:
                for i, (_, at) in enumerate(rows):
                    inside = [c for c, t in seen if at - s.window_ms < t <= at]
                    assert found[f"t{i}", s.name] == (len(set(inside)) if s.member else len(inside))
