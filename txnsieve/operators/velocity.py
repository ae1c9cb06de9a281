"""Sliding-window velocity signals and the behavioural score."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnsieve.config import DEFAULT_SIGNALS, HOUR_MS, MINUTE_MS, VelocitySignal
from txnsieve.functions.scores import tier_score
from txnsieve.functions.search import count_at_most, listed
from txnsieve.functions.text import is_blank, starts_with_any
from txnsieve.operators.levels import ASKED, AT, PARTS, SLICE, running_levels, slice_levels, slice_start, split_hot
from txnsieve.operators.lookups import lookup_join, shuffled

MS = "event_ms"
MAX_INSTANTS = 10_000
#: A key that may have more events than this in one slice is summed in parts of the slice, each a task of its own.
HOT_EVENTS = 200_000
#: Keys and slices fall into this many cells by their hash, to find those that may have as many.
CELLS = 65_536
#: Slices of event counts, in lengths of the longest window.
EVENT_SLICES = 4
#: Such keys and slices are listed on the driver up to this number; beyond, every slice is summed in parts.
MAX_HOT_SLICES = 10_000
#: Events of the slices that a task sums.
EVENTS_PER_TASK = 50_000


def signal_guard(signal: VelocitySignal) -> Column:
    """Rows that take part in a signal; the others neither score nor count."""
    key = F.col(signal.key)
    guard = key.isNotNull()
    if signal.skip_blank:
        guard = guard & ~is_blank(key)
    if signal.skip_prefixes:
        guard = guard & ~starts_with_any(key, signal.skip_prefixes)
    return guard


def event_uses(rows: DataFrame, signals: list[VelocitySignal], asked: Column, slice_ms: int) -> DataFrame:
    """Each event in its own slice, and in the next one if its longest window reaches it."""
    here = slice_start(F.col(MS), slice_ms)
    reaches = F.col(MS) + max(s.window_ms for s in signals) > here + slice_ms

    def use(slice_: Column, ask: Column) -> Column:
        return F.struct(slice_.alias(SLICE), ask.cast("long").alias(ASKED))

    both = F.when(reaches, F.array(use(here, asked), use(here + slice_ms, F.lit(0)))).otherwise(F.array(use(here, asked)))
    return rows.select(signals[0].key, MS, F.inline(both))


def event_changes(uses: DataFrame, signals: list[VelocitySignal], slice_ms: int) -> DataFrame:
    """What the events of a slice change in it: they enter every window at their time and leave window ``w`` at their time + ``w``.

    Events of the slice before enter at its start the windows that they are still in. Events of one time are one
    row, so at most one row is asked for at an instant.
    """
    key = signals[0].key
    merged = uses.groupBy(key, SLICE, MS).agg(F.count("*").alias("_events"), F.sum(ASKED).alias(ASKED))
    inside = {s.name: F.col(MS) + s.window_ms > F.col(SLICE) for s in signals}

    def change(at: Column, values: dict[str, Column], ask: Column) -> Column:
        numbers = [values.get(s.name, F.lit(0)).cast("long").alias(s.name) for s in signals]
        return F.struct(at.alias(AT), *numbers, ask.cast("long").alias(ASKED))

    entering = change(F.greatest(MS, SLICE), {n: F.when(i, F.col("_events")).otherwise(0) for n, i in inside.items()}, F.col(ASKED))
    leaving = [
        F.when(
            inside[s.name] & (F.col(MS) + s.window_ms < F.col(SLICE) + slice_ms),
            change(F.col(MS) + s.window_ms, {s.name: -F.col("_events")}, F.lit(0)),
        )
        for s in signals
    ]
    changes = F.filter(F.array(entering, *leaving), lambda c: c.isNotNull())
    return merged.select(key, SLICE, F.inline(changes))


def member_changes(rows: DataFrame, signal: VelocitySignal, asked: Column) -> DataFrame:
    """A member counts while its last use is younger than the window.

    With slices as long as the window, the members at an instant are those used in the slice so far,
    and those of the previous slice whose last use is still young and that were not used again. Per
    key, member and slice that needs the first use there and the last use in the slice before: one
    map-side-combined aggregate, however hot the key.
    """
    key, member, window = signal.key, signal.member, signal.window_ms
    here = slice_start(F.col(MS), window)
    no_use = F.lit(None).cast("long")

    def use(slice_: Column, first: Column, before: Column) -> Column:
        return F.struct(slice_.alias(SLICE), first.alias("_first"), before.alias("_before"))

    uses = rows.select(
        key, member, F.inline(F.array(use(here, F.col(MS), no_use), use(here + window, no_use, F.col(MS))))
    )
    members = uses.groupBy(key, member, SLICE).agg(F.min("_first").alias("_first"), F.max("_before").alias("_before"))

    def change(at: Column, value: int) -> Column:
        return F.struct(
            at.alias(AT), F.lit(value).cast("long").alias(signal.name), F.lit(0).cast("long").alias(ASKED)
        )

    carried = F.when(F.col("_before").isNotNull(), F.col(SLICE))
    ended = F.when(F.col("_before").isNotNull(), F.least(F.col("_before") + window, F.col("_first")))
    changes = members.select(
        key, F.inline(F.array(change(F.col("_first"), 1), change(carried, 1), change(ended, -1)))
    ).where(F.col(AT).isNotNull())
    questions = rows.where(asked > 0).select(
        key, F.col(MS).alias(AT), F.lit(0).cast("long").alias(signal.name), F.lit(1).cast("long").alias(ASKED)
    )
    return changes.unionByName(questions)


@dataclass(frozen=True)
class Spread:
    """How the events of a signal family lie over keys and slices."""

    events: int
    #: Keys (as text) and slices that one task should not sum; None: too many to list.
    hot: list[tuple[str, int]] | None


def slice_length(family: list[VelocitySignal]) -> int:
    """Slices of member counts are as long as the window; those of event counts longer, so that few events reach the next one."""
    longest = max(s.window_ms for s in family)
    return longest if family[0].member else EVENT_SLICES * longest


def family_spread(rows: DataFrame, families: list[list[VelocitySignal]]) -> list[Spread]:
    """Per family the number of events, and the keys and slices with too many of them for one task.

    A slice holds its own events and those of the slice before that reach it, so it has more than ``HOT_EVENTS`` only if one
    of the two has more than half as many. One job over one scan counts the events of cells, into which keys and slices fall by their hash;
    only in cells of that many events the slices themselves are counted.
    """

    def use(i: int, family: list[VelocitySignal]) -> Column:
        key, own = F.col(family[0].key).cast("string"), slice_start(F.col(MS), slice_length(family))
        cell = F.pmod(F.xxhash64(F.lit(i), key, own), F.lit(CELLS)).cast("int")
        taken = F.struct(F.lit(i).alias("family"), key.alias("key"), own.alias(SLICE), cell.alias("cell"))
        return F.when(signal_guard(family[0]) & F.col(MS).isNotNull(), taken)

    uses = rows.select(F.explode(F.array(*[use(i, f) for i, f in enumerate(families)])).alias("use")).where("use IS NOT NULL").select("use.*")
    by_cell = uses.groupBy("family", "cell").agg(F.count("*").alias("events"))
    busy = F.collect_list(F.when(F.col("events") > HOT_EVENTS // 2, F.col("cell")))
    found = {r["family"]: r for r in by_cell.groupBy("family").agg(F.sum("events").alias("events"), busy.alias("busy")).collect()}
    events = [found[i]["events"] if i in found else 0 for i in range(len(families))]
    cells = pa.table({"family": [i for i, r in found.items() for _ in r["busy"]], "cell": [c for r in found.values() for c in r["busy"]]},
                     pa.schema([("family", pa.int32()), ("cell", pa.int32())]))
    if not cells.num_rows:
        return [Spread(n, []) for n in events]
    listed = F.broadcast(rows.sparkSession.createDataFrame(cells))
    counted = uses.join(listed, ["family", "cell"], "left_semi").groupBy("family", "key", SLICE).agg(F.count("*").alias("events"))
    own = counted.where(F.col("events") > HOT_EVENTS // 2).limit(MAX_HOT_SLICES + 1).collect()
    lengths = [slice_length(f) for f in families]
    hot = {(r["family"], r["key"], r[SLICE] + n) for r in own for n in (0, lengths[r["family"]])}
    if len(hot) > MAX_HOT_SLICES:
        return [Spread(n, None) for n in events]
    return [Spread(n, sorted((k, s) for f, k, s in hot if f == i)) for i, n in enumerate(events)]


def velocity_levels(
    rows: DataFrame,
    signals: list[VelocitySignal],
    asked: Column | None = None,
    parts: int = PARTS,
    spread: Spread | None = None,
) -> DataFrame:
    """Counts of signals that share a key and a guard, per key and instant; a hot slice is summed in ``parts``.

    ``spread`` is the outcome of ``family_spread`` for the family; without it, all slices are summed in parts.
    Adaptive execution would join partitions by their compressed size, which is small for these rows, so their number
    follows the events.
    """
    asked = F.lit(1) if asked is None else asked
    guarded = rows.where(signal_guard(signals[0]) & F.col(MS).isNotNull())
    slice_ms = slice_length(signals)
    key, names = signals[0].key, [s.name for s in signals]
    events = signals[0].member is None
    if events:
        taken = event_uses(guarded, signals, asked, slice_ms)
    else:
        taken = member_changes(guarded, signals[0], asked).withColumn(SLICE, slice_start(F.col(AT), slice_ms))
    cold, hot = split_hot(taken, key, spread and spread.hot)
    levels = []
    if cold is not None:
        cold = cold.repartition(1 + spread.events // EVENTS_PER_TASK, key, SLICE)
        if events:
            cold = event_changes(cold, signals, slice_ms)
        else:
            cold = cold.groupBy(key, SLICE, AT).agg(*[F.sum(n).alias(n) for n in names], F.sum(ASKED).alias(ASKED))
        levels.append(slice_levels(cold, key, names))
    if hot is not None:
        changes = event_changes(hot, signals, slice_ms) if events else hot
        levels.append(running_levels(changes.drop(SLICE), key, names, slice_ms, parts))
    return reduce(DataFrame.unionByName, levels)


def signal_families(signals: tuple[VelocitySignal, ...]) -> list[list[VelocitySignal]]:
    """Event counts over one key share a pass; each distinct count has its own."""
    families: dict[tuple, list[VelocitySignal]] = defaultdict(list)
    for s in signals:
        families[(s.key, s.skip_blank, s.skip_prefixes, s.name if s.member else None)].append(s)
    return list(families.values())


def with_velocity(
    rows: DataFrame,
    signals: tuple[VelocitySignal, ...] = DEFAULT_SIGNALS,
    uses: DataFrame | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """Add one count column per signal; rows a guard skips count 0.

    ``rows`` needs ``event_ms`` and the key and member columns. ``uses`` are the same events before
    costly steps that the windows do not need. ``history`` holds earlier events that fill the
    windows but are not returned. Rows of equal time on one key count each other.
    """
    uses = rows if uses is None else uses
    result = rows
    families = signal_families(signals)
    keys = list(dict.fromkeys([*[f[0].key for f in families], MS]))
    known = uses.select(*keys) if history is None else uses.select(*keys).unionByName(history.select(*keys))
    for family, spread in zip(families, family_spread(known, families)):
        key = family[0].key
        used = list(dict.fromkeys([key, *[s.member for s in family if s.member], MS]))
        events = uses.select(*used, F.lit(1).alias("_new"))
        if history is not None:
            present = uses.select(key).distinct()
            earlier = lookup_join(history.select(*used), present, [key], "left_semi", spread_by=[MS])
            events = events.unionByName(earlier.withColumn("_new", F.lit(0)))
        levels = velocity_levels(events, family, F.col("_new"), spread=spread).withColumnRenamed(AT, MS)
        result = result.join(shuffled(levels), [key, MS], "left")
    names = [s.name for s in signals]
    kept = [F.col(c) for c in rows.columns]
    return result.select(*kept, *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names])


def velocity_scores(signals: tuple[VelocitySignal, ...] = DEFAULT_SIGNALS) -> list[Column]:
    return [tier_score(F.col(s.name), s.tiers).alias(f"{s.name}_score") for s in signals]


def behavioral_score(signals: tuple[VelocitySignal, ...] = DEFAULT_SIGNALS) -> Column:
    return reduce(lambda a, b: a + b, [tier_score(F.col(s.name), s.tiers) for s in signals], F.lit(0)).cast(
        "long"
    )


def velocity_snapshot(rows: DataFrame, as_of_ms: int, scale: int = 1) -> DataFrame:
    """Per card, the events of the last 1 minute, 5 minutes and 1 hour and in all, at one instant.

    Both window ends count here. Events after the instant are not known yet.
    """
    ms = F.col(MS)

    def recent(window: int) -> Column:
        return F.count_if(ms >= as_of_ms - window * scale)

    return (
        rows.where(ms <= as_of_ms)
        .groupBy("card_fingerprint")
        .agg(
            recent(MINUTE_MS).alias("count_1m"),
            recent(5 * MINUTE_MS).alias("count_5m"),
            recent(HOUR_MS).alias("count_1h"),
            F.count("*").alias("total"),
        )
    )


def velocity_snapshots(rows: DataFrame, instants: DataFrame, scale: int = 1, ms: str = "as_of_ms") -> DataFrame:
    """``velocity_snapshot`` at every instant of a table, by one pass over the events.

    An event counts at the instants from its own time on: in a window up to its end, in the total for ever.
    So it raises each count at the first such instant and lowers it after the last one. These changes are
    added up per card and instant before the shuffle, which leaves a card with at most one row per instant
    and task, however many events it has, and a running sum over the instants gives every count. Instants
    (at most ``MAX_INSTANTS``) are part of the plan; repeated and null ones are left out. Events without a time
    are not known at any instant.
    """
    at = [r[0] for r in instants.select(ms).where(F.col(ms).isNotNull()).distinct().orderBy(ms).limit(MAX_INSTANTS + 1).collect()]
    if len(at) > MAX_INSTANTS:
        raise ValueError(f"more than {MAX_INSTANTS} instants; ask for them in parts")
    windows = {"count_1m": MINUTE_MS, "count_5m": 5 * MINUTE_MS, "count_1h": HOUR_MS}
    counts = [*windows, "total"]
    place = F.col("_place")

    def change(where: Column, values: dict[str, int]) -> Column:
        return F.struct(where.alias("_place"), *[F.lit(values.get(c, 0)).cast("long").alias(c) for c in counts])

    entering = change(count_at_most(at, F.col(MS) - 1), dict.fromkeys(counts, 1))
    leaving = [change(count_at_most(at, F.col(MS) + w * scale), {c: -1}) for c, w in windows.items()]
    changes = rows.where(F.col(MS).isNotNull()).select("card_fingerprint", F.inline(F.array(entering, *leaving)))
    changes = changes.where(place < len(at)).groupBy("card_fingerprint", "_place").agg(*[F.sum(c).alias(c) for c in counts])
    by_card = Window.partitionBy("card_fingerprint").orderBy("_place")
    so_far = by_card.rowsBetween(Window.unboundedPreceding, 0)
    levels = changes.select(
        "card_fingerprint", "_place", (F.coalesce(F.lead("_place").over(by_card), F.lit(len(at))) - 1).alias("_last"),
        *[F.sum(c).over(so_far).alias(c) for c in counts],
    )
    known = levels.where("total > 0").withColumn("_place", F.explode(F.sequence("_place", "_last")))
    return known.select("card_fingerprint", F.get(listed(at), place).alias(ms), *counts)
