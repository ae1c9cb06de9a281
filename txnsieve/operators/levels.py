"""Running levels per key over event time, split so that no task holds a whole key.

A sliding window count is a level: each event raises it when it enters the window and lowers it
when it leaves. Summing the changes in time order gives the count at every instant with one pass,
where a RANGE frame would visit every row of the frame again for each row.

A single key may hold a large share of all rows, so time is cut into slices at least as long as the longest
window, and each slice is summed on its own: an event that is still inside its window at the end of
a slice enters the next slice at its start, and never reaches a third one. Changes of one instant
are merged first.

Most slices of a key hold few rows and are summed by one task each (``slice_levels``): a second level would cost
more rows than it spreads. A hot key may still have most of its rows in one slice, so such a slice is cut into
``PARTS`` parts (``running_levels``), and the sum runs on two levels: each part is added up, the totals of the earlier parts of the slice (at most
``PARTS`` rows) are added up to what the part starts with, and that enters the part as one more change
before its first instant. One task then holds one part of a slice of a key: at most one row for each
millisecond of the part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Column of 1 where the level is asked for, 0 for rows that only change it.
ASKED = "_asked"
AT = "_at"
SLICE = "_slice"
PART = "_part"
# Parts of a slice that are summed by tasks of their own.
PARTS = 96


def slice_start(ms: Column, length: int) -> Column:
    return ms - F.pmod(ms, F.lit(length))


def split_hot(rows: DataFrame, key: str, hot: list[tuple] | None) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows with ``key`` and ``_slice`` outside and inside the listed slices; None for a side without any.

    The keys are listed as text. Without a list all rows count as inside.
    """
    if hot is None:
        return None, rows
    if not hot:
        return rows, None
    listed = F.broadcast(rows.sparkSession.createDataFrame(hot, "_hot_key string, _hot_slice long"))
    same = (F.col(key).cast("string") == F.col("_hot_key")) & (F.col(SLICE) == F.col("_hot_slice"))
    return rows.join(listed, same, "left_anti"), rows.join(listed, same, "left_semi")


def slice_levels(changes: DataFrame, key: str, measures: list[str]) -> DataFrame:
    """Sum ``measures`` from the start of the slice up to each instant asked for, a slice of a key in one task.

    ``changes`` has the slice too, and at most one row that is asked for per key and instant; it comes last there.
    """
    up_to_here = Window.partitionBy(key, SLICE).orderBy(AT, ASKED).rowsBetween(Window.unboundedPreceding, 0)
    levels = changes.select(key, AT, ASKED, *[F.sum(m).over(up_to_here).alias(m) for m in measures])
    return levels.where(F.col(ASKED) > 0).drop(ASKED)


def running_levels(changes: DataFrame, key: str, measures: list[str], slice_ms: int, parts: int = PARTS) -> DataFrame:
    """Sum ``measures`` from the start of the slice up to and including each instant, per key.

    ``changes`` has columns ``key``, ``_at``, ``_asked`` and the measures. Returns one row
    ``key, _at, measures`` for every instant asked for.
    """
    part_ms = -(-slice_ms // parts)
    merged = changes.groupBy(key, AT).agg(*[F.sum(m).alias(m) for m in measures], F.sum(ASKED).alias(ASKED))
    start = slice_start(F.col(AT), slice_ms)
    placed = merged.withColumn(SLICE, start).withColumn(PART, F.floor((F.col(AT) - start) / part_ms))
    earlier = Window.partitionBy(key, SLICE).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(key, SLICE, PART).agg(*[F.sum(m).alias(m) for m in measures])
    carried = totals.select(
        key, (F.col(SLICE) + F.col(PART) * part_ms - 1).alias(AT), *[F.sum(m).over(earlier).alias(m) for m in measures],
        F.lit(0).cast("long").alias(ASKED), SLICE, PART,
    ).where(F.greatest(*[F.abs(F.coalesce(m, F.lit(0))) for m in measures], F.lit(0)) > 0)
    up_to_here = Window.partitionBy(key, SLICE, PART).orderBy(AT).rowsBetween(Window.unboundedPreceding, 0)
    rows = placed.unionByName(carried)
    levels = rows.select(key, AT, ASKED, *[F.sum(m).over(up_to_here).alias(m) for m in measures])
    return levels.where(F.col(ASKED) > 0).drop(ASKED)
