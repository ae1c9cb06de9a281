"""First rows per key. Both operators cut each group to its first rows before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnsieve.operators.lookups import shuffled
from txnsieve.session import staged


def placed_rows(df: DataFrame, label: str, name: str = "place") -> DataFrame:
    """``df`` stored once, with its places from 0 without gaps in the order of its partitions and rows.

    Shuffles nothing: each partition numbers its rows, and one counted row per partition moves them on. The
    numbers are stored, so they are the same whenever a task runs again.
    """
    stored = staged(df.withColumn("_mono", F.monotonically_increasing_id()), label)
    stored = stored.withColumn("_part", F.shiftright("_mono", 33))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored.groupBy("_part").agg(F.count("*").alias("_rows"))
    starts = starts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    within = F.col("_mono").bitwiseAND(F.lit(2**33 - 1))
    return stored.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + within).drop("_mono", "_part", "_start")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row per key. ``order`` must be total within a key.

    Catalyst limits each group to one row per map task, so a hot key does not reach one task whole.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


GROUP_LIMIT = 1000  # Catalyst cuts groups before the shuffle up to this many rows per key
SALTS = 32
#: Keys fall into this many cells by their hash; a cell of more than ``WHOLE_ROWS`` rows may hold a hot key.
CELLS = 32_768
WHOLE_ROWS = 200_000


def key_cell(keys: Sequence[str]) -> Column:
    """The cell of a key, by its hash."""
    return F.pmod(F.xxhash64(*keys), F.lit(CELLS)).cast("int")


def rank_up_to(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int, name: str = "rank", hot: Sequence[int] | None = None
) -> DataFrame:
    """All rows, with their rank within the key where it is at most ``limit`` and null beyond.

    ``hot`` are the cells of more than ``WHOLE_ROWS`` rows, where the caller has counted them (at most ``CELLS``). Each key
    of the other cells is numbered by one task, which shuffles its rows once. Without ``hot`` any key may be hot.
    """
    if hot is None:
        return _rank_spread(df, keys, order, limit, name)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    numbered = F.when(rank <= limit, rank).cast("long")
    if not hot:
        return df.withColumn(name, numbered)
    inside = F.array_contains(F.array(*[F.lit(c) for c in hot]), key_cell(keys))
    return df.where(~inside).withColumn(name, numbered).unionByName(_rank_spread(df.where(inside), keys, order, limit, name))


def _rank_spread(df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int, name: str) -> DataFrame:
    """``rank_up_to`` of keys of any size.

    Rows of equal keys and order are counted first and take ranks one after the other, so they need
    not be unique; nulls are keys and times like any other and come first. At most ``limit`` distinct
    places per key are shuffled by key from each map task, or, beyond what Catalyst cuts by itself,
    from each of ``SALTS`` parts of the key. The ranks return over the whole sort key, which spreads a
    hot key.
    """
    columns = [*keys, *order]
    places = df.groupBy(*columns).agg(F.count("*").alias("_rows"))
    if limit > GROUP_LIMIT:
        salted = places.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)))
        within = Window.partitionBy(*keys, "_salt").orderBy(*order)
        places = salted.withColumn("_place", F.row_number().over(within)).where(F.col("_place") <= limit).drop("_salt", "_place")
    window = Window.partitionBy(*keys).orderBy(*order)
    first = places.withColumn("_place", F.row_number().over(window)).where(F.col("_place") <= limit)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    starts = first.withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    starts = starts.where(F.col("_start") < limit).select(*[F.col(c).alias(f"_at_{c}") for c in columns], "_start", "_rows")
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(starts[f"_at_{c}"]) for c in columns])
    joined = df.join(shuffled(starts), same, "left").select(*[df[c] for c in df.columns], "_start", "_rows")
    # Only equal rows share a place; a place of one row needs no further number.
    equal = Window.partitionBy(*columns).orderBy(F.lit(0))
    rank = F.col("_start") + F.when(F.col("_rows") == 1, 1).otherwise(F.row_number().over(equal))
    return joined.withColumn(name, F.when(rank <= limit, rank).cast("long")).select(*df.columns, name)
