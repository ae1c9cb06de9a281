"""Equi-joins against lookup tables, broadcast only after counting them."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnsieve.config import LOOKUP_SALTS, MAX_BROADCAST_ROWS


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def shuffled(table: DataFrame) -> DataFrame:
    """Side of a join that grows with the input: joined by sort and merge, whatever Catalyst takes its size for.

    It takes the size of a stored table from its compressed files, and of an exploded one from the rows before, so
    millions of rows would be collected on the driver and broadcast as a small table.
    """
    return table.hint("merge")


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread_by: Sequence[str] = (),
    max_rows: int = MAX_BROADCAST_ROWS,
    salts: int = LOOKUP_SALTS,
    fits: bool | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Join rows to a table, which commonly has one row per key.

    A table of at most ``max_rows`` rows is broadcast. A bigger one is shuffled: with ``spread_by``,
    each key is spread over ``salts`` tasks by the hash of these columns, which repeats the table as
    often; without it, adaptive execution splits the partitions that turn out too big. ``fits`` is the
    outcome of the check where the caller has counted the rows already. ``where`` is a further condition of
    the join, over columns that only one side has.
    """
    on = list(on)
    if fits_broadcast(table, max_rows) if fits is None else fits:
        return _joined(rows, F.broadcast(table), on, how, where)
    if not spread_by:
        return _joined(rows, shuffled(table), on, how, where)
    salted_rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    salted_table = table.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return _joined(salted_rows, shuffled(salted_table), [*on, "_salt"], how, where).drop("_salt")


def _joined(rows: DataFrame, table: DataFrame, on: list[str], how: str, where: Column | None) -> DataFrame:
    if where is None:
        return rows.join(table, on, how)
    keyed = table.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_right_{c}") for c in on])
    return rows.join(keyed, same & where, how).drop(*[f"_right_{c}" for c in on])
