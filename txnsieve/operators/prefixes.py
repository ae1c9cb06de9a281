"""Longest matching prefix by one range join, whatever the lengths of the prefixes.

All texts that begin with a prefix lie, in the order of their code points, from the prefix up to the next text
that does not. Nested prefixes cut these ranges into disjoint intervals, each with its longest prefix. The
intervals are put into bins of consecutive ones; a text finds its bin by binary search among the bins'
first texts, and its interval by an equi-join on the bin with a comparison of at most ``BIN`` intervals.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from txnsieve.config import MAX_BROADCAST_ROWS
from txnsieve.functions.search import count_at_most
from txnsieve.operators.lookups import lookup_join
from txnsieve.operators.ranking import placed_rows
from txnsieve.session import staged

#: Intervals in a bin, unless there would be more than ``MAX_BINS`` bins.
BIN = 16
MAX_BINS = 16_384
DRIVER_PREFIXES = 10_000
#: The last code point, and the first and last of those that stand for no sign.
LAST_SIGN = 0x10FFFF
SURROGATES = (0xD800, 0xDFFF)


@dataclass(frozen=True)
class PrefixIntervals:
    """``bin, low, high, entry``: disjoint intervals of texts; ``high`` is null for the last of a bin."""

    intervals: DataFrame
    starts: list[str]
    fits: bool


def after_prefix(prefix: Column) -> Column:
    """The smallest text after all that begin with ``prefix``, by code points; null where there is none.

    Signs that cannot be raised are cut off at the end, and the last one left is raised by one.
    """
    cut = F.regexp_replace(prefix, r"\x{10FFFF}+$", "")
    code = F.conv(F.hex(F.encode(F.right(cut, F.lit(1)), "UTF-32")), 16, 10).cast("long") + 1
    code = F.when(code == SURROGATES[0], F.lit(SURROGATES[1] + 1)).otherwise(code)
    raised = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(F.length(cut) > 0, F.concat(F.substring(cut, F.lit(1), F.length(cut) - 1), raised))


def after_text(prefix: str) -> str | None:
    """``after_prefix`` of a text on the driver."""
    cut = prefix.rstrip(chr(LAST_SIGN))
    if not cut:
        return None
    code = ord(cut[-1]) + 1
    return cut[:-1] + chr(SURROGATES[1] + 1 if code == SURROGATES[0] else code)


def _few(named: list[Row]) -> tuple[list[dict], list[str]]:
    """Intervals and first texts of the bins, of a list of prefixes that the driver holds."""
    entries = {r["prefix"]: r["entry"].asDict() if isinstance(r["entry"], Row) else r["entry"] for r in named}
    lengths = sorted({len(p) for p in entries}, reverse=True)
    bounds = sorted({*entries, *(a for a in map(after_text, entries) if a is not None)})
    found = []
    for place, low in enumerate(bounds):
        longest = next((low[:n] for n in lengths if n <= len(low) and low[:n] in entries), None)
        last = (place + 1) % BIN == 0 or place + 1 == len(bounds)
        if longest is not None:
            high = None if last else bounds[place + 1]
            found.append({"bin": place // BIN + 1, "low": low, "high": high, "entry": entries[longest]})
    return found, bounds[::BIN]


def _many(named: DataFrame) -> tuple[DataFrame, list[str], int]:
    """Intervals, first texts of the bins, and how many intervals there are, by joins and one sort."""
    named = staged(named, "prefixes")
    ends = named.select(after_prefix(F.col("prefix")).alias("low")).where("low IS NOT NULL")
    bounds = named.select(F.col("prefix").alias("low")).unionByName(ends).distinct()
    # Every bound against its own beginnings of the lengths that occur: the longest one that is a prefix.
    lengths = [r[0] for r in named.select(F.length("prefix")).distinct().collect()]
    heads = F.array(*[F.when(F.length("low") >= n, F.substring("low", 1, n)) for n in lengths])
    heads = bounds.select("low", F.explode(F.filter(heads, lambda h: h.isNotNull())).alias("prefix"))
    found = heads.join(named, "prefix").groupBy("low").agg(F.max_by("entry", F.length("prefix")).alias("entry"))
    placed = placed_rows(bounds.join(found, "low", "left").orderBy("low"), "prefix-order")
    count = placed.count()
    width = max(BIN, -(-count // MAX_BINS))
    binned = placed.withColumn("bin", F.floor(F.col("place") / width).cast("int") + 1)
    in_bin = Window.partitionBy("bin").orderBy("place")
    intervals = staged(binned.select("bin", "low", F.lead("low").over(in_bin).alias("high"), "entry"), "intervals")
    starts = [r[0] for r in intervals.groupBy("bin").agg(F.min("low").alias("low")).orderBy("bin").select("low").collect()]
    return intervals.where("entry IS NOT NULL"), starts, count


def prefix_intervals(table: DataFrame, entry: Column, prefix: str = "prefix") -> PrefixIntervals:
    """Flattens the prefixes of a table; of rows that repeat one, the smallest ``entry`` counts. Null prefixes match nothing.

    Up to ``DRIVER_PREFIXES`` prefixes are flattened on the driver, more of them by Spark, with one result.
    """
    spark = table.sparkSession
    named = table.where(F.col(prefix).isNotNull()).groupBy(F.col(prefix).alias("prefix")).agg(F.min(entry).alias("entry"))
    held = named.limit(DRIVER_PREFIXES + 1).collect()
    if len(held) > DRIVER_PREFIXES:
        intervals, starts, count = _many(named)
        return PrefixIntervals(intervals, starts, count <= MAX_BROADCAST_ROWS)
    rows, starts = _few(held)
    schema = T.StructType(
        [T.StructField("bin", T.IntegerType()), T.StructField("low", T.StringType()), T.StructField("high", T.StringType()),
         T.StructField("entry", named.schema["entry"].dataType)]
    )
    return PrefixIntervals(spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(schema)), schema), starts, True)


def with_longest_prefix(rows: DataFrame, table: PrefixIntervals, text: str, name: str, spread_by: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``name``, the entry of the longest prefix of ``text``; null where no prefix matches."""
    sought = rows.withColumn("_bin", count_at_most(table.starts, F.col(text)))
    side = table.intervals.select(
        F.col("bin").alias("_bin"), F.col("low").alias("_low"), F.col("high").alias("_high"), F.col("entry").alias(name)
    )
    inside = (F.col(text) >= F.col("_low")) & (F.col("_high").isNull() | (F.col(text) < F.col("_high")))
    return lookup_join(sought, side, ["_bin"], spread_by=spread_by, fits=table.fits, where=inside).drop("_bin", "_low", "_high")
