"""Small helpers that several of these operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnsieve.session import ship_package

__all__ = ["documents", "full_text", "held_out", "labelled_sample", "numbered", "ship_package", "slices", "table"]

HELD_OUT_FOLDS = 5
NUMBERED_ROWS = 200_000


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that few whole texts are held as Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def full_text(column: str) -> Column:
    """The whole text; a null text counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(id_col: str) -> Column:
    """True for the rows that no model may learn from: crc32 of the id as text, modulo five."""
    return F.coalesce(
        F.crc32(F.col(id_col).cast("string").cast("binary")) % HELD_OUT_FOLDS == 0, F.lit(True)
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int, id_col: str, text_col: str) -> DataFrame:
    """At most ``bound`` labelled rows with their texts, chosen by a hash of the id.

    Held-out rows and rows without a label never take part. The bound also bounds the side that is
    broadcast. A document id that occurs several times gives one row each, as does a repeated label.
    """
    chosen = (
        labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("_id"))
        .orderBy(F.xxhash64("_id"), "_id", "label")
        .limit(bound)
    )
    return docs.select(F.col(id_col).alias("_id"), full_text(text_col).alias("text")).join(F.broadcast(chosen), "_id")


def numbered(df: DataFrame, keys: list[str], order: list[str], rows: int, name: str = "rank") -> DataFrame:
    """Adds ``name``: numbers from 0 without gaps for each value of ``keys``.

    Rows are counted in hashed parts of about ``NUMBERED_ROWS`` and the parts are added up, so a hot
    key spreads over many tasks. ``order`` decides ties within a part; its columns spread the rows.
    """
    parts = max(8, rows // NUMBERED_ROWS)
    dealt = df.withColumn("_num_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    earlier = Window.partitionBy(*keys).orderBy("_num_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(*keys, "_num_part")
        .agg(F.count("*").alias("_num_rows"))
        .select(*keys, "_num_part", F.coalesce(F.sum("_num_rows").over(earlier), F.lit(0)).alias("_num_start"))
    )
    within = Window.partitionBy(*keys, "_num_part").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return (
        dealt.withColumn("_num_row", F.row_number().over(within) - 1)
        .join(starts, [*keys, "_num_part"])
        .withColumn(name, F.col("_num_start") + F.col("_num_row"))
        .drop("_num_part", "_num_row", "_num_start")
    )
