"""Appends that a repeated micro-batch cannot double."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: The run of rows written outside a stream.
NO_RUN = "batch"


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that a checkpoint belongs to, kept as an empty file beside its state.

    A new checkpoint counts its batches from 0 again, but is another run, so it never replaces what an
    earlier run wrote.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(checkpoint)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(hadoop.Path(folder, "run_id=*"))
    if found:
        return found[0].getPath().getName().split("=", 1)[1]
    name = uuid.uuid4().hex
    files.mkdirs(folder)
    files.create(hadoop.Path(folder, f"run_id={name}"), False).close()
    return name


def of_earlier_batches(batch_id: int, run: str = NO_RUN) -> Column:
    """Rows of other runs, and of earlier batches of this run."""
    return (F.col("run_id") != run) | (F.col("batch_id") < batch_id)


def append_batch(
    df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (), run: str = NO_RUN
) -> None:
    """Write the rows of one batch of a run into partitions of their own.

    Running the batch again replaces exactly these partitions.
    """
    (
        df.withColumn("run_id", F.lit(run))
        .withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by, "run_id", "batch_id")
        .parquet(path)
    )
