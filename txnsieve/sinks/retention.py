"""Retention of tables that streams grow by one folder per run and batch.

Such a table is laid out as ``<partition>=<value>/run_id=<run>/batch_id=<batch>``. A merge writes the rows of
all batches of a run in one partition, up to a committed batch, into one folder ``run_id=merged-<run>/
batch_id=<batch>``. That folder stands for theirs: readers that go through ``current`` take it instead of them
as soon as it is complete, and they are deleted by the next call only, so a batch that has listed them
may still read them. A merge that is cut off leaves a folder without its mark, which nobody reads and the
next call removes. A batch that runs again replaces its own folder only, which is never merged: merges
stop before the newest batch of each run, and a batch starts after the one before it is committed.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from txnsieve.session import remove_folder

MERGED = "merged-"
FILE_BYTES = 128 << 20


@dataclass(frozen=True)
class Folder:
    """The rows of one batch of a run in one partition, or of all its batches up to that one."""

    value: str
    run: str
    batch: int
    path: str
    complete: bool = True

    @property
    def merged_run(self) -> str | None:
        return self.run[len(MERGED) :] if self.run.startswith(MERGED) else None


def batch_folders(spark: SparkSession, path: str, partition: str) -> list[Folder]:
    """All folders of a table, by listing; merged ones are complete once they carry the mark of a finished write."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in files.globStatus(hadoop.Path(root, f"{partition}=*/run_id=*/batch_id=*")) or []:
        at = status.getPath()
        value, run, batch = (unquote(p.getName().split("=", 1)[1]) for p in (at.getParent().getParent(), at.getParent(), at))
        complete = not run.startswith(MERGED) or files.exists(hadoop.Path(at, "_SUCCESS"))
        found.append(Folder(value, run, int(batch), at.toString(), complete))
    return found


def current(found: Sequence[Folder]) -> list[Folder]:
    """The folders that count: of what a merged folder stands for, only that folder."""
    upto: dict[tuple[str, str], int] = {}
    for f in found:
        if f.merged_run is not None and f.complete:
            key = (f.value, f.merged_run)
            upto[key] = max(f.batch, upto.get(key, -1))
    kept = []
    for f in found:
        if f.merged_run is not None:
            if f.complete and f.batch == upto[f.value, f.merged_run]:
                kept.append(f)
        elif f.batch > upto.get((f.value, f.run), -1):
            kept.append(f)
    return kept


def read_current(
    spark: SparkSession, path: str, partition: str, schema: T.StructType, first: str | None = None, last: str | None = None,
    among: Sequence[str] | None = None,
) -> DataFrame | None:
    """The rows that count, of the partitions between two values or among some; None where there is no folder.

    Only folders that exist are named, whatever the two values are.
    """
    folders = [
        f.path
        for f in current(batch_folders(spark, path, partition))
        if (first is None or f.value >= first) and (last is None or f.value <= last) and (among is None or f.value in among)
    ]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders) if folders else None


def _bytes(spark: SparkSession, path: str) -> int:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def retain(spark: SparkSession, path: str, partition: str, schema: T.StructType, keep_from: str | None = None, least: int = 2) -> None:
    """Drops partitions before ``keep_from``, merges the batches of each run, and removes what earlier merges replaced.

    A partition is merged where at least ``least`` folders of a run are committed. ``schema`` is the
    table's, with its partition columns.
    """
    found = batch_folders(spark, path, partition)
    counted = set(current(found))
    for f in found:
        if f not in counted:
            remove_folder(spark, f.path)
    newest: dict[str, int] = defaultdict(int)
    for f in counted:
        if f.merged_run is None:
            newest[f.run] = max(newest[f.run], f.batch)
    parts: dict[tuple[str, str], list[Folder]] = defaultdict(list)
    for f in sorted(counted, key=lambda f: f.path):
        if keep_from is not None and f.value < keep_from:
            remove_folder(spark, f"{path}/{partition}={f.value}")
        elif f.merged_run is not None:
            parts[f.value, f.merged_run].append(f)
        elif f.batch < newest[f.run]:
            parts[f.value, f.run].append(f)
    columns = [c for c in schema.names if c not in (partition, "run_id", "batch_id")]
    for (value, run), folders in parts.items():
        if len(folders) < least:
            continue
        rows = spark.read.schema(schema).option("basePath", path).parquet(*[f.path for f in folders]).select(*columns)
        files = max(1, sum(_bytes(spark, f.path) for f in folders) // FILE_BYTES)
        target = f"{path}/{partition}={value}/run_id={MERGED}{run}/batch_id={max(f.batch for f in folders)}"
        rows.coalesce(files).write.mode("overwrite").parquet(target)
