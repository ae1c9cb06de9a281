"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Else every column function looks up its caller's line, which costs more than planning for long plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app: str = "txnsieve", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A local session may fall back to a temporary folder; a cluster must name one that all
    executors can reach.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="txnsieve-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder made by ``run_folder`` once nothing reads it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def staged(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder, or to a new table below ``folder``, and read it back.

    Cuts the lineage where several branches would recompute the same shuffle or parse. The table
    is columnar, so each branch still reads only its own columns, and it outlives lost executors.
    """
    spark = df.sparkSession
    path = f"{folder}/{label}-{uuid.uuid4().hex}" if folder else run_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives this package to the executors' Python, once per application, by way of the shared folder.

    Needed where executors were started without it; harmless where they have it.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.writestr(str(source.relative_to(package.parent)), source.read_bytes())
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{run_folder(spark, 'package')}/{package.name}.zip")
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(content.getvalue())
    out.close()
    context.addPyFile(target.toString())
    _SHIPPED.add(context.applicationId)
