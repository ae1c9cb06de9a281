"""Stored tables as DataFrames."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, format: str = "parquet", **options: str
) -> DataFrame:
    """Scan a stored table; ``format="jdbc"`` takes the connection as ``options``."""
    reader = spark.read.format(format).options(**options)
    if format == "jdbc":
        return reader.option("dbtable", path).load()
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, *paths: str) -> DataFrame:
    """A table that may not exist yet; ``paths`` narrow the listing to some of its partitions."""
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(*(paths or (path,)))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of the first partition column of a stored table, from the names of its folders; in order."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop.Path(folder, f"{column}=*"))
    return sorted(unquote(f.getPath().getName().split("=", 1)[1]) for f in found or [])


def stream_table(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """Rows appended to a stored table, as a stream; the checkpoint remembers what was read."""
    return spark.readStream.schema(schema).options(**options).parquet(path)
