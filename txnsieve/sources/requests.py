"""Transaction requests as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnsieve.schemas import FIELD_COLUMNS, REQUEST, TRANSACTIONS

#: Request fields whose column in the transactions table holds no null.
REQUIRED = frozenset(
    f.name for f in REQUEST.fields if not TRANSACTIONS[FIELD_COLUMNS[f.name]].nullable
)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REQUEST).json(path)


REJECTED = "reject_reason"
_CORRUPT = "_corrupt"


def parse_requests(df: DataFrame, body: str = "body") -> DataFrame:
    """Request fields from a JSON text column; the other columns stay.

    ``reject_reason`` names what keeps a body from being stored: a body that is no JSON object, a field
    of the wrong type, or the first required field that is missing. It is null for good requests.
    """
    others = [c for c in df.columns if c != body]
    schema = T.StructType([*REQUEST.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = df.withColumn("_request", F.from_json(body, schema, {"columnNameOfCorruptRecord": _CORRUPT}))
    rows = parsed.select(*others, F.col(body).alias("_body"), "_request.*")
    return rows.withColumn(REJECTED, _reject_reason()).drop("_body", _CORRUPT)


def _reject_reason() -> Column:
    """In order: the body as a whole, the types of its fields, the required fields."""
    is_object = F.coalesce(F.col("_body"), F.lit("")).rlike(r"^\s*\{")
    reason = F.when(~is_object | F.try_parse_json("_body").isNull(), F.lit("malformed body"))
    reason = reason.when(F.col(_CORRUPT).isNotNull(), F.lit("wrong type"))
    for field in REQUEST.fields:
        if field.name in REQUIRED:
            reason = reason.when(F.col(field.name).isNull(), F.lit(f"missing {field.name}"))
    return reason


def good_requests(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected_requests(parsed: DataFrame) -> DataFrame:
    """Requests that may not be stored; they keep their reason."""
    return parsed.where(F.col(REJECTED).isNotNull())
