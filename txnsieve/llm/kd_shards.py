"""Shards of near-equal bytes by a k-d tree over metadata of the text.

Each node is split at the weighted median of its widest dimension until a leaf has at most the
target bytes. The dimensions come from the text alone (byte size, bytes per character, share of
spaces, content hash), so equal texts fall into the same leaf. Every coordinate is a whole number whose low
half is the content hash, so the median may cut between rows of equal metadata, never between equal
texts. Only a text whose copies together exceed a sixteenth of the target is cut itself, into
parts by a hash of the id; there are at most 16 such texts per shard, which bounds their broadcast.

A row carries the first leaf and the number of leaves of the node it has come to, and all nodes of a level
are split at once, so the jobs grow with the logarithm of the leaves and the driver holds nothing of a
node. The medians are exact: sums by histogram bin, reduced before the shuffle, are refined around the
median until one coordinate is left. A table of one row per open node is joined to the rows; it is broadcast
up to ``MAX_BROADCAST_ROWS`` nodes, and salted by the rows beyond.

Null text has no bytes; each row weighs its bytes plus one. Null ids and repeated rows are rows
like any other; their order within a shard is by id, nulls first. An empty table gives no rows. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnsieve.config import MAX_BROADCAST_ROWS
from txnsieve.llm.common import full_text, numbered
from txnsieve.operators.lookups import lookup_join
from txnsieve.session import remove_folder, run_folder, staged

BINS = 4096
SPLIT_COPIES = 16
DIMENSIONS = ("_kd_size", "_kd_script", "_kd_spaces", "_kd_content")
CONTENT = "_kd_content"
LOW = 31


def _points(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = full_text(text_col)
    size = F.octet_length(text)
    chars = F.length(text)
    spaces = chars - F.length(F.replace(text, F.lit(" "), F.lit("")))
    hashed = F.xxhash64(text)
    top = (1 << LOW) - 1
    return docs.select(
        F.col(id_col).alias("_kd_id"),
        (size + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        hashed.alias("_kd_hash"),
        F.least(F.round(F.log2(size + 1) * (1 << 25)), F.lit(top)).cast("long").alias("_kd_size"),
        F.least(F.round((size + 1) / (chars + 1) * (1 << 28)), F.lit(top)).cast("long").alias("_kd_script"),
        F.least(F.round((spaces + 1) / (chars + 1) * (1 << 30)), F.lit(top)).cast("long").alias("_kd_spaces"),
        F.shiftrightunsigned(hashed, 64 - LOW).alias(CONTENT),
    )


def _with_parts(points: DataFrame, piece: float) -> DataFrame:
    """Adds the tie-break of the coordinates: the content hash, and for a text of many copies its part."""
    many = staged(
        points.groupBy("_kd_hash", "text_crc32").agg(F.sum("size").alias("_kd_all")).where(F.col("_kd_all") > piece),
        "kd-copies",
    ).select("_kd_hash", "text_crc32", F.ceil(F.col("_kd_all") / piece).alias("_kd_parts"))
    part = F.pmod(F.xxhash64("_kd_id", "_kd_hash"), "_kd_parts")
    low = F.when(F.col("_kd_parts").isNull(), F.xxhash64("_kd_hash", "text_crc32")).otherwise(
        F.xxhash64("_kd_hash", "text_crc32", part)
    )
    joined = points.join(F.broadcast(many), ["_kd_hash", "text_crc32"], "left").withColumn(
        "_kd_low", F.shiftrightunsigned(low, 64 - LOW)
    )
    return joined.select(
        "_kd_id",
        "size",
        "text_crc32",
        *[(F.shiftleft(d, LOW) + F.col("_kd_low")).alias(d) for d in DIMENSIONS],
    )


def _spans(points: DataFrame) -> DataFrame:
    """One row per open node: its widest dimension, the range there, and the bytes that its left side should hold.

    Widths are shares of the whole table's; the first of equally wide dimensions counts.
    """
    every = range(len(DIMENSIONS))
    edges = [f(F.col("at")[d]).alias(f"{w}{d}") for d in every for w, f in (("a", F.min), ("z", F.max))]
    nodes = points.where("k > 1").groupBy("first", "k").agg(F.sum("size").alias("bytes"), *edges)
    whole = points.agg(*edges).first()
    widths = [max(1, (whole[f"z{d}"] or 0) - (whole[f"a{d}"] or 0)) for d in every]
    wide = F.array(*[(F.col(f"z{d}") - F.col(f"a{d}")) / widths[d] for d in every])
    dim = (F.array_position(wide, F.array_max(wide)) - 1).cast("int")
    found = nodes.withColumn("dim", dim)
    return found.select(
        "first",
        "dim",
        F.array(*[f"a{d}" for d in every])[F.col("dim")].alias("low"),
        F.array(*[f"z{d}" for d in every])[F.col("dim")].alias("high"),
        F.lit(0).cast("long").alias("before"),
        (F.floor(F.col("k") / 2) / F.col("k") * F.col("bytes")).alias("goal"),
    )


def _cuts(points: DataFrame, folder: str) -> tuple[DataFrame, int]:
    """For each open node the dimension and the smallest coordinate at which its right side begins, and how many nodes."""
    active = staged(_spans(points), "kd-nodes", folder)
    count = left = active.count()
    found = []
    while left:
        rows = points.where("k > 1").select("first", "size", "at")
        rows = lookup_join(rows, active, ["first"], "inner", spread_by=["at"], fits=left <= MAX_BROADCAST_ROWS)
        rows = rows.withColumn("c", F.col("at")[F.col("dim")]).where("c BETWEEN low AND high")
        state = ["first", "dim", "before", "goal"]
        bins = (
            rows.withColumn("bin", F.expr(f"(c - low) div ((high - low) div {BINS} + 1)"))
            .groupBy(*state, "bin")
            .agg(F.sum("size").alias("bytes"), F.min("c").alias("low"), F.max("c").alias("high"))
        )
        in_order = Window.partitionBy("first").orderBy("bin")
        upto = F.col("before") + F.sum("bytes").over(in_order)
        reached = bins.withColumn("upto", upto).where("upto >= goal")
        reached = reached.withColumn("n", F.row_number().over(in_order)).where("n = 1")
        reached = staged(
            reached.select("first", "dim", "low", "high", (F.col("upto") - F.col("bytes")).alias("before"), "goal", "upto"), "kd-bins", folder
        )
        # One coordinate is left: the cut is at its nearer side.
        nearer = F.when(F.abs(F.col("upto") - F.col("goal")) <= F.abs(F.col("goal") - F.col("before")), F.col("high") + 1)
        found.append(reached.where("low = high").select("first", "dim", F.coalesce(nearer, F.col("low")).alias("cut")))
        active = reached.where("low < high").drop("upto")
        left = active.count()
    return reduce(DataFrame.unionByName, found), count


def kd_shards(
    docs: DataFrame,
    target_bytes: float | None = None,
    shards: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot`` (gapless from 0).

    Give ``target_bytes``, or ``shards`` for a target of an equal share each. Splits go on until
    every leaf may hold the target; a node that owes an odd number of leaves is cut in that ratio.
    """
    spark = docs.sparkSession
    points = staged(_points(docs, id_col, text_col), "kd-points")
    whole = points.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    total, rows = whole["bytes"] or 0, whole["rows"]
    leaves = shards or max(1, math.ceil(total / target_bytes))
    keys = _with_parts(points, max(1.0, total / leaves / SPLIT_COPIES))
    node = [F.lit(0).cast("long").alias("first"), F.lit(leaves).cast("long").alias("k")]
    points = staged(keys.select("_kd_id", "size", "text_crc32", F.array(*DIMENSIONS).alias("at"), *node), "kd-keys")
    for _ in range(math.ceil(math.log2(leaves)) if rows else 0):
        folder = run_folder(spark, "kd-level")
        cuts, nodes = _cuts(points, folder)
        moved = lookup_join(points, cuts, ["first"], "left", spread_by=["at"], fits=nodes <= MAX_BROADCAST_ROWS)
        right = F.coalesce(F.col("at")[F.col("dim")] >= F.col("cut"), F.lit(False))
        half = F.when(F.col("k") > 1, F.floor(F.col("k") / 2)).otherwise(0)
        moved = moved.withColumn("half", half).select(
            "_kd_id", "size", "text_crc32", "at",
            F.when(right, F.col("first") + F.col("half")).otherwise(F.col("first")).alias("first"),
            F.when(right | (F.col("k") == 1), F.col("k") - F.col("half")).otherwise(F.col("half")).alias("k"),
        )
        points = staged(moved, "kd-keys")
        remove_folder(spark, folder)
    dealt = points.select(F.col("_kd_id").alias("doc_id"), "size", "text_crc32", F.col("first").cast("int").alias("shard"))
    return numbered(dealt, ["shard"], ["doc_id", "text_crc32", "size"], max(rows, 1) // leaves, "slot")
