"""Exact duplicates by a content sort.

Sampled splitters range-partition the texts, an external sort places equal texts side by side, and
neighbouring texts are compared in full. Of equal texts one row stays. A sort key begins with the
first ``HEAD`` characters and the digest of the text, and the splitters are made of these alone, so
whole texts are neither sampled to the driver nor compared where a few bytes tell them apart.

A text that makes up more than a 65,536th of all rows (and more than ``HOT_ROWS`` rows) would fill
one range. Such texts are found by counting hashes, reduced to one row per map task, and spread
over several ranges by a salt. There are at most 65,536 of them, so their digests may be broadcast.

Null text counts as empty, so null and empty texts are equal. A null id stays only where its whole
group has null ids. Identical repeated rows (same id, same text) keep one row. An empty table gives
an empty result. Other columns are carried along under any name that does not start with ``_sort_``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnsieve.llm.common import full_text
from txnsieve.session import staged

HEAD = 32
HOT_ROWS = 512
HOT_TEXTS = 65_536


def hot_texts(rows: DataFrame, keep: str) -> DataFrame:
    """Texts of very many rows: digest, kept id, rows and salts; at most ``HOT_TEXTS`` rows."""
    limit = max(HOT_ROWS, rows.count() / HOT_TEXTS)
    hashes = F.broadcast(
        staged(rows.groupBy("_sort_hash").count().where(F.col("count") > limit).select("_sort_hash"), "hot-hashes")
    )
    chosen = F.max("_sort_id") if keep == "largest" else F.min("_sort_id")
    hot = (
        rows.join(hashes, "_sort_hash", "left_semi")
        .groupBy("_sort_text")
        .agg(chosen.alias("_sort_hot_keep"), F.count("*").alias("_sort_hot_rows"))
        .select(
            F.unhex(F.sha2("_sort_text", 256)).alias("_sort_sha"),
            "_sort_hot_keep",
            "_sort_hot_rows",
            F.ceil(F.col("_sort_hot_rows") / limit).alias("_sort_salts"),
        )
    )
    return staged(hot, "hot-texts")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest"
) -> DataFrame:
    """All rows and columns of ``docs`` with ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``keep`` is ``largest`` or ``smallest``: the id that stays. The new columns replace columns of
    the same name.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be largest or smallest, not {keep}")
    fresh = ("keep_id", "group_size", "kept", "text_sha256")
    carried = [c for c in docs.columns if c not in (*fresh, text_col)]
    text = full_text(text_col)
    rows = docs.select(
        *carried, F.col(id_col).alias("_sort_id"), F.col(text_col).isNull().alias("_sort_null"), text.alias("_sort_text")
    ).withColumn("_sort_hash", F.xxhash64("_sort_text"))
    hot = F.broadcast(hot_texts(rows.select("_sort_id", "_sort_text", "_sort_hash"), keep))
    dealt = (
        rows.withColumn("_sort_sha", F.unhex(F.sha2("_sort_text", 256)))
        .join(hot, "_sort_sha", "left")
        .withColumn("_sort_salt", F.coalesce(F.pmod(F.xxhash64("_sort_id"), "_sort_salts"), F.lit(0)))
        .withColumn("_sort_head", F.substring("_sort_text", 1, HEAD))
        .repartitionByRange("_sort_head", "_sort_sha", "_sort_salt")
    )
    # The range partitioning already holds what the window needs, so it adds a sort and no shuffle.
    side = F.col("_sort_id").asc_nulls_first() if keep == "largest" else F.col("_sort_id").desc_nulls_first()
    sorted_run = Window.partitionBy("_sort_head", "_sort_sha", "_sort_text", "_sort_salt").orderBy(side)
    whole_run = sorted_run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    run = dealt.withColumns(
        {
            "keep_id": F.coalesce("_sort_hot_keep", F.last("_sort_id").over(whole_run)),
            "group_size": F.coalesce("_sort_hot_rows", F.count("*").over(whole_run)),
            "_sort_last": F.lead(F.lit(False), 1, True).over(sorted_run),
        }
    )
    whole_text = F.when(~F.col("_sort_null"), F.col("_sort_text")).alias(text_col)
    return run.select(
        *[whole_text if c == text_col else c for c in docs.columns if c not in fresh],
        "keep_id",
        "group_size",
        (F.col("_sort_last") & F.col("_sort_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("_sort_sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs`` whatever their names."""
    inner = {c: f"_doc_{i}" for i, c in enumerate(docs.columns)}
    kept = exact_dedup(docs.toDF(*inner.values()), inner[id_col], inner[text_col]).where("kept")
    return kept.select(*[F.col(i).alias(c) for c, i in inner.items()])
