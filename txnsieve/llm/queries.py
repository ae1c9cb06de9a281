"""Registered queries of these operators; each reads a whole table and returns its full result."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnsieve.llm import (
    decontamination,
    exact_dedup,
    kd_shards,
    ngram_join,
    packing,
    periodic_runs,
    pii,
    quality,
    token_counts,
    toxicity,
    unigram,
    vptree,
    whitening,
)
from txnsieve.llm.common import documents, held_out, ship_package, table

SHARDS = 16


def tokenizer_path(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data per document, as counts, digest and text."""
    found = pii.find_pii(documents(spark, sf_dir).select("doc_id", "text"))
    spans = F.col("pii_spans")
    counts = [pii.count_kind(spans, k.name).alias(f"n_{k.name}") for k in pii.KINDS if k.base]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.span_text(pii.base_spans(spans)), 256).alias("base_sha256"),
        pii.span_text(spans).alias("spans"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    return packing.pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by a model of the labelled rows outside the held-out fold."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return _scored(quality.score(docs, model), quality.THRESHOLD)


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every 20th vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return vptree.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near duplicates of every document."""
    return ngram_join.near_duplicates(documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by a model of the labelled rows outside the held-out fold."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return _scored(toxicity.score(docs, model), toxicity.THRESHOLD)


def _scored(rows: DataFrame, threshold: float) -> DataFrame:
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "score", predicted)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, kept row and digest of every document."""
    return exact_dedup.exact_dedup(documents(spark, sf_dir).select("doc_id", "text")).drop("text")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy word pieces of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return token_counts.count_tokens(docs, tokenizer_path("byte_bpe_50k.json")).drop("text")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; shards have near-equal bytes."""
    dealt = kd_shards.kd_shards(documents(spark, sf_dir), shards=SHARDS)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document as count and checksum, and whether decoding gives the text back."""
    model = tokenizer_path("piece_bpe_32k.model")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    back = unigram.decode(unigram.encode(docs, model), model)
    return back.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector on the first four whitened components."""
    white = whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)
    each = white.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        F.col("explained")[F.col("at")].alias("explained"),
        "identity_error",
    )


def _with_loops(docs: DataFrame) -> DataFrame:
    """Every tenth text, by a hash of its id, repeats a block of its words from some word to its end."""
    ids = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", -1), lambda w: w != F.lit(""))
    chosen = docs.select("doc_id", "text", ids.alias("h"), F.when(ids % 10 == 0, words).alias("words"))
    n, g, a, p = F.size("words"), F.floor(F.col("h") / 10), F.col("a"), F.col("p")
    looped = chosen.withColumn("a", F.when(n > 0, F.pmod(g, n)).cast("int"))
    looped = looped.withColumn("p", (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int"))
    blocks = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    text = F.array_join(F.slice(F.concat(F.slice("words", F.lit(1), a), blocks), F.lit(1), n), " ")
    return looped.select("doc_id", F.when(a.isNotNull(), text).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, the longest of them, and digests of all runs and of the text without repeats."""
    found = periodic_runs.periodic_runs(_with_loops(documents(spark, sf_dir)))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        longest.alias("longest"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    length = -F.col("longest.less")
    return rows.select(
        "doc_id",
        "n_runs",
        F.col("longest.start").alias("start"),
        length.alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(1000 * length / F.col("longest.period")).alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat ten words of a benchmark item, and the items."""
    found = decontamination.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _with_package(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query after its executors got this package; for queries that run Python there."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    "op1_pii": op1_pii,
    "op2_packing": _with_package(op2_packing),
    "op3_quality": _with_package(op3_quality),
    "op4_nearest": _with_package(op4_nearest),
    "op5_ngram_join": _with_package(op5_ngram_join),
    "op6_toxicity": _with_package(op6_toxicity),
    "op7_exact_dedup": op7_exact_dedup,
    "op8_token_counts": _with_package(op8_token_counts),
    "op9_sharding": op9_sharding,
    "op10_unigram": _with_package(op10_unigram),
    "op11_whitening": _with_package(op11_whitening),
    "op12_periodic_runs": _with_package(op12_periodic_runs),
    "op13_decontamination": op13_decontamination,
}

ORACLES = {
    "op5_ngram_join": r"""
        WITH RECURSIVE words AS (
          SELECT doc_id, list_filter(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
          FROM documents),
        sets AS (
          SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
            ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS grams
          FROM words),
        each AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets),
        shared AS (
          SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k, any_value(a.n) AS na, any_value(b.n) AS nb
          FROM each a JOIN each b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
        links AS (SELECT a, b FROM shared WHERE 100 * k >= 75 * (na + nb - k)),
        reached AS (
          SELECT doc_id AS node, doc_id AS root FROM sets
          UNION SELECT links.b, reached.root FROM reached JOIN links ON links.a = reached.node)
        SELECT sets.doc_id, len(grams) AS n_shingles, min(root) AS component_id
        FROM sets JOIN reached ON reached.node = sets.doc_id GROUP BY sets.doc_id, len(grams)
    """,
    "op7_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(whole) AS text_sha256
        FROM (SELECT doc_id, coalesce(text, '') AS whole FROM documents)
        WINDOW same AS (PARTITION BY whole)
    """,
    "op13_decontamination": r"""
        WITH doc_words AS (
          SELECT row_number() OVER () AS doc_row, doc_id, list_filter(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
          FROM documents),
        item_words AS (
          SELECT cast(item_id AS varchar) AS item, list_filter(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
          FROM benchmark),
        windows AS (
          SELECT DISTINCT item, k, array_to_string(ws[i:i + k - 1], ' ') AS gram
          FROM (SELECT item, ws, least(10, len(ws)) AS k, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i
                FROM item_words WHERE len(ws) > 0)),
        grams AS (
          SELECT doc_row, k, i, array_to_string(ws[i:i + k - 1], ' ') AS gram
          FROM (SELECT doc_row, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
                FROM doc_words JOIN (SELECT DISTINCT k FROM windows) ON len(ws) >= k)),
        found AS (SELECT doc_row, i, grams.k, item FROM grams JOIN windows ON grams.gram = windows.gram AND grams.k = windows.k),
        hits AS (
          SELECT doc_row, count(DISTINCT place) AS n_hit
          FROM (SELECT doc_row, unnest(range(i, i + k)) AS place FROM (SELECT DISTINCT doc_row, i, k FROM found)) GROUP BY doc_row),
        listed AS (
          SELECT doc_row, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
          FROM found GROUP BY doc_row)
        SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc_words LEFT JOIN hits USING (doc_row) LEFT JOIN listed USING (doc_row)
    """,
}
