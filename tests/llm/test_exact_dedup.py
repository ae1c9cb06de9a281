import hashlib

import duckdb
from pyspark.sql import functions as F

from helpers import awkward, nothing
from txnsieve.llm import exact_dedup
from txnsieve.llm.queries import ORACLES, QUERIES


def test_equals_sql(spark, sf_dir):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    want = sorted(duckdb.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES['op7_exact_dedup']})").fetchall())
    got = QUERIES["op7_exact_dedup"](spark, sf_dir).select(columns)
    assert sorted(map(tuple, got.collect())) == want


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = exact_dedup.exact_dedup(docs)
    by_id = {}
    for r in found.collect():
        by_id.setdefault(r["doc_id"], []).append(r)
    assert found.count() == docs.count()
    assert [r["keep_id"] for r in by_id[2] + by_id[3]] == [3, 3]  # null counts as empty
    assert by_id[2][0]["text"] is None
    assert [r["kept"] for r in by_id[6]].count(True) == 1 and not by_id[1][0]["kept"]
    assert by_id[1][0]["group_size"] == 3
    assert by_id[None][0]["kept"]
    assert by_id[3][0]["text_sha256"] == hashlib.sha256(b"").hexdigest()
    stay = exact_dedup.drop_copies(docs)
    assert stay.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in stay.collect()) == [0, 3, 4, 5, 6, 8, 9]
    assert {r["keep_id"] for r in stay.collect()} == {"k"}


def test_hot_texts_and_smallest(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", 5)
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 150)).alias("text")
    )
    for keep, hot in (("largest", 297), ("smallest", 0)):
        rows = exact_dedup.exact_dedup(docs, keep=keep).collect()
        assert {(r["keep_id"], r["group_size"]) for r in rows if r["text"] == "hot"} == {(hot, 100)}
        kept = [r["text"] for r in rows if r["kept"]]
        assert len(kept) == len(set(kept)) == 101


def test_empty_and_plan(spark):
    assert exact_dedup.exact_dedup(nothing(spark)).count() == 0
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = exact_dedup.exact_dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange rangepartitioning") == 1
    assert "Exchange hashpartitioning" not in plan
