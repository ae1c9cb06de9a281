import corpus_pipeline
from helpers import awkward, near_components, nothing
from txnsieve.llm import pii
from txnsieve.session import staged


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = staged(stage(spark, before, sf_dir), name)
        steps[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns

    before, after = steps["exact_dedup"]
    last = {r["text"] or "": r["doc_id"] for r in sorted(before.collect(), key=lambda r: r["doc_id"])}
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(last.values())

    before, after = steps["ngram_join"]
    groups = near_components({r["doc_id"]: r["text"] for r in before.collect()})
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(set(groups.values()))

    before, after = steps["pii"]
    assert after.count() == before.count()
    left = pii.find_pii(after).selectExpr("sum(size(pii_spans)) AS n").first()["n"]
    assert left == 0 and pii.find_pii(before).selectExpr("sum(size(pii_spans)) AS n").first()["n"] > 0

    before, after = steps["packing"]
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()}


def test_names_and_run(spark, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_join", "pii", "packing"]
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(rows.columns)


def through(spark, docs, labels, folder):
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return corpus_pipeline.run(spark, folder)


def test_awkward_and_empty_tables(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows and columns with the names that stages use."""
    texts = ["write to ann@example.org or 10.1.2.3 about the meeting on the second floor", "some toxic zorblat words " * 4]
    docs = awkward(spark, texts)
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (None, 1, 1), (101, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")
    pieces = through(spark, docs, labels, f"{tmp_path}/a").collect()
    assert {r["doc_id"] for r in pieces} >= {5, 6, 8, 9, 100, None} and not {1, 2} & {r["doc_id"] for r in pieces}
    by_doc = {}
    for r in pieces:
        by_doc.setdefault(r["doc_id"], []).append(r["length"])
    assert all(sum(v) >= 1 for v in by_doc.values())
    assert through(spark, nothing(spark), labels, f"{tmp_path}/b").count() == 0
    assert through(spark, docs, labels.limit(0), f"{tmp_path}/c").count() > 0
