import hashlib
import random
import re

import duckdb
from pyspark.sql import functions as F

from helpers import awkward, nothing
from txnsieve.llm import decontamination
from txnsieve.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def words(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return WORD.findall((text or "").translate(lower))


def brute(texts, items, window=10):
    """(words, hits, items) of every text, by comparing every window with every place."""
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            k = min(window, len(v))
            for i in range(len(v) - k + 1 if v else 0):
                for j in range(len(w) - k + 1):
                    if w[j : j + k] == v[i : i + k]:
                        hit |= set(range(j, j + k))
                        if item_id is not None:
                            found.add(str(item_id))
        out.append((len(w), len(hit), sorted(found)))
    return out


def test_equals_sql(spark, sf_dir):
    for table in ("documents", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    want = duckdb.sql(ORACLES["op13_decontamination"])
    columns = want.columns
    got = sorted(tuple(r) for r in QUERIES["op13_decontamination"](spark, sf_dir).select(columns).collect())
    assert got == sorted(want.fetchall())
    assert any(r[columns.index("contaminated")] for r in got)


def test_equals_brute_force(spark):
    random.seed(8)
    few = ["the", "a", "b", "c"]
    texts = [" ".join(random.choice(few) for _ in range(random.randint(0, 60))) for _ in range(80)]
    items = [(i % 17, " ".join(random.choice(few) for _ in range(random.randint(0, 7)))) for i in range(30)]
    texts += [f"{t} | {items[i % 30][1].upper()}! {t}" for i, t in enumerate(texts[:20])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for window in (1, 4):
        got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontamination.contamination(docs, spark.createDataFrame(items, ITEMS), window).collect()}
        assert [got[i] for i in range(len(texts))] == brute(texts, items, window)


def test_awkward_rows(spark):
    passage = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    docs = awkward(spark, [f"x {passage.upper()} y", f"{passage} {passage}", "alpha beta gamma delta epsilon zeta eta theta iota", "Zwölf, ÄPFEL"])
    items = [
        (1, passage), (1, "wholly other words"), (2, None), (3, ""), (4, "?!"), (None, "plain words in a row that mean little to anybody here"),
        (5, "zwölf"), (6, passage), (7, "äpfel"),
    ]
    bench = spark.createDataFrame([(*i, "t", 0) for i in items], f"{ITEMS}, term string, row int")
    got = decontamination.contamination(docs, bench)
    rows = got.collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert (by_id[100]["n_hit"], by_id[100]["items"]) == (11, ["1", "6"])
    assert (by_id[101]["n_hit"], by_id[101]["n_words"]) == (22, 22)
    assert by_id[102]["n_hit"] == 0
    assert (by_id[103]["n_hit"], by_id[103]["items"]) == (1, ["5"])  # only A-Z are lower-cased
    assert (by_id[1]["n_hit"], by_id[1]["items"]) == (11, [])  # an item without an id is in no list
    for empty in (2, 3, 4):
        assert (by_id[empty]["n_words"], by_id[empty]["n_hit"], by_id[empty]["items"]) == (0, 0, [])
    assert [r["doc_id"] for r in rows].count(6) == 2 and by_id[None]["n_words"] == 5
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = [i for i in texts if i != 5]
    assert [(by_id[i]["n_words"], by_id[i]["n_hit"], by_id[i]["items"]) for i in ids] == brute([texts[i] for i in ids], items)
    assert decontamination.contamination(nothing(spark), bench).count() == 0
    assert {r["n_hit"] for r in decontamination.contamination(docs, bench.limit(0)).collect()} == {0}


def test_joins_without_broadcast_and_hot_words(spark, monkeypatch):
    monkeypatch.setattr("txnsieve.operators.lookups.fits_broadcast", lambda df, max_rows=0: False)
    text = "the " * 60 + "one two three four five six seven eight nine ten"
    texts = [text] * 40 + ["the one two", "two one"]
    items = [(1, "the the the one two three four five six seven eight"), (2, "the " * 12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontamination.contamination(docs, spark.createDataFrame(items, ITEMS)).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, items)


def test_index_segments_and_matches(spark):
    docs = spark.createDataFrame([(1, "b a b"), (2, "A, b"), (3, "")], "doc_id long, text string").coalesce(1)
    index = decontamination.positional_index(docs)
    postings = [(r["term"], r["row"], r["position"], r["doc_id"]) for r in index.collect()]
    assert postings == [("", 0, 3, 1), ("", 1, 2, 2), ("", 2, 0, 3), ("a", 0, 1, None), ("a", 1, 0, None), ("b", 0, 0, None), ("b", 0, 2, None), ("b", 1, 1, None)]
    phrases = spark.createDataFrame([(7, ["a", "b"]), (8, ["b"]), (9, ["a", "zzz"])], "phrase long, words array<string>")
    found = sorted(tuple(r) for r in decontamination.phrase_matches(index, phrases).collect())
    assert found == [(0, 0, 8), (0, 1, 7), (0, 2, 8), (1, 0, 7), (1, 1, 8)]


def test_proximity(spark):
    random.seed(2)
    texts = [" ".join(random.choice("abcdefgh") for _ in range(random.randint(0, 40))) for _ in range(50)] + ["rare a b", "a x x x x rare"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = decontamination.positional_index(docs)
    rows = {r["row"]: r["doc_id"] for r in decontamination.indexed_documents(index).collect()}
    asked = [(1, ["a", "b"]), (2, ["rare", "a", "a"]), (3, ["c", "d", "e"]), (4, ["f"])]
    counts = {}
    for t in texts:
        for w in t.split():
            counts[w] = counts.get(w, 0) + 1
    found = decontamination.near_matches(index, spark.createDataFrame(asked, "phrase long, words array<string>"), 3)
    got = sorted((rows[r["row"]], r["position"], r["phrase"]) for r in found.collect())
    want = []
    for phrase, terms in asked:
        distinct = list(dict.fromkeys(terms))
        rarest = min(distinct, key=lambda t: (counts[t], distinct.index(t)))
        for doc, text in enumerate(texts):
            w = text.split()
            for p, term in enumerate(w):
                if term == rarest and set(distinct) <= set(w[max(0, p - 3) : p + 4]):
                    want.append((doc, p, phrase))
    assert got == sorted(want)


def test_no_python_and_no_cross_join(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    index = decontamination.positional_index(docs)
    phrases, _ = decontamination.item_windows(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    for df in (index, decontamination.phrase_matches(index, phrases), decontamination.near_matches(index, phrases, 5)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
    assert index.select(F.count("*")).first()[0] > 0
