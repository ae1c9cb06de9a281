import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from txnsieve.llm import vptree
from txnsieve.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, queries, k):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids], dtype=float)
    out = {}
    for q in queries:
        score = x @ np.array(vectors[q], dtype=float)
        order = [o for o in np.lexsort((ids, -score)) if ids[o] != q][:k]
        out[q] = [(int(ids[o]), float(score[o])) for o in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall(spark, sf_dir):
    vectors = {i: [np.float32(x) for x in v] for i, v in rows_of(sf_dir, "embeddings", "vec_id, embedding")}
    want = brute(vectors, [i for i in vectors if i % 20 == 0], 20)
    got = found(QUERIES["op4_nearest"](spark, sf_dir))
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 20 * len(want)


@pytest.mark.parametrize("shard_rows", [16, 4096])
def test_exact_at_factor_one(spark, shard_rows):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(240, 6)) * rng.random((240, 1)) * 3
    base[40:80] = base[40]  # one vector of many rows, so ties decide
    base[80:90] = np.round(base[80:90])
    base[80] = 1
    vectors = {int(i): [float(np.float32(v)) for v in x] for i, x in enumerate(base)}
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors.items()], SCHEMA)
    got = found(vptree.nearest(df, df.where("vec_id % 7 = 0"), k=5, relax=1.0, shard_rows=shard_rows))
    want = brute(vectors, [i for i in vectors if i % 7 == 0], 5)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-12)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1),
        (6, [1.0, None], 1), (7, [], 1), (8, [1.0, 2.0, 3.0], 1), (None, [9.0, 9.0], 1), (20, [0.5, 0.5], 1), (20, [0.5, 0.5], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'r' AS rank", "'s' AS score")
    got = found(vptree.nearest(df, df.where("vec_id % 20 = 0")))
    assert got == {0: [(1, 0.5), (20, 0.5)], 20: [(0, 0.5), (1, 0.5)]}
    three = found(vptree.nearest(df.unionByName(df.where("vec_id = 8").withColumn("vec_id", F.lit(9))), df.where("vec_id = 8")))
    assert three == {8: [(9, 14.0)]}  # a query finds vectors of its own length
    empty = spark.createDataFrame([], SCHEMA)
    assert vptree.nearest(empty, empty).count() == 0
    assert vptree.nearest(df, df.limit(0)).count() == 0


def unit_vectors(count=2400, clusters=0):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(count, 32))
    if clusters:
        x = rng.normal(size=(clusters, 32))[rng.integers(0, clusters, count)] + 0.6 * x
    return x / np.linalg.norm(x, axis=1)[:, None]


def one_long(factor, clusters=0):
    x = unit_vectors(clusters=clusters)
    x[17] *= factor
    return x


def heavy_tailed():
    x = unit_vectors()
    return x * np.random.default_rng(12).lognormal(0, 1, len(x))[:, None]


@pytest.mark.parametrize("shard_rows", [300, 4096])
@pytest.mark.parametrize("base", [one_long(10), one_long(50), one_long(50, 20), heavy_tailed()], ids=["x10", "x50", "x50 clusters", "log-normal"])
def test_recall_of_uneven_norms(spark, base, shard_rows):
    vectors = {i: [float(np.float32(v)) for v in x] for i, x in enumerate(base)}
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors.items()], SCHEMA)
    got = found(vptree.nearest(df, df.where("vec_id % 40 = 0"), shard_rows=shard_rows))
    want = brute(vectors, [i for i in vectors if i % 40 == 0], 20)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    print("recall", hits / (20 * len(want)))
    assert hits >= 0.9 * 20 * len(want)


def test_repeated_id_takes_one_place(spark):
    rows = [(3, [1.0, 0.0], 0)] * 30 + [(i, [1.0, 0.0], 0) for i in range(10, 35)] + [(50, [0.5, 0.5], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(vptree.nearest(df, df.where("vec_id IN (3, 50)")))
    assert [i for i, _ in got[3]] == list(range(10, 30))
    assert [i for i, _ in got[50]] == [3, *range(10, 29)]


@pytest.mark.parametrize("relax", [1.0, 0.9])
def test_extreme_norms(spark, relax):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(300, 5))
    scales = [1.0, 1e-160, 1e150, 1e-60, 1e120, 1e-120]
    base *= np.array([scales[i % 6] for i in range(300)])[:, None]
    vectors = {i: [float(v) for v in x] for i, x in enumerate(base)}
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors.items()], "vec_id long, embedding array<double>, label int")
    got = found(vptree.nearest(df, df.where("vec_id % 7 = 0"), k=5, relax=relax, shard_rows=64))
    want = brute(vectors, [i for i in vectors if i % 7 == 0], 5)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


@pytest.mark.parametrize("rows", [
    [(0, [1e200, 1e200]), (1, [1e200, 5e199]), (2, [1.0, 0.0]), (3, [-1e200, 0.0])],
    [(0, [1e100, 0.0]), (1, [1e-60, 0.0]), (2, [0.0, 1e100]), (3, [5e-324, 0.0])],
    [(0, [1.0, 0.0]), (1, [1e-158, 0.0]), (2, [1e-158, 1e-158]), (3, [-1e-300, 0.0])],
])
def test_no_finite_vector_overflows(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(vptree.nearest(df, df))
    with np.errstate(over="ignore"):
        want = brute(dict(rows), range(4), 20)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(s == w or abs(s - w) <= 1e-12 * abs(w) for q in want for (_, s), (_, w) in zip(got[q], want[q]))


def test_many_visits_to_one_shard(spark, monkeypatch):
    monkeypatch.setattr(vptree, "QUERY_BLOCK", 50)
    rng = np.random.default_rng(9)
    vectors = {i: [float(v) for v in x] for i, x in enumerate(rng.normal(size=(400, 4)))}
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors.items()], SCHEMA.replace("float", "double"))
    got = found(vptree.nearest(df, df, k=3, relax=1.0))
    want = brute(vectors, range(400), 3)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
