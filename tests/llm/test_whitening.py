import math

import numpy as np
import pytest

from helpers import rows_of
from txnsieve.llm import whitening
from txnsieve.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, components=None):
    """n, deviation by row, whitened rows (either sign), explained: with whole matrices in memory."""
    x = np.array([np.floor(256 * np.array(v, dtype=float)) for v in vectors], dtype=object).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = fit - total / n
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    values, vecs = values[::-1][:components], vecs[:, ::-1][:, :components]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, total)) for row in x]
    with np.errstate(invalid="ignore", divide="ignore"):
        return n, deviation, (x - total / n) @ vecs / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_query_equals_whole_matrices(spark, sf_dir):
    vectors = {i: v for i, v in rows_of(sf_dir, "embeddings", "vec_id, embedding")}
    usable = [(i, v) for i, v in vectors.items() if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, deviation, white, explained = brute([v for _, v in usable], 4)
    got = {(r["vec_id"], r["component"]): r for r in QUERIES["op11_whitening"](spark, sf_dir).collect()}
    assert len(got) == 4 * len(usable)
    signs = [np.sign(got[usable[0][0], c + 1]["whitened"] * white[0, c]) for c in range(4)]
    for (i, _), d, w in zip(usable, deviation, white):
        for c in range(4):
            r = got[i, c + 1]
            assert (r["n"], r["deviation"]) == (n, d)
            assert r["whitened"] * signs[c] == pytest.approx(w[c], abs=1e-9)
            assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
            assert 0 <= r["identity_error"] < 1e-9


def test_many_blocks_and_all_components(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS_PER_BLOCK", 32)
    monkeypatch.setattr(whitening, "COLS_PER_BLOCK", 4)
    monkeypatch.setattr(whitening, "SPLIT_BLOCKS", 2)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(500, 10)) * np.arange(1, 11)
    base[100:300] = base[100]  # a third of all rows are one vector, which the fit holds once
    df = spark.createDataFrame([(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(base)], SCHEMA)
    n, deviation, white, explained = brute(np.float32(base))
    got = {r["vec_id"]: r for r in whitening.whiten(df).collect()}
    assert n == 301 and len(got) == 500 and got[0]["n"] == 301
    signs = np.sign(np.array(got[0]["whitened"]) * white[0])
    for i in range(500):
        assert got[i]["deviation"] == deviation[i]
        assert np.allclose(np.array(got[i]["whitened"]) * signs, white[i], atol=1e-9)
    assert np.allclose(got[0]["explained"], explained)
    assert got[0]["identity_error"] < 1e-9


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [0.0, 2.0], 1), (3, [3.0, 5.0], 1), (3, [3.0, 5.0], 1), (None, [-0.0, 2.0], 1),
        (4, None, 1), (5, [nan, 1.0], 1), (6, [1.0, inf], 1), (7, [None, 1.0], 1), (8, [], 1), (9, [7.0, 7.0, 7.0], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS x", "'n' AS n", "'d' AS deviation", "1 AS _index")
    got = whitening.whiten(df).collect()
    assert sorted((r["vec_id"] or 0) for r in got) == [0, 1, 2, 3, 3]
    assert {r["n"] for r in got} == {3} and {len(r["whitened"]) for r in got} == {2}  # the only vector of three entries has no spread
    by_id = {r["vec_id"]: r for r in got}
    assert by_id[None]["whitened"] == by_id[2]["whitened"]  # minus zero is zero on the grid
    _, deviation, _, _ = brute([[1.0, 0.0], [0.0, 2.0], [3.0, 5.0]])
    assert [by_id[i]["deviation"] for i in (1, 2, 3)] == deviation
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(df.where("vec_id IN (4, 8, 9)")).count() == 0


def test_large_entries_and_flat_directions(spark):
    rows = [(1, [1e300, 1.0]), (2, [-1e300, 1.0]), (3, [5.0, 1.0])]
    got = {r["vec_id"]: r for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert {len(r["whitened"]) for r in got.values()} == {1}  # the second entry does not vary
    assert got[1]["deviation"] is None  # beyond a long
    assert got[1]["whitened"][0] == pytest.approx(-got[2]["whitened"][0])
    exact = [(i, [float(2**30 * i), 0.5 * i]) for i in range(1, 200)]
    df = spark.createDataFrame(exact, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(df, 1).collect()}
    x = [(2**38 * i, 128 * i) for i in range(1, 200)]
    total = [sum(c) for c in zip(*x)]
    for i, row in enumerate(x, 1):
        want = sum((199 * a - s) ** 2 for a, s in zip(row, total))
        assert got[i] == (want if want < 2**63 else None)


def test_no_task_multiplies_all_rows(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS_PER_BLOCK", 8)
    rows = spark.range(400).selectExpr("id AS _index", "array(id * 7 % 31, id) AS x")
    matrix = whitening.block_matrix(rows, [0, 0], 1, 400)
    assert matrix.numRowBlocks == 50
    x = np.array([(i * 7 % 31, i) for i in range(400)], dtype=float)
    assert np.array_equal(whitening.scatter(matrix), x.T @ x)
