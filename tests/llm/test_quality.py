import zlib

import numpy as np

from helpers import awkward, nothing, rows_of
from txnsieve.llm import quality
from txnsieve.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op3_quality"](spark, SF).collect()}
    assert len(rows) == len(rows_of(SF, "documents", "doc_id"))
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows.values())
    labels = [(rows[i], q) for i, q in rows_of(SF, "labels", "doc_id, quality") if rows[i]["held_out"]]
    assert np.mean([r["predicted"] == q for r, q in labels]) >= 0.95
    assert all(r["predicted"] for r, q in labels if q == 1)


def test_tables_learn_a_pair(spark):
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(quality.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert (2, 5) in model.pairs
    assert ((model.scores(x) > 0.5) == y).mean() > 0.97


def test_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (8, None, 0), (None, 1, 1), (77, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    out = quality.score(docs, model)
    assert out.count() == docs.count() and sorted(out.columns) == sorted(docs.columns)
    scores = {r["doc_id"]: r["score"] for r in out.collect()}
    assert scores[2] == scores[3] and all(0 <= s <= 1 for s in scores.values())
    assert quality.keep_good(docs, model).columns == docs.columns
    none = quality.train(docs, labels.limit(0))
    assert all(r["score"] < 1e-5 for r in quality.score(docs, none).collect())
    assert quality.score(nothing(spark), model).count() == 0


def plain_margin(model, row):
    """The margin of one row by loops over the tables."""
    total = model.intercept
    for j, table in enumerate(model.tables):
        total += table[sum(edge <= row[j] for edge in model.edges[j])]
    for (i, j), table in zip(model.pairs, model.pair_tables):
        total += table[sum(e <= row[i] for e in model.pair_edges[i])][sum(e <= row[j] for e in model.pair_edges[j])]
    return total


def test_scores_equal_plain_loops(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    x = np.array([quality.features(t or "") for (t,) in rows_of(sf_dir, "documents", "text")])
    y = ((x[:, 2] > np.median(x[:, 2])) ^ (x[:, 10] > np.median(x[:, 10]))).astype(float)
    model = quality.fit(np.tile(x, (4, 1)), np.tile(y, 4))
    assert model.tables and model.pairs
    for r in quality.score(docs, model).collect():
        margin = plain_margin(model, quality.features(r["text"] or ""))
        assert abs(r["score"] - 1 / (1 + np.exp(-np.clip(margin, -35, 35)))) < 1e-12


def leaf_gain(g, h):
    return g * g / (h + quality.RIDGE)


def test_cuts_equal_a_search_of_all(monkeypatch):
    monkeypatch.setattr(quality, "MIN_LEAF", 1.0)
    rng = np.random.default_rng(3)
    for _ in range(40):
        g, h = rng.normal(size=6), rng.random(6) + 0.2
        gain, at = quality._cut(g, h)
        tried = {
            a: leaf_gain(g[:a].sum(), h[:a].sum()) + leaf_gain(g[a:].sum(), h[a:].sum()) - leaf_gain(g.sum(), h.sum())
            for a in range(1, 6)
            if h[:a].sum() >= 1 and h[a:].sum() >= 1
        }
        best = max([*tried.values(), 0.0])
        assert np.isclose(gain, best) and (gain <= 0 or np.isclose(tried[at], best))


def test_pair_trees_equal_a_search_of_all(monkeypatch):
    """Every cut of one axis with every cut, or none, of the other on each of its sides."""
    monkeypatch.setattr(quality, "MIN_LEAF", 0.5)
    rng = np.random.default_rng(4)
    for _ in range(25):
        g, h = rng.normal(size=(4, 3)), rng.random((4, 3)) + 0.2
        best = 0.0
        for gg, hh in ((g, h), (g.T, h.T)):
            for a in range(1, gg.shape[0]):
                gain = -leaf_gain(g.sum(), h.sum())
                sides = (slice(0, a), slice(a, None))
                if any(hh[s].sum() < 0.5 for s in sides):
                    continue
                for s in sides:
                    tried = [leaf_gain(gg[s].sum(), hh[s].sum())]
                    for b in range(1, gg.shape[1]):
                        parts = [(gg[s, :b].sum(), hh[s, :b].sum()), (gg[s, b:].sum(), hh[s, b:].sum())]
                        if all(w >= 0.5 for _, w in parts):
                            tried.append(sum(leaf_gain(x, w) for x, w in parts))
                    gain += max(tried)
                best = max(best, gain)
        gain, values = quality._pair_tree(g, h)
        assert np.isclose(gain, best)
        assert (gain == 0) == (not values.any())
