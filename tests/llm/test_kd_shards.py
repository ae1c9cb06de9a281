import zlib

import numpy as np
import pytest

from helpers import awkward, nothing, rows_of
from txnsieve.llm import kd_shards
from txnsieve.llm.queries import QUERIES


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op9_sharding"](spark, sf).collect()
    texts = {i: (t or "") for i, t in rows_of(sf, "documents", "doc_id, text")}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    shards, by_text = {}, {}
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw)
        assert r["law"] == "bytes" and r["grown_shard"] is None
        shards.setdefault(r["shard"], []).append(r)
        by_text.setdefault(raw, set()).add(r["shard"])
    assert set(shards) == set(range(16))
    sizes = np.array([sum(r["size"] for r in s) for s in shards.values()])
    largest = max(len(t.encode()) for t in texts.values())
    assert np.abs(sizes - sizes.mean()).max() <= largest
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(r["slot"] for r in s) == list(range(len(s))) for s in shards.values())


def test_hot_text_and_odd_counts(spark):
    rows = [(i, "the same text again and again") for i in range(600)] + [(1000 + i, "t" * (i % 90)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for n in (3, 5):
        got = kd_shards.kd_shards(docs, shards=n).collect()
        sizes = np.bincount([r["shard"] for r in got], weights=[r["size"] for r in got])
        assert len(sizes) == n and sizes.max() <= 1.15 * sizes.mean()
    got = kd_shards.kd_shards(docs, target_bytes=10_000).collect()
    assert len({r["shard"] for r in got}) == -(-sum(r["size"] for r in got) // 10_000)


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = kd_shards.kd_shards(docs, shards=4)
    assert got.count() == docs.count()
    assert [r["size"] for r in got.where("doc_id = 2").collect()] == [1]
    assert kd_shards.kd_shards(nothing(spark), shards=16).count() == 0
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


def in_memory(points, leaves):
    """The k-d tree over all points at once: the shard of each."""
    every = range(len(points[0][2]))
    whole = [max(1, max(p[2][d] for p in points) - min(p[2][d] for p in points)) for d in every]
    out = {}

    def split(rows, first, k):
        if k == 1 or not rows:
            out.update({i: first for i, _, _ in rows})
            return
        wide = [(max(r[2][d] for r in rows) - min(r[2][d] for r in rows)) / whole[d] for d in every]
        dim = wide.index(max(wide))
        goal, upto = k // 2 / k * sum(r[1] for r in rows), 0
        by = {}
        for r in rows:
            by[r[2][dim]] = by.get(r[2][dim], 0) + r[1]
        for c in sorted(by):
            if upto + by[c] >= goal:
                cut = c + 1 if abs(upto + by[c] - goal) <= abs(goal - upto) else c
                break
            upto += by[c]
        split([r for r in rows if r[2][dim] < cut], first, k // 2)
        split([r for r in rows if r[2][dim] >= cut], first + k // 2, k - k // 2)

    split(points, 0, leaves)
    return out


def keys_of(docs, leaves):
    points = kd_shards._points(docs, "doc_id", "text")
    total = points.groupBy().sum("size").first()[0]
    keys = kd_shards._with_parts(points, max(1.0, total / leaves / kd_shards.SPLIT_COPIES))
    return [(r["_kd_id"], r["size"], [r[d] for d in kd_shards.DIMENSIONS]) for r in keys.collect()]


@pytest.mark.parametrize("leaves", [1, 2, 7, 16, 300])
def test_cuts_equal_an_in_memory_tree(spark, sf_dir, leaves):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r["shard"] for r in kd_shards.kd_shards(docs, shards=leaves).collect()}
    assert got == in_memory(keys_of(docs, leaves), leaves)


def test_few_bins_and_salted_nodes(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(kd_shards, "BINS", 7)
    monkeypatch.setattr(kd_shards, "MAX_BROADCAST_ROWS", 0)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r["shard"] for r in kd_shards.kd_shards(docs, shards=5).collect()}
    assert got == in_memory(keys_of(docs, 5), 5)


def test_more_leaves_than_rows(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 9 + 1)) for i in range(30)], "doc_id long, text string")
    got = kd_shards.kd_shards(docs, target_bytes=0.2).collect()
    assert len(got) == 30 and all(0 <= r["shard"] < sum(r["size"] for r in got) * 5 for r in got)
