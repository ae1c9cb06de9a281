import random

import numpy as np

from helpers import awkward, near_components, nothing, rows_of, shingles
from txnsieve.llm import ngram_join
from txnsieve.llm.components import connected
from txnsieve.llm.queries import QUERIES


def test_equals_all_pairs(spark, sf_dir):
    texts = dict(rows_of(sf_dir, "documents", "doc_id, text"))
    rows = QUERIES["op5_ngram_join"](spark, sf_dir).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == near_components(texts)
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {i: len(shingles(t)) for i, t in texts.items()}


def test_long_lists_and_chains(spark):
    """A large group of near copies, chains of drifting copies, and one line that most texts share."""
    random.seed(9)
    words = ["".join(random.choice("abcdefghij") for _ in range(4)) for _ in range(3000)]

    def some(n):
        return [random.choice(words) for _ in range(n)]

    def changed(text, n):
        text = list(text)
        for _ in range(n):
            text[random.randrange(len(text))] = random.choice(words)
        return text

    base, line = some(120), some(40)
    texts = [changed(base, random.randint(0, 7)) for _ in range(150)]
    drift = some(100)
    for _ in range(25):
        drift = changed(drift, 2)
        texts.append(drift)
    texts += [some(60) + line for _ in range(60)] + [some(8) + line for _ in range(40)]
    texts = {10 * i + 3: " ".join(t) for i, t in enumerate(texts)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicates(docs).collect()}
    assert got == near_components(texts)


def test_awkward_rows(spark):
    docs = awkward(spark, ["one two", "One TWO", "one two three four five", "ONE two three four five"])
    rows = ngram_join.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert got[1] == got[6] and got[6][1] == 1
    assert got[2] == (0, 2) and got[3] == (0, 3) and got[4] == (0, 4)
    assert got[100] == (1, 100) and got[101] == (1, 100) and got[103] == (1, 102)
    assert got[None] == (1, None)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 8, 9, 100, 102]
    assert ngram_join.near_duplicates(nothing(spark)).count() == 0


def test_bounds():
    random.seed(1)
    for _ in range(300):
        a, b = (np.unique(np.random.default_rng(random.randrange(1 << 30)).integers(0, 3000, random.randint(1, 900)).astype(np.uint64)) for _ in "ab")
        a, b = (ngram_join._mixed(x) for x in (a, b))
        shared = len(np.intersect1d(a, b))
        assert ngram_join.most_shared(ngram_join.bitmap(a), len(a), ngram_join.bitmap(b), len(b)) >= shared
        need = ngram_join.least_overlap(len(a), len(b))
        assert (100 * shared >= 75 * (len(a) + len(b) - shared)) == (shared >= need)


def test_components(spark):
    random.seed(2)
    pairs = [(i, i + 1) for i in range(0, 60) if i % 13] + [(random.randrange(100, 200), random.randrange(100, 200)) for _ in range(60)]
    pairs += [(7, 7), (300, 300), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    got = connected(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in got} == {x: find(x) for x in root} and len(got) == len(root)
