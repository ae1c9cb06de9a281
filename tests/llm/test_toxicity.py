import zlib

import numpy as np

from helpers import awkward, nothing, rows_of
from txnsieve.llm import toxicity
from txnsieve.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op6_toxicity"](spark, SF).collect()}
    assert len(rows) == len(rows_of(SF, "documents", "doc_id"))
    labels = [(rows[i], t) for i, t in rows_of(SF, "labels", "doc_id, toxic")]
    held = [(r, t) for r, t in labels if r["held_out"]]
    assert np.mean([r["predicted"] == t for r, t in held]) >= 0.9
    assert not any(r["predicted"] for r, t in held if t == 0)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())


def test_grams_are_exact():
    text = "Ab  cé\nd"
    raw = toxicity.normalise(text)
    assert raw == " ab cé d ".encode()
    keys = toxicity.distinct_grams(text)
    want = {(n, raw[i : i + n]) for n in toxicity.ORDERS for i in range(len(raw) - n + 1)}
    got = {(int(k) >> 56, (int(k) & ((1 << 56) - 1)).to_bytes(int(k) >> 56, "big")) for k in keys}
    assert got == want
    matcher = toxicity.GramMatcher(np.sort(keys[::3]))
    assert matcher.hits(text).tolist() == list(range(len(keys[::3])))
    assert not len(matcher.hits("zzzzzzz"))


def test_planted_words_and_awkward_rows(spark):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    texts = [" ".join(rng.choice(words, 60)) for _ in range(300)]
    texts = [t + " you zorblat fool" if i % 4 == 0 else t for i, t in enumerate(texts)]
    docs = awkward(spark, texts)
    labels = spark.createDataFrame([(100 + i, 1, int(i % 4 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    out = toxicity.score(docs, model)
    rows = {r["doc_id"]: r["score"] for r in out.collect()}
    assert all((rows[100 + i] >= 0.5) == (i % 4 == 0) for i in range(300))
    assert rows[2] == rows[3] and out.count() == docs.count()
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 75
    assert toxicity.score(nothing(spark), model).count() == 0
    none = toxicity.train(docs, labels.limit(0))
    assert toxicity.drop_toxic(docs, none).count() == docs.count()


def test_held_out_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in QUERIES["op6_toxicity"](spark, sf).collect()}
    held = [(rows[i]["predicted"], t) for i, t in rows_of(sf, "labels", "doc_id, toxic") if rows[i]["held_out"]]
    found = [p for p, t in held if t == 1]
    print("held-out recall", sum(found), len(found), "false positives", sum(p for p, t in held if t == 0))
    assert np.mean(found) >= 0.75
    assert not any(p for p, t in held if t == 0)


def test_rare_toxic_words_among_very_many_common_grams(spark):
    rng = np.random.default_rng(6)
    common = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789"), 70_000))
    assert len(toxicity.distinct_grams(common)) > 1 << 18
    toxic = [i % 9 == 0 for i in range(360)]
    planted = [t and i % 4 != 0 for i, t in enumerate(toxic)]
    docs = spark.createDataFrame([(i, common + " zorblat" * p) for i, p in enumerate(planted)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(toxic)], "doc_id long, toxic int")
    model = toxicity.train(docs.repartition(8), labels)
    asked = spark.createDataFrame([(0, "a zorblat here"), (1, "a word here")], "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(asked, model).collect()}
    assert scores[0] >= 0.5 > scores[1]


def gram_set(text):
    raw = toxicity.normalise(text)
    return {raw[i : i + n] for n in toxicity.ORDERS for i in range(len(raw) - n + 1)}


def named(key):
    n = int(key) >> 56
    return (int(key) & ((1 << 56) - 1)).to_bytes(n, "big")


def test_ratios_and_scores_equal_plain_counts(spark):
    """N-grams by z-score, their ratios, and scores as sums over the n-grams of a text, all by plain counting."""
    rng = np.random.default_rng(12)
    words = ["".join(rng.choice(list("abcd"), 3)) for _ in range(25)]
    texts = [" ".join(rng.choice(words, 12)) + (" zor blat" if i % 5 == 0 else "") for i in range(400)]
    toxic = [int(i % 5 == 0) for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    seen = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    counts = {}
    for i in seen:
        for gram in gram_set(texts[i]):
            counts.setdefault(gram, [0, 0])[toxic[i]] += 1
    total = [sum(toxic[i] == c for i in seen) for c in (0, 1)]
    z, ratio = {}, {}
    for gram, (clean, bad) in counts.items():
        if bad >= toxicity.MIN_TOXIC_DOCS:
            ratio[gram] = np.log((bad + 0.5) / (total[1] + 1)) - np.log((clean + 0.5) / (total[0] + 1))
            z[gram] = abs(ratio[gram]) / np.sqrt(1 / (bad + 0.5) + 1 / (clean + 0.5))
    top = sorted(z, key=lambda g: -z[g])[: toxicity.FEATURES]
    assert {named(k) for k in model.keys} == {g for g in top if z[g] >= toxicity.Z_SCORE}
    weights = {named(k): w for k, w in zip(model.keys, model.weights)}
    for r in toxicity.score(docs, model).collect():
        margin = model.intercept + sum(weights[g] for g in gram_set(r["text"]) if g in weights)
        assert abs(r["score"] - 1 / (1 + np.exp(-margin))) < 1e-9
    coefficients = {g: weights[g] / ratio[g] for g in weights}
    rows = [([g for g in weights if g in gram_set(texts[i])], toxic[i]) for i in seen]
    for gram in list(weights)[:5]:  # the fit is a minimum: no slope along any scaled n-gram is left
        slope = sum((1 / (1 + np.exp(-(model.intercept + sum(weights[h] for h in held)))) - y) * ratio[gram] for held, y in rows if gram in held)
        assert abs(slope / len(rows) + 0.5 * coefficients[gram] / len(rows)) < 0.02
