"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Training takes at most ``TRAIN_DOCS`` labelled documents, chosen by a hash of the id, and only rows
outside the held-out fold. Spark counts in how many toxic and clean documents each n-gram of at least
``MIN_TOXIC_DOCS`` toxic documents occurs and ranks all of them by how far their log-count ratio
stands out from chance; the first ``FEATURES`` are kept. The presence of
an n-gram counts its ratio, and logistic regression weighs these scaled features. The model is a
table of at most ``FEATURES`` numbers, so every task gets it whole.

N-grams are runs of ``ORDERS`` bytes of the lower-cased (A-Z) text with a space at both ends and
every run of white space as one space. Up to seven bytes and their number fit into one integer, so
features are exact and never collide.

Null text counts as empty. Empty texts and texts without any feature get the score of the intercept.
Scoring looks at the text alone: repeated rows and null ids are scored like others, extra columns
are carried along. Without labelled rows of both classes every score is the share of toxic rows
seen, or 0. Where an id is labelled twice, both rows count in training.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from txnsieve.llm.common import labelled_sample, slices
from txnsieve.session import staged

TRAIN_DOCS = 16_000
ORDERS = (3, 4, 5, 6, 7)
FEATURES = 8_000
MIN_TOXIC_DOCS = 3
Z_SCORE = 4.0
THRESHOLD = 0.5
_FILTER_BITS = 24
_MIX = np.uint64(0x9E3779B97F4A7C15)


def normalise(text: str) -> bytes:
    return b" " + b" ".join(text.encode("utf-8", "replace").lower().split()) + b" "


def grams(raw: bytes) -> Iterator[np.ndarray]:
    """For each order all n-grams as integers: their bytes, then their order in the top byte."""
    signs = np.frombuffer(raw, dtype=np.uint8).astype(np.uint64)
    key = signs
    for order in range(2, max(ORDERS) + 1):
        if len(signs) < order:
            return
        key = (key[:-1] << np.uint64(8)) | signs[order - 1 :]
        if order in ORDERS:
            yield key | np.uint64(order << 56)


def distinct_grams(text: str) -> np.ndarray:
    found = list(grams(normalise(text)))
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)


@dataclass(frozen=True)
class ToxicityModel:
    """Sorted n-gram keys, their weights (ratio times coefficient) and the intercept."""

    keys: np.ndarray
    weights: np.ndarray
    intercept: float

    def matcher(self) -> GramMatcher:
        return GramMatcher(self.keys)


class GramMatcher:
    """Finds which of some sorted n-gram keys occur in a text: a bitmap first, then the keys."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.maybe = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.maybe[self._slot(keys)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * _MIX) >> np.uint64(64 - _FILTER_BITS)

    def hits(self, text: str) -> np.ndarray:
        """Positions in ``keys`` of the distinct n-grams that the text holds."""
        found = [np.empty(0, np.int64)]
        if len(self.keys):
            for key in grams(normalise(text)):
                key = key[self.maybe[self._slot(key)]]
                at = np.searchsorted(self.keys, key)
                at[at == len(self.keys)] = 0
                found.append(at[self.keys[at] == key])
        return np.unique(np.concatenate(found))


def _toxic_slots(sample: DataFrame) -> np.ndarray:
    """A bitmap, packed, with the n-grams of several toxic documents; others may share their bits."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [distinct_grams(t) for t in batch.column(0).to_pylist()]
            keys, n = np.unique(np.concatenate(found or [np.empty(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = np.unique(GramMatcher._slot(batch.column(0).to_numpy().view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32))], names=["slot"])

    toxic = sample.where("label = 1").select("text").mapInArrow(count, "key long, n long")
    several = toxic.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_TOXIC_DOCS).select("key")
    maybe = np.zeros(1 << _FILTER_BITS, dtype=bool)
    maybe[several.mapInArrow(mark, "slot int").distinct().toArrow().column("slot").to_numpy()] = True
    return np.packbits(maybe)


def _log_ratio(held: np.ndarray, clean: int, toxic: int) -> tuple[np.ndarray, np.ndarray]:
    """The log-count ratio of n-grams by their clean and toxic documents, and its z-score."""
    ratio = np.log((held[1] + 0.5) / (toxic + 1)) - np.log((held[0] + 0.5) / (clean + 1))
    return ratio, ratio / np.sqrt(1 / (held[1] + 0.5) + 1 / (held[0] + 0.5))


def _telling_grams(sample: DataFrame, clean: int, toxic: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``FEATURES`` n-grams of the largest z-score: sorted keys, and their clean and toxic documents in two rows."""
    shared = sample.sparkSession.sparkContext.broadcast(_toxic_slots(sample))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = np.unpackbits(shared.value).view(bool)
        for batch in slices(batches, 400):
            labels = batch.column(1).to_numpy()
            found = [g[maybe[GramMatcher._slot(g)]] for g in (distinct_grams(t) for t in batch.column(0).to_pylist())]
            for label in (0, 1):
                mine = [g for g, is_toxic in zip(found, labels) if is_toxic == label]
                keys, n = np.unique(np.concatenate(mine or [np.empty(0, np.uint64)]), return_counts=True)
                n = [n * (label == 0), n * (label == 1)]
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *map(pa.array, n)], names=["key", "clean", "toxic"])

    held = (
        sample.select("text", "label").mapInArrow(count, "key long, clean long, toxic long")
        .groupBy("key").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("toxic") >= MIN_TOXIC_DOCS)
    )
    in_clean, in_toxic = F.col("clean") + 0.5, F.col("toxic") + 0.5
    ratio = F.log(in_toxic / (toxic + 1)) - F.log(in_clean / (clean + 1))
    z = F.abs(ratio / F.sqrt(1 / in_toxic + 1 / in_clean))
    top = held.orderBy(F.desc(z), "key").limit(FEATURES).toPandas().sort_values("key")
    return top["key"].to_numpy(np.int64).view(np.uint64), top[["clean", "toxic"]].to_numpy(np.int64).T


def _rows(sample: DataFrame, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features per document, all their positions, and the labels; bounded by the sample."""
    shared = sample.sparkSession.sparkContext.broadcast(keys)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = GramMatcher(shared.value)
        for batch in batches:
            hits = [matcher.hits(t).astype(np.int32) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([h.tobytes() for h in hits], pa.binary()), batch.column(1)], names=["hits", "label"]
            )

    found = sample.select("text", "label").mapInArrow(find, "hits binary, label int").toArrow()
    hits = found.column("hits").combine_chunks()
    each = np.array([len(h) // 4 for h in hits.to_pylist()], dtype=np.int32)
    return each, np.frombuffer(b"".join(hits.to_pylist()), np.int32), found.column("label").to_numpy().astype(float)


def _logistic(
    each: np.ndarray, col: np.ndarray, y: np.ndarray, scale: np.ndarray, ridge: float = 0.5, rounds: int = 300
) -> tuple[np.ndarray, float]:
    """Logistic regression on scaled presence features by accelerated gradient steps.

    ``col`` holds the features of all documents one after the other, ``each`` how many a document has.
    """
    n = len(y)
    row = np.repeat(np.arange(n, dtype=np.int32), each)
    squares = np.bincount(row, weights=(scale * scale)[col], minlength=n)
    step = 4.0 / max(1e-9, squares.mean() * 4 + ridge / n + 1)
    w, b = np.zeros(len(scale)), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    seen_w, seen_b = w, b
    for t in range(1, rounds + 1):
        pull = (t - 1) / (t + 2)
        aw, ab = w + pull * (w - seen_w), b + pull * (b - seen_b)
        margin = np.bincount(row, weights=(scale * aw)[col], minlength=n) + ab
        error = 1 / (1 + np.exp(-np.clip(margin, -35, 35))) - y
        gradient = scale * np.bincount(col, weights=error[row], minlength=len(scale)) / n + ridge * aw / n
        seen_w, seen_b = w, b
        w, b = aw - step * gradient, ab - step * error.mean()
    return w, b


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """A model from at most ``TRAIN_DOCS`` labelled documents."""
    sample = staged(
        labelled_sample(docs, labels, label, TRAIN_DOCS, id_col, text_col).select("text", "label").repartition(24), "toxicity"
    )
    classes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    clean, toxic = classes.get(0, 0), classes.get(1, 0)
    keys, held = _telling_grams(sample, clean, toxic) if clean and toxic else (np.empty(0, np.uint64), None)
    if not len(keys):
        share = toxic / (clean + toxic) if clean + toxic else 0.0
        bounded = min(max(share, 1e-6), 1 - 1e-6)
        return ToxicityModel(np.empty(0, np.uint64), np.empty(0), float(np.log(bounded / (1 - bounded))))
    ratio, z = _log_ratio(held, clean, toxic)
    best = np.flatnonzero(np.abs(z) >= Z_SCORE)
    if not len(best):
        best = np.sort(np.argsort(-np.abs(z), kind="stable")[:50])
    weights, intercept = _logistic(*_rows(sample, keys[best]), ratio[best])
    return ToxicityModel(keys[best], weights * ratio[best], intercept)


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1; a column of that name is replaced."""
    carried = [c for c in docs.columns if c != score_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.select(*carried).schema.fields, StructField(score_col, DoubleType())])
    at = carried.index(text_col)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        matcher = model.matcher()
        for batch in batches:
            margins = [model.weights[matcher.hits(t or "")].sum() + model.intercept for t in batch.column(at).to_pylist()]
            scores = 1 / (1 + np.exp(-np.clip(np.array(margins, dtype=float), -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, score_col])

    return docs.select(*carried).mapInArrow(rate, schema)


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with the columns of ``docs``."""
    name = "_toxicity"
    while name in docs.columns:
        name += "_"
    return score(docs, model, text_col, name).where(F.col(name) < threshold).drop(name)


