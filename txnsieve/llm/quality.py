"""Quality: a generalised additive model with pairwise interactions.

Each feature of the text is cut into bins. Shallow trees are boosted in turn, feature by feature, on
what the sum of all tables leaves unexplained; each tree adds to the table of its feature. Then the
pairs of features whose joint bins explain most of the rest get two-way tables by the same
boosting. A text is scored by one look-up per table.

Training takes at most ``TRAIN_DOCS`` labelled documents, chosen by a hash of the id, and only rows
outside the held-out fold. Texts are turned into features on the executors; the driver holds one
small row of numbers per training document.

Null text counts as empty; an empty text has all features zero and is scored like any other. Scoring
looks at the text alone: repeated rows and null ids are scored like others, extra columns are
carried along. Without labelled rows of both classes every score is the share of good rows seen,
or 0. Where an id is labelled twice, both rows count in training.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from txnsieve.llm.common import labelled_sample

TRAIN_DOCS = 20_000
THRESHOLD = 0.3
MAX_BINS = 48
PAIR_BINS = 12
PAIRS = 8
ROUNDS = 250
PAIR_ROUNDS = 100
RATE = 0.08
RIDGE = 2.0
MIN_LEAF = 5.0
FEATURES = (
    "log_bytes", "upper", "digit", "punctuation", "symbol", "space", "newline", "wide", "entropy", "deflate",
    "word_bytes", "distinct_words", "distinct_triples", "distinct_lines", "top_word", "short_words", "capital_words",
    "bare_words", "line_bytes", "top_line",
)


def _classes() -> np.ndarray:
    """The class of each byte, as columns: upper, digit, punctuation, symbol, space, newline, wide."""
    table = np.zeros((256, 7))
    for byte in range(256):
        sign = chr(byte)
        table[byte] = (
            "A" <= sign <= "Z", "0" <= sign <= "9", sign in ".,;:!?'\"()-", 32 < byte < 127 and not sign.isalnum(),
            sign == " ", sign == "\n", byte >= 128,
        )
    return table


_BYTE_CLASSES = _classes()


def features(text: str) -> np.ndarray:
    """One number per name in ``FEATURES``."""
    raw = text.encode("utf-8", "replace")
    out = np.zeros(len(FEATURES))
    if not raw:
        return out
    n = len(raw)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = counts / n
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    m = max(1, len(words))
    held: dict[bytes, int] = {}
    for w in words:
        held[w] = held.get(w, 0) + 1
    in_lines: dict[bytes, int] = {}
    for x in lines:
        in_lines[x] = in_lines.get(x, 0) + 1
    triples = max(1, len(words) - 2)
    out[0] = np.log1p(n)
    out[1:8] = share @ _BYTE_CLASSES
    present = share[counts > 0]
    out[8] = -(present * np.log2(present)).sum()
    out[9] = len(zlib.compress(raw, 1)) / (n + 16)
    out[10] = sum(map(len, words)) / m
    out[11] = len(held) / m
    out[12] = len(set(zip(words, words[1:], words[2:]))) / triples
    out[13] = len(in_lines) / max(1, len(lines))
    out[14] = max(held.values(), default=0) / m
    out[15] = sum(c for w, c in held.items() if len(w) <= 3) / m
    out[16] = sum(c for w, c in held.items() if w[:1].isupper()) / m
    out[17] = sum(c for w, c in held.items() if w.isalpha()) / m
    out[18] = np.log1p(n / max(1, len(lines)))
    out[19] = max((c * len(x) for x, c in in_lines.items()), default=0) / n
    return out


@dataclass
class QualityModel:
    """Bin edges and one table per feature, further edges and tables for pairs, and the intercept."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[_bins(self.edges[j], x[:, j])]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[_bins(self.pair_edges[i], x[:, i]), _bins(self.pair_edges[j], x[:, j])]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -35, 35)))


def _bins(edges: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.searchsorted(edges, values, side="right")


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return np.where(h >= MIN_LEAF, g * g / (h + RIDGE), -1e-9)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best place to cut a row of bins in two: what it gains, and the first bin to the right."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0.0, 0
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = np.where(
        (left_h >= MIN_LEAF) & (right_h >= MIN_LEAF),
        _gain(left_g, left_h) + _gain(right_g, right_h) - _gain(g.sum(), h.sum()),
        0.0,
    )
    best = int(gain.argmax())
    return float(gain[best]), best + 1


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Leaf value of each bin in a tree of at most ``leaves`` leaves."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        cuts = [(_cut(g[a:b], h[a:b]), a, b) for a, b in parts]
        (gain, at), a, b = max(cuts, key=lambda c: c[0][0])
        if gain <= 0:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    values = np.zeros(len(g))
    for a, b in parts:
        values[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return values


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A tree of two levels over joint bins: one axis first, then the other on each side."""
    best, cut = 0.0, None
    whole = float(_gain(g.sum(), h.sum()))
    for axis in (0, 1):
        up_g, up_h = (np.cumsum(np.cumsum(v, axis=axis), axis=1 - axis) for v in (g, h))
        if axis:
            up_g, up_h = up_g.T, up_h.T  # sums of all bins up to (first axis, other axis)
        sides = []
        for part_g, part_h in ((up_g, up_h), (up_g[-1] - up_g, up_h[-1] - up_h)):
            rest_g, rest_h = part_g[:, -1:] - part_g, part_h[:, -1:] - part_h
            two = np.where(
                (part_h >= MIN_LEAF) & (rest_h >= MIN_LEAF), _gain(part_g, part_h) + _gain(rest_g, rest_h), -np.inf
            )
            sides.append((np.maximum(two.max(axis=1), _gain(part_g[:, -1], part_h[:, -1])), two.argmax(axis=1)))
        total = np.where((up_h[:, -1] >= MIN_LEAF) & (up_h[-1, -1] - up_h[:, -1] >= MIN_LEAF), sides[0][0] + sides[1][0] - whole, 0.0)
        at = int(total.argmax())
        if total[at] > best:
            best, cut = float(total[at]), (axis, at, int(sides[0][1][at]), int(sides[1][1][at]))
    values = np.zeros(g.shape)
    if cut:
        axis, at, low, high = cut
        gg, hh, table = (g, h, values) if axis == 0 else (g.T, h.T, values.T)
        for rows, other in ((slice(0, at + 1), low), (slice(at + 1, None), high)):
            for columns in (slice(0, other + 1), slice(other + 1, None)):
                weight = hh[rows, columns].sum()
                if weight >= MIN_LEAF:
                    table[rows, columns] = gg[rows, columns].sum() / (weight + RIDGE)
    return best, values


def fit(x: np.ndarray, y: np.ndarray) -> QualityModel:
    """Boosts the tables in turn, then those of the pairs that explain most of the rest.

    Both classes weigh the same in all, so that few bad rows count as much as many good ones. Scores
    are thus those of a corpus with as many bad as good rows.
    """
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 1e-6
    if len(np.unique(y)) < 2:
        return QualityModel(float(np.log(share / (1 - share))))
    model = QualityModel(0.0)
    weight = np.where(y > 0, 1.0, share / (1 - share))
    weight *= len(y) / weight.sum()
    d = x.shape[1]
    model.edges = [_edges(x[:, j], MAX_BINS) for j in range(d)]
    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(d)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    at = [_bins(model.edges[j], x[:, j]) for j in range(d)]
    margin = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
        return weight * (y - p), weight * p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(d):
            g, h = slopes()
            k = len(model.tables[j])
            step = RATE * _tree(np.bincount(at[j], g, k), np.bincount(at[j], h, k))
            model.tables[j] += step
            margin += step[at[j]]

    pair_at = [_bins(model.pair_edges[j], x[:, j]) for j in range(d)]
    size = [len(e) + 1 for e in model.pair_edges]

    def joint(i: int, j: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(pair_at[i] * size[j] + pair_at[j], v, size[i] * size[j]).reshape(size[i], size[j])

    g, h = slopes()
    gains = {(i, j): _pair_tree(joint(i, j, g), joint(i, j, h))[0] for i in range(d) for j in range(i + 1, d)}
    model.pairs = [p for p in sorted(gains, key=lambda p: -gains[p])[:PAIRS] if gains[p] > 0]
    model.pair_tables = [np.zeros((size[i], size[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (i, j) in enumerate(model.pairs):
            g, h = slopes()
            step = RATE * _pair_tree(joint(i, j, g), joint(i, j, h))[1]
            model.pair_tables[k] += step
            margin += step[pair_at[i], pair_at[j]]
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> QualityModel:
    """A model from at most ``TRAIN_DOCS`` labelled documents."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column(1)], names=["x", "label"])

    sample = labelled_sample(docs, labels, label, TRAIN_DOCS, id_col, text_col).select("text", "label")
    found = sample.mapInArrow(measure, "x binary, label int").toPandas()
    x = np.array([np.frombuffer(v) for v in found["x"]]).reshape(-1, len(FEATURES))
    y = found["label"].to_numpy(float)
    order = np.lexsort((y, *x.T))  # the same model whatever order the rows arrive in
    return fit(x[order], y[order])


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1; a column of that name is replaced."""
    carried = [c for c in docs.columns if c != score_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.select(*carried).schema.fields, StructField(score_col, DoubleType())])
    at = carried.index(text_col)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t or "") for t in batch.column(at).to_pylist()]).reshape(-1, len(FEATURES))
            scores = pa.array(shared.value.scores(x), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, score_col])

    return docs.select(*carried).mapInArrow(rate, schema)


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least the threshold, with the columns of ``docs``."""
    name = "_quality"
    while name in docs.columns:
        name += "_"
    return score(docs, model, text_col, name).where(F.col(name) >= threshold).drop(name)
