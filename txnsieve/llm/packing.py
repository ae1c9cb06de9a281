"""Packing of token sequences by non-negative least squares over a histogram of lengths.

Documents longer than a window are cut at whole windows while they are tokenized, so the checksum of
each piece is known at once and texts are encoded a single time. The other lengths are counted;
the histogram (at most one row per length) and the plan made from it are all that the driver holds:

1. every combination of at most ``DEPTH`` binned lengths that fills the window is a column,
2. non-negative least squares gives how often each is repeated to use up the histogram,
3. counts are rounded and cut back to the pieces at hand, bins are replaced by their real lengths,
4. what is left is packed greedily, longest first, each gap by the longest length that fits.

Pieces are numbered per length in hashed parts; a number and a length give sequence and offset
through the plan, so no sequence is gathered anywhere.

Null text counts as empty; an empty text is the end token alone. Repeated rows and null ids are
packed like any other row. An empty table gives no pieces. Extra columns are not looked at.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnsieve.llm.common import full_text, numbered
from txnsieve.llm.word_bpe import word_bpe
from txnsieve.session import staged

WINDOW = 4096
DEPTH = 3
BINS = 256
END_ID = 2
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut_pieces(docs: DataFrame, tokenizer: str, window: int, id_col: str, text_col: str) -> DataFrame:
    """One row per piece: at most ``window`` ids of a document and their checksum."""
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_bpe(tokenizer)
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.ids(text) + end
                n = len(ids) // 4
                view = memoryview(ids)
                for start in range(0, n, window):
                    length = min(window, n - start)
                    rows.append((doc_id, start, length, zlib.crc32(view[4 * start : 4 * (start + length)]), n))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return docs.select(F.col(id_col).cast("long"), full_text(text_col)).mapInArrow(cut, PIECES)


def combinations(bins: int, depth: int) -> np.ndarray:
    """All falling tuples of at most ``depth`` bins that add up to ``bins``; absent places are 0."""
    found: list[tuple[int, ...]] = []

    def extend(head: tuple[int, ...], rest: int) -> None:
        if rest == 0:
            found.append(head + (0,) * (depth - len(head)))
        elif len(head) == depth - 1:
            if rest <= (head[-1] if head else rest):
                found.append((*head, rest))
        else:
            for size in range(min(rest, head[-1] if head else rest), 0, -1):
                extend((*head, size), rest - size)

    extend((), bins)
    return np.array(found)


def non_negative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """Active-set solution of min |ax - b| with x >= 0; products are formed for active columns only."""
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], dtype=bool)
    tiny = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(rounds):
        slope = a.T @ (b - a[:, active] @ x[active])
        slope[active] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= tiny:
            break
        active[best] = True
        while True:
            at = np.flatnonzero(active)
            part = a[:, at]
            solved = np.linalg.solve(part.T @ part + 1e-9 * np.eye(len(at)), part.T @ b)
            if solved.min(initial=1) > 0:
                x[at] = solved
                break
            bad = solved <= 0
            step = np.min(x[at][bad] / np.maximum(x[at][bad] - solved[bad], 1e-300))
            x[at] += step * (solved - x[at])
            gone = at[(x[at] <= 1e-12) | (bad & (x[at] <= tiny))]
            x[gone] = 0
            active[gone] = False
            if not active.any():
                break
    return x


Pattern = tuple[tuple[tuple[int, int], ...], int]


def _squares(left: np.ndarray, window: int, bins: int, depth: int) -> list[Pattern]:
    """Patterns from least squares; takes their pieces from ``left`` (pieces by length)."""
    unit = -(-window // bins)
    bin_of = -(-np.arange(window + 1) // unit)
    held = np.bincount(bin_of, weights=left, minlength=bins + 1)[: bins + 1]
    combos = combinations(bins, depth)
    combos = combos[(held[combos] > 0).all(axis=1, where=combos > 0)]
    if not len(combos):
        return []
    a = np.zeros((bins + 1, len(combos)))
    for place in combos.T:
        np.add.at(a, (place, np.arange(len(combos))), place > 0)
    repeats = np.rint(non_negative_least_squares(a[1:], held[1:] / max(1.0, held.max())) * max(1.0, held.max()))
    free = held.astype(np.int64)
    lengths = {k: [int(v) for v in np.flatnonzero((bin_of == k) & (left > 0))] for k in range(1, bins + 1)}
    patterns: list[Pattern] = []
    for c in np.argsort(-repeats, kind="stable"):
        uses = {int(k): int((combos[c] == k).sum()) for k in combos[c] if k}
        wanted = min([int(repeats[c]), *(int(free[k]) // m for k, m in uses.items())])
        while wanted > 0:  # real lengths, the longest of each bin first, as often as the same set lasts
            taken: dict[int, int] = {}
            for k, m in uses.items():
                while m:
                    if left[lengths[k][-1]] <= taken.get(lengths[k][-1], 0):
                        lengths[k].insert(0, lengths[k].pop()) if left[lengths[k][-1]] else lengths[k].pop()
                        continue
                    taken[lengths[k][-1]] = taken.get(lengths[k][-1], 0) + 1
                    m -= 1
            times = min([wanted, *(int(left[v]) // n for v, n in taken.items())])
            for v, n in taken.items():
                left[v] -= times * n
                free[int(bin_of[v])] -= times * n
            patterns.append((tuple(sorted(taken.items(), reverse=True)), times))
            wanted -= times
    return patterns


def _greedy(left: np.ndarray, window: int) -> list[Pattern]:
    """Patterns for all that is left: the longest piece, then whatever longest length still fits."""
    patterns: list[Pattern] = []
    lengths = [int(v) for v in np.flatnonzero(left)]
    while lengths:
        taken, room, top = [], window, len(lengths)
        while top := bisect_right(lengths, room, 0, top):
            v = lengths[top - 1]
            n = min(room // v, int(left[v])) if taken else 1
            taken.append((v, n))
            room -= n * v
            top -= 1
            if len(taken) == 1 and left[v] > 1 and room >= v:  # more of the longest
                more = min(room // v, int(left[v]) - 1)
                taken[0] = (v, 1 + more)
                room -= more * v
        times = min(int(left[v]) // n for v, n in taken)
        for v, n in taken:
            left[v] -= times * n
        patterns.append((tuple(taken), times))
        lengths = [v for v in lengths if left[v]]
    return patterns


def plan(histogram: dict[int, int], window: int = WINDOW, bins: int = BINS, depth: int = DEPTH) -> np.ndarray:
    """The layout: rows of length, first rank, end rank, first sequence, repeats, offset."""
    left = np.zeros(window + 1, dtype=np.int64)
    for length, count in histogram.items():
        left[length] = count
    whole = int(left[window])
    left[window] = 0
    patterns: list[Pattern] = [(((window, 1),), whole)] if whole else []
    patterns += _squares(left, window, min(bins, window), depth)
    patterns += _greedy(left, window)
    rank = np.zeros(window + 1, dtype=np.int64)
    rows, sequence = [], 0
    for pieces, times in patterns:
        offset = 0
        for length, copies in pieces:
            rows.append((length, rank[length], rank[length] + copies * times, sequence, times, offset))
            rank[length] += copies * times
            offset += copies * length
        sequence += times
    layout = np.array(rows, dtype=np.int64).reshape(-1, 6)
    return layout[np.lexsort((layout[:, 1], layout[:, 0]))]


def place(layout: np.ndarray, length: np.ndarray, rank: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces by length and rank; ``span`` is above every rank."""
    row = layout[np.searchsorted(layout[:, 0] * span + layout[:, 1], length * span + rank, side="right") - 1]
    within = rank - row[:, 1]
    return row[:, 3] + within % row[:, 4], row[:, 5] + within // row[:, 4] * length


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    bins: int = BINS,
    depth: int = DEPTH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece with ``sequence_id`` and ``offset``; sequences hold at most ``window`` ids."""
    pieces = staged(cut_pieces(docs, tokenizer, window, id_col, text_col), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    layout = plan(histogram, window, bins, depth)
    rows = sum(histogram.values())
    ranked = numbered(pieces, ["length"], ["doc_id", "start", "ids_crc32"], rows)
    span = max(histogram.values(), default=0) + 1

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(n) for n in batch.schema.names]
            length, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            sequence, offset = place(layout, length, rank, span)
            names = [*batch.schema.names[:-1], "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*columns[:-1], pa.array(sequence), pa.array(offset)], names=names)

    fields = [f.split()[0] for f in PIECES.split(", ")]
    return ranked.select(*fields, "rank").mapInArrow(lay_out, f"{PIECES}, sequence_id long, offset long")
