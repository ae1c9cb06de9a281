"""Unigram pieces: Viterbi over a double-array trie, byte fallback, and decoding.

Encoding marks each space as ``▁`` and puts one before the text, then takes the split with the
largest sum of log scores. A character that no piece covers costs the smallest score less
``UNKNOWN_PENALTY`` and becomes its UTF-8 bytes. No piece holds ``▁`` after another sign or a line
break, so words are split on their own and each distinct word once per worker.

The file holds merge ranks instead of probabilities; by Zipf's law the piece of rank r gets the log
of 1 / (r * H). Decoding joins pieces and bytes, turns ``▁`` into spaces and drops the first one; it
gives the text back unless the text itself holds ``▁``.

Null text counts as empty and has no ids. Each row is encoded alone and whole: repeated rows, null
ids and extra columns are carried along, an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from txnsieve.llm.common import slices

CACHED_WORDS = 300_000
UNKNOWN_PENALTY = 10.0
SPACE = "▁"
_CHUNKS = re.compile(" +[^ ]*")


class DoubleArray:
    """A trie in two arrays: the child of a node by a byte is ``base[node] + byte`` if ``check`` agrees."""

    def __init__(self, keys: Mapping[bytes, int]) -> None:
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for key, value in keys.items():
            node = 0
            for byte in key:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                node = children[node][byte]
            ends[node] = value
        self.base, self.check, self.value = [0], [0], [-1]
        self._hole = self._family = 1
        placed = [(0, 0)]
        for node, at in placed:
            self.value[at] = ends.get(node, -1)
            if children[node]:
                start = self.base[at] = self._room(sorted(children[node]))
                for byte, child in children[node].items():
                    self.check[start + byte] = at
                    placed.append((child, start + byte))

    def _room(self, bytes_: list[int]) -> int:
        """A start from which the places of all these bytes are free.

        Single children fill the first holes; families go behind the last family, so that full
        stretches are not searched again and again.
        """
        alone = len(bytes_) == 1
        at = max(self._hole if alone else self._family, bytes_[0] + 1)
        while True:
            start = at - bytes_[0]
            missing = start + 256 - len(self.check)
            if missing > 0:
                self.base += [0] * missing
                self.check += [-1] * missing
                self.value += [-1] * missing
            if all(self.check[start + b] < 0 for b in bytes_):
                break
            at += 1
        if alone:
            self._hole = max(self._hole, at)
        else:
            self._family = max(self._family, at)
        return start


class Unigram(dict):
    """Encoder and decoder; as a mapping it gives the ids (as bytes) of a word with a space mark before it."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: dict[int, int]) -> None:
        """``pieces`` and ``scores`` by id; a piece of another kind (control, byte) is the empty string."""
        self.scores = scores
        self.trie = DoubleArray({p.encode(): i for i, p in enumerate(pieces) if p})
        self.unknown = min(s for p, s in zip(pieces, scores) if p) - UNKNOWN_PENALTY
        self.byte_ids = byte_ids
        self.surface = [p.replace(SPACE, " ").encode() for p in pieces]
        for byte, i in byte_ids.items():
            self.surface[i] = bytes([byte])

    def split(self, marked: str) -> list[int]:
        """The ids of the best split of a text whose spaces are marks."""
        raw = marked.encode("utf-8", "replace")
        n = len(raw)
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.scores
        room = len(check)
        best: list[float] = [-math.inf] * (n + 1)
        came: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        best[0] = 0.0
        start = 0
        while start < n:
            lead = raw[start]
            width = 1 if lead < 128 else 2 if lead < 224 else 3 if lead < 240 else 4
            here, node, single = best[start], 0, False
            for end in range(start, n):
                onward = base[node] + raw[end]
                if onward >= room or check[onward] != node:
                    break
                node = onward
                piece = value[node]
                if piece >= 0:
                    total = here + scores[piece]
                    if total > best[end + 1]:
                        best[end + 1], came[end + 1] = total, (start, piece)
                    single = single or end + 1 == start + width
            if not single and here + self.unknown > best[start + width]:
                best[start + width], came[start + width] = here + self.unknown, (start, -1)
            start += width
        ids: list[int] = []
        at = n
        while at > 0:
            start, piece = came[at]
            if piece >= 0:
                ids.append(piece)
            else:
                ids += [self.byte_ids[b] for b in reversed(raw[start:at])]
            at = start
        return ids[::-1]

    def _packed(self, marked: str) -> bytes:
        return np.array(self.split(marked), dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self._packed(SPACE + word)
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a whole text."""
        if not text:
            return b""
        out: list[bytes] = []
        line_break = self.byte_ids[10].to_bytes(4, "little")
        for number, line in enumerate(text.split("\n")):
            head, _, rest = line.partition(" ")
            if number:
                out.append(line_break)
                out.append(self._packed(head) if head else b"")
                line = line[len(head) :]
            else:
                line = " " + line
            if not line:
                continue
            if "  " in line or line[-1] == " ":
                for chunk in _CHUNKS.findall(line):
                    word = chunk.lstrip(" ")
                    marks = len(chunk) - len(word)
                    out.append(self[word] if marks == 1 and word else self._packed(SPACE * marks + word))
            else:
                out.extend(map(self.__getitem__, line[1:].split(" ")))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of some ids."""
        raw = b"".join(map(self.surface.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace")[1:]


def zipf(rank: int, pieces: int) -> float:
    """Log probability of the piece of a rank (from 1) among some pieces."""
    return -math.log(rank) - math.log(math.log(pieces) + 0.5772156649 + 0.5 / pieces)


@lru_cache(maxsize=2)
def unigram(path: str) -> Unigram:
    """One encoder per worker process and model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    normal = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    rank = {i: r for r, i in enumerate(normal, 1)}
    pieces = [model.id_to_piece(i) if i in rank else "" for i in range(n)]
    scores = [zipf(rank[i], len(normal)) if i in rank else 0.0 for i in range(n)]
    byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in range(n) if model.is_byte(i)}
    return Unigram(pieces, scores, byte_ids)


def encode(docs: DataFrame, model: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of the text as little-endian 32-bit numbers in a binary column."""
    carried = docs.select(*[c for c in docs.columns if c != ids_col])
    schema = StructType([*carried.schema.fields, StructField(ids_col, BinaryType())])
    at = carried.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = unigram(model)
        for batch in slices(batches):
            ids = pa.array([coder.encode(t or "") for t in batch.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, ids_col])

    return carried.mapInArrow(run, schema)


def decode(rows: DataFrame, model: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of the ids; null ids give an empty text."""
    carried = rows.select(*[c for c in rows.columns if c != text_col])
    schema = StructType([*carried.schema.fields, StructField(text_col, StringType())])
    at = carried.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = unigram(model)
        for batch in slices(batches):
            texts = pa.array([coder.decode(i or b"") for i in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, text_col])

    return carried.mapInArrow(run, schema)
