"""Token counts by greedy longest match with a linear automaton.

The pieces of a byte-level vocabulary form a trie. A node that cannot go on pops the pieces that the
longest match would take and follows its failure link to the node of what is left; both are worked
out beforehand, and only the number of popped pieces is stored. Every byte of a word is read once
and no piece is ever built.

A word is a run without the six ASCII white-space signs; it is matched with a space before it, so
pieces that begin with a space start words and the others go on. All 256 bytes must be pieces, so
every word can be matched.

Null and empty texts have no words and no tokens. Texts are counted whole, each row alone: repeated
rows, null ids and extra columns are carried along, an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from txnsieve.llm.word_bpe import printable_bytes

CACHED_WORDS = 500_000
ROOT = 0


class LongestMatch(dict):
    """The automaton of some pieces; as a mapping it gives the number of pieces of a word (bytes)."""

    def __init__(self, pieces: Iterable[bytes]) -> None:
        self.step: dict[int, int] = {}  # (node << 8 | byte) to node
        ends: set[int] = set()
        for piece in pieces:
            node = ROOT
            for byte in piece:
                node = self.step.setdefault(node << 8 | byte, len(self.step) + 1)
            ends.add(node)
        children: list[list[tuple[int, int]]] = [[] for _ in range(len(self.step) + 1)]
        for edge, node in self.step.items():
            children[edge >> 8].append((edge & 255, node))
        if len(children[ROOT]) < 256:
            raise ValueError("every byte must be a piece")
        self.fail = [ROOT] * len(children)
        self.pops = [0] * len(children)
        todo = deque([ROOT])
        while todo:
            parent = todo.popleft()
            for byte, node in children[parent]:
                todo.append(node)
                if node in ends:
                    self.pops[node] = 1  # the whole path is a piece; the rest is empty
                    continue
                popped, at = self.pops[parent], self.fail[parent]
                while (at << 8 | byte) not in self.step:
                    popped, at = popped + self.pops[at], self.fail[at]
                self.fail[node], self.pops[node] = self.step[at << 8 | byte], popped
        self.finish = [0] * len(children)  # pieces still to pop when the word ends at a node
        for node in range(1, len(children)):
            self._finish(node)

    def _finish(self, node: int) -> int:
        path = []
        while node != ROOT and not self.finish[node]:
            path.append(node)
            node = self.fail[node]
        total = self.finish[node]
        for n in reversed(path):
            total += self.pops[n]
            self.finish[n] = total
        return total

    def __missing__(self, word: bytes) -> int:
        step, fail, pops = self.step.get, self.fail, self.pops
        node, count = step(ROOT << 8 | 32), 0
        for byte in word:
            onward = step(node << 8 | byte)
            while onward is None:
                count += pops[node]
                node = fail[node]
                onward = step(node << 8 | byte)
            node = onward
        count += self.finish[node]
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = count
        return count

    def count(self, text: str) -> tuple[int, int]:
        """Words and tokens of a text."""
        words = text.encode("utf-8", "replace").split()
        return len(words), sum(map(self.__getitem__, words))


def byte_pieces(path: str) -> list[bytes]:
    """The pieces of a byte-level vocabulary file as bytes, without special tokens."""
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    special = {t["content"] for t in content.get("added_tokens", [])}
    byte_of = printable_bytes()
    return [bytes(byte_of[c] for c in t) for t in content["model"]["vocab"] if t not in special]


@lru_cache(maxsize=2)
def longest_match(path: str) -> LongestMatch:
    """One automaton per worker process and file."""
    return LongestMatch(byte_pieces(path))


def count_tokens(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words`` and ``n_tokens``; columns of these names are replaced."""
    fresh = ("n_words", "n_tokens")
    carried = docs.select(*[c for c in docs.columns if c not in fresh])
    schema = StructType([*carried.schema.fields, *(StructField(n, LongType()) for n in fresh)])
    at = carried.columns.index(text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = longest_match(vocabulary)
        for batch in batches:
            counts = [automaton.count(t or "") for t in batch.column(at).to_pylist()]
            new = [pa.array([c[i] for c in counts], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *fresh])

    return carried.mapInArrow(count, schema)
