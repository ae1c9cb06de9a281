"""Periodic runs of words: maximal stretches that repeat a block of words at least twice.

A run is a stretch of words with smallest period ``q`` whose length is at least ``min_length`` and
``2 * q`` and that no neighbouring word extends with the same period. Words are separated by ASCII white
space.

Method. The suffix automaton of the words has a link tree in which the path from the state of a prefix
to the root holds all suffixes of that prefix. A link-cut tree keeps, for every path segment, the end of
its last occurrence. Each word in turn accesses the state of its prefix and so recolours the whole path:
every segment met on the way gives the longest suffix (of ``length`` words) whose last earlier
occurrence ended at ``end``. If the distance of the two ends is at most that length, the two
occurrences touch or overlap and are a square, whose period is this distance; it is extended to the right
word by word and reported once. An access meets a logarithmic number of segments on average. The
automaton is finished before the first access, so the tree needs no link and no cut; nodes that later
words split off hold the same last occurrence as their upper part until then.

A run repeats an n-gram of half of ``min_length`` words one period later, and such n-grams cover it. So
only the stretches that repeated n-grams cover are given to the automaton, each by itself; all the
others cannot hold a run. This leaves out no run and no word of one.

One document is worked on at a time, by one task; an automaton takes some 600 bytes for a word of its
stretch. Null and empty texts have no words and no runs. Rows with a null id and repeated rows each
give a row. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnsieve.llm.common import ship_package, slices

MIN_LENGTH = 12
HASH_STEP = np.uint64(0x9E3779B97F4A7C15)
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"


def suffix_automaton(words: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """Length and link of every state (the root is 0), and the state of every prefix."""
    length, link, follow, prefixes = [0], [-1], [{}], []
    last = 0
    for word in words:
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        follow.append({})
        state = last
        while state >= 0 and word not in follow[state]:
            follow[state][word] = new
            state = link[state]
        if state >= 0:
            target = follow[state][word]
            if length[target] != length[state] + 1:
                copy = len(length)
                length.append(length[state] + 1)
                link.append(link[target])
                follow.append(follow[target].copy())
                while state >= 0 and follow[state].get(word) == target:
                    follow[state][word] = copy
                    state = link[state]
                link[target] = copy
                target = copy
            link[new] = target
        prefixes.append(new)
        last = new
    return length, link, prefixes


class LastOccurrences:
    """A link-cut tree over the links of an automaton; each preferred path has one last occurrence.

    Preferred paths are splay trees ordered by depth. The root of a splay tree holds the end of the last
    occurrence of all its states, or -1. State 0, the empty word, is no node.
    """

    def __init__(self, length: list[int], link: list[int]) -> None:
        self.length = length
        self.up = [max(parent, 0) for parent in link]
        self.higher = [0] * len(link)
        self.deeper = [0] * len(link)
        self.end = [-1] * len(link)

    def splay(self, x: int) -> None:
        up, higher, deeper, end = self.up, self.higher, self.deeper, self.end
        while True:
            y = up[x]
            if not y:
                return
            if higher[y] != x and deeper[y] != x:
                return
            z = up[y]
            if z and (higher[z] == y or deeper[z] == y):
                moves = (y, x) if (higher[z] == y) == (higher[y] == x) else (x, x)
            else:
                moves = (x,)
            for a in moves:  # rotate a over its parent
                b = up[a]
                c = up[b]
                if higher[b] == a:
                    t = deeper[a]
                    higher[b] = t
                    deeper[a] = b
                else:
                    t = higher[a]
                    deeper[b] = t
                    higher[a] = b
                if t:
                    up[t] = b
                if c:
                    if higher[c] == b:
                        higher[c] = a
                    elif deeper[c] == b:
                        deeper[c] = a
                up[a] = c
                up[b] = a
                end[a] = end[b]

    def access(self, state: int, at: int) -> list[tuple[int, int]]:
        """Recolours the path of a state to end ``at``; gives (longest length, former end) of each segment."""
        splay, up, deeper, end, length = self.splay, self.up, self.deeper, self.end, self.length
        met, below, x = [], 0, state
        while x:
            splay(x)
            former = end[x]
            if former >= 0:
                met.append((length[x], former))
            cut = deeper[x]
            if cut:
                end[cut] = former
            deeper[x] = below
            below = x
            x = up[x]
        end[below] = at
        splay(state)
        return met


def stretch_runs(words: Sequence[int], min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a list of word numbers."""
    length, link, prefixes = suffix_automaton(words)
    tree, reached, runs, n = LastOccurrences(length, link), {}, [], len(words)
    for at, state in enumerate(prefixes):
        for longest, former in tree.access(state, at):
            period = at - former
            if period > longest or reached.get(period, -1) >= at:
                continue
            end = at + 1
            while end < n and words[end] == words[end - period]:
                end += 1
            reached[period] = end - 1
            start = former - longest + 1
            if end - start >= min_length:
                runs.append((start, end - start, period))
    return runs


def repeated_stretches(words: np.ndarray, gram: int) -> list[tuple[int, int]]:
    """Start and end of the stretches that n-grams occurring more than once cover."""
    count = len(words) - gram + 1
    if count < 2:
        return []
    hashes = np.zeros(count, dtype=np.uint64)
    for k in range(gram):  # equal hashes of different n-grams only make a stretch longer
        hashes = hashes * HASH_STEP + words[k : k + count].astype(np.uint64)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    if not same.any():
        return []
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    again = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    edges[again] += 1
    edges[again + gram] -= 1
    covered = np.concatenate([[False], np.cumsum(edges[:-1]) > 0, [False]])
    turns = np.flatnonzero(covered[1:] != covered[:-1])
    return list(zip(turns[::2].tolist(), turns[1::2].tolist()))


def word_runs(words: Sequence[object], min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a list of words, by start and period."""
    numbers: dict[object, int] = {}
    ids = [numbers.setdefault(w, len(numbers)) for w in words]
    if len(numbers) == len(ids):
        return []
    runs = []
    for first, end in repeated_stretches(np.array(ids, dtype=np.int64), max((min_length + 1) // 2, 1)):
        if end - first >= min_length:
            runs += [(first + s, n, q) for s, n, q in stretch_runs(ids[first:end], min_length)]
    return sorted(runs, key=lambda run: (run[0], run[2]))


def without_repeats(words: Sequence[bytes], runs: list[tuple[int, int, int]]) -> Sequence[bytes]:
    """The words without those that some run contains after its first period."""
    if not runs:
        return words
    dropped = np.zeros(len(words), dtype=bool)
    for start, length, period in runs:
        dropped[start + period : start + length] = True
    return [w for w, gone in zip(words, dropped.tolist()) if not gone]


def _find(min_length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, found, texts = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                words = (text.as_py() or b"").split()
                runs = word_runs(words, min_length)
                counts.append(len(words))
                found.append([dict(zip(RUN.names, r)) for r in runs])
                texts.append(b" ".join(without_repeats(words, runs)))
            columns = [pa.array(counts, pa.int64()), pa.array(found, pa.list_(RUN)), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` per row.

    ``runs`` has ``start`` (number of its first word), ``length`` and ``period`` of every run, by start and
    period; ``collapsed`` is the text without the words that repeat the first period of a run, joined by
    single spaces.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_find(min_length), FOUND).withColumn("collapsed", F.col("collapsed").cast("string"))
