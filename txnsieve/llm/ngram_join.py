"""Near duplicates: a Jaccard self-join on word n-grams by T-occurrence search.

Texts of equal n-gram sets are one set. Two sets of sizes a and b reach the similarity only if they
share at least T n-grams. Each set reads its n-grams from rare to frequent, by a count of all documents
(a table of hashed counters; any order is exact, a better one is faster). The last T - 1 are its long
lists: they are never merged, a candidate is looked up there at the end. A partner must then occur in
one of the short lists in front, the inverted lists of the first n - T + 1 n-grams:

1. every task sends its list entries to buckets by n-gram; a bucket sorts, and so merges, its lists;
2. lists of at most ``SHORT_LIST`` sets give all their pairs; a longer list gives the pairs with a few
   hubs, the sets that have the fewest rare n-grams in front, and is kept;
3. a bitmap of each set bounds the overlap of each pair from above; the pairs left are counted
   exactly on the whole sets, and those that reach T are links;
4. in kept lists only pairs of different components can still add a link. Lists that hold several
   components are cut into blocks; a block compares the bitmaps of its pairs across components, and the
   pairs left are counted exactly.

So a group of near copies, however large, is joined through hubs, without all its pairs.

Words are runs without the six ASCII white-space signs, A to Z in lower case. A text of fewer words than
``WORDS`` has one n-gram, the whole; an empty or null text has none and no links. Rows of one id are
one document. Rows without an id share the component of equal texts, or have none. Extra columns are
not looked at; an empty table gives an empty result. N-grams are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnsieve.llm.common import full_text
from txnsieve.llm.components import connected
from txnsieve.session import staged

WORDS = 5
SIMILARITY = (3, 4)
SHORT_LIST = 32
HUBS = 3
BLOCK = 1024
MAX_SLOTS = 1 << 25
SLOTS_PER_DOC = 16
SLOT_BLOCK = 1 << 15
ENTRY = np.dtype([("gram", "<u4"), ("set", "<u8"), ("size", "u1"), ("place", "u1")])
BUCKET_BYTES = 16 << 20
CACHED_WORDS = 500_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


_HASHES = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_set(text: str, words: int = WORDS) -> np.ndarray:
    """The distinct word n-grams of a text as sorted hashes."""
    raw = text.encode("utf-8", "replace").lower().split()
    if not raw:
        return np.empty(0, np.uint64)
    hashes = np.array(list(map(_HASHES.__getitem__, raw)), dtype=np.uint64)
    k = min(words, len(raw))
    total = np.full(len(raw) - k + 1, k, dtype=np.uint64)
    for i, factor in enumerate(_mixed(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)):
        total += hashes[i : len(raw) - k + 1 + i] * factor
    return np.unique(_mixed(total))


def least_overlap(a: int, b: int, similarity: tuple[int, int] = SIMILARITY) -> int:
    """How many n-grams sets of these sizes must share to reach the similarity."""
    p, q = similarity
    return -(-p * (a + b) // (p + q))


def set_key(grams: np.ndarray) -> int:
    """A 64-bit name of a set (signed)."""
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def bitmap(grams: np.ndarray) -> bytes:
    """A bit per hash slot; at least 16 slots for each n-gram, a power of two, at most 262,144."""
    slots = 1 << min(18, max(9, int(16 * max(1, len(grams)) - 1).bit_length()))
    bits = np.zeros(slots, dtype=bool)
    bits[(grams & np.uint64(slots - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def folded(bits: np.ndarray, length: int) -> np.ndarray:
    """Bitmaps (along the last axis) with fewer slots."""
    while bits.shape[-1] > length:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def most_shared(a: bytes, a_size: int, b: bytes, b_size: int) -> int:
    """An upper bound of the overlap: each slot that only one set fills is an n-gram the other lacks."""
    length = min(len(a), len(b))
    x, y = folded(np.frombuffer(a, np.uint8), length), folded(np.frombuffer(b, np.uint8), length)
    only_x = int(np.bitwise_count(x & ~y).sum())
    only_y = int(np.bitwise_count(y & ~x).sum())
    return min(a_size - only_x, b_size - only_y)


def _size_class(n: int, similarity: tuple[int, int]) -> int:
    """Sizes in steps of a third of the allowed ratio, so partners are at most four classes apart."""
    return min(127, int(3 * np.log(n) / np.log(similarity[1] / similarity[0])))


def _blocks(counts: np.ndarray) -> list[tuple[int, bytes]]:
    parts = counts.reshape(-1, min(SLOT_BLOCK, len(counts)))
    return [(int(i), zlib.compress(parts[i].tobytes(), 1)) for i in np.flatnonzero(parts.any(axis=1))]


def _gathered(rows: DataFrame, slots: int) -> np.ndarray:
    """Sums counter blocks of all tasks; a byte per slot that grows with the logarithm of its count."""
    block = min(SLOT_BLOCK, slots)

    def add(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(block, dtype=np.int64)
        for data in frame["data"]:
            total += np.frombuffer(zlib.decompress(data), np.uint16)
        level = np.minimum(255, 8 * np.log2(1.0 + total)).astype(np.uint8)
        return pd.DataFrame({"block": [key[0]], "data": [level.tobytes()]})

    table = np.zeros(slots, dtype=np.uint8)
    for row in rows.groupBy("block").applyInPandas(add, "block long, data binary").collect():
        table[row["block"] * block : (row["block"] + 1) * block] = np.frombuffer(row["data"], np.uint8)
    return table


def _measure(docs: DataFrame, slots: int, words: int) -> DataFrame:
    """Per row its set's size, name and bitmap; and from each task its counters, as rows with a block."""
    block_schema = pa.schema(
        [("id", pa.int64()), ("n", pa.int64()), ("set", pa.int64()), ("data", pa.binary()), ("block", pa.int64())]
    )
    shift = np.uint64(64 - (slots.bit_length() - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(slots, dtype=np.uint16), set()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams = gram_set(text, words)
                name = set_key(grams) if len(grams) else None
                rows.append((doc_id, len(grams), name, bitmap(grams) if len(grams) else None, None))
                if len(grams) and name not in seen:
                    seen.add(name)
                    at, n = np.unique(grams >> shift, return_counts=True)
                    at = at.astype(np.int64)
                    counts[at] = np.minimum(65535, counts[at] + n)
            yield pa.RecordBatch.from_pylist([dict(zip(block_schema.names, r)) for r in rows], schema=block_schema)
        rows = [(None, None, None, data, block) for block, data in _blocks(counts)]
        yield pa.RecordBatch.from_pylist([dict(zip(block_schema.names, r)) for r in rows], schema=block_schema)

    return docs.mapInArrow(run, "id long, n long, set long, data binary, block long")


def _list_entries(docs: DataFrame, table: np.ndarray, buckets: int, words: int, similarity: tuple[int, int]) -> DataFrame:
    """The short-list entries of all sets, packed by bucket."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    shift = np.uint64(64 - (len(table).bit_length() - 1))
    p, q = similarity

    def pack(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        grams, sets, sizes, places = (np.concatenate([x[i] for x in parts]) for i in range(4))
        bucket = ((grams >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        entries = np.empty(len(grams), ENTRY)
        entries["gram"] = (grams & np.uint64(0xFFFFFFFF))[order]
        entries["set"], entries["size"], entries["place"] = sets[order], sizes[order], places[order]
        ends = np.cumsum(np.bincount(bucket, minlength=buckets))
        filled = [b for b in range(buckets) if ends[b] > (ends[b - 1] if b else 0)]
        data = [entries[(ends[b - 1] if b else 0) : ends[b]].tobytes() for b in filled]
        yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int64()), pa.array(data, pa.binary())], names=["bucket", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = shared.value, set()
        parts: list[tuple] = []
        held = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                grams = gram_set(text, words)
                n = len(grams)
                name = set_key(grams) if n else 0
                if not n or name in seen:
                    continue
                seen.add(name)
                front = n - -(-p * n // q) + 1
                probed = n - least_overlap(n, n, similarity) + 1  # enough against sets at least as large
                rank = (level[grams >> shift].astype(np.uint64) << np.uint64(56)) | (grams >> np.uint64(8))
                order = np.argpartition(rank, front - 1)[:front] if front < n else np.arange(n)
                order = order[np.argsort(rank[order], kind="stable")]
                size = np.full(front, _size_class(n, similarity), dtype=np.uint8)
                size[:probed] |= 128
                place = np.minimum(255, np.arange(front) * 1024 // n).astype(np.uint8)
                parts.append((grams[order], np.full(front, name, dtype=np.int64).view(np.uint64), size, place))
                held += front
                if held >= 4_000_000:
                    yield from pack(parts)
                    parts, held = [], 0
        if parts:
            yield from pack(parts)

    return docs.mapInArrow(run, "bucket long, data binary")


def _may_match(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether two entries of one list can be partners: sizes close, and the smaller one's entry in front."""
    a, b = x["size"] & 127, y["size"] & 127
    a_front, b_front = x["size"] > 127, y["size"] > 127
    front = np.where(a < b, a_front, np.where(b < a, b_front, a_front | b_front))
    return (np.abs(a.astype(int) - b.astype(int)) <= 4) & front


def _merge_lists(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """Candidates of one bucket: pairs of sets (``kind`` 0), and the entries of long lists (``kind`` 1)."""
    entries = np.concatenate([np.frombuffer(d, ENTRY) for d in frame["data"]])
    entries = entries[np.lexsort((entries["set"], entries["gram"]))]
    again = np.zeros(len(entries), dtype=bool)
    again[1:] = (entries["gram"][1:] == entries["gram"][:-1]) & (entries["set"][1:] == entries["set"][:-1])
    entries = entries[~again]
    starts = np.flatnonzero(np.r_[True, entries["gram"][1:] != entries["gram"][:-1]])
    lengths = np.diff(np.r_[starts, len(entries)])
    pairs, long_lists = [np.empty((0, 2), np.int64)], []
    for length in np.unique(lengths[(lengths > 1) & (lengths <= SHORT_LIST)]):
        table = entries[starts[lengths == length][:, None] + np.arange(length)]
        i, j = np.triu_indices(length, 1)
        x, y = table[:, i].ravel(), table[:, j].ravel()
        ok = _may_match(x, y)
        pairs.append(np.column_stack([x["set"][ok], y["set"][ok]]).view(np.int64))
    for start, length in zip(starts[lengths > SHORT_LIST], lengths[lengths > SHORT_LIST]):
        run = entries[start : start + length]
        long_lists.append(run)
        size = (run["size"] & 127).astype(int)
        for hub in _hubs(size, run["place"]):
            near = run[np.abs(size - size[hub]) <= 4]
            pairs.append(np.column_stack([np.full(len(near), run["set"][hub]), near["set"]]).view(np.int64))
    found = np.sort(np.concatenate(pairs), axis=1)
    found = found[found[:, 0] != found[:, 1]]
    found = np.unique(found, axis=0) if len(found) else found
    kept = np.concatenate(long_lists) if long_lists else np.empty(0, ENTRY)
    name = kept["gram"].astype(np.int64) * (1 << 31) + int(key[0])
    return pd.DataFrame(
        {
            "kind": np.r_[np.zeros(len(found), int), np.ones(len(kept), int)],
            "x": np.r_[found[:, 0], name],
            "y": np.r_[found[:, 1], kept["set"].view(np.int64) if len(kept) else np.empty(0, np.int64)],
            "size": np.r_[np.zeros(len(found), int), kept["size"].astype(int)],
        }
    )


def _hubs(size: np.ndarray, place: np.ndarray) -> list[int]:
    """For each stretch of size classes that can be partners, the sets nearest to what the list shares.

    Where a list stands far in front, its set has few n-grams of its own, as the text has that others
    are copies of.
    """
    hubs: list[int] = []
    for low in range(int(size.min()), int(size.max()) + 1, 5):
        inside = np.flatnonzero((size >= low) & (size < low + 5))
        hubs += inside[np.argsort(place[inside], kind="stable")[:HUBS]].tolist()
    return hubs


def _across(similarity: tuple[int, int]) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    """Pairs of one list in different components whose bitmaps allow a link.

    A group holds one block of the list (side 2), or two that are compared with each other (0 and 1).
    """
    p, q = similarity

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        entries = np.zeros(len(frame), ENTRY)
        entries["size"] = frame["size"].to_numpy()
        label, rep, side, n = (frame[c].to_numpy() for c in ("label", "rep", "side", "n"))
        bits = [np.frombuffer(d, np.uint8) for d in frame["data"]]
        length = np.array([len(b) for b in bits])
        out = [np.empty((0, 2), np.int64)]
        rows = {v: np.flatnonzero((length == v) & (side != 0)) for v in np.unique(length)}
        table = {v: np.array([bits[r] for r in at]).reshape(len(at), v) for v, at in rows.items()}
        for i in np.flatnonzero(side != 1):
            for v, at in rows.items():
                ok = (label[at] != label[i]) & ((side[i] != 2) | (at > i))
                ok &= _may_match(np.broadcast_to(entries[i], len(at)), entries[at])
                at, other = at[ok], table[v][ok]
                if len(at):
                    x, y = folded(bits[i], min(v, length[i])), folded(other, min(v, length[i]))
                    only_x = np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64)
                    only_y = np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64)
                    most = np.minimum(n[i] - only_x, n[at] - only_y)
                    j = at[(p + q) * most >= p * (n[i] + n[at])]
                    out.append(np.column_stack([np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j])]))
        return pd.DataFrame(np.concatenate(out), columns=["a", "b"]).drop_duplicates()

    return run


def _could_link(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs ``a``, ``b`` whose bitmaps allow the overlap that they need."""
    side = {s: sets.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("data").alias(f"bits_{s}")) for s in "ab"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, x, m, y = (batch.column(c).to_pylist() for c in ("a", "b", "n_a", "bits_a", "n_b", "bits_b"))
            keep = [most_shared(x[i], n[i], y[i], m[i]) >= least_overlap(n[i], m[i], similarity) for i in range(len(a))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(side["a"], "a").join(side["b"], "b").select("a", "b", "n_a", "bits_a", "n_b", "bits_b")
    return joined.mapInArrow(run, "a long, b long")


def _sets_of(docs: DataFrame, ids: DataFrame, slots: int, words: int) -> DataFrame:
    """The whole n-gram sets of documents whose id may be among ``ids``: a table of hashed ids is shared."""

    def slot(values: np.ndarray) -> np.ndarray:
        return (_mixed(values.astype(np.int64).view(np.uint64)) >> np.uint64(64 - (slots.bit_length() - 1))).astype(np.int64)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(slots, dtype=np.uint16)
        for batch in batches:
            counts[slot(batch.column(0).to_numpy())] = 1
        rows = _blocks(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([b for b, _ in rows], pa.int64()), pa.array([d for _, d in rows], pa.binary())], names=["block", "data"]
        )

    wanted = docs.sparkSession.sparkContext.broadcast(
        np.packbits(_gathered(ids.mapInArrow(mark, "block long, data binary"), slots) > 0)
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column(0)))
            at = slot(batch.column(0).to_numpy(zero_copy_only=False))
            batch = batch.filter(pa.array((bits[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)))
            grams = [gram_set(t, words).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(grams, pa.list_(pa.int64()))], names=["id", "grams"])

    return docs.mapInArrow(read, "id long, grams array<long>")


def _links(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs whose sets reach the similarity, counted on the whole sets."""
    p, q = similarity
    side = {s: sets.select(F.col("id").alias(s), F.col("grams").alias(f"grams_{s}")) for s in "ab"}
    joined = pairs.join(side["a"], "a").join(side["b"], "b")
    shared = F.size(F.array_intersect("grams_a", "grams_b"))
    return joined.where((p + q) * shared >= p * (F.size("grams_a") + F.size("grams_b"))).select("a", "b")


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    similarity: tuple[int, int] = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for every row of ``docs``.

    ``similarity`` is a fraction; sets of sizes a and b with overlap o link if o / (a + b - o) reaches it.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), full_text(text_col).alias("text"))
    slots = min(MAX_SLOTS, max(1 << 16, 1 << (SLOTS_PER_DOC * max(1, rows.count()) - 1).bit_length()))
    measured = staged(_measure(rows, slots, words), "gram-sets")
    sets = measured.where("block IS NULL").drop("block")
    level = _gathered(measured.where("block IS NOT NULL").select("block", "data"), slots)

    names = staged(sets.where("set IS NOT NULL").groupBy("set").agg(F.min("id").alias("rep")), "set-names")
    total = sets.agg(F.sum("n")).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(partitions, int(total * ENTRY.itemsize // 4 // BUCKET_BYTES))
    entries = _list_entries(rows.select("text"), level, buckets, words, similarity)
    found = staged(
        entries.groupBy("bucket").applyInPandas(_merge_lists, "kind long, x long, y long, size long"), "list-pairs"
    )

    def rep_of(column: str, name: str) -> DataFrame:
        return names.select(F.col("set").alias(column), F.col("rep").alias(name))

    pairs = (
        found.where("kind = 0").select("x", "y").distinct()
        .join(rep_of("x", "a"), "x").join(rep_of("y", "b"), "y")
        .where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    bits = sets.where("set IS NOT NULL AND id IS NOT NULL").select("id", "n", "data")
    pairs = staged(_could_link(pairs, bits, similarity), "pairs")
    lists = staged(found.where("kind = 1").select("x", "size", F.col("y").alias("set")).join(rep_of("set", "rep"), "set").where("rep IS NOT NULL"), "lists")
    ids = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).unionByName(lists.select(F.col("rep").alias("a")))
    whole = staged(_sets_of(rows, ids.where("a IS NOT NULL"), slots, words), "whole-sets")
    links = staged(_links(pairs, whole, similarity), "links")
    labels = staged(connected(links), "labels")

    if lists.limit(1).count():
        more = _list_links(lists, labels, bits, whole, similarity)
        labels = staged(connected(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more)), "labels")

    groups = staged(
        names.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("set", F.coalesce("label", "rep").alias("component_id")),
        "components",
    )
    def result(rows: DataFrame, component: str) -> DataFrame:
        return rows.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col(component).alias("component_id"))

    filled = sets.where("set IS NOT NULL").drop("data").join(groups, "set")
    return result(filled, "component_id").unionByName(result(sets.where("set IS NULL"), "id"))


def _list_links(lists: DataFrame, labels: DataFrame, bits: DataFrame, whole: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Links across components within long lists."""
    marked = staged(
        lists.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep")).drop("set"),
        "list-labels",
    )
    mixed = staged(
        marked.groupBy("x").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"))
        .where("low != high").select("x", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")),
        "mixed-lists",
    )
    # Each pair of blocks is one group: side 0 against side 1, or one block with itself (side 2).
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = (
        marked.join(mixed, "x")
        .join(bits.withColumnRenamed("id", "rep"), "rep")
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "x", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "rep", "label", "size", "n", "data",
            F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1).alias("side"),
        )
    )
    pairs = staged(dealt.groupBy("x", "i", "j").applyInPandas(_across(similarity), "a long, b long"), "across").distinct()
    return staged(_links(pairs, whole, similarity), "more-links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the smallest id stays."""
    name = "_near"
    while name in docs.columns:
        name += "_"
    stays = near_duplicates(docs, id_col=id_col, text_col=text_col).where("doc_id = component_id OR doc_id IS NULL")
    stays = stays.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(stays, docs[id_col].cast("long").eqNullSafe(stays[name]), "left_semi")
