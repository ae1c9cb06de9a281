"""Nearest neighbours by largest inner product with vantage-point trees per shard.

An extra coordinate gives every vector one norm, so the largest inner product is the smallest
distance and the triangle inequality holds. Vectors are first parted into at most ``BANDS`` bands of
norms, each half as long as the one before and lifted to its own largest norm, so a few long vectors
do not blur the distances of the others. A small vantage-point tree per band, all of them fitted on
at most ``SAMPLE`` vectors chosen by a hash of the id, deals the vectors to cells; a cell of more than
``SHARD_ROWS`` vectors (or ``SHARD_BYTES``) is dealt on to several shards by a hash. Each shard builds its own
tree, once, and is stored with it. A query first searches one shard of the cell in its direction in the
largest band, which bounds the score of its last neighbour, and then every shard whose cell may hold
something better. Only shards that some query visits are read, one copy for each ``QUERY_BLOCK`` visits.

A branch or cell has a best score that its longest vector allows and a lower one that the triangle
inequality allows. It is skipped when the second lies further below the first than ``relax`` squared
times the gap of the last neighbour's score. The gap does not hold the norm that vectors are lifted
to, and for equal norms it is the distance times ``relax``. ``relax`` = 1 is exact; less skips more
and may miss neighbours.

Equal vectors are indexed once with their ``k`` + 1 smallest ids, however many rows share them.
Vectors that are null, empty, zero or that hold null or non-finite components take no part, neither do
rows without an id. Vectors of one length are searched among themselves, so a query finds only vectors of
its own length. Ties go to the smaller id. Scores are inner products of the original vectors in double
precision: bands and queries are scaled by powers of two, so only a score that is itself beyond the range
of a double becomes infinite or zero. A repeated id is found once per distinct vector and asks with the
smallest of its vectors. An empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import floor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnsieve.llm.common import ship_package
from txnsieve.operators.lookups import lookup_join
from txnsieve.session import staged

K = 20
SAMPLE = 20_000
SHARD_ROWS = 4096
SHARD_BYTES = 32 << 20
LEAF_ROWS = 128
QUERY_BLOCK = 16_384
RELAX = 0.9
BANDS = 32
_ROUNDING = 1e-12
FOUND = "query_id long, vec_id long, score double"
NEAREST = "query_id long, rank int, vec_id long, score double"


@dataclass
class Node:
    """An inner node: its vantage point and the radius inside which the first child lies; or a leaf.

    ``longest`` is the largest norm of the vectors below, before they were lifted.
    """

    point: np.ndarray | None = None
    radius: float = 0.0
    inside: Node | None = None
    outside: Node | None = None
    rows: np.ndarray | None = None
    cell: int = -1
    longest: float = 0.0


@dataclass
class Band:
    """The vectors of similar norm: their largest norm, how many, their tree and its cells from ``first`` on.

    All lengths in the band are in units of two to the ``power``.
    """

    top: float
    power: int
    count: int
    tree: Node
    first: int
    cells: int


def unscaled(queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Queries divided by a power of two near their largest component, and these powers."""
    power = np.frexp(np.abs(queries).max(axis=1, initial=0.0))[1].astype(np.int64)
    return np.ldexp(queries, -power[:, None]), power


def in_units(score: np.ndarray, power: np.ndarray) -> np.ndarray:
    """Scores in units of two to the ``power``; a score beyond the range of a double bounds nothing."""
    with np.errstate(over="ignore"):
        return np.where(score == np.inf, -np.inf, np.ldexp(score, -power))


def lifted(vectors: np.ndarray, top: float) -> np.ndarray:
    """Vectors with one more coordinate, so that all have norm ``top``."""
    rest = np.maximum(0.0, top * top - np.einsum("ij,ij->i", vectors, vectors))
    return np.column_stack([vectors, np.sqrt(rest)])


def distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, np.einsum("ij,ij->i", points - to, points - to)))


def turned(queries: np.ndarray, top: float) -> np.ndarray:
    """Queries scaled to norm ``top``, beside lifted vectors."""
    norm = np.linalg.norm(queries, axis=1)
    return np.column_stack([queries * (top / norm)[:, None], np.zeros(len(queries))])


def may_hold(bound: np.ndarray, longest: np.ndarray | float, product: np.ndarray, top: float, relax: float) -> np.ndarray:
    """Whether vectors at least ``bound`` away and of norm up to ``longest`` may reach ``product`` with a turned query."""
    most = top * longest
    reached = top * top - np.square(np.maximum(bound, 0.0)) / 2
    slack = _ROUNDING * top * top
    return (product <= most + slack) & (most - reached <= relax * relax * (most - product) + slack)


def build(points: np.ndarray, leaf_rows: int, seed: int = 7) -> Node:
    """A vantage-point tree of lifted vectors: each node splits its rows at the median distance to one of them."""
    random = np.random.default_rng(seed)
    length = np.linalg.norm(points[:, :-1], axis=1)

    def grow(rows: np.ndarray) -> Node:
        longest = float(length[rows].max(initial=0.0))
        if len(rows) <= leaf_rows:
            return Node(rows=rows, longest=longest)
        tried = random.choice(rows, min(8, len(rows)), replace=False)
        seen = random.choice(rows, min(64, len(rows)), replace=False)
        vantage = max(tried, key=lambda r: distances(points[seen], points[r]).std())
        far = distances(points[rows], points[vantage])
        half = len(rows) // 2
        order = np.argsort(far, kind="stable")
        radius = float((far[order[half - 1]] + far[order[half]]) / 2)
        inside = far <= radius
        if inside.all():  # half the rows at one distance: no radius separates them
            return Node(rows=rows, longest=longest)
        return Node(points[vantage], radius, grow(rows[inside]), grow(rows[~inside]), longest=longest)

    return grow(np.arange(len(points)))


class Best:
    """The best ``k`` rows of each query so far, ties by the smaller first id."""

    def __init__(self, queries: int, k: int, floor: np.ndarray) -> None:
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.row = np.full((queries, k), -1)
        self.floor = floor  # a score that the last neighbour is known to reach

    def last(self, q: np.ndarray) -> np.ndarray:
        return np.maximum(self.floor[q], self.score[q, -1])

    def add(self, q: np.ndarray, scores: np.ndarray, rows: np.ndarray, first_id: np.ndarray) -> None:
        hit = (scores >= self.last(q)[:, None]).any(axis=1)
        q, scores = q[hit], scores[hit]
        if not len(q):
            return
        both = np.concatenate([self.score[q], scores], axis=1)
        rows = np.concatenate([self.row[q], np.broadcast_to(rows, scores.shape)], axis=1)
        ids = np.where(rows >= 0, first_id[rows], np.iinfo(np.int64).max)
        order = np.lexsort((ids, -both), axis=1)[:, : self.k]
        self.score[q] = np.take_along_axis(both, order, axis=1)
        self.row[q] = np.take_along_axis(rows, order, axis=1)


def search(
    tree: Node,
    vectors: np.ndarray,
    first_id: np.ndarray,
    queries: np.ndarray,
    k: int,
    floor: np.ndarray,
    top: float,
    relax: float,
    power: np.ndarray,
) -> Best:
    """The best rows for each query; visits the nearer child first, then the other if it may help.

    Products of ``queries`` and ``vectors`` are in units of two to the ``power`` of the query; ``floor`` and
    the scores found are not.
    """
    best = Best(len(queries), k, floor)
    norm = np.linalg.norm(queries, axis=1)
    at = turned(queries, top)

    def hopeful(q: np.ndarray, node: Node, bound: np.ndarray) -> np.ndarray:
        """The queries that may find something better than their last neighbour below a node."""
        return q[may_hold(bound, node.longest, in_units(best.last(q), power[q]) * top / norm[q], top, relax)]

    def visit(node: Node, q: np.ndarray) -> None:
        if not len(q):
            return
        if node.rows is not None:
            with np.errstate(over="ignore"):
                scores = np.ldexp(queries[q] @ vectors[node.rows].T, power[q, None])
            best.add(q, scores, node.rows, first_id)
            return
        far = distances(at[q], node.point)
        near = far <= node.radius
        visit(node.inside, q[near])
        visit(node.outside, q[~near])
        a, b = q[near], q[~near]
        visit(node.outside, hopeful(a, node.outside, node.radius - far[near]))
        visit(node.inside, hopeful(b, node.inside, far[~near] - node.radius))

    visit(tree, np.arange(len(queries)))
    return best


def _cells(tree: Node) -> int:
    """Numbers the leaves of a tree."""
    count = 0

    def walk(node: Node) -> None:
        nonlocal count
        if node.rows is not None:
            node.rows, node.cell = np.empty(0, int), count
            count += 1
        else:
            walk(node.inside)
            walk(node.outside)

    walk(tree)
    return count


def _home(tree: Node, points: np.ndarray) -> np.ndarray:
    cell = np.zeros(len(points), dtype=np.int64)

    def walk(node: Node, at: np.ndarray) -> None:
        if node.rows is not None:
            cell[at] = node.cell
        elif len(at):
            inside = distances(points[at], node.point) <= node.radius
            walk(node.inside, at[inside])
            walk(node.outside, at[~inside])

    walk(tree, np.arange(len(points)))
    return cell


def _bounds(tree: Node, points: np.ndarray, cells: int) -> np.ndarray:
    """A lower bound of the distance from each point to each cell."""
    bound = np.zeros((len(points), cells))

    def walk(node: Node, least: np.ndarray) -> None:
        if node.rows is not None:
            bound[:, node.cell] = least
            return
        far = distances(points, node.point)
        walk(node.inside, np.maximum(least, far - node.radius))
        walk(node.outside, np.maximum(least, node.radius - far))

    walk(tree, np.zeros(len(points)))
    return bound


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows that take part: ``id``, ``vec`` and the logarithm of its norm, which no finite vector overflows."""
    v = F.col("vec")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.coalesce(whole, F.lit(False)))
    most = F.array_max(F.transform(v, F.abs))
    squares = F.aggregate(F.transform(v, lambda x: x / F.col("most")), F.lit(0.0), lambda a, x: a + x * x)
    return rows.withColumn("most", most).select("id", "vec", (F.log2("most") + F.log2(squares) / 2).alias("log_norm"))


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """One row per distinct vector with its smallest ids, in order."""
    w = Window.partitionBy("vec").orderBy("id")
    pairs = rows.select("vec", "id").distinct()  # a repeated id takes one place only
    few = pairs.withColumn("n", F.row_number().over(w)).where(F.col("n") <= ids)
    return few.groupBy("vec").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    relax: float = RELAX,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score``: the ``k`` nearest other rows of each query."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = staged(usable(vectors, id_col, vector_col), "vectors")
    asked = queries.select(F.col(id_col).cast("long").alias("id")).distinct()
    asked = staged(rows.join(asked, "id", "left_semi").groupBy("id").agg(F.min("vec").alias("vec")), "queries")
    lengths = [r["n"] for r in asked.groupBy(F.size("vec").alias("n")).count().collect()]
    found = [
        _nearest_of_length(rows.where(F.size("vec") == n), asked.where(F.size("vec") == n), n, k, relax, shard_rows)
        for n in sorted(lengths)
    ]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], NEAREST)


def _bands(index: DataFrame, length: int, shard_rows: int) -> dict[int, Band]:
    """Bands of norms, their trees fitted on a sample, and cells of about ``shard_rows`` vectors."""
    sizes = index.groupBy("band").agg(F.count("*").alias("count"), F.max("log_norm").alias("log_norm")).collect()
    sample = index.orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0]).limit(SAMPLE).select("band", "vec").collect()
    bands: dict[int, Band] = {}
    for r in sorted(sizes, key=lambda r: r["band"]):
        power = floor(r["log_norm"])
        top = 2.0 ** (r["log_norm"] - power)
        seen = np.array([s["vec"] for s in sample if s["band"] == r["band"]], dtype=float).reshape(-1, length)
        tree = build(lifted(np.ldexp(seen, -power), top), max(4, int(len(seen) * shard_rows / r["count"])))
        bands[r["band"]] = Band(top, power, r["count"], tree, sum(b.cells for b in bands.values()), _cells(tree))
    return bands


def _nearest_of_length(rows: DataFrame, asked: DataFrame, length: int, k: int, relax: float, shard_rows: int) -> DataFrame:
    spark = rows.sparkSession
    shard_rows = max(1, min(shard_rows, SHARD_BYTES // (8 * length)))
    query_block = max(1, min(QUERY_BLOCK, 4 * SHARD_BYTES // (8 * length)))
    longest = rows.agg(F.max("log_norm")).first()[0]
    norms = rows.groupBy("vec").agg(F.first("log_norm").alias("log_norm"))
    halvings = F.floor(F.lit(float(longest)) - F.col("log_norm")).cast("int")  # a few thousand at most
    index = distinct_vectors(rows, k + 1).join(norms, "vec")
    index = staged(index.withColumn("band", F.greatest(F.lit(0), F.least(halvings, F.lit(BANDS - 1)))), "index")
    shared = spark.sparkContext.broadcast(_bands(index, length, shard_rows))

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bands = shared.value
        for f in frames:
            f["cell"] = np.zeros(len(f), np.int64)
            for number, band in bands.items():
                at = np.flatnonzero(f["band"] == number)
                if len(at):
                    points = lifted(np.ldexp(np.array(f["vec"].iloc[at].tolist()), -band.power), band.top)
                    f.iloc[at, f.columns.get_loc("cell")] = band.first + _home(band.tree, points)
            yield f[["vec", "ids", "log_norm", "cell"]]

    index = staged(index.mapInPandas(deal, "vec array<double>, ids array<long>, log_norm double, cell long"), "cells")
    held = index.groupBy("cell").agg(F.count("*").alias("count"), F.max("log_norm").alias("log_norm")).collect()
    parts = {r["cell"]: max(1, -(-r["count"] // shard_rows)) for r in held}
    reach = {r["cell"]: r["log_norm"] for r in held}
    width = max(parts.values())
    held = spark.createDataFrame(sorted(parts.items()), "cell long, parts long")  # one row per cell
    part = F.pmod(F.xxhash64(F.col("ids")[0]), F.col("parts"))
    index = index.join(F.broadcast(held), "cell").select("vec", "ids", "cell", (F.col("cell") * width + part).alias("shard"))

    def band_of(cell: int) -> Band:
        return max((b for b in shared.value.values() if b.first <= cell), key=lambda b: b.first)

    def grow(f: pd.DataFrame) -> pd.DataFrame:
        """One shard with its tree."""
        first = np.array([i[0] for i in f["ids"]])
        order = np.argsort(first, kind="stable")  # the same tree whatever order the rows arrive in
        power = band_of(int(f["cell"].iloc[0])).power
        x = np.ldexp(np.array(f["vec"].tolist())[order], -power)
        top = float(np.linalg.norm(x, axis=1).max())
        whole = (x, first[order], [list(f["ids"].iloc[o]) for o in order], build(lifted(x, top), LEAF_ROWS), top, power)
        return pd.DataFrame({"shard": [int(f["shard"].iloc[0])], "tree": [pickle.dumps(whole)]})

    shards = staged(index.groupBy("shard").applyInPandas(grow, "shard long, tree binary"), "shards")

    def shards_of(cell: int) -> range:
        return range(cell * width, cell * width + parts.get(cell, 0))

    def go_home(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        band = max(shared.value.values(), key=lambda b: b.count)
        for f in frames:
            if len(f):
                home = band.first + _home(band.tree, turned(unscaled(np.array(f["vec"].tolist()))[0], band.top))
                f["shard"] = [c * width + int(i) % max(1, parts.get(int(c), 1)) for c, i in zip(home, f["id"])]
                f["floor"] = -np.inf
                yield f[["id", "vec", "shard", "floor"]]

    def go_on(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            q, powers = unscaled(np.array(f["vec"].tolist()))
            norm, out = np.linalg.norm(q, axis=1), []
            for band in shared.value.values():
                most = np.array([2.0 ** (reach[band.first + c] - band.power) if band.first + c in reach else 0.0 for c in range(band.cells)])
                bound = _bounds(band.tree, turned(q, band.top), band.cells)
                product = in_units(f["floor"].to_numpy(), powers + band.power) * band.top / norm
                at, cell = np.nonzero(may_hold(bound, most, product[:, None], band.top, relax))
                out += [(i, s) for i, c in zip(at, cell) for s in shards_of(band.first + int(c))]
            g = f.iloc[[i for i, _ in out]].copy()
            g["shard"] = [s for _, s in out]
            yield g[g["shard"] != g["home"]][["id", "vec", "shard", "floor"]]

    def look(key: tuple, held: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(held) and len(wanted):
            x, first, ids, tree, top, power = pickle.loads(held["tree"].iloc[0])
            q, powers = unscaled(np.array(wanted["vec"].tolist()))
            best = search(tree, x, first, q, k + 1, wanted["floor"].to_numpy(), top, relax, powers + power)
            for n, name in enumerate(wanted["id"]):
                found = [(s, i) for s, r in zip(best.score[n], best.row[n]) if r >= 0 for i in ids[r] if i != name]
                out += [(name, i, s) for s, i in sorted(found, key=lambda v: (-v[0], v[1]))[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    visit = "id long, vec array<double>, shard long, floor double"

    def visited(visits: DataFrame) -> DataFrame:
        """What the visits find: shards without visits are left out, those of very many are copied for blocks of them."""
        busy = staged(visits.groupBy("shard").agg(F.ceil(F.count("*") / query_block).alias("blocks")), "visited")
        copies = lookup_join(shards, busy, ["shard"], "inner")
        copies = copies.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
        dealt = lookup_join(visits, busy, ["shard"], "inner", spread_by=["id"])
        dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))).drop("blocks")
        by = copies.groupBy("shard", "block").cogroup(dealt.groupBy("shard", "block"))
        return by.applyInPandas(look, FOUND)

    homes = staged(asked.mapInPandas(go_home, visit), "homes")
    near = staged(visited(homes), "near")
    kth = Window.partitionBy("query_id").orderBy(F.desc("score"))
    floors = near.withColumn("n", F.row_number().over(kth)).where(F.col("n") == k).select(F.col("query_id").alias("id"), F.col("score").alias("reached"))
    onward = (
        homes.withColumnRenamed("shard", "home")
        .join(floors, "id", "left")
        .select("id", "vec", "home", F.coalesce("reached", "floor").alias("floor"))
        .mapInPandas(go_on, visit)
    )
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        near.unionByName(visited(staged(onward, "onward")))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
