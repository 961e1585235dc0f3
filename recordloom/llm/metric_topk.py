"""Exact top-k by inner product with M-trees and best-first search (operator 3).

Inner products become distances by one more component: with M the largest squared
norm, (x, sqrt(M - x.x)) and (q, 0) are at the squared distance q.q + M - 2 q.x, so
the largest products are the nearest points of a metric space. Vectors are dealt to
cells by their nearest pivot, a cell into blocks of bounded size by the distance from
it, and each block is an M-tree of pages: inner entries hold a routing object, a
covering radius and the distance to the parent, leaf entries the distance to theirs.
A search takes the page with the least lower bound first; an entry's distance is not
computed where the stored ones rule it out by the triangle inequality. The blocks
themselves are the tree's top page: each has its least and largest distance to some
pivots. A query searches its own block first, then the few of the highest bound, and
its k-th score so far decides which others it must visit at all.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.llm.common import discard, materialize, table

#: Neighbours asked for, entries of a page, vectors of a block, most pivots.
K, PAGE, BLOCK, PIVOTS = 10, 64, 16_384, 1024
#: Most blocks, of whose bounds the driver gets one row each (blocks of more than 2^31 vectors are larger than ``BLOCK``); pivots whose distances bound a block; blocks of the second round.
BLOCKS, RINGS, NEXT = 1 << 17, 16, 4
SCALE = 1024
#: The largest squared norm; products of two such vectors are 62 bits.
LARGEST = float(1 << 62)


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, e`` (the floor of each scaled component, as packed int64), ``dim`` and ``norm2``, of usable vectors.

    Null vectors, null ids and vectors with a null or non-finite component are left
    out. Scores are 64-bit integers; a vector with which they could leave 62 bits is
    an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, packed, dims, norms = [], [], [], []
            for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if vec_id is None or v is None or None in v:
                    continue
                x = np.asarray(v, np.float64)
                if np.isfinite(x).all():
                    e = np.floor(scale * x)
                    if e @ e > LARGEST:
                        raise OverflowError(f"vector {vec_id}: its scores may leave 63 bits")
                    e = e.astype(np.int64)
                    ids.append(vec_id)
                    packed.append(e.astype("<i8").tobytes())
                    dims.append(len(e))
                    norms.append(int(e @ e))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(packed, pa.binary()), pa.array(dims, pa.int64()), pa.array(norms, pa.int64())], ["vec_id", "e", "dim", "norm2"])

    return vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(run, "vec_id long, e binary, dim long, norm2 long")


def unpack(packed: list[bytes], dim: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    return np.frombuffer(b"".join(p.ljust(8 * dim, b"\0") for p in packed), "<i8").reshape(len(packed), dim).astype(np.int64)


def raised(e: np.ndarray, most: int) -> np.ndarray:
    """With the component that turns products into distances."""
    x = e.astype(np.float64)
    return np.hstack([x, np.sqrt(np.maximum(0.0, most - (x * x).sum(axis=1)))[:, None]])


def distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    d = points - to
    return np.sqrt(np.einsum("ij,ij->i", d, d))


class MTree:
    """A metric tree over rows of integer vectors, loaded in bulk."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, most: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.most = ids[order], vectors[order], most
        self.points = raised(self.vectors, most)
        self.computed = 0
        self.root = self._load(np.arange(len(ids)), None)

    def _load(self, rows: np.ndarray, parent: np.ndarray | None):
        """A page: (is leaf, rows or routing rows, distances to the parent, radii, children)."""
        near = distances(self.points[rows], parent) if parent is not None else np.zeros(len(rows))
        if len(rows) <= PAGE:
            return True, rows, near, None, None
        fan = min(PAGE, -(-len(rows) // PAGE))
        picks = rows[np.linspace(0, len(rows) - 1, fan).astype(int)]
        best, which = np.full(len(rows), np.inf), np.zeros(len(rows), np.int64)
        for i, p in enumerate(picks):
            d = distances(self.points[rows], self.points[p])
            closer = d < best
            best[closer], which[closer] = d[closer], i
        if np.bincount(which).max() > 0.9 * len(rows):  # equal or nearly equal points: cut by order
            which = np.arange(len(rows)) * fan // len(rows)
        routing, radii, children = [], [], []
        for i in np.unique(which):
            own = rows[which == i]
            centre = picks[i] if picks[i] in own else own[0]
            routing.append(centre)
            radii.append(distances(self.points[own], self.points[centre]).max())
            children.append(self._load(own, self.points[centre]))
        routing = np.asarray(routing)
        above = distances(self.points[routing], parent) if parent is not None else np.zeros(len(routing))
        return False, routing, above, np.asarray(radii), children

    def search(self, vec_id: int, query: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
        """The best ``(score, vec_id)`` without the query's own id: k at most, none below ``floor``."""
        point = np.append(query.astype(np.float64), 0.0)
        reach = float(query.astype(np.float64) @ query) + self.most
        slack = 0.5 + 1e-9 * reach
        most = lambda d: (reach - np.maximum(0.0, d) ** 2) / 2 + slack  # noqa: E731  the largest score at distance d or more
        scores, ids = np.empty(0, np.int64), np.empty(0, np.int64)
        least = -math.inf if floor is None else floor
        heap, n = [(0.0, 0, None, self.root)], 0
        while heap:
            bound, _, from_parent, (leaf, rows, above, radii, children) = heapq.heappop(heap)
            if most(bound) < least:
                break
            apart = np.abs(above - from_parent) if from_parent is not None else np.zeros(len(rows))
            if leaf:
                rows = rows[most(apart) >= least]
                rows = rows[self.ids[rows] != vec_id]
                self.computed += len(rows)
                got = self.vectors[rows] @ query
                scores, ids = np.append(scores, got), np.append(ids, self.ids[rows])
                if floor is not None:
                    scores, ids = scores[keep := scores >= floor], ids[keep]
                order = np.lexsort((ids, -scores))[:k]
                scores, ids = scores[order], ids[order]
                if len(scores) == k:
                    least = max(least, int(scores[-1]))
            else:
                for i in np.flatnonzero(most(apart - radii) >= least).tolist():
                    self.computed += 1
                    d = float(distances(self.points[rows[i : i + 1]], point)[0])
                    if most(low := max(0.0, d - radii[i])) >= least:
                        n += 1
                        heapq.heappush(heap, (low, n, d, children[i]))
        return list(zip(scores.tolist(), ids.tolist(), strict=True))


def top_k(vectors: DataFrame, *, k: int = K, every: int = 100, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest inner products of each query with all other rows.

    Queries are the usable rows whose ``vec_id`` is divisible by ``every``. Ties go
    to the smaller ``vec_id``; vectors of unequal length are compared as if the
    shorter ended in zeros. Rows of the query's own id are never its answers; a
    repeated query id is asked once, with its largest packed vector; repeated
    candidates count as often as they occur. An empty table gives no rows.

    The driver gets at most 1,024 pivots and the bounds of at most some 2^17 blocks.
    A cell, however large, is cut into blocks of about 16,384 rows (more from 2^31
    rows on), so neither a dense region nor one vector repeated a billion times meets
    in one task.
    """
    spark = vectors.sparkSession
    rows = materialize(integers(vectors, scale), "integers")
    n, dim, most = rows.agg(F.count("*"), F.max("dim"), F.max("norm2")).first()
    out = "query_id long, rank int, vec_id long, score long"
    if not n:
        return spark.createDataFrame([], out)
    dim = max(1, dim)
    count = int(min(PIVOTS, max(8, math.sqrt(n) / 4)))
    picked = unpack([r.e for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id", "e").limit(count).select("e").collect()], dim)
    pivots = raised(np.unique(picked, axis=0), most)

    rings = min(RINGS, len(pivots))

    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = raised(unpack(batch.column(1).to_pylist(), dim), most)
                best, cell, near = np.full(len(points), np.inf), np.zeros(len(points), np.int64), []
                for i, p in enumerate(pivots):
                    d = distances(points, p)
                    cell[d < best] = i
                    best = np.minimum(best, d)
                    if i < rings:
                        near.append(d)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell), pa.array(best), pa.array(list(np.stack(near, axis=1)), pa.list_(pa.float64()))], ["vec_id", "e", "cell", "away", "rings"])

    dealt = materialize(rows.select("vec_id", "e").mapInArrow(to_cells, "vec_id long, e binary, cell long, away double, rings array<double>"), "cells")
    block_size = max(BLOCK, -(-n // BLOCKS))
    # Cells are cut where their quantiles by distance lie; what is still too large, as equal vectors are, is dealt at random.
    large = dealt.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > block_size).select("cell", F.ceil(F.col("n") / block_size).alias("parts"))
    share = [i / 100 for i in range(1, 100)]
    cuts = dealt.join(F.broadcast(large), "cell").groupBy("cell").agg(F.percentile_approx("away", share, 10_000).alias("cuts"), F.first("parts").alias("parts"))
    cuts = cuts.select("cell", F.expr("filter(cuts, (x, i) -> floor((i + 1) * parts / 100) > floor(i * parts / 100))").alias("cuts"))
    ring = dealt.join(F.broadcast(cuts), "cell", "left").withColumn("part", F.coalesce(F.size(F.filter("cuts", lambda x: x < F.col("away"))), F.lit(0))).drop("cuts")
    ring = materialize(ring, "parts")
    full = ring.groupBy("cell", "part").agg(F.count("*").alias("n")).where(F.col("n") > 2 * block_size).select("cell", "part", F.ceil(F.col("n") / block_size).alias("splits"))
    spread = F.pmod(F.xxhash64(F.lit(3), "vec_id", F.monotonically_increasing_id()), F.coalesce("splits", F.lit(1)))
    block = F.shiftleft("cell", 48) + F.shiftleft(F.col("part").cast("long"), 40) + spread
    placed = materialize(ring.join(F.broadcast(full), ["cell", "part"], "left").select("vec_id", "e", block.alias("block"), "rings"), "blocks")
    edges = [f("rings", i) for i in range(rings) for f in (lambda c, i: F.min(F.col(c)[i]), lambda c, i: F.max(F.col(c)[i]))]
    bounds = sorted(placed.groupBy("block").agg(*edges).collect())
    blocks = np.asarray([r[0] for r in bounds], np.int64)
    low, high = (np.asarray([r[at::2] for r in bounds], np.float64) for at in (1, 2))
    placed = placed.drop("rings")
    discard(dealt)
    discard(ring)
    asked = placed.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.max(F.struct("e", "block")).alias("q")).select("vec_id", "q.e", "q.block", F.lit(None).cast("long").alias("floor"))

    def searched(group: pa.Table) -> pa.Table:
        of_query = np.asarray(group.column("asks"))
        ids, packed, floors = np.asarray(group.column("vec_id")), group.column("e").to_pylist(), group.column("floor").to_pylist()
        found: list[tuple] = []
        if of_query.any() and not of_query.all():
            members, queries = np.flatnonzero(~of_query), np.flatnonzero(of_query)
            tree = MTree(ids[members], unpack([packed[i] for i in members], dim), most)
            wanted = unpack([packed[i] for i in queries], dim)
            for i, q in zip(queries, wanted, strict=True):
                found += [(int(ids[i]), v, s) for s, v in tree.search(int(ids[i]), q, k, floors[i])]
        return pa.table({"query_id": pa.array([f[0] for f in found], pa.int64()), "vec_id": pa.array([f[1] for f in found], pa.int64()), "score": pa.array([f[2] for f in found], pa.int64())})

    def search(queries: DataFrame) -> DataFrame:
        both = placed.select("block", "vec_id", "e", F.lit(None).cast("long").alias("floor"), F.lit(False).alias("asks")).union(queries.select("block", "vec_id", "e", "floor", F.lit(True).alias("asks")))
        return both.groupBy("block").applyInArrow(searched, "query_id long, vec_id long, score long")

    def elsewhere(again: bool):
        """The blocks that a query's k-th score leaves to visit besides its own: the ``NEXT`` of the highest bound, or ``again``, by the score after these, the others."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                ids, packed, home, floors, later = batch.to_pydict().values()
                queries = unpack(packed, dim)
                columns: list[list] = [[], [], [], []]
                for vec_id, e, own, floor, floor_now, q in zip(ids, packed, home, floors, later, queries, strict=True):
                    reach = float(q.astype(np.float64) @ q) + most
                    d = distances(pivots[:rings], np.append(q.astype(np.float64), 0.0))
                    apart = np.maximum(0.0, np.maximum(low - d, d - high).max(axis=1))
                    bound = (reach - apart**2) / 2 + 0.5 + 1e-9 * reach
                    left = np.flatnonzero((blocks != own) & (bound >= (-math.inf if floor is None else floor)))
                    left = left[np.argsort(-bound[left], kind="stable")]
                    to = left[NEXT:] if again else left[:NEXT]
                    if again and floor_now is not None:
                        to = to[bound[to] >= floor_now]
                    for b in blocks[to].tolist():
                        for c, v in zip(columns, (vec_id, e, b, floor_now if again else floor), strict=True):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.int64(), pa.int64()), strict=True)], ["vec_id", "e", "block", "floor"])

        return run

    def floors(found: DataFrame, name: str) -> DataFrame:
        """Each query's k-th score so far, if it has as many."""
        best = Window.partitionBy("query_id").orderBy(F.col("score").desc())
        kth = found.withColumn("place", F.row_number().over(best)).where(F.col("place") == k)
        return kth.select(F.col("query_id").alias("vec_id"), F.col("score").alias(name))

    visits = "vec_id long, e binary, block long, floor long"
    near = materialize(search(asked), "near")
    known = materialize(asked.drop("floor").join(floors(near, "floor"), "vec_id", "left").select("vec_id", "e", "block", "floor", F.lit(None).cast("long").alias("later")), "asked")
    second = materialize(search(known.mapInArrow(elsewhere(False), visits)), "second")
    both = near.union(second)
    rest = known.drop("later").join(floors(both, "later"), "vec_id", "left").select("vec_id", "e", "block", "floor", "later")
    every_hit = both.union(search(rest.mapInArrow(elsewhere(True), visits)))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return every_hit.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))
