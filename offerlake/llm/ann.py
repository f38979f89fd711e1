"""Approximate nearest neighbours by collision-counting hashing.

Every vector is projected on ``PROJECTIONS`` random lines.  Vectors are dealt into blocks;
a block keeps one sorted array per line.  A query opens a window around its own projection
on every line and counts in how many windows each vector lies.  Virtual rehashing widens
all windows by one factor, without new arrays, and counts only what the wider rings add.
Vectors that lie in at least ``COLLISIONS`` of the windows are verified on the original
vectors in double precision.  The search of a block ends when its k-th best distance is
within the radius the windows stand for, or when the windows hold the whole block.

Largest inner product becomes smallest distance by one more coordinate sqrt(M^2 - |x|^2),
M the largest norm, and queries scaled to norm M.

A stated query set meets all rows, block by block: pairs of a block and a slice of the
queries are the groups, each bounded by BLOCK_ROWS and QUERY_ROWS.  Rows are dealt by a
hash of the whole row's number, so equal vectors and repeated ids are spread evenly.

Defined results.  Null or zero vectors, those with null or non-finite components, those
whose length is not the commonest (on a tie the longer) and rows with a null id take no
part.  Rows that repeat an id are separate queries and candidates; only a query's own row
is no candidate of it.  Ties go to the smaller id.  Extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlake.llm.spark import materialize

PROJECTIONS = 24
REACH = 1.2816                # half window of radius 1: holds 80 % of projections at distance 1
COLLISIONS = 16               # windows of 24; a vector within the radius fails this with P < 0.04
WIDEN = 1.12
START = 0.6                   # first radius, as a share of the largest norm
BLOCK_ROWS = 32768
QUERY_ROWS = 1024


def valid(vectors: DataFrame) -> DataFrame:
    """Rows (number, id, v) that take part."""
    ok = (F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    rows = vectors.where("id is not null and v is not null").where(ok)
    size = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).limit(1)
    rows = rows.withColumn("size", F.size("v")).join(F.broadcast(size.select("size")), "size").drop("size")
    return rows.withColumn("number", F.monotonically_increasing_id())


class Block:
    """Sorted projections of one block's vectors."""

    def __init__(self, x: np.ndarray, norm: float, lines: np.ndarray):
        self.x, self.norm, self.lines = x, norm, lines
        self.small = x.astype(np.float32)
        rest = np.sqrt(np.maximum(norm**2 - (x * x).sum(1), 0))
        p = x @ lines[:-1] + rest[:, None] * lines[-1]
        self.order = np.argsort(p, axis=0, kind="stable").T.astype(np.int32).copy()
        self.sorted = np.sort(p, axis=0).T.copy()

    def windows(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Radii of virtual rehashing, and the ends of each query's window per line and
        radius; the last window is the whole line."""
        radii = [START * self.norm]
        while radii[-1] < 2 * self.norm:
            radii.append(radii[-1] * WIDEN)
        length = np.sqrt((queries * queries).sum(1, keepdims=True))
        at = ((queries * (self.norm / length)) @ self.lines[:-1]).T
        low = np.empty((len(queries), len(radii), len(self.sorted)), np.int64)
        high = np.empty_like(low)
        for j, line in enumerate(self.sorted):
            for r, radius in enumerate(radii):
                low[:, r, j] = line.searchsorted(at[j] - REACH * radius, "left")
                high[:, r, j] = line.searchsorted(at[j] + REACH * radius, "right")
        low[:, -1], high[:, -1] = 0, len(self.x)
        return np.array(radii), low, high

    def search(self, q: np.ndarray, radii, low, high, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of vectors among which the k nearest are, as far as found."""
        n, m = len(self.x), len(self.sorted)
        length = float(np.sqrt((q * q).sum()))
        q32 = q.astype(np.float32)
        count = np.zeros(n, np.int64)
        open_ = np.ones(n, bool)
        if own >= 0:
            open_[own] = False
        places, scores, kth = [], [], -np.inf
        for r, radius in enumerate(radii):
            if r == 0:
                rings = [self.order[j, low[0, j]:high[0, j]] for j in range(m)]
            else:
                rings = [self.order[j, low[r, j]:low[r - 1, j]] for j in range(m)]
                rings += [self.order[j, high[r - 1, j]:high[r, j]] for j in range(m)]
            count += np.bincount(np.concatenate(rings), minlength=n)
            new = np.flatnonzero((count >= COLLISIONS) & open_)
            if len(new):
                open_[new] = False
                places.append(new)
                scores.append(self.small[new] @ q32)
                best = np.concatenate(scores)
                kth = float(np.partition(best, len(best) - k)[-k]) if len(best) >= k else -np.inf
            if 2 * self.norm**2 - 2 * self.norm / length * kth <= radius**2:
                break
        if not places:
            return np.zeros(0, np.int64), np.zeros(0)
        # Single precision only sorts out what is clearly behind the k-th.
        place = np.concatenate(places)
        place = place[np.concatenate(scores) >= kth - 1e-4 * self.norm * length]
        return place, (self.x[place] * q).sum(1)


def _lines(size: int) -> np.ndarray:
    return np.random.default_rng(4099).standard_normal((size + 1, PROJECTIONS))


def _matrix(table: pa.Table) -> np.ndarray:
    v = table.column("v").combine_chunks()
    return v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(v), -1)


def _search(norm: float, k: int):
    def run(block: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query", "query_id", "vec_id", "score"]
        parts = []
        if block.num_rows and queries.num_rows:
            x = _matrix(block)
            index = Block(x, norm, _lines(x.shape[1]))
            ids = block.column("id").combine_chunks()
            by_id = np.empty(len(x), np.int64)                 # place of each id in id order: for ties
            by_id[pa.compute.sort_indices(ids).to_numpy()] = np.arange(len(x))
            number = {int(r): i for i, r in enumerate(block.column("number").to_numpy())}
            asked, qid = queries.column("number").to_numpy(), queries.column("id").combine_chunks()
            vectors = _matrix(queries)
            radii, low, high = index.windows(vectors)
            for i, q in enumerate(vectors):
                place, score = index.search(q, radii, low[i], high[i], number.get(int(asked[i]), -1), k)
                best = np.lexsort((by_id[place], -score))[:k]
                parts.append(pa.table([pa.array(np.full(len(best), asked[i])), qid.take(pa.array(np.full(len(best), i))),
                                       ids.take(pa.array(place[best])), pa.array(score[best])], names=names))
        if parts:
            return pa.concat_tables(parts)
        kind = block.schema.field("id").type
        return pa.table([pa.array([], pa.int64()), pa.array([], kind), pa.array([], kind), pa.array([], pa.float64())], names=names)
    return run


def nearest(vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of largest inner product with each
    query.  ``is_query`` is a condition on the input's columns that marks the queries."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = materialize(valid(rows), "ann-vectors")
    n, asked, norm = rows.agg(F.count("*"), F.count(F.when(F.col("asks"), 1)), F.max(
        F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))).first()
    blocks, slices = max(1, -(-n // BLOCK_ROWS)), max(1, -(-asked // QUERY_ROWS))
    dealt = F.xxhash64("number")
    data = (rows.withColumn("block", F.pmod(dealt, F.lit(blocks)))
                .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<bigint>"))))
    queries = (rows.where("asks").withColumn("slice", F.pmod(dealt, F.lit(slices)))
                   .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>"))))
    kind = rows.schema["id"].dataType.simpleString()
    cols = ["block", "slice", "number", "id", "v"]
    near = (data.select(cols).groupBy("block", "slice").cogroup(queries.select(cols).groupBy("block", "slice"))
                .applyInArrow(_search(float(norm or 1.0) ** 0.5 * (1 + 1e-12), k), f"query bigint, query_id {kind}, vec_id {kind}, score double"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
