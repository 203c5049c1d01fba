"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Candidates are dealt into blocks by a hash of their id, queries likewise, and each pair of blocks is one
group of bounded size. Within it every dimension has its list of candidates in order of value.
A query walks all lists at once, from the end that its component's sign favours, scores what it meets, and
stops as soon as the best score that an unseen candidate could have (the components at the
current depth) is below its k-th best. Each group gives at most k rows a query; these are merged by query.

Defined cases: rows whose id or vector is null, or whose vector holds a null or non-finite
component, take no part; vectors meet only vectors of the same length; an empty vector scores 0
with every empty one; ties go to the smaller id; a query with fewer than k candidates gets all; an id on several
rows counts once, with its smallest vector; an empty side gives an empty result. Components and scores beyond the range
of a long end at its limits: blocks that could reach them are scored whole, in whole numbers of any size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 8192


def quantize(vector: Column, factor: int = 256) -> Column:
    """Each component times ``factor``, rounded down, as long; null unless all are finite numbers."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * factor)))


class Lists:
    """A block of candidates with its sorted lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)
        self.exact = vectors.astype(np.float64)
        self.largest = float(np.abs(self.exact).max(initial=0))

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        most = self.reach(query)
        if most < 2.0**53:  # exact in doubles
            return (self.exact[rows] @ query.astype(np.float64)).astype(np.int64)
        if most < 2.0**62:
            return self.vectors[rows] @ query
        whole = query.tolist()
        exact = (sum(a * b for a, b in zip(v, whole, strict=True)) for v in self.vectors[rows].tolist())
        return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in exact], np.int64)

    def reach(self, query: np.ndarray) -> float:
        """No inner product of the block with the query is larger."""
        return self.largest * float(np.abs(query.astype(np.float64)).max(initial=0)) * max(1, len(query))

    def best(self, own: int, query: np.ndarray, k: int, depth: int = 32) -> tuple[np.ndarray, np.ndarray]:
        """The k best (ids, scores) but the query's own, by falling score and rising id."""
        n = len(self.ids)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = self.ids == own
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = 0
        while at < n:
            to = n if len(up) + len(down) == 0 or self.reach(query) >= 2.0**62 else min(n, max(depth, 2 * at))
            met = np.zeros(n, bool)
            if to == n:
                met[:] = True
            else:
                met[self.order[n - to : n - at, up].ravel()] = True
                met[self.order[at:to, down].ravel()] = True
            rows = np.flatnonzero(met & ~seen)
            seen |= met
            new = self.scores(rows, query)
            if len(new) > k:
                keep = new >= np.partition(new, len(new) - k)[len(new) - k]
                rows, new = rows[keep], new[keep]
            ids, scores = np.append(ids, self.ids[rows]), np.append(scores, new)
            first = np.lexsort((ids, ~scores))[:k]  # ~ reverses the order without overflow
            ids, scores = ids[first], scores[first]
            at = to
            if at < n and len(ids) == k:
                bound = self.sorted[n - at, up] @ query[up] + self.sorted[at - 1, down] @ query[down]
                if bound < scores[-1]:  # on a tie an unseen smaller id could still come first
                    break
        return ids, scores


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 0), np.int64)


def top_k(queries: DataFrame, candidates: DataFrame, k: int, key: str = "vec_id", vector: str = "vector",
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, key, score) of the k best candidates of each query; vectors are array<long>."""
    sides = []
    for side in (queries, candidates):
        side = side.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
        side = side.where("id is not null and v is not null").groupBy("id").agg(F.min("v").alias("v"))
        sides.append((side, max(1, math.ceil(side.count() / block_rows))))
    (asked, q_blocks), (held, c_blocks) = sides

    def dealt(side: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        """Each row goes to its own block, once for each block of the other side."""
        block = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(n))
        return side.select("id", "v", F.size("v").alias("dims"), block.alias(own),
                           F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))).alias(other))

    cell = ["dims", "q_block", "c_block"]
    left = dealt(asked, "q_block", q_blocks, "c_block", c_blocks).groupBy(*cell)
    right = dealt(held, "c_block", c_blocks, "q_block", q_blocks).groupBy(*cell)

    def search(q: pa.Table, c: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(3)]
        if q.num_rows and c.num_rows:
            block = Lists(c.column("id").to_numpy(), matrix(c.column("v")))
            for own, query in zip(q.column("id").to_numpy(), matrix(q.column("v")), strict=True):
                ids, scores = block.best(own, query, k)
                for into, values in zip(found, (np.full(len(ids), own), ids, scores), strict=True):
                    into.append(values)
        return pa.table([np.concatenate(f) for f in found], names=["query_id", key, "score"])

    rows = left.cogroup(right).applyInArrow(search, f"query_id long, {key} long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", key, "score")
