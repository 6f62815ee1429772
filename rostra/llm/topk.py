"""Exact top-k search by no-random-access aggregation over sorted lists.

Vectors become integers, and a score is an inner product. Each task takes its vectors in
segments and keeps one list per component, sorted by its value. For a query the lists are
read from the end that its component's sign favours, all in step. A vector read in some
lists has a lower bound (unread components count as the list's worst value) and an upper
bound (they count as the last value read). Reading stops when the k-th best lower bound,
of this or an earlier segment, exceeds the upper bounds of all others; the few vectors left
get their final scores, and the best k of the segment join those of the task. Tasks give k
candidates per query, ranked across tasks by a window that keeps k rows.

Queries go to the tasks in batches of ``QUERY_BYTES``, in as many passes as there are.

Defined cases: null vectors and those with null or non-finite components take no part, nor
do empty ones; vectors are compared with those of their length; a query's candidates are all
rows with another id; equal scores rank by the smaller id; a null id takes no part; rows
that repeat an id and a vector count once; vectors of any length are read whole; an empty
table, of queries or of candidates, gives no row; only ``vec_id`` and ``embedding`` are read,
so other columns may have any name.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostra.llm.common import Batches, map_batches, written

K = 5
SCALE = 256
SEGMENT = 4096
QUERY_BYTES = 8 << 20
QUERIES_AT_ONCE = 256
# Steps in which the lists are read; bounds are compared after each.
STEPS = 16


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, dims, vec) with floor(scale * x) of usable vectors, without repeated rows."""
    x = F.col("embedding").cast("array<double>")
    usable = (F.size(x) > 0) & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    )
    return (
        vectors.filter(F.col("vec_id").isNotNull() & usable)
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.transform(x, lambda v: F.floor(v * scale)).alias("vec"),
        )
        .withColumn("dims", F.size("vec"))
    )


class Segment:
    """Sorted lists of the components of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.real = self.vectors.astype(float)
        lists = np.argsort(self.vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.real, lists, 0)
        self.rank = np.empty(lists.shape, np.int32)  # place in the list, from the least value
        np.put_along_axis(self.rank, lists, np.arange(len(ids), dtype=np.int32)[:, None], 0)

    def scores(self, rows: np.ndarray | slice, queries: np.ndarray) -> np.ndarray:
        """Exact inner products; doubles are exact for integers while sums stay below 2^53."""
        vectors = self.vectors[rows]
        largest = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0))
        if largest * queries.shape[-1] < 2.0**53:
            return (self.real[rows] @ queries.T.astype(float)).astype(np.int64)
        return vectors @ queries.T

    def candidates(
        self, queries: np.ndarray, own_ids: np.ndarray, k: int, least: np.ndarray
    ) -> tuple[list[np.ndarray], np.ndarray]:
        """Per query the rows that may be among the k best, and the part of the lists read.

        ``least`` is a score that k others have already. All queries read their lists in the
        same steps, so what a step adds is a product of two matrices: ``seen`` holds the sums
        over the components read; unread ones count as the list's worst value or as the last
        value read. A query is done when few rows can still qualify, or when its lists are at
        their end; rows that qualify for no query any more are not looked at again.
        """
        n = len(self.ids)
        found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
        depths = np.ones(len(queries))
        todo, rows = np.arange(len(queries)), np.arange(n)
        bound, seen, read = least.copy(), np.zeros((len(queries), n)), 0
        for step in range(1, STEPS + 1):
            upto = -(-n * step // STEPS)
            falls, rises = np.maximum(queries[todo], 0), np.minimum(queries[todo], 0)
            real, rank = self.real[rows], self.rank[rows]
            top, bottom = rank >= n - upto, rank < upto
            seen += falls @ np.where(top & (rank < n - read), real, 0).T
            seen += rises @ np.where(bottom & (rank >= read), real, 0).T
            low = seen + falls @ np.where(top, 0, self.sorted[0]).T
            low += rises @ np.where(bottom, 0, self.sorted[-1]).T
            high = seen + falls @ np.where(top, 0, self.sorted[n - upto]).T
            high += rises @ np.where(bottom, 0, self.sorted[upto - 1]).T
            own = self.ids[None, rows] == own_ids[todo, None]
            low[own], high[own] = -np.inf, -np.inf
            if len(rows) >= k:
                kth = np.partition(low, len(rows) - k, axis=1)[:, len(rows) - k]
                bound[todo] = np.maximum(bound[todo], kth)
            slack = 1e-6 * (1 + np.abs(np.where(np.isfinite(bound[todo]), bound[todo], 0)))
            close = (high >= (bound[todo] - slack)[:, None]) & ~own
            done = (close.sum(1) <= 4 * k) | (upto == n)
            for at in np.flatnonzero(done):
                found[todo[at]], depths[todo[at]] = rows[close[at]], upto / n
            todo, read = todo[~done], upto
            if not len(todo):
                break
            left = close[~done].any(0)
            seen, rows = seen[~done][:, left], rows[left]
        return found, depths


def _search(queries: list[tuple[int, int, bytes]], k: int):
    """queries: (id, dims, components as int64)."""

    def run(batches: Batches) -> Batches:
        mine = defaultdict(list)
        for query_id, dims, packed in queries:
            mine[dims].append((query_id, np.frombuffer(packed, np.int64)))
        top: dict[int, set[tuple[int, int]]] = defaultdict(set)  # by place: (-score, id)

        def search(dims: int, ids: list, flat: list) -> None:
            segment = Segment(np.concatenate(ids), np.concatenate(flat).reshape(-1, dims))
            for begin in range(0, len(mine[dims]), QUERIES_AT_ONCE):
                part = mine[dims][begin : begin + QUERIES_AT_ONCE]
                own = np.array([query_id for query_id, _ in part])
                queries = np.array([query for _, query in part])
                known = [sorted(top[dims, begin + i]) for i in range(len(part))]
                least = np.array([-t[k - 1][0] if len(t) >= k else -np.inf for t in known])
                found, _ = segment.candidates(queries.astype(float), own, k, least)
                for i, rows in enumerate(found):
                    scores = segment.scores(rows, queries[i])
                    if len(rows) > k:  # ties with the k-th stay: ids decide
                        keep = scores >= np.partition(scores, -k)[-k]
                        rows, scores = rows[keep], scores[keep]
                    both = set(known[i]).union(zip((-scores).tolist(), segment.ids[rows].tolist()))
                    top[dims, begin + i] = set(sorted(both)[:k])

        held: dict[int, tuple[list, list, int]] = {}
        for batch in batches:
            sizes = batch.column("dims").to_numpy()
            ids = batch.column("vec_id").to_numpy()
            ends = batch.column("vec").offsets.to_numpy()
            values = batch.column("vec").values.to_numpy()
            for dims in np.unique(sizes).tolist():
                if dims not in mine:
                    continue
                rows = np.flatnonzero(sizes == dims)
                for begin in range(0, len(rows), SEGMENT):
                    part = rows[begin : begin + SEGMENT]
                    at = ends[part][:, None] + np.arange(dims)
                    a, b, n = held.get(dims, ([], [], 0))
                    a.append(ids[part])
                    b.append(values[at].ravel())
                    n += len(part)
                    held[dims] = (a, b, n)
                    if n >= SEGMENT:
                        search(dims, *held.pop(dims)[:2])
        for dims, (a, b, _) in held.items():
            search(dims, a, b)
        rows = [
            (mine[dims][place][0], vec_id, -score)
            for (dims, place), found in top.items()
            for score, vec_id in found
        ]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows)], ["query_id", "vec_id", "score"]
            )

    return run


def top_k(queries: DataFrame, vectors: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` for each of ``queries``.

    Both have vec_id, dims and vec as ``integers`` gives them.
    """
    spark = vectors.sparkSession
    asked = written(queries.select("vec_id", "dims", "vec").distinct(), "queries")
    size = asked.agg(F.coalesce(F.sum(F.col("dims") * 8 + 16), F.lit(0))).first()[0]
    passes = size // QUERY_BYTES + 1
    part = F.pmod(F.xxhash64("vec_id"), F.lit(passes))
    schema = "query_id long, vec_id long, score long"
    found = spark.createDataFrame([], schema)
    for number in range(passes):
        rows = asked.filter(part == number).collect()  # about QUERY_BYTES
        packed = [(r["vec_id"], r["dims"], np.array(r["vec"], np.int64).tobytes()) for r in rows]
        if packed:
            found = found.unionByName(map_batches(vectors, _search(packed, k), schema))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.distinct()
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
