"""Operator 9, exact top-k search by inner product: vector-approximation files.

1. :func:`quantise` turns components into integers and writes, beside the vectors, the cell of every component: its place among
   64 equal ranges between the smallest and largest value of its dimension, over all rows.
2. Queries are broadcast in blocks of a fixed size. A task goes through its rows and has, from the cells alone, an upper bound of the
   score of each query and row. Exact vectors are read only where the bound reaches the query's limit: the kth best exact score
   that the task has met, or at first the kth lower bound.
3. A task hands on its k best rows of each query, which are merged, and the block's result is written before the next block is asked.
   Before all rows, a block asks one row of :data:`FIRST`, picked by hash: their kth best is a limit that all tasks start with, so
   what tasks hand on grows with the queries, and not with the queries times the tasks.

No pairs are written but those a task hands on, so what is on disk at a time follows the input. Equal scores count as beaten by smaller ids.

Where the components are so large that a score can leave the whole numbers that doubles hold (2**53), bounds are widened by what
rounding can cost, and exact scores are Python integers, ordered by their bytes; else all is double and long arithmetic.

Defined results: rows whose vector is null or holds a null or a component that is not finite (before or after scaling), and rows
with a null id, take no part; a score beyond 64 bits is null, its rank is right; vectors of different lengths are not compared; a query sees every row but its own, so
repeated rows see each other; fewer than k candidates: all of them; ties go to the smaller id, then to the row met first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableferry.llm.textkit import discard, read_table, stored

CELLS = 64
QUERY_BLOCK = 4096
#: One row of so many gives the limits that all tasks start with.
FIRST = 8
#: Queries and rows whose bounds are held at once, components of the rows at once, and rows of all queries between two sortings of the best.
STEP = 256
ROWS = 2048
COMPONENTS = 1 << 20
PENDING = 1 << 18


def quantise(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 64) -> tuple[DataFrame, DataFrame]:
    """(rows: row, vec_id, dim, v, cells; edges: dim, at, lo, hi): scaled integers and the cell of each component."""
    x = F.col("x")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x")).where("vec_id IS NOT NULL AND x IS NOT NULL")
    rows = rows.where(F.forall(x, lambda c: F.coalesce((F.abs(c * scale) < float("inf")) & ~F.isnan(c), F.lit(False))))
    whole = F.transform("x", lambda c: _whole(c * scale))
    rows = stored(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.size("x").alias("dim"), whole.alias("v")), "vectors")
    edges = rows.select("dim", F.posexplode("v").alias("at", "c")).groupBy("dim", "at").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    listed = stored(edges.groupBy("dim").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "lo", "hi"))), lambda e: F.struct(e["lo"].alias("lo"), e["hi"].alias("hi"))).alias("edges")), "edges")
    # In halves, which a difference of doubles never leaves.
    place = lambda c, e: F.floor((c / 2 - e["lo"] / 2) / (e["hi"] / 2 - e["lo"] / 2 + 0.5) * CELLS)
    cell = F.zip_with("v", "edges", lambda c, e: F.greatest(F.lit(0), F.least(F.lit(CELLS - 1), place(c, e))).cast("tinyint"))
    cells = stored(rows.join(listed, "dim", "left").withColumn("cells", F.coalesce(cell, F.array().cast("array<tinyint>"))).drop("edges"), "cells")
    discard(rows)
    return cells, listed


def _whole(c: Column) -> Column:
    """The floor of a double as a double: one of 2**52 or more is whole."""
    return F.when(F.abs(c) < 2.0**52, F.floor(F.when(F.abs(c) < 2.0**52, c).otherwise(0.0)).cast("double")).otherwise(c)


def _peak(edges: np.ndarray) -> float:
    """The largest size that a score between vectors within these edges can have."""
    with np.errstate(over="ignore"):
        return float((np.abs(edges).max(axis=1, initial=0) ** 2).sum())


#: Whole numbers below are exact in doubles.
EXACT = 2.0**53


def _matrix(column: pa.Array, dim: int, kind: type) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), kind).reshape(len(column), dim)


#: Bytes of a score of doubles: products of two 1024-bit numbers, and the sums of any dimension.
SCORE_BYTES = 264
#: Added to a score, so that the order of its bytes is the order of the scores.
ZERO = 1 << (8 * SCORE_BYTES - 1)


def _whole_numbers(m: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in r] for r in m.tolist()], object).reshape(m.shape)


def _under(score: int) -> float:
    """A double that ``score`` reaches."""
    return float(np.nextafter(float(score), -np.inf)) if abs(score) < 1 << 1020 else (np.finfo(float).max if score > 0 else -np.inf)


class _Nearest:
    """The k best rows that a task has met for each query of one length, and the limits that other rows must reach.

    ``asked``: (row, dim, vector, limit) of each query, the limit (score, vec_id, row) or None. ``edges``: lo and hi of each dimension."""

    def __init__(self, asked: list, edges: np.ndarray, k: int) -> None:
        self.k, self.lo, self.hi = k, edges[:, 0], edges[:, 1]
        self.number = np.array([q[0] for q in asked], np.int64)
        self.vectors = np.array([q[2] for q in asked], np.float64).reshape(len(asked), len(edges))
        self.exact = _peak(edges) < EXACT  # scores are whole numbers of doubles
        with np.errstate(over="ignore", invalid="ignore"):
            peak = np.abs(self.vectors).sum(axis=1).max(initial=0) * max(1.0, np.abs(edges).max(initial=0))
            self.slack = None if self.exact else (np.abs(self.vectors) @ np.abs(edges).max(axis=1, initial=0)) * 2.0**-40
        self.kind = np.float32 if self.exact and peak < 1 << 24 else np.float64  # whole numbers are exact below
        self.sides = np.hstack([np.maximum(self.vectors, 0), np.minimum(self.vectors, 0)]).astype(self.kind)
        self.vectors = self.vectors.astype(self.kind) if self.exact else _whole_numbers(self.vectors)
        self.limit = np.full(len(asked), np.iinfo(np.int64).min if self.exact else -np.inf, np.int64 if self.exact else object)
        self.limit_id, self.limit_row, self.reach = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64), np.full(len(asked), -np.inf)
        given = [i for i, q in enumerate(asked) if q[3] is not None]
        self._limit(np.array(given, np.int64), *(np.array([asked[i][3][j] for i in given], t) for j, t in enumerate((self.limit.dtype, np.int64, np.int64))))
        self.met: list[tuple[np.ndarray, ...]] = []
        self.size, self.full = 0, PENDING

    def _limit(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        self.limit[query], self.limit_id[query], self.limit_row[query] = score, ids, row
        self.reach[query] = np.maximum(self.reach[query], score.astype(np.float64) if self.exact else np.array([_under(s) for s in score.tolist()], np.float64))

    def meet(self, row: np.ndarray, ids: np.ndarray, v: np.ndarray, cell: np.ndarray) -> None:
        step = max(1, min(ROWS, COMPONENTS // max(1, len(self.lo))))
        with np.errstate(over="ignore", invalid="ignore"):
            for at in range(0, len(row), step):
                self._meet(*(x[at : at + step] for x in (row, ids, v, cell)))

    def _edges(self, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The smallest and largest value that each component can have by its cell."""
        lo, hi, cell = self.lo, self.hi, cell.astype(np.float64)
        if self.exact:
            width = hi - lo + 1
            low, high = np.ceil(lo + cell * width / CELLS) - 1, np.ceil(lo + (cell + 1) * width / CELLS)  # the integers of a cell, and one more at each end
            return np.maximum(low, lo).astype(self.kind), np.minimum(high, hi).astype(self.kind)
        half, loss = hi / 2 - lo / 2 + 0.5, (np.abs(lo) + np.abs(hi)) * 2.0**-45 + 1
        low, high = (np.clip(2 * (lo / 2 + (cell + i) * half / CELLS) + side * loss, lo, hi) for i, side in ((0, -1), (1, 1)))
        return low, high

    def _bound(self, queries: np.ndarray | slice, sides: np.ndarray, way: int) -> np.ndarray:
        found = self.sides[queries] @ sides
        if self.slack is None:
            return found
        found += way * self.slack[queries, None]
        return np.where(np.isfinite(found), found, way * np.inf)

    def _meet(self, row: np.ndarray, ids: np.ndarray, v: np.ndarray, cell: np.ndarray) -> None:
        low, high = self._edges(cell)
        above, below, n = np.hstack([high, low]).T, np.hstack([low, high]).T, len(row)
        v = v.astype(self.kind) if self.exact else v
        for at in range(0, len(self.number), STEP):
            some = slice(at, at + STEP)
            free = at + np.flatnonzero(self.reach[some] == -np.inf)
            if len(free) and n >= self.k:
                least = self._bound(free, below, -1).astype(np.float64)
                least[self.number[free, None] == row[None, :]] = -np.inf
                self.reach[free] = np.partition(least, n - self.k, axis=1)[:, n - self.k]
            query, place = np.divmod(np.flatnonzero(self._bound(some, above, 1) >= self.reach[some, None].astype(self.kind)), n)  # faster than in two dimensions
            query += at
            other = self.number[query] != row[place]
            query, place = query[other], place[other]
            score = self._scores(some, query, place, v)
            limit, own_id, least_id = self.limit[query], ids[place], self.limit_id[query]
            before = (own_id < least_id) | ((own_id == least_id) & (row[place] <= self.limit_row[query]))
            good = (score > limit) | ((score == limit) & before)
            self.met.append((query[good], score[good], own_id[good], row[place[good]]))
            self.size += int(good.sum())
            if self.size > self.full:
                self._sort()

    def _scores(self, some: slice, query: np.ndarray, place: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The exact scores, int64 or Python's integers."""
        if self.exact and len(query) * 16 > len(v) * STEP:
            return (self.vectors[some] @ v.T)[query - some.start, place].astype(np.int64)
        out, run = np.empty(len(query), self.limit.dtype), max(1, COMPONENTS // 4 // max(1, v.shape[1]))
        for at in range(0, len(query), run):
            q, c = self.vectors[query[at : at + run]], v[place[at : at + run]]
            out[at : at + run] = np.einsum("ij,ij->i", q, c).astype(np.int64) if self.exact else (q * _whole_numbers(c)).sum(axis=1)
        return out

    def _sort(self) -> None:
        """Keep the k best of each query; the kth is the new limit."""
        query, score, ids, row = (np.concatenate(x) for x in zip(*self.met, strict=True))
        down = -score if self.exact else -np.unique(score, return_inverse=True)[1]
        order = np.lexsort((row, ids, down, query))
        rank = np.arange(len(order)) - np.searchsorted(query[order], query[order])
        last = order[rank == self.k - 1]
        self._limit(query[last], score[last], ids[last], row[last])
        order = order[rank < self.k]
        self.met = [(query[order], score[order], ids[order], row[order])]
        self.size, self.full = len(order), len(order) + PENDING

    def best(self) -> Iterator[tuple[np.ndarray, ...]]:
        """(query, score, vec_id, row) of the k best of each query, some at a time."""
        if self.met:
            self._sort()
            for at in range(0, self.size, 1 << 14):
                query, *found = (x[at : at + (1 << 14)] for x in self.met[0])
                yield self.number[query], *found


def _scan(cells: DataFrame, shared: Broadcast, k: int, wide: bool) -> DataFrame:
    """(query, vec_id, row, score, key: in the order of the scores): per query of ``shared`` and task the k best rows.

    ``shared``: the queries and the edges by dim. ``wide``: scores are Python's integers, the key is the score, moved above zero, in bytes
    from the highest, and a score that 64 bits do not hold is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, ranges = shared.value
        nearest: dict[int, _Nearest] = {}
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in nearest:
                    nearest[dim] = _Nearest([q for q in asked if q[1] == dim], ranges[dim] if dim else np.zeros((0, 2)), k)
                if not len(nearest[dim].number):
                    continue
                part = batch.filter(pa.array(dims == dim)) if (dims != dim).any() else batch
                nearest[dim].meet(part.column(0).to_numpy(), part.column(1).to_numpy(), _matrix(part.column(3), dim, np.float64), _matrix(part.column(4), dim, np.int8))
        for query, score, ids, row in (found for each in nearest.values() for found in each.best()):
            columns = [pa.array(query), pa.array(ids), pa.array(row)]
            if wide:
                scores = score.tolist()
                columns += [pa.array([s if -(1 << 63) <= s < 1 << 63 else None for s in scores], pa.int64()), pa.array([(s + ZERO).to_bytes(SCORE_BYTES, "big") for s in scores], pa.binary())]
            else:
                columns += [pa.array(score), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, ["query", "vec_id", "row", "score", "key"])

    return cells.select("row", "vec_id", "dim", "v", "cells").mapInArrow(run, f"query long, vec_id long, row long, score long, key {'binary' if wide else 'long'}")


def _ask(cells: DataFrame, asked: list, ranges: dict[int, np.ndarray], k: int, columns: list[str]) -> DataFrame:
    """The ``columns`` of the k best rows of each query, with their rank, stored."""
    shared = cells.sparkSession.sparkContext.broadcast((asked, ranges))
    best = Window.partitionBy("query").orderBy(F.desc("key"), "vec_id", "row")
    found = _scan(cells, shared, k, max((_peak(e) for e in ranges.values()), default=0.0) >= EXACT)
    try:
        return stored(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(*columns), "nearest")
    finally:
        shared.destroy()


def top_k(rows: DataFrame, edges: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(row of the query, vec_id, score, rank) for ``queries`` (rows of ``rows``), from 1 for the largest score."""
    spark = rows.sparkSession
    ranges = {r["dim"]: np.array([(e["lo"], e["hi"]) for e in r["edges"]], np.float64).reshape(-1, 2) for r in edges.collect()}
    placed = stored(queries.select("row", "dim", "v"), "queries")
    blocks = -(-placed.count() // QUERY_BLOCK)
    if not blocks:
        return spark.createDataFrame([], "query long, vec_id long, score long, rank int")
    first = stored(rows.where(F.pmod(F.xxhash64("row"), F.lit(FIRST)) == 0), "first")
    found = []
    for block in range(blocks):
        here = placed.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).collect()
        asked = [(r["row"], r["dim"], np.array(r["v"], np.float64), None) for r in here]
        tried = _ask(first, asked, ranges, k, ["query", "vec_id", "row", "key", "rank"])
        # The kth of some rows; fewer than k of them: no limit.
        kth = {r["query"]: (r["key"] if isinstance(r["key"], int) else int.from_bytes(r["key"], "big") - ZERO, r["vec_id"], r["row"]) for r in tried.where(F.col("rank") == k).collect()}
        discard(tried)
        found.append(_ask(rows, [(*q[:3], kth.get(q[0])) for q in asked], ranges, k, ["query", "vec_id", "score", "rank"]))
    discard(placed, first)
    return spark.read.schema(found[0].schema).parquet(*(t.stored_at for t in found))


def q_op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, edges = quantise(read_table(spark, sf_dir, "embeddings"))
    queries = rows.where("vec_id % 20 = 0")
    found = top_k(rows, edges, queries, 20)
    return found.join(queries.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id")), "query").select("query_id", "rank", "vec_id", "score")


OP9_SQL = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, q.r, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.r <> c.r WHERE q.vec_id % 20 = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM o WHERE rank <= 20
"""
