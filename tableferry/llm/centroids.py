"""Operator 11, centroid clustering (Lloyd's rounds on integer vectors) with PCA-rotated filtering.

1. The usable vectors are stored once. Their mean and scatter matrix, sums over all rows, give a rotation (the principal axes).
2. :func:`rotated` stores beside each vector its ``lead`` leading rotated coordinates and the norm of the rest. For a centroid
   turned the same way, |head - head'|^2 + (rest - rest')^2 never exceeds the squared distance.
3. Each round starts every vector at the centroid of the smallest bound, takes that distance in integers, and verifies, in integers
   too, each centroid whose bound (less a margin for rounding) reaches the best so far. Tasks send one row of sums for each
   cluster, split into 32-bit limbs, so that Spark's sums are exact; the driver sees as many rows as there are clusters.

The rotation only saves work: every distance that decides is an integer one, so rounding can't change a result.

Defined results: vectors that are null, of another length, or with a null or non-finite component take no part; a repeated row is a
vector of its own; a null id hashes last and is kept; vectors of one id that compete for a first centroid go by their components;
equal distances go to the smaller cluster number, so equal first centroids leave the later one empty, and an empty one stays where
it is; fewer vectors than clusters give fewer clusters; an empty table gives no rows; a distance or a sum beyond 64 bits is null
(the assignment is right all the same); other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm.textkit import read_table, stored

#: Components up to this size go through 64-bit arithmetic (64 squares of differences stay below 2**63), larger ones through Python's integers.
PLAIN = 1 << 26
#: Rounding of the bounds, as a part of the squared lengths; the arithmetic itself loses less than 1e-12.
MARGIN = 1e-9
_LONG = 1 << 63


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", dim: int = 64) -> DataFrame:
    """(vec_id, x: array<double>) of the vectors with ``dim`` components, all finite; stored."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return stored(rows.where(F.col("x").isNotNull() & (F.size("x") == dim) & finite), "usable")


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of a matrix of doubles: int64 where all fit :data:`PLAIN`, else Python's integers."""
    with np.errstate(over="ignore"):
        v = np.floor(x * scale)
    if not len(v) or np.abs(v).max() <= PLAIN:
        return v.astype(np.int64)
    whole = [int(a) if np.isfinite(a) else int(b) * scale for a, b in zip(v.ravel(), x.ravel(), strict=True)]
    out = np.empty(len(whole), object)
    out[:] = whole
    return out.reshape(v.shape)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def rotation(rows: DataFrame, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, axes by falling variance) of the scaled vectors, from sums over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + dim + dim * dim)
        for batch in batches:
            with np.errstate(over="ignore", invalid="ignore"):
                v = np.floor(_matrix(batch.column(0), dim) * scale)
                total += np.r_[len(v), v.sum(axis=0), (v.T @ v).ravel()]
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["s"])

    sums = rows.select("x").mapInArrow(run, "s array<double>").select(F.posexplode("s").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s"))
    total = np.zeros(1 + dim + dim * dim)
    for r in sums.collect():  # 1 + dim + dim * dim rows
        total[r["i"]] = r["s"]
    if not total[0] or not np.isfinite(total).all():  # too large for squares: the axes as they are
        return np.zeros(dim), np.eye(dim)
    mean = total[1 : 1 + dim] / total[0]
    spread = total[1 + dim :].reshape(dim, dim) / total[0] - np.outer(mean, mean)
    return mean, np.linalg.eigh(spread)[1][:, ::-1]


def turned(v: np.ndarray, mean: np.ndarray, axes: np.ndarray, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """(leading rotated coordinates, norm of the others) of scaled vectors."""
    with np.errstate(over="ignore", invalid="ignore"):
        turned_v = (v.astype(np.float64) - mean) @ axes
        return turned_v[:, :lead], np.sqrt((turned_v[:, lead:] ** 2).sum(axis=1))


def rotated(rows: DataFrame, mean: np.ndarray, axes: np.ndarray, lead: int, scale: int) -> DataFrame:
    """``rows`` with head (the leading rotated coordinates) and rest (the norm of the others); stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            head, rest = turned(scaled(_matrix(batch.column(1), len(mean)), scale), mean, axes, lead)
            heads = pa.ListArray.from_arrays(pa.array(np.arange(len(head) + 1, dtype=np.int32) * lead), pa.array(head.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), heads, pa.array(rest)], ["vec_id", "x", "head", "rest"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return stored(rows.select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, x array<double>, head array<double>, rest double"), "rotated")


def nearest(v: np.ndarray, head: np.ndarray, rest: np.ndarray, centroids: np.ndarray, heads: np.ndarray, rests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each vector: bounds first, then integers for the centroids that the bounds leave."""
    with np.errstate(over="ignore", invalid="ignore"):
        bound = ((head[:, None, :] - heads[None, :, :]) ** 2).sum(axis=2) + (rest[:, None] - rests[None, :]) ** 2
        length = ((head**2).sum(axis=1) + rest**2)[:, None] + ((heads**2).sum(axis=1) + rests**2)[None, :]
        bound = bound - MARGIN * length
    bound[~np.isfinite(bound)] = -np.inf

    def exact(which: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        return ((v[which] - centroids[cluster]) ** 2).sum(axis=1)

    cluster = bound.argmin(axis=1)
    best = exact(np.arange(len(v)), cluster)
    first = cluster.copy()
    for c in range(len(centroids)):
        which = np.flatnonzero((first != c) & (bound[:, c] <= best.astype(np.float64) * (1 + 1e-15)))
        if not len(which):
            continue
        found = exact(which, np.full(len(which), c))
        better = (found < best[which]) | ((found == best[which]) & (c < cluster[which]))
        best[which[better]], cluster[which[better]] = found[better], c
    return cluster, best


def _limbs(number: int) -> list[int]:
    out = []
    while not -(1 << 31) <= number < 1 << 31:
        out.append(number & 0xFFFFFFFF)
        number >>= 32
    return [*out, number]


def _as_centroids(rows: list[list[int]]) -> np.ndarray:
    plain = all(abs(c) <= PLAIN for row in rows for c in row)
    return np.array(rows, np.int64 if plain else object).reshape(len(rows), -1)


Assign = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _assigner(centroids: np.ndarray, mean: np.ndarray, axes: np.ndarray, lead: int, scale: int) -> Assign:
    """A function from a batch (vec_id, x, head, rest) to (scaled vectors, cluster, squared distance)."""
    heads, rests = turned(centroids, mean, axes, lead)

    def run(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        v = scaled(_matrix(batch.column(1), len(mean)), scale)
        wide = v.dtype == object or centroids.dtype == object
        head, rest = _matrix(batch.column(2), lead), batch.column(3).to_numpy()
        cluster, distance = nearest(v.astype(object) if wide else v, head, rest, centroids.astype(object) if wide else centroids, heads, rests)
        return v, cluster, distance

    return run


def _moved(rows: DataFrame, centroids: np.ndarray, assign: Assign) -> np.ndarray:
    """The centroids after one round: the floor of the mean of each one's vectors; without vectors, as it was."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dim), object), np.zeros(k, np.int64)
        for batch in batches:
            v, cluster, _ = assign(batch)
            for c in np.unique(cluster):
                counts[c] += int((cluster == c).sum())
                sums[c] += v[cluster == c].sum(axis=0).astype(object)
        out: list[tuple[int, int, int, list[int]]] = []
        for c in np.flatnonzero(counts):
            parts = [_limbs(int(s)) for s in sums[c]]
            for limb in range(max(len(p) for p in parts)):
                out.append((int(c), limb, int(counts[c]) if limb == 0 else 0, [p[limb] if limb < len(p) else 0 for p in parts]))
        columns = list(zip(*out, strict=True)) if out else [(), (), (), ()]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(columns, kinds, strict=True)], ["cluster", "limb", "n", "s"])

    parts = rows.mapInArrow(run, "cluster int, limb int, n long, s array<long>")
    total = parts.select("cluster", "limb", "n", F.posexplode("s").alias("i", "s")).groupBy("cluster", "limb", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    counts, sums = [0] * k, [[0] * dim for _ in range(k)]
    for r in total.collect():  # a row for each cluster, limb and component
        counts[r["cluster"]] += r["n"] if r["i"] == 0 else 0
        sums[r["cluster"]][r["i"]] += r["s"] << (32 * r["limb"])
    old = centroids.tolist()
    return _as_centroids([[s // counts[c] for s in sums[c]] if counts[c] else old[c] for c in range(k)])


def cluster(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", dim: int = 64, clusters: int = 8, rounds: int = 10, scale: int = 1024, seed: int = 3, lead: int = 16) -> tuple[DataFrame, list[list[int]]]:
    """((vec_id, cluster, distance), centroids) after ``rounds`` rounds and a last assignment."""
    rows = usable(vectors, vec_id, vector, dim)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    start = rows.orderBy(key.asc_nulls_last(), "x").limit(clusters).collect()
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"
    if not start:
        return rows.sparkSession.createDataFrame([], schema), []
    centroids = _as_centroids([[int(c) for c in scaled(np.array([r["x"]], np.float64), scale)[0]] for r in start])
    lead = min(lead, dim)
    mean, axes = rotation(rows, dim, scale)
    rows = rotated(rows, mean, axes, lead, scale)
    for _ in range(rounds):
        centroids = _moved(rows, centroids, _assigner(centroids, mean, axes, lead, scale))
    assign = _assigner(centroids, mean, axes, lead, scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, found, distance = assign(batch)
            if distance.dtype == object:
                distance = [int(d) if d < _LONG else None for d in distance]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.astype(np.int32)), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    return stored(rows.mapInArrow(run, schema), "clusters"), [[int(c) for c in row] for row in centroids.tolist()]


def _long(total: Column, complete: Column) -> Column:
    return F.when(complete, total.try_cast("long"))


def q_op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster(read_table(spark, sf_dir, "embeddings"))
    whole = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = found.groupBy("cluster").agg(whole.alias("s"), (F.count("distance") == F.count("*")).alias("ok"))
    sums = {r["cluster"]: (int(r["s"]) if r["ok"] else None) for r in sums.collect()}  # a row for each cluster
    inertia = None if None in sums.values() else sum(sums.values())
    known = [(c, s if s is not None and s < _LONG else None, inertia if inertia is not None and inertia < _LONG else None, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, s in sums.items()]
    told = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _op11_sql(rounds: int = 10) -> str:
    def assign(c: str) -> str:
        return f"""(SELECT vec_id, arg_min(k, (d, k)) AS k, min(d) AS d FROM (
  SELECT v.vec_id, c.k, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS d FROM v JOIN {c} c USING (i) GROUP BY v.vec_id, c.k) GROUP BY vec_id)"""

    parts = [
        """kept AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        "v AS MATERIALIZED (SELECT vec_id, unnest(range(64)) AS i, unnest(x) AS x FROM kept)",
        "s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k FROM kept QUALIFY k < 8)",
        "c0 AS MATERIALIZED (SELECT s.k, v.i, v.x FROM s JOIN v USING (vec_id))",
    ]
    for r in range(rounds):
        parts.append(f"a{r} AS MATERIALIZED {assign(f'c{r}')}")
        parts.append(
            f"""c{r + 1} AS MATERIALIZED (SELECT c.k, c.i, CASE WHEN m.n IS NULL THEN c.x ELSE CAST((m.s - ((m.s % m.n) + m.n) % m.n) // m.n AS BIGINT) END AS x FROM c{r} c
  LEFT JOIN (SELECT a.k, v.i, sum(v.x) AS s, count(*) AS n FROM a{r} a JOIN v USING (vec_id) GROUP BY a.k, v.i) m USING (k, i))"""
        )
    parts.append(f"a AS MATERIALIZED {assign(f'c{rounds}')}")
    parts.append(f"h AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY k)")
    return (
        "WITH " + ",\n".join(parts) + "\nSELECT a.vec_id, CAST(a.k AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,"
        " CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.h AS centroid_sha256 FROM a JOIN h USING (k)"
    )


OP11_SQL = _op11_sql()
