"""Vector search over components of every size, against Python's integers."""

import random

import numpy as np
import pytest

from tableferry.llm import vectors


def brute(rows, k, scale):
    from math import floor

    whole = [(i, [floor(scale * c) for c in x]) for i, x in rows]
    out = []
    for q, (qi, qv) in enumerate(whole):
        if qi % 5:
            continue
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for r, (i, v) in enumerate(whole) if r != q and len(v) == len(qv))
        out += [(qi, rank, i, -s if -(1 << 63) <= -s < 1 << 63 else None) for rank, (s, i) in enumerate(scored[:k], start=1)]
    return sorted(out)


@pytest.mark.parametrize("bits", [3, 13, 16, 19, 22, 25, 40, 100])
def test_any_size(spark, bits):
    rng = random.Random(bits)
    rows = [(i, [rng.uniform(-1, 1) * 2.0**bits if rng.random() < 0.7 else rng.uniform(-1, 1) for _ in range(4)]) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(0, 20, 5)] + [(200, [0.0] * 4), (205, [1.0, 2.0]), (206, [3.0, 2.0])]
    df = spark.createDataFrame([*rows, (300, None), (305, [float("nan"), 1.0, 1.0, 1.0]), (310, [float("inf"), 0.0, 0.0, 0.0])], "vec_id long, embedding array<double>").repartition(3)
    found, edges = vectors.quantise(df)
    queries = found.where("vec_id % 5 = 0")
    got = vectors.top_k(found, edges, queries, 7).join(queries.selectExpr("row AS query", "vec_id AS qid"), "query")
    assert sorted((r.qid, r.rank, r.vec_id, r.score) for r in got.collect()) == brute(rows, 7, 64)


def test_one_large_row_is_kept(spark):
    rows = [(0, [5e6, 1.0]), (5, [1.0, 1.0]), (6, [2.0, -1.0])]
    found, edges = vectors.quantise(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = vectors.top_k(found, edges, found.where("vec_id = 5"), 2)
    assert sorted((r.rank, r.vec_id, r.score) for r in got.collect()) == [(1, 0, 64 * 64 * 5_000_001), (2, 6, 64 * 64)]


@pytest.mark.parametrize("bits", [0, 40])
def test_what_is_written_follows_rows_and_queries(spark, monkeypatch, bits):
    """No table holds the pairs of queries and rows that bounds leave; in several blocks, with equal vectors, as by brute force."""
    rng = random.Random(bits)
    rows = [(i, [rng.gauss(0, 1) * 2.0**bits for _ in range(4)]) for i in range(800)]
    rows += [(800 + i, rows[7][1]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found, edges = vectors.quantise(df)
    queries = found.where("vec_id % 5 = 0")
    written = []
    keep = vectors.stored

    def counted(table, label):
        out = keep(table, label)
        written.append(out.count() + sum(out.selectExpr(f"sum(size({name})) AS n").first()["n"] or 0 for name in ("top", "found") if name in out.columns))
        return out

    monkeypatch.setattr(vectors, "stored", counted)
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 90)
    got = vectors.top_k(found, edges, queries, 3).join(queries.selectExpr("row AS query", "vec_id AS qid"), "query")
    assert sorted((r.qid, r.rank, r.vec_id, r.score) for r in got.collect()) == brute(rows, 3, 64)
    # A block has about 67 queries, whose pairs with all rows are 67,000.
    assert max(written) <= 600


def test_a_task_keeps_the_best_of_each_query(monkeypatch):
    """However many rows tie or come unsorted, k are kept, and the limit falls to no row that a tie beats."""
    monkeypatch.setattr(vectors, "PENDING", 40)
    monkeypatch.setattr(vectors, "ROWS", 16)
    rng = np.random.default_rng(3)
    v = rng.integers(-2, 3, (300, 3)).astype(float)
    row, ids = np.arange(300), rng.integers(0, 150, 300)
    edges = np.stack([v.min(axis=0), v.max(axis=0)], axis=1)
    cell = np.floor((v - edges[:, 0]) / (edges[:, 1] - edges[:, 0] + 1) * vectors.CELLS).astype(np.int8)
    want = {q: sorted((-int(v[q] @ v[r]), int(ids[r]), r) for r in range(300) if r != q)[:5] for q in range(20)}
    for start in (None, 4):
        near = vectors._Nearest([(q, 3, v[q], None if start is None else (-want[q][start][0], *want[q][start][1:])) for q in range(20)], edges, 5)
        near.meet(row, ids, v, cell)
        assert near.size <= 20 * 5 + 40 + 16 * 20
        got = [x for part in near.best() for x in zip(*(c.tolist() for c in part), strict=True)]
        assert sorted(got) == sorted((q, -s, i, r) for q in want for s, i, r in want[q])
