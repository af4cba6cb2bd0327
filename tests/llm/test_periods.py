"""Periodic runs against a brute-force search over all periods."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tableferry.llm import periods
from tests.conftest import SF_SMALL


def brute_runs(words, min_length=24, min_repeats=3):
    """Stretches of every period from small to large; one whose smallest period is smaller is left out."""
    n, out = len(words), []
    for q in range(1, n // min_repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(min_length, min_repeats * q) and not any(all(words[x] == words[x + p] for x in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def split(text):
    return "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ")


def brute(doc_id, text):
    words = [w for w in split(text) if w]
    h, n = (zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    told = (None,) * 4 if best is None else (best[0], best[1], best[2], 1000 * best[1] // best[2])
    return (
        doc_id, len(runs), *told, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=6), st.integers(1, 12)), max_size=6), min_size=1, max_size=4), st.sampled_from([(24, 3), (6, 2), (5, 3)]))
def test_runs_of_random_words(texts, rule):
    texts = [[w for piece, times in t for w in piece * times] for t in texts]
    rows = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    words = np.array([w for t in texts for w in t], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    found, first = periods.find_runs(words, rows, *rule), np.searchsorted(rows, np.arange(len(texts)))
    got = [[(int(p - first[r]), int(n), int(q)) for p, n, q in found if rows[p] == r] for r in range(len(texts))]
    assert got == [brute_runs(t, *rule) for t in texts]


def odd_documents():
    lines = ["a " * 100, "x y z " * 30 + "x y", "a b " * 20 + "c " + "a b " * 20, "äß 漢 " * 15, "one\ttwo\x0bthree\x0cfour\r\n" * 10, "w v " * 30]
    texts = [None, "", " \n ", "word", *lines, " ".join(f"w{i % 1000}" for i in range(5000)), " ".join(f"u{i}" for i in range(30_000)), "A a " * 30]
    rows = [(i, t) for i, t in enumerate(texts)] + [(4, "a " * 100), (None, "b c " * 20)]
    rows += [(1000 + i, " ".join(f"w{j % 7}v{j * i % 11}" for j in range(i))) for i in range(80)]
    return pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"), "text": [r[1] for r in rows], "runs": 1, "collapsed": "x", "checksum": 0})


def test_query_on_odd_texts(spark, tmp_path):
    frame = odd_documents()
    frame.to_parquet(tmp_path / "documents.parquet")
    got = sorted((tuple(r) for r in periods.q_op12(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((brute(None if pd.isna(d) else int(d), t) for d, t in zip(frame.doc_id, frame.text)), key=str)
    assert sum(r[1] > 0 for r in got) > 10


def test_query_on_given_texts(spark):
    import duckdb

    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet' WHERE strlen(text) < 4000").fetchall()
    got = {r[0]: tuple(r) for r in periods.q_op12(spark, SF_SMALL).collect()}
    assert len(got) == 200 and all(got[d] == brute(d, t) for d, t in rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert periods.q_op12(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("n", [20_000, 80_000])
def test_long_periodic_text(n):
    words = np.tile(np.arange(1, n // 8 + 1, dtype=np.uint64), 8)
    assert periods.find_runs(words, np.zeros(len(words), np.int64)).tolist() == [[0, len(words), n // 8]]
