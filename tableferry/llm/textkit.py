"""Arrow/numpy helpers shared by the operators: whole texts as bytes, words and word hashes.

Everything works on a run of rows at a time ("chunk"): the texts of the run stand one after the other in one byte
array, ``bounds`` holds where each starts. A chunk holds about :data:`CHUNK_BYTES`, or one text that is longer, so
a task's memory follows the longest text and not the partition.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.session import new_run_dir

CHUNK_BYTES = 1 << 21
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

# A-Z to a-z; every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Words of letters, digits and non-ASCII characters, once A-Z is lower-cased.
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[0x30:0x3A] = ALNUM_WORD[0x61:0x7B] = ALNUM_WORD[0x80:] = True
# Words between white space.
SPACED_WORD = np.ones(256, bool)
SPACED_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet below the shared folder and read back: cuts the lineage, survives lost executors.

    A collection of the driver's garbage follows, so that Spark's cleaner drops the shuffle files that the write leaves behind."""
    path = f"{new_run_dir(df.sparkSession, label)}/{uuid.uuid4().hex[:8]}"
    df.write.option("compression", "zstd").parquet(path)
    df.sparkSession.sparkContext._jvm.System.gc()
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    for scope in getattr(_open, "scopes", []):
        scope.append(table)
    return table


def totals(df: DataFrame, *columns: Column) -> list[float]:
    """The sums of columns without nulls, long (exact, also beyond 64 bits) or double; 0 where there are no rows.

    Each task gives one row of sums, which are added here: one job without a shuffle, of which less stays in the driver than of an aggregate."""
    n = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: list[float] = [0] * n
        for batch in batches:
            for i, value in enumerate(c.to_numpy() for c in batch.columns):
                whole = value.dtype == np.int64
                sums[i] += ((value >> 32).sum().item() << 32) + (value & 0xFFFFFFFF).sum().item() if whole else value.sum().item()
        yield pa.RecordBatch.from_pydict({"sums": [[str(x) for x in sums]]})

    named = df.select(*(c.alias(f"c{i}") for i, c in enumerate(columns)))
    parts = named.mapInArrow(run, "sums array<string>").collect()  # a row for each task
    kinds = [float if kind == "double" else int for _, kind in named.dtypes]
    return [sum((kind(r["sums"][i]) for r in parts), kind(0)) for i, kind in enumerate(kinds)]


_open = threading.local()


def discard(*tables: DataFrame) -> None:
    """Remove tables of :func:`stored` that no plan reads any more; any other DataFrame is left alone."""
    for table in tables:
        if getattr(table, "stored_at", None):
            at = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(table.stored_at)
            at.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
            table.stored_at = None


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """Tables that this thread stores inside are removed at the end, but for those appended to the list that is given."""
    made: list[DataFrame] = []
    keep: list[DataFrame] = []
    _open.scopes = [*getattr(_open, "scopes", []), made]
    try:
        yield keep
    finally:
        _open.scopes = _open.scopes[:-1]
        discard(*(t for t in made if not any(t is k for k in keep)))


def with_rows(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a number for each row that every reading gives again: the place of its file and its place in the file, so that a
    narrow result can be joined to it later. What is not read from Parquet files is stored first."""
    file, at = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    try:
        found = docs.select("*", file.alias("__file"), at.alias("__at"))
    except AnalysisException:
        return stored(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")
    files = sorted(r[0] for r in found.select("__file").distinct().collect())  # a row for each file
    numbers = docs.sparkSession.createDataFrame([(f, i << 40) for i, f in enumerate(files)], "__file string, __first long")
    return found.join(numbers, "__file").withColumn(name, F.col("__first") + F.col("__at")).drop("__file", "__first", "__at")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's texts (null: empty) as one byte array, and the bounds of the rows in it."""
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    blank = b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else ""
    column = column.fill_null(blank) if column.null_count else column
    _, offsets, data = column.buffers()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, bounds) of runs of rows of about ``size`` bytes."""
    raw, bounds = text_bytes(column)
    low, rows = 0, len(bounds) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + size, "right")) - 1)
        yield low, high, raw[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]
        low = high


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    def series(base: int) -> np.ndarray:
        out = np.full(1 << bits, base, _U)
        out[0] = 1
        return np.cumprod(out, dtype=_U)

    return series(_BASE), series(_BASE_INVERSE)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below ``n`` at least."""
    return _powers(max(21, int(n).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finalizer)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


BYTE_CODE = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))


def find_words(raw: np.ndarray, bounds: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of all words in order, and per row the number of words before it."""
    inside = is_word[raw]
    before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    heads = bounds[:-1][bounds[:-1] < len(raw)]
    before[heads] = False
    after[heads[heads > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; equal bytes give equal hashes in every chunk and process."""
    power, inverse = powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, _U)
    np.cumsum(BYTE_CODE[raw] * power[: len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(_U))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of ``k`` words that start at each word but the last ``k - 1``."""
    n = max(0, len(words) - k + 1)
    out = np.zeros(n, _U)
    for j in range(k):
        out = out * _U(_BASE) + words[j : j + n]
    return mix(out + _U(k))


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of each word, from ``first`` of :func:`find_words`."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
