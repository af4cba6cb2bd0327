"""Operator 10, language identification: multinomial naive Bayes over hashed character n-grams.

:func:`fit` counts the hashed n-grams of every labelled text on the executors and turns the summed counts into one
matrix of log probabilities (languages x buckets). :func:`predict` broadcasts that matrix (its size is languages x
2**bits x 4 bytes; :data:`MAX_LANGS` languages bound it) and scores all n-grams of each whole text in numpy.

Defined results: null text or text without a letter -> ``und`` with score 0; no learned language -> ``und``;
repeated rows are scored alike; a tie goes to the language that sorts first; rows with a null label or a null id teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm.textkit import chunks, read_table

BITS = 14
MAX_N = 3
MAX_LANGS = 500
UNKNOWN = "und"
#: Bytes of text whose n-grams a task holds at a time (or one text that is longer): each takes some hundred bytes beside it.
GRAM_BYTES = 1 << 19


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _grams(raw: np.ndarray, bounds: np.ndarray, bits: int, max_n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of the n-grams of each length; what is no letter counts as one blank, n-grams without letters are left out."""
    point_at = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    points = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(point_at[bounds]))
    letter = _letters()[points]
    keep = letter.copy()  # of a run of other characters only the first stays
    keep[1:] |= letter[:-1]
    keep[1:] |= row[1:] != row[:-1]
    code, row, letter = np.where(letter, points, 32)[keep].astype(np.uint64), row[keep], letter[keep]
    for n in range(1, max_n + 1):
        m = len(code) - n + 1
        if m <= 0:
            return
        value, some = np.full(m, n, np.uint64), np.zeros(m, bool)
        for j in range(n):
            value = value * np.uint64(0x100000001B3) + code[j : j + m]
            some |= letter[j : j + m]
        some &= row[:m] == row[n - 1 :]
        bucket = (value[some] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
        yield row[:m][some], bucket.astype(np.int64)


@dataclass(frozen=True)
class Model:
    langs: list[str]
    log_prob: np.ndarray  # buckets x languages, float32
    log_prior: np.ndarray
    bits: int
    max_n: int


def fit(docs: DataFrame, text: str = "text", label: str = "lang", bits: int = BITS, max_n: int = MAX_N, smoothing: float = 0.5) -> Model:
    """Learn from every row of ``docs`` with a label; the counts are summed by Spark, only the summed matrix is collected."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = batch.column(1).to_pylist()
            for low, high, raw, bounds in chunks(pc.utf8_lower(batch.column(0)), GRAM_BYTES):
                names = sorted(set(labels[low:high]))
                code = {x: i for i, x in enumerate(names)}
                of_row = np.array([code[x] for x in labels[low:high]])
                total = np.zeros(len(names) << bits, np.int64)
                for row, bucket in _grams(raw, bounds, bits, max_n):
                    total += np.bincount((of_row[row] << bits) + bucket, minlength=len(total))
                for i, x in enumerate(names):
                    if x not in sums:
                        sums[x] = np.zeros(1 << bits, np.int64)
                    sums[x] += total[i << bits : (i + 1) << bits]
        for x, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], ["lang", "bucket", "n"])

    taught = docs.select(F.col(text).alias("text"), F.col(label).alias("lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    priors = {r["lang"]: r["n"] for r in taught.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGS + 1).collect()}
    if len(priors) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages: the matrix to broadcast would have no bound")
    langs = sorted(priors)
    code = {x: i for i, x in enumerate(langs)}
    counts = np.zeros((1 << bits, max(1, len(langs))))
    for r in taught.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r["bucket"], code[r["lang"]]] = r["n"]
    counts += smoothing
    prior = np.log(np.array([priors[x] for x in langs], float) / max(1, sum(priors.values()))) if langs else np.zeros(1)
    return Model(langs, np.log(counts / counts.sum(axis=0)).astype(np.float32), prior, bits, max_n)


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all but none: every column) with ``lang_pred`` and ``score``, the posterior of the predicted language."""
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    shared = spark.sparkContext.broadcast(model)
    kept = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = pa.array([*m.langs, UNKNOWN], pa.string())
        for batch in batches:
            best, chance = np.full(batch.num_rows, len(m.langs)), np.zeros(batch.num_rows)
            for low, high, raw, bounds in chunks(pc.utf8_lower(batch.column(batch.num_columns - 1)), GRAM_BYTES) if m.langs else ():
                total, seen = np.tile(m.log_prior, (high - low, 1)), np.zeros(high - low, bool)
                for row, bucket in _grams(raw, bounds, m.bits, m.max_n):
                    if len(row):
                        heads = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                        total[row[heads]] += np.add.reduceat(m.log_prob[bucket], heads, axis=0, dtype=np.float64)
                        seen[row[heads]] = True
                total -= total.max(axis=1, keepdims=True)
                odds = np.exp(total)
                top = odds.argmax(axis=1)
                best[low:high] = np.where(seen, top, len(m.langs))
                chance[low:high] = np.where(seen, 1.0 / odds.sum(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], names.take(pa.array(best)), pa.array(chance)], [*batch.schema.names[:-1], "lang_pred", "score"])

    return kept.mapInArrow(score, f"{schema}{', ' if schema else ''}lang_pred string, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether the row is kept from learning: crc32 of the id as text, modulo 5, is 0 (null id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame) -> Model:
    """The model of the rows that are not held out."""
    return fit(docs.where(F.col("doc_id").isNotNull() & ~held_out()))


def q_op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return predict(docs.withColumn("held_out", held_out()), learn(docs), keep=["doc_id", "held_out"])
