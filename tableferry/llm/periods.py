"""Operator 12, periodic run detection: descending-LCP Kruskal over the words of each text.

A run is a stretch of words with smallest period q (words q apart are equal) that no neighbouring word extends, of
``min_length`` words and ``min_repeats`` periods at least. For the texts of a chunk:

1. A run of period q has common prefixes of ``least = min_length - min_length // min_repeats`` words or more between places q apart, so
   a text without two equal stretches of that many words has no run and is left as it is (found by sorting hashes of the stretches).
2. The suffixes of the other texts are sorted by doubling ranks; neighbours' common prefixes come from the same ranks. Ranks hold the
   number of the text, so nothing matches across texts.
3. :func:`seeds` unites neighbours by falling common prefix, with a sorted list of places for each class, small ones into
   large ones. Two places of a class that become neighbours, at distance q and with common prefix l >= q, are a stretch of period q
   that ends where the words differ. A place between them with the same prefix would give a smaller period, so q is the smallest.
4. Seeds whose word before also repeats are not the start of their run; the others that are long enough are the runs.

No shuffle: a text is the largest unit of work; a task holds a chunk of about 2 MB or one longer text with the ranks of the repeating ones
(4 bytes a word and doubling). Words are compared by 64-bit hashes of their bytes.

Defined results: a null or empty text, or one of white space only, has no runs and an empty collapsed text; equal rows give equal results;
a text of one repeated word is one run of period 1; runs may overlap, a word goes if any run holds it after its first period; a null id is
kept as it is; an empty table gives no rows; columns other than those named are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm.textkit import SPACED_WORD, chunks, find_words, mix, read_table, row_of, shingle_hashes, word_hashes

MIN_LENGTH = 24
MIN_REPEATS = 3
#: Words that are copied to the collapsed texts at once.
BLOCK = 1 << 16


def repeating(words: np.ndarray, rows: np.ndarray, least: int) -> np.ndarray:
    """The rows with two equal stretches of ``least`` words."""
    if len(words) < least:
        return np.empty(0, np.int64)
    grams, inside = shingle_hashes(words, least), rows[: len(rows) - least + 1] == rows[least - 1 :]
    keys = np.flatnonzero(inside)
    marked = mix(grams[keys] ^ mix(rows[keys].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(marked)
    return np.unique(rows[keys[order[1:][marked[order[1:]] == marked[order[:-1]]]]])


def ranks(words: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """For 1, 2, 4, ... words: the rank of the stretch from each place (shorter at the end of its row) until all ranks differ."""
    n = len(words)
    _, codes = np.unique(words, return_inverse=True)
    _, rank = np.unique(rows * (codes.max() + 1) + codes, return_inverse=True)
    levels, width = [rank.astype(np.int32)], 1
    while rank.max() < n - 1:
        after = np.zeros(n, np.int64)
        if width < n:
            same = rows[:-width] == rows[width:]
            after[:-width][same] = rank[width:][same] + 1
        _, rank = np.unique(rank.astype(np.int64) * (n + 1) + after, return_inverse=True)
        levels.append(rank.astype(np.int32))
        width *= 2
    return levels


def common_prefixes(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, next place, common prefix) of neighbours in the order of the suffixes."""
    order = np.argsort(levels[-1])
    a, b = order[:-1], order[1:]
    length = np.zeros(len(a), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        known = np.append(levels[level], -1)  # a place behind the last word
        length[known[a + length] == known[b + length]] += 1 << level
    return a, b, length


def seeds(a: np.ndarray, b: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """Rows (place, distance, prefix): neighbours in a class at the moment the class forms, no farther apart than their prefix."""
    order = np.argsort(-prefix, kind="stable")
    home: dict[int, list[int]] = {}
    found: list[tuple[int, int, int]] = []
    for x, y, length in zip(a[order].tolist(), b[order].tolist(), prefix[order].tolist(), strict=True):
        large, small = home.setdefault(x, [x]), home.setdefault(y, [y])
        if len(small) > len(large):
            large, small = small, large
        for place in small:
            insort(large, place)
        for place in small:
            at = bisect_left(large, place)
            if at and home[large[at - 1]] is not small and place - large[at - 1] <= length:
                found.append((large[at - 1], place - large[at - 1], length))
            if at + 1 < len(large) and home[large[at + 1]] is not small and large[at + 1] - place <= length:
                found.append((place, large[at + 1] - place, length))
        for place in small:
            home[place] = large
    return np.array(found, np.int64).reshape(-1, 3)


def find_runs(words: np.ndarray, rows: np.ndarray, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> np.ndarray:
    """(place of the first word, length, period) of all runs, by place and period; ``rows`` is the text of each word."""
    least = max(1, min_length - min_length // min_repeats)
    few = repeating(words, rows, least)
    at = np.flatnonzero(np.isin(rows, few))
    if not len(at):
        return np.empty((0, 3), np.int64)
    mine, own = words[at], rows[at]
    a, b, prefix = common_prefixes(ranks(mine, own))
    near = prefix >= least
    place, period, length = seeds(a[near], b[near], prefix[near]).T
    length = length + period
    before = np.maximum(place - 1, 0)
    first = (place == 0) | (own[before] != own[place]) | (mine[before] != mine[before + period])
    good = first & (length >= np.maximum(min_length, min_repeats * period))
    place, length, period = place[good], length[good], period[good]
    order = np.lexsort((period, place))
    return np.stack([at[place], length, period], axis=1)[order]


def made_periodic(counts: np.ndarray, first: np.ndarray, checksums: list[int | None]) -> np.ndarray:
    """The word that stands at each place once texts whose checksum h ends in 0 repeat: with g = h // 10, a = g % n and
    p = 1 + (n - a) // (3 + g % 8), word i >= a is word a + (i - a) % p."""
    order = np.arange(first[-1])
    for row, h in enumerate(checksums):
        n = int(counts[row])
        if h is None or h % 10 or not n:
            continue
        g = h // 10
        a = g % n
        period = 1 + (n - a) // (3 + g % 8)
        order[first[row] + a : first[row] + n] = first[row] + a + np.arange(n - a) % period
    return order


def _texts(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, chosen: np.ndarray, rows: np.ndarray, count: int) -> pa.Array:
    """The words ``chosen`` (of ``rows``, in order), joined by one space, as a text for each of ``count`` rows."""
    widths = ends[chosen] - starts[chosen]
    last = np.ones(len(chosen), bool)
    last[:-1] = rows[1:] != rows[:-1]
    room = widths + ~last
    to = np.cumsum(room) - room
    out = np.full(int(room.sum()), 0x20, np.uint8)
    for low in range(0, len(chosen), BLOCK):
        width = widths[low : low + BLOCK]
        step = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        out[np.repeat(to[low : low + BLOCK], width) + step] = raw[np.repeat(starts[chosen[low : low + BLOCK]], width) + step]
    sizes = np.bincount(rows, weights=room, minlength=count).astype(np.int64)
    return pa.LargeStringArray.from_buffers(count, pa.py_buffer(np.r_[0, np.cumsum(sizes)].astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", checksum: Column | None = None, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """(doc_id, runs: array of start, length, period by start and period; collapsed: the text without the repeats of its runs).

    ``checksum`` plants runs first (:func:`made_periodic`); without it texts are taken as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, raw, bounds in chunks(batch.column(1)):
                starts, ends, first = find_words(raw, bounds, SPACED_WORD)
                rows, count = row_of(first), high - low
                order = made_periodic(np.diff(first), first, batch.column(2).slice(low, count).to_pylist())
                runs = find_runs(word_hashes(raw, starts, ends)[order], rows, min_length, min_repeats)
                edges = np.zeros(len(order) + 1, np.int64)
                np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
                np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
                kept = np.cumsum(edges[:-1]) == 0
                place = rows[runs[:, 0]]
                entries = pa.StructArray.from_arrays([pa.array(runs[:, 0] - first[place]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], ["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(place, minlength=count))].astype(np.int32)), entries)
                collapsed = _texts(raw, starts, ends, order[kept], rows[kept], count)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, count), lists, collapsed], ["doc_id", "runs", "collapsed"])

    kind = docs.schema[doc_id].dataType.simpleString()
    told = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), (F.lit(None) if checksum is None else checksum).cast("long").alias("checksum"))
    return told.mapInArrow(run, f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period; ties: smallest start, then period."""
    more = F.aggregate(runs, F.try_element_at(runs, F.lit(1)), lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))
    return more


def q_op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = periodic_runs(docs, checksum=F.crc32(F.col("doc_id").cast("string").cast("binary")))
    best, lines = F.col("best"), F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    return found.withColumn("best", strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
