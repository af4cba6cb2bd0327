"""Operator 5, benchmark decontamination: a prefix-filtered set join of item windows and documents.

Every run of ``window`` consecutive words of an item (an item with fewer words, but not none: its whole sequence) is the
set of its word shingles. A document that holds a window holds all its shingles, so the rarest one is a sufficient
prefix:

1. :func:`item_windows` lists the distinct windows, :func:`shared_shingles` passes once over all texts and keeps, as runs
   of words, the surroundings of those shingles that a fixed-size bit filter of the benchmark lets through;
2. shingles are ordered by how often they stand in the documents, each window keeps its rarest; windows with a shingle
   that stands nowhere are dropped;
3. the kept prefix joins the document shingles; the offset in the window and the length bound where it can stand;
4. the words there are compared with the window's words, exactly.

Defined results: null or empty text has no words and no hits; repeated rows get a row each; equal item ids are one item;
a null item id counts as the id ``null``; an empty benchmark hits nothing; nulls and clashing names in other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm.textkit import ALNUM_WORD, LOWER, chunks, find_words, read_table, row_of, shingle_hashes, stored, word_hashes

WINDOW = 10
SHINGLE = 5
#: Bits of the filter that is broadcast, 1 MiB whatever the benchmark's size, and probes for each shingle.
FILTER_BITS = 23
PROBES = 3


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(item_id string, window, n_words, k, hashes): each window of each item, its words joined by a blank, its shingles' hashes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, raw, bounds in chunks(batch.column(1)):
                raw = LOWER[raw]
                starts, ends, first = find_words(raw, bounds, ALNUM_WORD)
                hashes, data, out = word_hashes(raw, starts, ends), raw.tobytes(), []
                for row in range(high - low):
                    a, b = int(first[row]), int(first[row + 1])
                    n = min(window, b - a)
                    k = min(shingle, n)
                    grams = shingle_hashes(hashes[a:b], k).view(np.int64) if n else ()
                    words = [data[s:e].decode() for s, e in zip(starts[a:b], ends[a:b], strict=True)]
                    for i in range(b - a - n + 1) if n else ():
                        out.append({"item_id": batch.column(0)[low + row].as_py(), "window": " ".join(words[i : i + n]), "n_words": n, "k": k, "hashes": grams[i : i + n - k + 1].tolist()})
                yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("item_id", pa.string()), ("window", pa.string()), ("n_words", pa.int32()), ("k", pa.int32()), ("hashes", pa.list_(pa.int64()))])
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item_id"), F.col(text).alias("text"))
    return named.mapInArrow(cut, "item_id string, window string, n_words int, k int, hashes array<long>")


def _probes(hashes: np.ndarray) -> Iterator[np.ndarray]:
    for i in range(PROBES):
        yield (hashes >> np.uint64(i * (64 - FILTER_BITS) // (PROBES - 1))) & np.uint64((1 << FILTER_BITS) - 1)


def _bit_filter(windows: DataFrame) -> np.ndarray:
    """The filter of all shingles of the windows; at most 2**FILTER_BITS slots come to the driver."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            found = np.unique(np.concatenate([*_probes(hashes), np.empty(0, np.uint64)]))
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32))], ["slot"])

    found = windows.select(F.explode("hashes")).mapInArrow(slots, "slot int").distinct().toPandas()["slot"].to_numpy(np.int64)
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[found] = True
    return np.packbits(bits, bitorder="little")


_RUN = pa.struct([("start", pa.int32()), ("words", pa.string()), ("hits", pa.list_(pa.struct([("at", pa.int32()), ("k", pa.int32()), ("hash", pa.int64())])))])


def shared_shingles(docs: DataFrame, windows: DataFrame, keep: list[Column], text: str = "text", window: int = WINDOW) -> DataFrame:
    """``keep``, n_words and runs: the words around each shingle that the benchmark may hold, overlapping surroundings joined."""
    spark = docs.sparkSession
    lengths = sorted(r[0] for r in windows.select("k").distinct().collect())
    shared = spark.sparkContext.broadcast(_bit_filter(windows) if lengths else None)
    base = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:-1])

    def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        at = np.arange(len(hashes))
        for probe in _probes(hashes):  # each probe looks only at what the one before let through
            slot = probe[at]
            at = at[(bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0]
        return at

    def runs(low: int, high: int, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list]:
        raw = LOWER[raw]
        starts, ends, first = find_words(raw, bounds, ALNUM_WORD)
        hashes, out = word_hashes(raw, starts, ends), [[] for _ in range(high - low)]
        row, hits = row_of(first), []
        for k in lengths:
            grams = shingle_hashes(hashes, k)
            at = passes(shared.value, grams)
            at = at[row[at] == row[at + k - 1]]
            hits.append(np.stack([at, np.full(len(at), k), grams[at].view(np.int64)]))
        found = np.concatenate(hits, axis=1) if hits else np.empty((3, 0), np.int64)
        found = found[:, np.argsort(found[0], kind="stable")]
        if found.shape[1]:
            at = found[0]
            left, right = np.maximum(at - window + 1, first[row[at]]), np.minimum(at + window, first[row[at] + 1])
            new = np.flatnonzero(np.r_[True, left[1:] > np.maximum.accumulate(right)[:-1]])
            data = raw.tobytes()
            for i, j in zip(new, np.r_[new[1:], len(at)], strict=True):
                a, b = int(left[i]), int(right[i:j].max())
                words = " ".join(data[s:e].decode() for s, e in zip(starts[a:b], ends[a:b], strict=True))
                out[row[at[i]]].append({"start": a - int(first[row[a]]), "words": words, "hits": [{"at": int(x) - a, "k": int(y), "hash": int(z)} for x, y, z in found[:, i:j].T]})
        return np.diff(first), out

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, found = np.zeros(batch.num_rows, np.int64), []
            for low, high, raw, bounds in chunks(batch.column(batch.num_columns - 1)):
                count[low:high], more = runs(low, high, raw, bounds)
                found += more
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(count), pa.array(found, pa.list_(_RUN))], [*batch.schema.names[:-1], "n_words", "runs"])

    return base.mapInArrow(look, f"{schema}, n_words long, runs array<struct<start: int, words: string, hits: array<struct<at: int, k: int, hash: long>>>>")


def find_windows(docs: DataFrame, items: DataFrame, keep: list[Column], text: str = "text", item_text: str = "text", item_id: str = "item_id", window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents: row, ``keep``, n_words; matches: row, start, n, window_id; members: window_id, item_id)."""
    listed = stored(item_windows(items, item_id, item_text, window, shingle), "windows")
    distinct = listed.groupBy("window").agg(F.first("n_words").alias("n"), F.first("k").alias("k"), F.first("hashes").alias("hashes"))
    distinct = stored(distinct.withColumn("window_id", F.monotonically_increasing_id()), "windows")
    members = listed.select("window", "item_id").distinct().join(distinct.select("window", "window_id"), "window").select("window_id", "item_id")
    rows = stored(shared_shingles(docs, distinct, keep, text, window).withColumn("row", F.monotonically_increasing_id()), "runs")
    run = rows.select("row", F.explode("runs").alias("run")).select("row", "run.start", F.split("run.words", " ").alias("words"), F.explode("run.hits").alias("hit"))
    counts = rows.select(F.explode("runs.hits").alias("hits")).select(F.explode("hits").alias("hit")).groupBy("hit.k", "hit.hash").agg(F.count("*").alias("rarity"))
    grams = distinct.select("window_id", "k", F.posexplode("hashes").alias("offset", "hash"))
    rarest = grams.join(counts, ["k", "hash"]).groupBy("window_id").agg(F.count("*").alias("found"), F.min(F.struct("rarity", "offset", "hash")).alias("least"))
    prefix = distinct.join(rarest, "window_id").where(F.col("found") == F.size("hashes")).select("window_id", "window", "n", "k", "least.offset", "least.hash")
    at = F.col("hit.at") - F.col("offset")
    placed = run.join(prefix, (F.col("hit.k") == prefix["k"]) & (F.col("hit.hash") == prefix["hash"])).where((at >= 0) & (at + F.col("n") <= F.size("words")))
    matches = placed.where(F.array_join(F.slice("words", at + 1, F.col("n")), " ") == F.col("window")).select("row", (F.col("start") + at).alias("start"), "n", "window_id")
    return rows.drop("runs"), stored(matches, "matches"), members


def contamination(docs: DataFrame, items: DataFrame, keep: list[Column], **options) -> DataFrame:
    """``keep``, n_words, n_hit (words inside any occurrence), n_items, items (sorted ids) of every document."""
    rows, matches, members = find_windows(docs, items, keep, **options)
    spans = matches.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("stop")))).alias("spans"))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("stop"), F.lit(0).cast("long").alias("n")),
        lambda acc, x: F.struct(F.greatest(acc["stop"], x["stop"]).alias("stop"), (acc["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(acc["stop"], x["start"]))).cast("long").alias("n")),
        lambda acc: acc["n"],
    )
    named = matches.select("row", "window_id").distinct().join(members, "window_id").groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    found = spans.select("row", covered.alias("n_hit")).join(named, "row")
    return rows.join(found, "row", "left").drop("row").withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")), "items": F.coalesce("items", F.array().cast("array<string>"))}).withColumn("n_items", F.size("items").cast("long"))


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents without any occurrence of an item window; every column as it was."""
    rows, matches, _ = find_windows(docs, items, [F.md5(F.col(text).cast("binary")).alias("digest")], text=text, **options)
    hit = stored(rows.join(matches.select("row").distinct(), "row", "left_semi").select("digest").distinct(), "hit")
    return docs.join(hit, F.md5(docs[text].cast("binary")) == hit["digest"], "left_anti")


def q_op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    found = contamination(docs, items, [F.col("doc_id")])
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


SQL_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL_WORDS = f"regexp_extract_all({SQL_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP5_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {SQL_WORDS} AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item_id, {SQL_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS g
  FROM i, LATERAL (SELECT unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s) WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)),
m AS (SELECT r, s, grams.n, item_id FROM grams JOIN win ON grams.n = win.n AND grams.g = win.g),
hit AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(s, s + n)) AS p FROM m) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""
