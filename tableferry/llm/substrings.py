"""Operator 3, exact substring deduplication: column-wise construction of a multi-document BWT and its common prefixes.

Which bytes are covered by a string of ``length`` bytes that also starts elsewhere is decided on collections that are small
enough for a task:

1. Equal texts become one document with its number of copies.
2. Every window of ``length`` bytes is assigned to its anchor, the leftmost of its ``ANCHOR``-byte grams with the smallest
   hash. Equal windows have equal anchors at the same offset, so windows with different anchors need not be compared and
   an anchor that occurs once can be dropped. Neighbouring windows with one anchor are one string of the collection; equal
   strings (128 bits of hash, of the anchor and of the string) are one string with a count. Where an anchor has a single
   string, the count tells; no two of its own windows are equal, since the anchor stands elsewhere in each.
3. The other strings of some anchors form a collection (:func:`repeated_columns`). Aligned at their anchors they are inserted one
   symbol for each string and round, from the last column to the first: the order of all suffixes is updated by a stable
   sort of the column in the order of the round before (the step of the BWT), the common prefixes of neighbours by range
   minima over the prefixes before, all in sequential passes over arrays of one entry for each string. Neighbours with
   ``length`` common symbols start with the same window.
4. The windows found go back to every occurrence of the string and are merged for each document.

An anchor with more than ``CROWD`` different strings, whose collection would outgrow a task, is cut into single windows that are
counted by Spark. The arrays of a round stand in the task's memory, which the collection's size bounds, and not in files: local
folders of executors are not to be used, and shared ones have no use for data of one task.

Defined results: null is the empty text; a text shorter than ``length`` keeps all; repeated rows are copies of each other and
lose everything if long enough; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm.textkit import BYTE_CODE, chunks, mix, powers, read_table, stored, text_bytes

LENGTH = 200
ANCHOR = 40
#: Different strings of one anchor in one collection, and bytes of a collection.
CROWD = 20_000
COLLECTION_BYTES = 16 << 20


def _anchors(raw: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, start, n, offset of the anchor, hash of the anchor, hash of the string): the runs of windows with one anchor."""
    none = tuple(np.empty(0, np.int64) for _ in range(6))
    if len(raw) < length:
        return none
    power, inverse = powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_CODE[raw] * power[: len(raw)], out=total[1:])
    value = mix((total[ANCHOR:] - total[:-ANCHOR]) * inverse[: len(raw) - ANCHOR + 1])
    at, span, reach = np.arange(len(value), dtype=np.int32), length - ANCHOR + 1, 1

    def least(value: np.ndarray, at: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
        """The smaller of each entry and the one ``shift`` later, the earlier of equals."""
        right = value[shift:] < value[: len(value) - shift]
        return np.where(right, value[shift:], value[: len(value) - shift]), np.where(right, at[shift:], at[: len(at) - shift])

    while 2 * reach <= span:
        value, at = least(value, at, reach)
        reach *= 2
    value, at = least(value, at, span - reach) if span > reach else (value, at)
    count = np.maximum(np.diff(bounds) - length + 1, 0)
    row = np.repeat(np.arange(len(count)), count)
    window = np.arange(count.sum()) + np.repeat(bounds[:-1] - np.r_[0, np.cumsum(count)[:-1]], count)
    if not len(window):
        return none
    value, at = value[window], at[window].astype(np.int64)
    head = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (row[1:] != row[:-1])])
    low, n = window[head], np.diff(np.r_[head, len(window)])
    whole = mix((total[low + n + length - 1] - total[low]) * inverse[low] + n.astype(np.uint64))
    return row[head], low - bounds[row[head]], n, at[head] - low, value[head].view(np.int64), whole.view(np.int64)


def anchored(texts: DataFrame, length: int) -> DataFrame:
    """(id, copies, start, n, offset, key, digest) of every run of windows with one anchor in ``texts`` (id, copies, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, copies = (batch.column(i).to_numpy() for i in (0, 1))
            for low, _, raw, bounds in chunks(batch.column(2)):
                row, start, n, offset, key, digest = _anchors(raw, bounds, length)
                columns = ids[low + row], copies[low + row], start.astype(np.int32), n.astype(np.int16), offset.astype(np.int16), key, digest
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["id", "copies", "start", "n", "offset", "key", "digest"])

    return texts.select("id", F.least("copies", F.lit(2)).cast("short").alias("copies"), "text").mapInArrow(run, "id long, copies short, start int, n short, offset short, key long, digest long")


def repeated_columns(raw: np.ndarray, bounds: np.ndarray, anchor: np.ndarray, copies: np.ndarray, length: int) -> np.ndarray:
    """strings x (length - ANCHOR + 1): whether the window that starts at each offset of each string also starts elsewhere."""
    before, n = length - ANCHOR, len(anchor)
    width, size = before + length, np.diff(bounds)
    low = before - anchor  # all anchors stand in column ``before``
    row = np.repeat(np.arange(n), size)
    table = np.full((width, n), 256, np.uint16)  # 256: the string has no symbol here
    table[np.arange(len(raw)) - np.repeat(bounds[:-1], size) + low[row], row] = raw
    order, common = np.arange(n), np.zeros(n + 1, np.int16)
    found = np.zeros((before + 1, n), bool)
    for column in range(width - 1, -1, -1):
        symbol = table[column][order]
        step = np.argsort(symbol, kind="stable")
        symbol = symbol[step]
        last, here = step[:-1], step[1:]
        prefix = np.zeros(n + 1, np.int16)
        same = np.flatnonzero((symbol[1:] == symbol[:-1]) & (symbol[1:] < 256))
        if len(same):
            pairs = np.stack([last[same] + 1, here[same] + 1], axis=1).ravel()
            prefix[same + 1] = np.minimum(np.minimum.reduceat(common, pairs)[::2] + 1, length)
        order, common = order[step], prefix
        if column <= before:
            equal = np.flatnonzero(common[:n] >= length)
            found[column, order[equal]] = found[column, order[equal - 1]] = True
    column = np.arange(before + 1)[:, None]
    many = (copies > 1) & (column >= low) & (column + length <= low + size)
    shifted = (found | many).T
    out = np.zeros_like(shifted)
    for offset in np.unique(low):  # back to offsets in the string
        at = low == offset
        out[at, : before + 1 - offset] = shifted[at, offset:]
    return out


def _collections(strings: DataFrame, length: int) -> DataFrame:
    """(key, digest, low, high): the byte spans of each string covered by windows that are repeated; a collection is one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [x for x in batches if x.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts).combine_chunks()
        column = table.column("bytes").combine_chunks()
        raw, bounds = text_bytes(column.chunk(0) if isinstance(column, pa.ChunkedArray) else column)
        found = repeated_columns(raw, bounds, table.column("offset").to_numpy().astype(np.int64), table.column("copies").to_numpy(), length)
        edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, start = np.nonzero(edge == 1)
        _, stop = np.nonzero(edge == -1)
        named = [table.column(x).take(pa.array(row)) for x in ("key", "digest")]
        yield from pa.table([*named, pa.array(start.astype(np.int32)), pa.array((stop - 1 + length).astype(np.int32))], ["key", "digest", "low", "high"]).to_batches()

    return strings.select("key", "digest", "offset", "copies", "bytes").mapInArrow(run, "key long, digest long, low int, high int")


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(texts: id, digest, copies, text of each distinct text; spans: id, low, high, the bytes to remove, as found: they may overlap)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(whole.alias("text")).groupBy(F.md5(F.col("text").cast("binary")).alias("digest")).agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    texts = stored(texts.withColumn("id", F.monotonically_increasing_id()), "texts")
    runs = stored(anchored(texts, length), "anchors")
    twice = stored(runs.groupBy("key").agg(F.sum("copies").alias("c")).where("c > 1").select("key"), "twice")
    places = stored(runs.join(twice, "key"), "places")
    strings = places.groupBy("key", "digest").agg(F.sum("copies").alias("copies"), F.min(F.struct("id", "start", "n", "offset")).alias("x")).select("key", "digest", "copies", "x.*")
    strings = stored(strings, "strings")
    kinds = stored(strings.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1"), "kinds")
    mixed = stored(strings.join(kinds, "key"), "mixed")
    total = mixed.agg(F.sum(F.col("n") + length - 1)).first()[0] or 0
    wanted = mixed.groupBy("id").agg(F.collect_list(F.struct("start", "n", "offset", "copies", "key", "digest", "kinds")).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = text_bytes(batch.column(0))
            listed, data = batch.column(1), raw.tobytes()
            ends, values = listed.offsets.to_numpy(), listed.values
            start, n, *rest = (values.field(i).to_numpy()[ends[0] : ends[-1]] for i in range(7))
            at = np.repeat(bounds[:-1], np.diff(ends)) + start
            for low in range(0, len(at), 20_000):
                part = slice(low, low + 20_000)
                strings = [data[a : a + m] for a, m in zip(at[part].tolist(), (n[part].astype(int) + length - 1).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(pa.array(x[part]) for x in rest), pa.array(strings, pa.binary())], ["offset", "copies", "key", "digest", "kinds", "bytes"])

    joined = texts.join(wanted, "id").select(F.col("text").cast("binary").alias("text"), "runs")
    cut_out = joined.mapInArrow(cut, "offset short, copies long, key long, digest long, kinds long, bytes binary")
    spans = _collections(cut_out.where(F.col("kinds") <= CROWD).repartition(max(1, -(-total // COLLECTION_BYTES)), "key"), length)
    if not kinds.where(F.col("kinds") > CROWD).isEmpty():
        single = cut_out.where(F.col("kinds") > CROWD).select("key", "digest", "copies", "bytes", F.explode(F.sequence(F.lit(0), F.length("bytes") - length)).alias("low"))
        single = stored(single.select("key", "digest", "copies", "low", F.unhex(F.sha2(F.substring("bytes", F.col("low") + 1, F.lit(length)), 256)).alias("window")), "windows")
        again = single.groupBy("window").agg(F.sum("copies").alias("c")).where("c > 1").select("window")
        spans = spans.unionByName(single.join(again, "window").select("key", "digest", "low", (F.col("low") + length).alias("high")))
    spans = stored(spans, "repeated")
    found = places.join(spans, ["key", "digest"]).select("id", (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high"))
    alone = places.join(kinds, "key", "left_anti").select("id", F.col("start").alias("low"), (F.col("start") + F.col("n") + (length - 1)).alias("high"))
    return texts, stored(found.unionByName(alone), "spans")


def removed(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """(digest of the text, text, n_bytes, spans: array of [low, high), kept: the bytes that remain) of each distinct text."""
    texts, spans = repeated_spans(docs, text, length)
    of_text = spans.groupBy("id").agg(F.collect_list(F.struct("low", "high")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = text_bytes(batch.column(1))
            data, merged, kept = raw.tobytes(), [], []
            for row, spans in enumerate(batch.column(2).to_pylist()):
                whole, out, left, at = data[bounds[row] : bounds[row + 1]], [], [], 0
                for low, high in sorted((x["low"], x["high"]) for x in spans or ()):
                    if out and low <= out[-1]["high"]:
                        out[-1]["high"] = max(out[-1]["high"], high)
                    else:
                        out.append({"low": low, "high": high})
                for x in out:
                    left.append(whole[at : x["low"]])
                    at = x["high"]
                merged.append(out)
                kept.append(b"".join([*left, whole[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(bounds)), pa.array(merged, pa.list_(span)), pa.array(kept, pa.binary())], ["digest", "n_bytes", "spans", "kept"])

    span = pa.struct([("low", pa.int32()), ("high", pa.int32())])
    joined = texts.join(of_text, "id", "left").select("digest", F.col("text").cast("binary").alias("text"), "spans")
    return joined.mapInArrow(run, "digest string, n_bytes long, spans array<struct<low: int, high: int>>, kept binary")


def q_op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = removed(docs)
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["high"] - x["low"])
    told = found.select("digest", "n_bytes", size.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    rows = docs.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"))
    return rows.join(told, "digest").drop("digest")
