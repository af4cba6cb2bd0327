"""Operator 13, language-model scoring: an n-gram model as a weighted backoff automaton, walked once from left to right.

Model (orders 1 to ``orders``, each smoothed by the next lower one; sums to 1 over the known tokens and one unknown):
  P(w) = (c(w) + 1) / (N + V + 1),
  P(w | h) = (c(hw) + m P(w | h without its first word)) / (c(h) + m) where the training texts hold h, else P(w | h without its first word).
Each text begins after a start mark, which is only a history, and ends with one end token, which is scored.

1. :func:`blocks` turns texts into blocks of about :data:`BLOCK_BYTES`, or :data:`BLOCK_TOKENS` of a longer text (a block that goes on with
   a text carries its last tokens as history), with numbers for the block's words. The blocks are stored.
2. :func:`counts`: a block sorts its distinct n-grams' 64-bit keys, cuts them into ranges, and sends each range as one packed row of keys and
   training counts. The task of a range adds up what all blocks sent and answers each block with the totals, in the order of its keys.
   The number of ranges follows the number of tokens; an n-gram is at most one key for each block, so frequent words do not crowd a
   task. Nothing of the corpus is broadcast or collected but three totals.
3. A block's n-grams with their totals are its part of the automaton (:class:`Automaton`): histories are states; a known n-gram is an arc
   with its log-probability to the state of the longest known history, a state without the arc is left by its failure arc with
   its backoff weight. One traversal from left to right carries the state and adds up.

Words and n-grams are compared by 64-bit hashes: the odds that any two of 10^8 n-grams meet are about 3e-4.

Defined results: a null or empty text is one end token; rows with a null id are training texts unless the caller says otherwise; repeated
rows count and are scored one by one; with no training text N is 0 and every token has probability 1; an empty table gives no rows; columns
other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm.textkit import LOWER, SPACED_WORD, chunks, find_words, mix, read_table, stored, word_hashes

BLOCK_BYTES = 1 << 22
BLOCK_TOKENS = 1 << 20
#: Longest n-grams, and the weight m of the lower order (the best of 0.1, 0.3, 1, ... 100 on held-out texts of sf0.01).
ORDERS = 2
PRIOR = 100.0
#: Tokens for each range of keys.
RANGE_TOKENS = 1 << 20
_U = np.uint64
#: Stand-ins for the end of a text, a token, and for its start, a history only.
END, START = mix(np.array([1, 2], _U))
_FACTOR = _U(0x9E3779B97F4A7C15)


def _longer(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The key of each n-gram from the key of its history and the hash of its last word."""
    return mix(mix(history) * _FACTOR + word)


def _tokens(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the tokens with an end after every text, where each text starts)."""
    raw = LOWER[raw]
    starts, ends, first = find_words(raw, bounds, SPACED_WORD)
    return np.insert(word_hashes(raw, starts, ends), first[1:], END), first + np.arange(len(first))


def _packed(values: np.ndarray, width: int = 8) -> bytes:
    """Unsigned values byte by byte from the highest: those of sorted keys and of small numbers hardly differ and compress to little."""
    return np.ascontiguousarray(values.astype(f">u{width}").view(np.uint8).reshape(-1, width).T).tobytes()


def _unpacked(data: bytes, width: int = 8) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(f">u{width}").ravel().astype(f"u{width}")


def blocks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out: Column | None = None, orders: int = ORDERS) -> DataFrame:
    """One row for each block: its texts (row, id, held, size with histories, history tokens), token numbers and word hashes; stored."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for low, high, raw, bounds in chunks(batch.column(1), BLOCK_BYTES):
                tokens, first = _tokens(raw, bounds)
                for at in range(0, len(tokens), BLOCK_TOKENS):
                    to = min(at + BLOCK_TOKENS, len(tokens))
                    texts = np.arange(np.searchsorted(first, at, "right") - 1, np.searchsorted(first, to, "left"))
                    begin, end = np.maximum(first[texts], at), np.minimum(first[texts + 1], to)
                    back = np.minimum(begin - first[texts], orders)  # tokens before, of a text that began in an earlier block
                    lead = np.minimum(back + 1, max(orders - 1, 1))  # with the start mark, where it is near enough
                    size = end - begin + lead
                    place = np.cumsum(size) - size
                    hashes = np.empty(int(size.sum()), _U)
                    step = np.arange(len(hashes)) - np.repeat(place, size)
                    source = np.repeat(begin - lead, size) + step
                    hashes[:] = tokens[np.maximum(source, 0)]
                    hashes[place[back < lead]] = START
                    numbers, words = pd.factorize(hashes)
                    ids, held = batch.column(0).slice(low + int(texts[0]), len(texts)), batch.column(2).slice(low + int(texts[0]), len(texts))

                    def listed(values: pa.Array) -> pa.Array:
                        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block]), listed(pa.array(row + texts)), listed(ids), listed(held), listed(pa.array(size.astype(np.int32))), listed(pa.array(lead.astype(np.int32))),
                         pa.array([_packed(numbers, 4)]), pa.array([np.asarray(words, _U).tobytes()])],
                        ["block", "rows", "ids", "held", "sizes", "leads", "numbers", "words"],
                    )
                    block += 1
                row += high - low

    told = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.coalesce(F.lit(False) if held_out is None else held_out, F.lit(False)).alias("held"))
    schema = f"block long, rows array<long>, ids array<{kind}>, held array<boolean>, sizes array<int>, leads array<int>, numbers binary, words binary"
    return stored(told.mapInArrow(run, schema), "blocks")


class Grams:
    """The n-grams of one block. For each order: ``of``, the n-gram that ends at a token (-1: none), ``key``, and ``history`` (the
    (n-1)-gram before the last word), ``shorter`` (the n-gram without its first word) and ``word`` as places in those lists."""

    def __init__(self, numbers: np.ndarray, words: np.ndarray, place: np.ndarray, orders: int):
        k = len(words)
        self.of, self.key = [numbers], [mix(words)]
        self.word, self.history, self.shorter = [np.arange(k)], [np.zeros(k, np.int64)], [np.zeros(k, np.int64)]
        for order in range(1, orders):
            at = np.flatnonzero(place >= order)
            code, found = pd.factorize(self.of[-1][at - 1].astype(np.int64) * k + numbers[at])
            of = np.full(len(numbers), -1, np.int64)
            of[at] = code
            shorter = np.zeros(len(found), np.int64)
            shorter[code] = self.of[-1][at]
            self.history.append(found // k)
            self.word.append(found % k)
            self.shorter.append(shorter)
            self.key.append(_longer(self.key[-1][found // k], words[found % k]))
            self.of.append(of)


def _read(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token numbers, word hashes, place of each token in its piece, size and history of each piece) of a block."""
    size, lead = (np.array(batch.column(c)[row].as_py(), np.int64) for c in ("sizes", "leads"))
    numbers, words = _unpacked(batch.column("numbers")[row].as_buffer(), 4).astype(np.int64), np.frombuffer(batch.column("words")[row].as_buffer(), _U)
    return numbers, words, np.arange(len(numbers)) - np.repeat(np.cumsum(size) - size, size), size, lead


def counts(stored_blocks: DataFrame, orders: int = ORDERS) -> DataFrame:
    """(block, n, part, totals, known): for each block, order and range of keys the training counts of the block's n-grams in the order of
    their keys, packed; ``known``, in one row of a range, its n-grams that occur in training texts. Stored."""
    tokens = stored_blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda s, n: s + n))).first()[0] or 0
    bits = max(6, (tokens // RANGE_TOKENS).bit_length())

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                numbers, words, place, size, lead = _read(batch, row)
                grams = Grams(numbers, words, place, orders)
                train = ~np.repeat(np.array(batch.column("held")[row].as_py(), bool), size)
                learnt = train & (place >= np.repeat(lead, size))
                start = words[numbers] == START
                # A start mark counts once, where its text's first token is.
                learnt |= train & start & (place == 0) & np.append(~start[1:] & (place[1:] >= np.repeat(lead, size)[1:]), False)
                for order in range(orders):
                    of = grams.of[order][learnt & (grams.of[order] >= 0)]
                    keys, which = np.unique(grams.key[order], return_inverse=True)
                    c = np.bincount(which, np.bincount(of, minlength=len(which)), len(keys)).astype(np.uint32)
                    parts = (keys >> _U(64 - bits)).astype(np.int64)
                    edges = np.flatnonzero(np.diff(parts, prepend=-1, append=-1))
                    out = [(int(parts[a]), _packed(keys[a:b]), c[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                    if not out:  # no text has so many tokens
                        continue
                    part, blobs, ns = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(out), batch.column("block")[row].as_py())), pa.array(np.full(len(out), order + 1, np.int8)), pa.array(part, pa.int32()), pa.array(blobs, pa.binary()), pa.array(ns, pa.binary())], ["block", "n", "part", "keys", "c"])

    def answer(asked: pa.Table) -> pa.Table:
        keys = [_unpacked(k) for k in asked.column("keys").to_pylist()]
        found, which = np.unique(np.concatenate(keys), return_inverse=True)
        c = np.bincount(which, np.concatenate([np.frombuffer(x, np.uint32) for x in asked.column("c").to_pylist()]), len(found)).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])
        totals = [c[which[e - len(k) : e]].tobytes() for k, e in zip(keys, ends, strict=True)]
        known = np.zeros(len(keys), np.int64)
        known[0] = np.count_nonzero(c)
        return pa.Table.from_arrays([asked.column("block"), asked.column("n"), asked.column("part"), pa.array(totals, pa.binary()), pa.array(known)], ["block", "n", "part", "totals", "known"])

    asked = stored_blocks.select("block", "held", "sizes", "leads", "numbers", "words").mapInArrow(ask, "block long, n tinyint, part int, keys binary, c binary")
    return stored(asked.groupBy("n", "part").applyInArrow(answer, "block long, n tinyint, part int, totals binary, known long"), "totals")


class Automaton:
    """The part of the model that a block needs. State 0 is the empty history, the others are known histories, shorter ones first."""

    def __init__(self, grams: Grams, c: list[np.ndarray], total: int, vocabulary: int, prior: float):
        self.width, orders = len(c[0]), len(c)
        known = [n > 0 for n in c[: orders - 1]]
        offset = np.cumsum([1, *(k.sum() for k in known)])
        state = [np.where(k, np.cumsum(k) - 1 + o, 0) for k, o in zip(known, offset, strict=False)]
        for order in range(1, orders - 1):  # an unknown history is left for the one without its first word
            state[order] = np.where(known[order], state[order], state[order - 1][grams.shorter[order]])
        probability = (c[0] + 1) / (total + vocabulary + 1)
        self.root_weight = np.log10(probability)
        self.root_next = state[0] if state else np.zeros(self.width, np.int64)
        keys, weights, nexts, fails, fail_weights = [np.empty(0, np.int64)], [np.empty(0)], [np.empty(0, np.int64)], [np.zeros(1, np.int64)], [np.zeros(1)]
        for order in range(1, orders):
            h, lower = grams.history[order], probability[grams.shorter[order]]
            probability = np.where(known[order - 1][h], (c[order] + prior * lower) / (c[order - 1][h] + prior), lower)
            arcs = np.flatnonzero(c[order] > 0)
            keys.append(state[order - 1][h[arcs]] * self.width + grams.word[order][arcs])
            weights.append(np.log10(probability[arcs]))
            nexts.append(state[min(order, orders - 2)][arcs if order < orders - 1 else grams.shorter[order][arcs]])
            fails.append((state[order - 2][grams.shorter[order - 1]] if order > 1 else np.zeros(len(known[0]), np.int64))[known[order - 1]])
            fail_weights.append(np.log10(prior / (c[order - 1][known[order - 1]] + prior)))
        self.arcs = dict(zip(np.concatenate(keys).tolist(), range(sum(map(len, keys))), strict=True))
        self.weight, self.next = np.concatenate(weights).tolist(), np.concatenate(nexts).tolist()
        self.fail, self.fail_weight = np.concatenate(fails).tolist(), np.concatenate(fail_weights).tolist()

    def walk(self, tokens: list[int], lead: int) -> float:
        """The log10 probability of the tokens after the first ``lead``, which only set the state."""
        arcs, weight, onward, fail, fail_weight = self.arcs, self.weight, self.next, self.fail, self.fail_weight
        root_weight, root_next, width = self.root_weight, self.root_next, self.width
        state, score, before = 0, 0.0, 0.0
        for at, token in enumerate(tokens):
            if at == lead:
                before = score
            while state:
                arc = arcs.get(state * width + token)
                if arc is not None:
                    score += weight[arc]
                    state = onward[arc]
                    break
                score += fail_weight[state]
                state = fail[state]
            else:
                score += root_weight[token]
                state = root_next[token]
        return score - before


def score(stored_blocks: DataFrame, totals: DataFrame, orders: int = ORDERS, prior: float = PRIOR) -> DataFrame:
    """(row, doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each text of the blocks."""
    stored_blocks.sparkSession.sparkContext._jvm.System.gc()  # the files of the counts' shuffle are not needed any more
    learnt = F.aggregate(F.arrays_zip("sizes", "leads", "held"), F.lit(0).cast("long"), lambda s, p: s + F.when(p["held"], 0).otherwise(p["sizes"] - p["leads"]))
    total = stored_blocks.agg(F.sum(learnt)).first()[0] or 0
    # Known tokens; the start mark, known once there is a training text, is none.
    vocabulary = max(0, (totals.where("n = 1").agg(F.sum("known")).first()[0] or 0) - 1)
    kind = stored_blocks.schema["ids"].dataType.elementType.simpleString()

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        batch = block.combine_chunks().to_batches()[0]
        numbers, words, place, size, lead = _read(batch, 0)
        grams = Grams(numbers, words, place, orders)
        found, c = found.sort_by([("n", "ascending"), ("part", "ascending")]), []
        order_of, blobs = found.column("n").to_numpy(), found.column("totals").to_pylist()
        for order in range(orders):
            mine = np.concatenate([np.frombuffer(blobs[i], np.int64) for i in np.flatnonzero(order_of == order + 1)] or [np.empty(0, np.int64)])
            c.append(mine[np.unique(grams.key[order], return_inverse=True)[1]])
        automaton = Automaton(grams, c, total, vocabulary, prior)
        base, known = automaton.root_weight, c[0] > 0
        automaton.root_weight, automaton.root_next = automaton.root_weight.tolist(), automaton.root_next.tolist()
        out: list[tuple[int, int, float, float]] = []
        for end, n, skip in zip(np.cumsum(size).tolist(), size.tolist(), lead.tolist(), strict=True):
            mine = numbers[end - n : end]
            out.append((n - skip, int(known[mine[skip:]].sum()), float(base[mine[skip:]].sum()), automaton.walk(mine.tolist(), skip)))
        tokens, n_known, plain, scores = zip(*out, strict=True)
        lists = [batch.column(x)[0].values for x in ("rows", "ids", "held")]
        columns = [pa.array(np.full(len(out), batch.column("block")[0].as_py())), *lists, pa.array(tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(plain, pa.float64()), pa.array(scores, pa.float64())]
        return pa.Table.from_arrays(columns, ["block", "row", "id", "held", "n_tokens", "n_known", "base_score", "score"])

    pieces = stored_blocks.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(run, f"block long, row long, id {kind}, held boolean, n_tokens long, n_known long, base_score double, score double")
    # A text that fills several blocks has a piece in each; sums go by the order of the blocks.
    whole = pieces.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("block", "id", "held", "n_tokens", "n_known", "base_score", "score"))).alias("p"))

    def added(name: str, zero: Column) -> Column:
        return F.aggregate("p", zero, lambda s, p: s + p[name]).alias(name)

    count, real = F.lit(0).cast("long"), F.lit(0.0)
    return whole.select("row", F.col("p")[0]["id"].alias("doc_id"), F.col("p")[0]["held"].alias("held_out"), added("n_tokens", count), added("n_known", count), F.lit(total).cast("long").alias("train_tokens"), added("base_score", real), added("score", real))


def q_op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    stored_blocks = blocks(read_table(spark, sf_dir, "documents"), held_out=held)
    return score(stored_blocks, counts(stored_blocks)).drop("row")
