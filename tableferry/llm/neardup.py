"""Operator 7, near-duplicate detection: HyperMinHash registers, banding, corrected estimate, exact verification.

1. :func:`sketch` hashes each text's distinct word shingles and keeps, for each of 256 buckets, the smallest hash as its
   number of leading zeros and ten mantissa bits, packed into two bytes; an order-free digest names the whole set.
2. Equal sets collapse to one node, so exact copies of any number cost one node and one link each.
3. A band is six neighbouring registers (empty ones borrow from others); nodes that share a band are candidates. At the threshold of
   0.85 a pair misses all 42 bands with a probability below 3e-9, at 0.8 below 3e-6. That holds where a band's other pairs are few
   (step 5). A pair of different families whose bands are all crowded needs up to three shared bands: it is missed with a
   probability of up to 7.9e-7 at 0.85 and 3.6e-4 at 0.8 (two: 6.1e-8 and 4.5e-5). Each node meets the smallest node
   of each of its bands; pairs that pass a size bound and the collision-corrected estimate (six standard deviations to
   spare) make families.
4. Inside a family all members are compared in full with one member, then with the hub, the member nearest to what most hold.
   With D(x) the shingles in which x and the hub differ, two members differ by |D(x)| + |D(y)| - 2 |D(x) & D(y)|: a link
   that does not run through the hub needs a known overlap of D(x) and D(y), so a prefix of each, its rarest
   shingles in the family, must meet. Only those pairs are compared, by their D; no family is ever paired with itself.
5. A node in one band with members of another family becomes a guest of the largest family there and is compared by its
   hub too. Other pairs of different families in one band: all of them where they are few for the band's size, else the
   band is divided by a second (third) shared band, and at the last level all of them whatever their number. What passes
   the estimate is compared on the full sets.

Defined results: null text and text without words form an empty set, linked with nothing; fewer words than a shingle:
the whole sequence is one shingle; repeated rows are linked (equal sets); a null id never becomes a component's id while
another id is there; other columns and their nulls play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm.components import components
from tableferry.llm.textkit import LOWER, SPACED_WORD, chunks, find_words, mix, read_table, row_of, scratch, shingle_hashes, stored, word_hashes

BUCKET_BITS = 8
MANTISSA = 10
REGISTERS = 1 << BUCKET_BITS
ROWS = 6
BANDS = REGISTERS // ROWS
#: Pairs that a band may list directly, for each of its nodes.
PER_NODE = 16
LEVELS = 3
#: Two hashes that differ fall into one register value with a probability of about this (leading zeros and mantissa equal).
COLLISION = 0.17 / (1 << MANTISSA)


def shingle_sets(raw: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, ordered by both."""
    raw = LOWER[raw]
    starts, ends, first = find_words(raw, bounds, SPACED_WORD)
    words, row, count = word_hashes(raw, starts, ends), row_of(first), np.diff(first)
    grams = shingle_hashes(words, k)
    whole = row[: len(grams)] == row[k - 1 :] if len(grams) else np.empty(0, bool)
    rows, hashes = [row[: len(grams)][whole]], [grams[whole]]
    for n in range(1, k):  # texts with fewer words
        at = np.flatnonzero(count == n)
        short = shingle_hashes(words, n) if len(at) else words
        rows.append(at)
        hashes.append(short[first[:-1][at]])
    row, value = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (value[1:] != value[:-1])] if len(row) else np.empty(0, bool)
    return row[new], value[new]


def _registers(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """rows x 256 registers: 0 where the bucket is empty, else leading zeros (from 1) and mantissa of its smallest hash."""
    out = np.zeros(rows * REGISTERS, np.uint16)
    slot = row * REGISTERS + (value >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    head = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]) if len(slot) else np.empty(0, int)
    rest = (value[head] & np.uint64((1 << (64 - BUCKET_BITS)) - 1)) | np.uint64(1)
    fraction, exponent = np.frexp(rest.astype(np.float64))
    zeros = np.clip(64 - BUCKET_BITS - exponent, 0, 61)
    out[slot[head]] = ((zeros + 1) << MANTISSA) + ((fraction * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    return out.reshape(rows, REGISTERS)


def _binary(matrix: np.ndarray) -> pa.Array:
    """Each row's bytes as one binary value."""
    return pa.array([x.tobytes() for x in np.ascontiguousarray(matrix)], pa.binary())


def sketch(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(id, digest of the text, n distinct shingles, digest of the set, registers) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, sets, registers = [np.empty(0, np.int64)], [], []
            for low, high, raw, bounds in chunks(batch.column(2)):
                row, value = shingle_sets(raw, bounds, shingle)
                n = np.bincount(row, minlength=high - low)
                total, ends = np.zeros((len(value) + 1, 2), np.uint64), np.cumsum(n)
                np.cumsum(np.stack([mix(value), mix(value ^ np.uint64(0xA5A5A5A5A5A5A5A5))], axis=1), axis=0, out=total[1:])
                count.append(n)
                sets += [x.tobytes() for x in total[ends] - total[ends - n]]
                registers += [x.tobytes() for x in _registers(row, value, high - low)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(count).astype(np.int64)), pa.array(sets, pa.binary()), pa.array(registers, pa.binary())], ["id", "text_digest", "n", "set_digest", "registers"])

    named = docs.select(F.col(doc_id).cast("long").alias("id"), F.md5(F.col(text).cast("binary")).alias("text_digest"), F.col(text).alias("text"))
    return named.mapInArrow(run, "id long, text_digest string, n long, set_digest binary, registers binary")


def _filled(registers: np.ndarray) -> np.ndarray:
    """Empty registers borrow the value of a bucket that is not, by the same random tries for every row, so that any register
    of two rows is equal about as often as their sets overlap, also where a set has fewer shingles than there are buckets."""
    out, tries = registers.copy(), mix(np.arange(REGISTERS * 96, dtype=np.uint64).reshape(96, REGISTERS)) % np.uint64(REGISTERS)
    for source in tries.astype(np.int64):
        rows, at = np.nonzero(out == 0)
        if not len(rows):
            return out
        out[rows, at] = registers[rows, source[at]]
    for shift in range(1, REGISTERS):  # very few shingles: the next bucket that holds one
        rows, at = np.nonzero(out == 0)
        if not len(rows):
            break
        out[rows, at] = registers[rows, (at + shift) % REGISTERS]
    return out


def _bands(nodes: DataFrame) -> DataFrame:
    """(node, band, key): a row for each band of each node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2048):
                part = batch.slice(low, 2048)
                full = _filled(np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, REGISTERS))[:, : BANDS * ROWS]
                key = np.zeros((len(full), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
                for j in range(ROWS):
                    key = mix(key ^ (full[:, j::ROWS].astype(np.uint64) + np.uint64(j << 32)))
                band = np.tile(np.arange(BANDS, dtype=np.int32), len(full))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part.column(0).to_numpy(), BANDS)), pa.array(band), pa.array(key.view(np.int64).ravel())], ["node", "band", "key"])

    return nodes.select("node", "registers").mapInArrow(run, "node long, band int, key long")


def _estimated(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose sizes allow the threshold and whose estimate lies less than six deviations below it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (2, 3))
                used = ((one > 0) | (two > 0)).sum(axis=1)
                same = ((one == two) & (one > 0)).sum(axis=1)
                jaccard = (same / used - COLLISION) / (1 - COLLISION)  # equal registers less those that collide by chance
                near = jaccard >= threshold - 6 * np.sqrt(threshold * (1 - threshold) / used) - 1 / used
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(near)) for i in (0, 1)], ["a", "b"])

    one, two = (nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("registers").alias(f"r{x}")) for x in "ab")
    sized = pairs.join(one, "a").join(two, "b").where(F.least("na", "nb") >= threshold * F.greatest("na", "nb") - 1e-6)
    return sized.select("a", "b", "ra", "rb").mapInArrow(run, "a long, b long")


def _sets(nodes: DataFrame, docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """(node, shingles): the full set of each of ``nodes``, its sorted hashes as bytes, read from the row that stands for the node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for low, high, raw, bounds in chunks(batch.column(1)):
                row, value = shingle_sets(raw, bounds, shingle)
                cut = np.searchsorted(row, np.arange(high - low + 1))
                out += [value[cut[i] : cut[i + 1]].tobytes() for i in range(high - low)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["node", "shingles"])

    texts = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    of_node = texts.join(nodes.select("node", "id", "text_digest"), texts["doc"].eqNullSafe(F.col("id")) & (F.md5(texts["text"].cast("binary")) == F.col("text_digest")))
    return of_node.select("node", "text").mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"])


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs whose full sets reach the threshold, compared in whole hundredths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for one, two in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (one, two))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(good, pa.bool_())) for i in (0, 1)], ["a", "b"])

    one, two = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _differences(members: DataFrame, centre: DataFrame, percent: int, listed: bool) -> DataFrame:
    """(node, family, n, d, linked, diff): each member against its family's centre; diff: what the centre lacks, then what the member lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, d, linked, diff = [], [], [], []
            for one, two in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (one, two))
                more, less = np.setdiff1d(x, y, assume_unique=True), np.setdiff1d(y, x, assume_unique=True)
                both = len(x) - len(more)
                n.append(len(x))
                d.append(len(more) + len(less))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
                diff.append(np.concatenate([more, less]).view(np.int64) if listed else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(d, pa.int64()), pa.array(linked, pa.bool_()), pa.array(diff, pa.list_(pa.int64()))], ["node", "family", "n", "d", "linked", "diff"])

    return members.join(centre, "family").select("node", "family", "shingles", "centre").mapInArrow(run, "node long, family long, n long, d long, linked boolean, diff array<long>")


def _cross_pairs(held: DataFrame, last: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From (key, node, comp, ...), for keys with several comps: (node, comp) of each node and the key's largest comp, if not its
    own; the pairs (a > b) of different smaller comps, where they are few for the key's nodes or ``last``; the rows of the other keys."""
    mixed = held.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    held = stored(held.join(mixed, "key", "left_semi"), "mixed")
    sizes = held.groupBy("key", "comp").agg(F.count("*").alias("c"))
    keys = sizes.groupBy("key").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("squares"), F.max(F.struct("c", "comp")).alias("main"))
    left = (F.col("m") - F.col("main.c")) * (F.col("m") - F.col("main.c")) - F.col("squares") + F.col("main.c") * F.col("main.c")
    keys = keys.select("key", F.col("main.comp").alias("main"), (F.lit(True) if last else left / 2 <= PER_NODE * F.col("m")).alias("few"))
    told = stored(held.join(keys, "key").where("comp <> main"), "told")
    guests = told.select("node", F.col("main").alias("comp")).distinct()
    one = told.where("few").select("key", F.col("node").alias("x"), F.col("comp").alias("cx"))
    two = told.where("few").select("key", F.col("node").alias("y"), F.col("comp").alias("cy"))
    pairs = one.join(two, "key").where("cx < cy").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
    return guests, stored(pairs.distinct(), "pairs"), told.where("NOT few").drop("main", "few", "comp")


def _family_links(families: DataFrame, guests: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that connect what is connected inside each family of ``families`` (node, family), its ``guests`` (node, family) included."""
    members = stored(families.withColumn("own", F.lit(True)).unionByName(guests.withColumn("own", F.lit(False))).join(sets, "node"), "members")
    centre = members.where("node = family").select("family", F.col("shingles").alias("centre"))
    first = stored(_differences(members.where("own"), centre, percent, True), "first")
    # The hub: the member nearest to what more than half of the family hold.
    told = first.select("node", "family", F.explode("diff").alias("shingle"))
    most = told.groupBy("family", "shingle").agg(F.count("*").alias("c")).join(first.groupBy("family").agg(F.count("*").alias("m")), "family").where("2 * c > m")
    common = told.join(most, ["family", "shingle"], "left_semi").groupBy("node", "family").agg(F.count("*").alias("c"))
    off = first.where("node <> family").join(common, ["node", "family"], "left").select("node", "family", (F.col("d") - 2 * F.coalesce("c", F.lit(0))).alias("off"))
    hubs = stored(off.groupBy("family").agg(F.min(F.struct("off", "node"))["node"].alias("hub")), "hubs")
    centre = members.join(hubs, "family").where("node = hub").select("family", F.col("shingles").alias("centre"))
    second = stored(_differences(members, centre, percent, True).join(members.select("node", "family", "own"), ["node", "family"]), "second")
    links = first.where("linked AND node <> family").select(F.col("node").alias("a"), F.col("family").alias("b"))
    links = stored(links.unionByName(second.join(hubs, "family").where("linked AND node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))), "links")
    # Members x and y are linked if they share (f(x) + f(y)) / (2 (100 + percent)) shingles of their D at least.
    scored = second.withColumn("f", (100 + percent) * F.col("d") - (100 - percent) * F.col("n"))
    reach = scored.where("own").groupBy("family").agg(F.max((100 + percent) * F.col("d") + (100 - percent) * F.col("n")).alias("reach"))
    scored = scored.join(reach, "family").where("own OR f <= reach")  # else no member's D is large enough for the overlap
    stats = scored.groupBy("family").agg(F.min(F.when(~F.col("linked"), F.col("f"))).alias("least_far"), F.min("f").alias("least")).where("least_far IS NOT NULL")

    def need(least: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil((F.col("f") + least) / (2 * (100 + percent)))).cast("int")

    # A pair has one member at least that is not linked with the hub: "far". Far members keep the prefix that any partner
    # asks for, and mark the shorter one that far partners ask for; the others keep what far partners ask for.
    open_ = scored.join(stats, "family").withColumn("among_far", need(F.col("least_far"))).withColumn("need", F.when(F.col("linked"), F.col("among_far")).otherwise(need(F.col("least"))))
    each = stored(open_.where("need <= d").select("node", "family", "linked", "need", "among_far", F.explode("diff").alias("shingle")), "shingles")
    ranked = each.join(each.groupBy("family", "shingle").agg(F.count("*").alias("rarity")), ["family", "shingle"])
    prefix = ranked.groupBy("node", "family", "linked", "need", "among_far").agg(F.array_sort(F.collect_list(F.struct("rarity", "shingle"))).alias("s"))
    comps = components(links)
    keyed = prefix.join(comps, "node", "left").select("node", "family", "linked", F.coalesce("comp", "node").alias("comp"), (F.size("s") - F.col("among_far")).alias("last"), F.posexplode(F.slice("s", 1, F.size("s") - F.col("need") + 1)).alias("at", "x"))
    keyed = keyed.where("x.rarity > 1").select("family", F.col("x.shingle").alias("shingle"), "node", "comp", "linked", (F.col("at") <= F.col("last")).alias("short"))
    mixed = keyed.groupBy("family", "shingle").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("family", "shingle")
    keyed = stored(keyed.join(mixed, ["family", "shingle"], "left_semi"), "prefixes")
    one = keyed.where("NOT linked").select("family", "shingle", F.col("node").alias("x"), F.col("comp").alias("cx"), F.col("short").alias("sx"))
    two = keyed.select("family", "shingle", F.col("node").alias("y"), F.col("comp").alias("cy"), "linked", F.col("short").alias("sy"))
    pairs = one.join(two, ["family", "shingle"]).where("cx <> cy AND (linked OR sx AND sy AND x < y)").select("family", F.col("x").alias("a"), F.col("y").alias("b"))
    pairs = stored(pairs.distinct(), "family_pairs")
    one, two = (scored.select("family", F.col("node").alias(x), F.col("f").alias(f"f{x}"), F.col("diff").alias(f"d{x}")) for x in "ab")
    near = pairs.join(one, ["family", "a"]).join(two, ["family", "b"]).where(2 * (100 + percent) * F.size(F.array_intersect("da", "db")) >= F.col("fa") + F.col("fb"))
    return stored(links.unionByName(near.select("a", "b")), "links")


def _grouped(docs: DataFrame, doc_id: str, text: str, shingle: int, threshold: float) -> DataFrame:
    """The columns of :func:`near_duplicates` and comp, which names the group also where its ids are null or repeated (null: no words)."""
    percent = round(100 * threshold)
    rows = stored(sketch(docs, doc_id, text, shingle), "sketch")
    with scratch() as keep:
        classes = rows.where("n > 0").groupBy("set_digest").agg(F.min(F.struct(F.col("id").isNull().alias("blank"), "id", "text_digest", "n", "registers")).alias("x"))
        nodes = stored(classes.select("set_digest", "x.id", "x.text_digest", "x.n", "x.registers").withColumn("node", F.monotonically_increasing_id()), "nodes")
        bands = _bands(nodes)
        crowded = bands.groupBy("key").agg(F.min("node").alias("least"), F.count("*").alias("m")).where("m > 1").select("key", "least")
        bands = stored(bands.join(crowded, "key"), "bands")
        stars = bands.where("node > least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
        near = stored(_estimated(stars, nodes, threshold), "near")
        families = stored(components(near).select("node", F.col("comp").alias("family")), "families")
        held = bands.join(families, "node", "left").select("key", "node", "band", F.coalesce("family", "node").alias("comp"))
        crossing, guests, level = None, None, 0
        while True:
            level += 1
            visits, pairs, rest = _cross_pairs(held, last=level == LEVELS)
            hosts = families.select(F.col("family").alias("comp")).distinct()
            lone = visits.join(hosts, "comp", "left_anti").select(F.greatest("node", "comp").alias("a"), F.least("node", "comp").alias("b"))
            close = _estimated(pairs.unionByName(lone).distinct(), nodes, threshold)
            visits = visits.join(hosts, "comp", "left_semi").select("node", F.col("comp").alias("family"))
            crossing = stored(close if crossing is None else crossing.unionByName(close).distinct(), "crossing")
            guests = stored(visits if guests is None else guests.unionByName(visits).distinct(), "guests")
            if level == LEVELS or rest.isEmpty():
                break
            other = bands.select("node", F.col("band").alias("next"), F.col("key").alias("other"))
            held = rest.join(other, "node").where("next > band").select("node", F.col("next").alias("band"), F.xxhash64("key", "other").alias("key"))
            held = held.join(families, "node", "left").select("key", "node", "band", F.coalesce("family", "node").alias("comp"))
        wanted = families.select("node").unionByName(guests.select("node")).unionByName(crossing.select(F.col("a").alias("node"))).unionByName(crossing.select(F.col("b").alias("node"))).distinct()
        sets = stored(_sets(nodes.join(wanted, "node", "left_semi"), docs, doc_id, text, shingle), "sets")
        links = _family_links(families, guests, sets, percent).unionByName(_compared(crossing, sets, percent))
        named = nodes.join(components(links), "node", "left").select("set_digest", "id", F.coalesce("comp", "node").alias("comp"))
        smallest = named.groupBy("comp").agg(F.min("id").alias("component_id"))
        of_set = stored(named.join(smallest, "comp").select("set_digest", "component_id", "comp"), "classes")
        keep.append(of_set)
    out = rows.join(of_set, "set_digest", "left")
    return out.select("id", "text_digest", F.col("n").alias("n_shingles"), "set_digest", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"), "comp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """(id, text_digest, n_shingles, set_digest, component_id) of every row of ``docs``; component_id: the smallest id reachable.

    ``docs`` is read again for the exact comparison; give a table, or a plan that returns the same rows again."""
    return _grouped(docs, doc_id, text, shingle, threshold).drop("comp")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """The documents, every column as it was, one of each group of near duplicates: the row with the smallest id (null after all
    others), then the smallest digest of the text; of repeated rows one. Rows without words are kept; they are linked with nothing."""
    with scratch() as keep:
        found = stored(_grouped(docs, doc_id, text, shingle, threshold).where("n_shingles > 0").groupBy("comp", "id", "text_digest").agg(F.count("*").alias("c")), "grouped")
        keep.append(found)
    place = F.struct(F.col("id").isNull().alias("blank"), "id", "text_digest")
    first = stored(found.groupBy("comp").agg(F.min(place).alias("first")), "first")
    placed = found.join(first, "comp").withColumn("stays", F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_digest") == F.col("first.text_digest")))
    gone = stored(placed.where("NOT stays").select("id", "text_digest"), "copies")
    kept = docs.join(gone, docs[doc_id].cast("long").eqNullSafe(gone["id"]) & (F.md5(docs[text].cast("binary")) == gone["text_digest"]), "left_anti")
    twice = stored(placed.where("stays AND c > 1").select("id", "text_digest"), "repeated")
    if twice.isEmpty():
        return kept
    same = kept[doc_id].cast("long").eqNullSafe(twice["id"]) & (F.md5(kept[text].cast("binary")) == twice["text_digest"])
    return kept.join(twice, same, "left_anti").unionByName(kept.join(twice, same, "left_semi").dropDuplicates([doc_id, text]))


def q_op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, threshold=0.85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


SQL_SPACED = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
OP7_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {SQL_SPACED} AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 2], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) AS i FROM d)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
e AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m, d.doc_id) AS component_id, coalesce(m, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS m FROM r GROUP BY x) USING (doc_id)
"""
