"""Operator 2, sharding: balanced label propagation on the graph of linked rows, then shards of equal row counts.

Vertices are rows with one text, cut into pieces that are small against a shard, so that a group that holds a third of all rows
can spread. Vertices are linked through the keys they share (their text, and the lines a query names); a key is a
vertex of its own, so that no pair of a group is ever listed. In rounds:

1. each key counts the rows of its vertices in every shard;
2. each vertex sums what its keys hold in each shard, leaves itself out, and would move to the best if that is more than in its own;
3. moves between two shards are limited by a quota, what wants to move the other way plus its part of the room below the mean size;
   within it those with the most to gain go first, chosen by cells of a histogram (gain, weight, hash) and not by a sort; a
   cell that does not fit gives the part that does, a single vertex that does not fit is passed over.

The rounds end when no vertex wishes to move, or when a round brings less than :data:`LEAST` of what all rounds have brought (the
rows of a key that are together, squared). Moves of one round may undo each other: a round that does not bring rows closer
together is taken back and tried with half of its moves, at last with one in :data:`DAMPED`.

Then rows are numbered in the order (shard, text, id) by a distributed sort, and equal ranges of the numbers become the shards: counts
are at most one row apart, and only rows at the borders leave the shard of their vertex.

Defined results: a null text is a text of its own with no bytes and checksum 0; repeated rows take slots of their own; a null id sorts
first; lines count without the white space around them, a null or blank one links nothing; fewer rows than shards leave shards empty; an empty table gives no rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableferry.llm.textkit import discard, read_table, scratch, stored, totals

SHARDS = 24
#: The smallest part of a round's moves that is tried: one in so many.
DAMPED = 8
LEAST = 0.01
#: Pieces of one text that a shard could hold, parts of the hash in a quota's histogram, and parts of one cell.
PIECES = 8
CELLS = 64
PARTS = 1024


def vertices(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (row, text_key, ...) with ``vertex``: the piece of the text that the row belongs to."""
    total = rows.count()
    piece = max(1, total // (shards * PIECES))
    sizes = rows.groupBy("text_key").agg(F.count("*").alias("c")).where(F.col("c") > 1)
    cut = rows.join(sizes, "text_key", "left").withColumn("piece", F.pmod(F.xxhash64("row"), F.expr(f"coalesce(c, 1) div {piece} + 1")))
    return cut.withColumn("vertex", F.xxhash64("text_key", "piece")).drop("c", "piece")


def holdings(links: DataFrame, state: DataFrame) -> DataFrame:
    """(key, held: n and shard of every shard where the key has rows)."""
    held = links.join(state, "vertex").groupBy("key", "shard").agg(F.sum("weight").alias("n"))
    return stored(held.groupBy("key").agg(F.collect_list(F.struct("n", "shard")).alias("held")), "held")  # a stored side lets the join split a key that many vertices share


def wishes(links: DataFrame, state: DataFrame, held: DataFrame) -> DataFrame:
    """(vertex, weight, own, to, gain) of the vertices whose keys hold more rows in another shard than, without them, in their own."""
    # One row for each link goes to the vertex, with what its key holds as two narrow arrays; they are taken apart where the vertex's rows are together.
    told = links.join(held, "key").select("vertex", F.col("held.n").alias("n"), F.col("held.shard").alias("at")).hint("merge")
    seen = told.join(state, "vertex").select("vertex", "weight", F.col("shard").alias("own"), F.explode(F.arrays_zip("n", "at")).alias("x"))
    votes = seen.groupBy("vertex", "weight", "own", F.col("x.at").alias("shard")).agg(F.sum(F.col("x.n") - F.when(F.col("own") == F.col("x.at"), F.col("weight")).otherwise(0)).alias("n"))
    top = votes.groupBy("vertex", "weight", "own").agg(F.max(F.struct("n", (F.col("shard") == F.col("own")).alias("stay"), (-F.col("shard")).alias("least"), "shard")).alias("best"), F.max(F.when(F.col("shard") == F.col("own"), F.col("n"))).alias("now"))
    return top.select("vertex", "weight", "own", F.col("best.shard").alias("to"), (F.col("best.n") - F.col("now")).alias("gain")).where("gain > 0 AND own <> to")


def _fitting(cells: pd.DataFrame, quota: float) -> pd.DataFrame:
    """The cells of one pair of shards with ``part``, how many of :data:`PARTS` fit the quota."""
    cells = cells.sort_values(["gains", "size", "cell"], ascending=False)
    room, parts = quota, []
    for n, c in zip(cells["n"], cells["c"], strict=True):
        part = PARTS if n <= room else int(PARTS * room / n) if c > 1 and n <= c * room else 0
        room -= n * part / PARTS
        parts.append(part)
    return cells.assign(part=parts)


def _let_in(told: pd.DataFrame, mean: float) -> pd.DataFrame:
    """What one shard lets in, from the cells that wish into it (``kind`` 0) and out of it (1) and its load (2)."""
    into, out, load = (told[told["kind"] == kind] for kind in range(3))
    room = max(0.0, mean - float(load["n"].sum())) if len(load) else mean
    back, total = out.groupby("to")["n"].sum(), float(into["n"].sum())
    asked = {own: (cells, int(cells["n"].sum())) for own, cells in into.groupby("own")}
    found = [_fitting(cells, min(n, int(back.get(own, 0))) + room * (n / total)) for own, (cells, n) in asked.items()]
    return pd.concat(found or [into.assign(part=0)])[["own", "to", "gains", "size", "cell", "part"]]


def allowed(wish: DataFrame, state: DataFrame, shards: int, mean: float, turn: int) -> DataFrame:
    """(vertex, to) of the wishes that the quotas of their pairs of shards let through."""
    place = F.xxhash64("vertex", F.lit(turn))
    wish = wish.withColumns({"gains": F.floor(F.log2("gain")).cast("int"), "size": F.floor(F.log2("weight")).cast("int"), "cell": F.pmod(place, F.lit(CELLS)).cast("int"), "at": F.pmod(F.shiftright(place, 20), F.lit(PARTS)).cast("int")})
    cells = wish.groupBy("own", "to", "gains", "size", "cell").agg(F.sum("weight").alias("n"), F.count("*").alias("c"))
    # Each cell goes to the shard it wishes into and to the one it wishes out of, where the load is too: no joins, few shuffles for the driver to plan.
    sides = F.explode(F.array(F.struct(F.col("to").alias("shard"), F.lit(0).alias("kind")), F.struct(F.col("own").alias("shard"), F.lit(1).alias("kind"))))
    told = cells.select(sides.alias("side"), "*").select("side.*", "own", "to", "gains", "size", "cell", "n", "c")
    loads = state.groupBy("shard").agg(F.sum("weight").alias("n"))
    loads = loads.select("shard", F.lit(2).alias("kind"), *(F.lit(0).alias(x) for x in ("own", "to", "gains", "size", "cell")), "n", F.lit(0).cast("long").alias("c"))
    good = told.unionByName(loads).groupBy("shard").applyInPandas(lambda x: _let_in(x, mean), "own int, to int, gains int, size int, cell int, part int")
    return wish.join(good.where("part > 0"), ["own", "to", "gains", "size", "cell"]).where("at < part").select("vertex", "to")


def propagate(nodes: DataFrame, links: DataFrame, shards: int) -> DataFrame:
    """(vertex, weight, shard) from nodes (vertex, weight) and links (vertex, key): labels after rounds of quota-bound moves."""
    links = links.distinct()
    shared = links.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    links = stored(links.join(shared, "key"), "links")
    state = stored(nodes.withColumn("shard", F.pmod(F.xxhash64("vertex"), F.lit(shards)).cast("int")), "labels")
    mean = (state.agg(F.sum("weight")).first()[0] or 0) / shards
    together = F.aggregate("held", F.lit(0.0), lambda t, x: t + x["n"].cast("double") * x["n"])
    best, wish, score, first, part, turn = state, None, -1.0, None, 1, 0
    while True:
        held = holdings(links, state)
        (now,) = totals(held, together.cast("double"))
        if now > score:
            first = now if first is None else first
            over = part == 1 and turn > 0 and now - score < LEAST * (now - first)
            best, score, part = state, now, 1
            if over:
                return best
            discard(wish)
            wish = stored(wishes(links, best, held), "wishes")
            if wish.isEmpty():
                return best
        else:
            part *= 2
            if part > DAMPED:
                return best
        discard(held)
        some = wish.where(F.pmod(F.xxhash64("vertex", F.lit(-1 - turn)), F.lit(part)) == 0)
        with scratch() as keep:
            moves = allowed(some, best, shards, mean, turn)
            moved = stored(best.join(moves, "vertex", "left").select("vertex", "weight", F.coalesce("to", "shard").alias("shard")), "labels")
            keep.append(moved)
        turn += 1
        if state is not best:
            discard(state)
        state = moved


def numbered(rows: DataFrame, order: list[str], partitions: int) -> DataFrame:
    """``rows`` with ``number``: the place in the order, from 0, without gaps; sorted by range partitions."""
    ranged = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    placed = stored(ranged.withColumn("__at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("__at", 33)
    counts = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("c"))
    before = F.sum("c").over(Window.orderBy("__part")) - F.col("c")  # a row for each partition
    starts = counts.select("__part", before.alias("__before"))
    return placed.withColumn("__part", part).join(F.broadcast(starts), "__part").withColumn("number", F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1)).drop("__at", "__part", "__before")


def shard(rows: DataFrame, links: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``rows`` (row, text_key, id, ...) with shard and slot; ``links``: (row, key), rows that share a key are linked."""
    with scratch() as keep:
        placed = stored(vertices(rows, shards), "vertices")
        nodes = placed.groupBy("vertex").agg(F.count("*").alias("weight"))
        texts = placed.select("vertex", F.xxhash64(F.lit("text"), "text_key").alias("key")).distinct()
        named = links.join(placed.select("row", "vertex"), "row").select("vertex", "key")
        labels = propagate(nodes, texts.unionByName(named), shards)
        keep += [placed, labels]
    total = placed.count()
    partitions = max(1, -(-total // 50_000))
    label = labels.select("vertex", F.col("shard").alias("label"))
    out = numbered(placed.join(label, "vertex").drop("vertex"), ["label", "text_key", "id", "row"], partitions)
    discard(placed, labels)
    place = F.expr(f"cast(number * {shards} div {max(1, total)} as int)")
    first = F.expr(f"(cast(shard as bigint) * {total} + {shards} - 1) div {shards}")
    return out.withColumn("shard", place).withColumn("slot", F.col("number") - first).drop("number", "label")


def document_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", row: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows: row, id, text_key, size, text_crc32; links: row, key) of documents; linked by equal lines."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    lines = F.array_distinct(F.transform(F.split(F.col(text), "\n"), lambda x: F.btrim(x, F.lit(" \t\r\f\v"))))
    keys = F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.xxhash64(F.lit("line"), x))
    told = docs.select(
        (F.monotonically_increasing_id() if row is None else row).alias("row"), F.col(doc_id).alias("id"), F.coalesce(F.md5(F.col(text).cast("binary")), F.lit("null")).alias("text_key"),
        (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.coalesce(keys, F.array().cast("array<bigint>")).alias("keys"),
    )
    told = stored(told, "rows")
    return told.drop("keys"), told.select("row", F.explode("keys").alias("key"))


def q_op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, links = document_rows(read_table(spark, sf_dir, "documents"))
    found = shard(rows, links)
    return found.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
