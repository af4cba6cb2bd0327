"""X1 without a key: the multiset difference of two tables from one invertible sketch.

Every row is a 64-bit hash that falls into one cell of each of three rows of cells. A cell
holds the signed count of its rows (source +1, target -1) and signed sums of their hashes
and of a check number; partial aggregation forms the cells inside the tasks, so what
crosses the shuffle is bounded by the cells and not by the tables. Rows that both sides
hold equally often cancel, whatever their number. A cell left with one hash gives that hash
away; taking it out of its other cells frees further ones, until all cells are empty.
Where more rows differ than the cells can tell, decoding stops with cells left, and the
differing hashes come from signed counts per hash instead, which is exact at any size.

The rows themselves are read in a second pass, only those with a differing hash, and counted
by value: no hash decides what is reported, and a difference goes unseen only where the
hashes of a missing and of an extra row agree in all 64 bits.

Defined results: one row per distinct differing row, all columns kept, ``status`` (``missing``
from the target or ``extra`` in it) and ``n_rows`` (how many times more one side holds it).
NULL equals NULL, NaN equals NaN, -0.0 equals 0.0. Columns that only the target has are left
out, columns that it lacks count as NULL. Map columns cannot be grouped and are refused.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.operators.difftree import parts
from tableferry.operators.reconcile import _aligned_target, _row_digest
from tableferry.session import materialize

#: Cells in each of the three rows of a sketch; three times as many decode about 0.8 differing rows a cell.
CELLS = 1 << 14
SUMS = ("n", "h0", "h1", "h2", "c0", "c1")
MASK = (1 << 64) - 1


def _cell(h: Column, row: int, cells: int) -> Column:
    """A row's cell by its own stretch of the hash's bits."""
    return F.pmod(parts(h)[row], F.lit(cells))


def _checks(h: Column) -> list[Column]:
    """A number that sums of other hashes do not give, as two halves whose sums fit a bigint."""
    crc = F.crc32(h.cast("string").cast("binary"))
    return [F.shiftright(crc, 16), crc.bitwiseAND(F.lit(0xFFFF))]


def _contents(h: int, n: int) -> list[int]:
    """What ``n`` rows of one hash add to a cell."""
    crc = zlib.crc32(str(h).encode())
    u = h & MASK
    return [n, n * (u >> 42), n * (u >> 21 & 0x1FFFFF), n * (u & 0x1FFFFF), n * (crc >> 16), n * (crc & 0xFFFF)]


def sketch(df: DataFrame, cells: int = CELLS, sign: int = 1) -> DataFrame:
    """The cells of a table: (row, cell) with signed sums. Sketches of parts merge by :func:`merged`."""
    one, h = F.lit(sign).cast("bigint"), F.col("_h")
    hashed = df.select(_row_digest(df, df.columns).alias("_h"))
    counted = hashed.select("_h", *[v.alias(c) for c, v in zip(SUMS, [one, *[one * p for p in [*parts(h), *_checks(h)]]])])
    placed = counted.select(*SUMS, F.posexplode(F.array(*[_cell(h, r, cells) for r in range(3)])).alias("row", "cell"))
    return placed.groupBy("row", "cell").agg(*[F.sum(c).alias(c) for c in SUMS])


def merged(*sketches: DataFrame) -> DataFrame:
    """Sketches added cell by cell; cells that cancel are gone."""
    total = reduce(DataFrame.unionByName, sketches).groupBy("row", "cell").agg(*[F.sum(c).alias(c) for c in SUMS])
    return total.where(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in SUMS]))


def _single(sums: list[int], row: int, cell: int, cells: int) -> int | None:
    """The hash that alone fills a cell, None where several do."""
    n = sums[0]
    if n == 0 or any(x % n for x in sums[1:]):
        return None
    p = [x // n for x in sums[1:4]]
    if not (0 <= p[0] < 1 << 22 and 0 <= p[1] < 1 << 21 and 0 <= p[2] < 1 << 21) or p[row] % cells != cell:
        return None
    h = p[0] << 42 | p[1] << 21 | p[2]
    h = h - (1 << 64) if h >= 1 << 63 else h
    return h if _contents(h, n) == sums else None


def decode(held: dict[tuple[int, int], list[int]], cells: int = CELLS) -> dict[int, int] | None:
    """Differing hashes with their signed counts, or None where cells are left over."""
    held = {k: list(v) for k, v in held.items()}
    found: dict[int, int] = defaultdict(int)
    open_cells = list(held)
    steps = 4 * len(held) + 16  # every hash taken out empties a cell; more steps mean a wrong one was taken
    while open_cells and steps:
        place = open_cells.pop()
        h = _single(held[place], *place, cells)
        if h is None:
            continue
        steps -= 1
        n = held[place][0]
        found[h] += n
        taken = _contents(h, n)
        for row in range(3):
            other = (row, taken[row + 1] // n % cells)
            if other not in held:
                return None
            held[other] = [a - b for a, b in zip(held[other], taken)]
            if any(held[other]):
                open_cells.append(other)
    if any(any(v) for v in held.values()):
        return None
    return {h: n for h, n in found.items() if n}


def _hashes_by_count(source: DataFrame, target: DataFrame) -> DataFrame:
    """Differing hashes at any size: signed counts per hash, 16 bytes a distinct row and task."""
    both = source.select(_row_digest(source, source.columns).alias("_h"), F.lit(1).alias("side")).unionByName(
        target.select(_row_digest(target, target.columns).alias("_h"), F.lit(-1).alias("side"))
    )
    return both.groupBy("_h").agg(F.sum("side").alias("n")).where("n <> 0").select("_h")


def differing_hashes(source: DataFrame, target: DataFrame, cells: int = CELLS) -> tuple[DataFrame, bool]:
    """Hashes of the rows that one side holds more often, and whether the sketch told them all.

    At most ``3 * cells`` cells reach the driver."""
    spark = source.sparkSession
    left = merged(sketch(source, cells), sketch(target, cells, -1)).collect()
    found = decode({(r.row, r.cell): [r[c] for c in SUMS] for r in left}, cells)
    if found is None:
        return materialize(_hashes_by_count(source, target)), False
    return spark.createDataFrame([(h,) for h in found], "_h bigint"), True


def content_diff_sketch(source: DataFrame, target: DataFrame, cells: int = CELLS) -> DataFrame:
    """X1 for tables without a key: differing rows with ``status`` and ``n_rows``."""
    if any(isinstance(f.dataType, T.MapType) for f in source.schema.fields):
        raise ValueError("map columns cannot be compared by value")
    target = _aligned_target(source, target)
    columns = source.columns
    hashes, _ = differing_hashes(source, target, cells)

    def side(df: DataFrame, sign: int) -> DataFrame:
        hit = df.withColumn("_h", _row_digest(df, columns)).join(hashes, "_h", "left_semi").drop("_h")
        return hit.withColumn("_n", F.lit(sign).cast("bigint"))

    total = side(source, 1).unionByName(side(target, -1)).groupBy(*[f"`{c}`" for c in columns]).agg(F.sum("_n").alias("_n"))
    return total.where("_n <> 0").select(
        *[f"`{c}`" for c in columns],
        F.when(F.col("_n") > 0, "missing").otherwise("extra").alias("status"),
        F.abs("_n").alias("n_rows"),
    )
