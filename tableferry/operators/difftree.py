"""X1 for nearly equal tables: a tree of digests over ranges of the key's hash.

:func:`digest_store` reads a table once and keeps, per row, its key, the key's 64-bit hash,
the row's hash and a hash of each value, sorted by the key's hash inside each task (no
shuffle). A range of hashes is then a stretch of every file, which a scan finds by the
files' own statistics. :func:`diff_stores` compares two stores from the top of the tree: a
node is a range of hashes with a common prefix, its digest a few sums that partial
aggregation forms inside the tasks. Only nodes whose digests differ are split further, so
each level reads what lies below the differing nodes of the level above, and the rows that
are compared in the end grow with the difference and not with the tables. A store can be
kept: a source's serves any number of targets.

Defined results: keys and values compare as in ``reconcile.content_diff`` (NULL equals NULL,
NaN equals NaN, -0.0 equals 0.0). A key that a side holds more than once is ``duplicate``
where the sides' rows of it differ; rows that both sides repeat alike are no difference
(``quality.duplicate_keys`` lists them). Two equal or two empty tables give no rows. A
difference goes unseen only where 64-bit hashes or three sums of a node collide.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.operators.reconcile import _aligned_target, _full_by_key, _row_digest, _value_hash
from tableferry.session import materialize, new_run_dir

#: A node is split into 2 ** FAN_BITS ranges.
FAN_BITS = 8
#: Differing nodes are split until they hold this many rows of both sides on average.
LEAF_ROWS = 256
#: Up to so many differing nodes are given to the scan as ranges of hashes; more are joined.
RANGES = 128


class Level(NamedTuple):
    """One level of the descent: how many of its nodes differ, and the rows of both sides below those."""

    level: int
    differing: int
    rows_below: int


def parts(h: Column) -> list[Column]:
    """64 bits as three numbers whose sums over 2 ** 41 rows fit a bigint."""
    return [F.shiftrightunsigned(h, 42), F.shiftright(h, 21).bitwiseAND(F.lit(0x1FFFFF)), h.bitwiseAND(F.lit(0x1FFFFF))]


def digest_store(df: DataFrame, keys: list[str], path: str) -> DataFrame:
    """The digest rows of a table, written to ``path`` in one pass without a shuffle and read back."""
    values = [c for c in df.columns if c not in keys]
    held = df.select(
        *[F.col(f"`{k}`") for k in keys],
        _row_digest(df, keys).alias("_key_hash"),
        *[_value_hash(df, c).alias(f"_v{i}") for i, c in enumerate(values)],
    )
    row = F.xxhash64("_key_hash", *[f"_v{i}" for i in range(len(values))])
    held.withColumn("_row_hash", row).sortWithinPartitions("_key_hash").write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _node(bits: int) -> Column:
    return F.shiftrightunsigned("_key_hash", 64 - bits)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _below(stores: list[DataFrame], nodes: DataFrame, bits: int) -> list[DataFrame]:
    """The rows of both stores under the given nodes."""
    few = [r.node for r in nodes.select("node").limit(RANGES + 1).collect()]
    if len(few) > RANGES:
        return [x.join(nodes.select("node"), _node(bits) == F.col("node"), "left_semi") for x in stores]
    shift = 64 - bits
    ranges = [F.col("_key_hash").between(_signed(n << shift), _signed((n << shift) + (1 << shift) - 1)) for n in few]
    inside = reduce(lambda a, b: a | b, ranges, F.lit(False))
    return [x.where(inside) for x in stores]


def _differing(src: DataFrame, tgt: DataFrame, bits: int) -> DataFrame:
    """Nodes whose sides differ, with the rows of both sides: one aggregation of both sides with signs."""
    both = src.select(_node(bits).alias("node"), F.lit(1).cast("bigint").alias("side"), "_row_hash").unionByName(
        tgt.select(_node(bits).alias("node"), F.lit(-1).cast("bigint").alias("side"), "_row_hash")
    )
    sums = {f"_d{i}": F.sum(F.col("side") * p) for i, p in enumerate(parts(F.col("_row_hash")))}
    nodes = both.groupBy("node").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("side").alias("_d"), *[v.alias(k) for k, v in sums.items()]
    )
    return nodes.where(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in ("_d", *sums)])).select("node", "n_rows")


def _compared(src: DataFrame, tgt: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Rows below the last nodes, one per key and side, joined 1:1."""

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.groupBy(*[f"`{k}`" for k in keys]).agg(
            F.count(F.lit(1)).alias(f"_n{tag}"),
            *[F.sum(p).alias(f"_h{i}{tag}") for i, p in enumerate(parts(F.col("_row_hash")))],
            *[F.min(f"_v{i}").alias(f"_{tag}{i}") for i in range(len(values))],
        )

    joined = _full_by_key(side(src, "s"), side(tgt, "t"), keys)
    changed = F.concat_ws(
        ",", *[F.when(~F.col(f"_s{i}").eqNullSafe(F.col(f"_t{i}")), F.lit(c)) for i, c in enumerate(values)]
    )
    alike = reduce(lambda a, b: a & b, [F.col(f"{c}s") == F.col(f"{c}t") for c in ("_n", "_h0", "_h1", "_h2")])
    status = (
        F.when(F.col("_ns").isNull(), "extra")
        .when(F.col("_nt").isNull(), "missing")
        .when(~alike & ((F.col("_ns") > 1) | (F.col("_nt") > 1)), "duplicate")
        .when(~alike, "changed")
    )
    return joined.select(
        *[f"`{k}`" for k in keys], status.alias("status"), F.when(status == "changed", changed).alias("changed_columns")
    ).where(F.col("status").isNotNull())


def diff_stores(
    source: DataFrame,
    target: DataFrame,
    keys: list[str],
    values: list[str],
    fan_bits: int = FAN_BITS,
    leaf_rows: int = LEAF_ROWS,
) -> tuple[DataFrame, list[Level]]:
    """Two stores of the same keys and values: rows as of ``content_diff``, and the levels of the descent.

    The differing nodes of each level are written under the shared folder before the next
    level starts, so a lost executor repeats one level at most."""
    stores, bits, levels = [source, target], 0, []
    while True:
        bits += fan_bits
        nodes = materialize(_differing(*stores, bits))
        found = nodes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("below")).first()
        levels.append(Level(len(levels) + 1, found.n, found.below))
        stores = _below(stores, nodes, bits)
        if found.below <= leaf_rows * found.n or bits + fan_bits > 56:
            return _compared(*stores, keys, values), levels


def content_diff_tree(
    source: DataFrame, target: DataFrame, keys: list[str], fan_bits: int = FAN_BITS, leaf_rows: int = LEAF_ROWS
) -> DataFrame:
    """Keys that are ``missing``, ``extra``, ``changed`` (with the columns) or ``duplicate``,
    found by descending the digest trees of both tables. Each table is read once."""
    values = [c for c in source.columns if c not in keys]
    path = new_run_dir(source.sparkSession, "digests")
    stores = [
        digest_store(df, keys, f"{path}/{side}")
        for side, df in (("source", source), ("target", _aligned_target(source, target)))
    ]
    return diff_stores(*stores, keys, values, fan_bits, leaf_rows)[0]
