"""Paged scans (S2, L5, T3), the legacy insert chunk plan (W3) and progress (A5).

The legacy tool pages with ``ORDER BY pk OFFSET k FETCH NEXT n`` — a re-sort per page.
Here a page number is derived from a *distributed* row index:

1. Spark's range partitioner over the full key in its own types (it samples the key to
   place the bounds); rows of one key value are ranged further by a hash of their other
   columns, so a hot value is split too;
2. each range is sorted (spilling to disk where it must), its rows are numbered and the
   result is pinned by a checkpoint in the shared folder: retried tasks and lost executors
   can't change a number that has been given;
3. rows per range, and their exclusive running sum (a table with one row per range, bounded
   by the partition count, so broadcasting it is safe);
4. ``row_no = offset of the range + position in it``.

No step funnels the table through one partition (a global ``Window.orderBy`` would). The
checkpoint holds the frame's columns: number a frame of the key columns where no others
are needed (:func:`page_index`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableferry.session import materialize

# Fixed values of the legacy loader.
DEFAULT_PAGE_SIZE = 1000      # rows per read page
CHUNK_SIZE = 100              # rows per executemany chunk
COMMIT_EVERY = 50             # pages between commits

_POSITION_BITS = 33           # low bits of monotonically_increasing_id: the row's position in its partition


def _spread(df: DataFrame, order_cols: list[str]) -> list:
    """A hash of the columns that are not ordered by (maps and variants have none)."""
    rest = [
        F.col(f"`{f.name}`") for f in df.schema.fields
        if f.name not in order_cols and not any(x in f.dataType.simpleString() for x in ("map<", "variant"))
    ]
    return [F.xxhash64(*rest)] if rest else []


def ranged(df: DataFrame, order_cols: list[str], n_buckets: int | None = None) -> DataFrame:
    """``df`` in sorted ranges of the key (NULLs first), rows of one key by a hash of the rest.

    Without ``n_buckets`` there are ``spark.sql.shuffle.partitions`` ranges, and small
    neighbours are merged at run time. Only rows that are equal in every column can't be
    told apart; they share a range, whose sort spills."""
    order = [F.col(f"`{c}`").asc_nulls_first() for c in order_cols] + _spread(df, order_cols)
    parts = df.repartitionByRange(n_buckets, *order) if n_buckets else df.repartitionByRange(*order)
    return parts.sortWithinPartitions(*order)


def row_index(
    df: DataFrame,
    order_cols: list[str],
    index_col: str = "row_no",
    n_buckets: int | None = None,
) -> DataFrame:
    """Add a 1-based global position by ``order_cols`` (ascending, NULLs first).

    Equals ``row_number() over (order by order_cols)``; ties beyond ``order_cols`` go by a
    hash of the other columns. The ranged rows are checkpointed when this is called."""
    pinned = materialize(ranged(df, order_cols, n_buckets).withColumn("_at", F.monotonically_increasing_id()))
    rows = pinned.withColumn("_range", F.shiftright("_at", _POSITION_BITS))
    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    position = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        rows.join(F.broadcast(offsets), "_range")
        .withColumn(index_col, (F.col("_offset") + position + 1).cast("bigint"))
        .drop("_at", "_range", "_offset")
    )


def scan_paged(df: DataFrame, keys: list[str], page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """Every row with its 1-based ``batch_no`` (pages of ``page_size`` rows by key).

    Without a key there is no defined order (quirk Q13): the table is one plain batch."""
    if not keys:
        return df.withColumn("batch_no", F.lit(1).cast("bigint")).withColumn(
            "row_no", F.lit(None).cast("bigint")
        )
    indexed = row_index(df, keys)
    return indexed.withColumn(
        "batch_no", (F.floor((F.col("row_no") - 1) / F.lit(page_size)) + 1).cast("bigint")
    )


def page_index(df: DataFrame, keys: list[str], page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """The key columns alone with their ``batch_no``: no other column is read or stored."""
    return scan_paged(df.select(*[F.col(f"`{k}`") for k in keys]), keys, page_size)


def page_summary(paged: DataFrame, key: str | list[str]) -> DataFrame:
    """Per page: rows, first and last key (T3: the pages concatenate to the table). The
    ends of a key given as a list are structs of its columns."""
    k = F.col(f"`{key}`") if isinstance(key, str) else F.struct(*[F.col(f"`{c}`") for c in key])
    return paged.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(k).alias("first_key"),
        F.max(k).alias("last_key"),
    )


def chunk_plan(pages: DataFrame, chunk_size: int = CHUNK_SIZE, commit_every: int = COMMIT_EVERY) -> DataFrame:
    """How the legacy loader inserts each page.

    1 row -> single insert; <= chunk_size rows -> one executemany; else chunks of
    chunk_size. A commit follows every ``commit_every`` pages and the last page."""
    last = pages.agg(F.max("batch_no")).scalar()  # a scalar subquery, computed once
    n = F.col("n_rows")
    return pages.withColumn("_last", last).select(
        "batch_no",
        "n_rows",
        F.ceil(n / F.lit(chunk_size)).cast("bigint").alias("n_chunks"),
        F.when(n == 1, F.lit("single"))
        .when(n <= chunk_size, F.lit("executemany"))
        .otherwise(F.lit("chunked"))
        .alias("insert_mode"),
        ((F.col("batch_no") % commit_every == 0) | (F.col("batch_no") == F.col("_last"))).alias(
            "commit_after"
        ),
    )


def running_sum(
    df: DataFrame, part: list[str], order: str, value, out: str, bucket_width: int = 10_000
) -> DataFrame:
    """Inclusive running sum of ``value`` by ``order`` within ``part``, in two levels.

    Rows are grouped into order buckets of ``bucket_width``; bucket totals get an
    exclusive prefix sum (a table of rows/bucket_width rows per partition key), and the
    fine running sum runs per (part, bucket). No window ever spans a whole partition key."""
    v = value if not isinstance(value, str) else F.col(value)
    b = df.withColumn("_rb", F.floor(F.col(order) / F.lit(bucket_width))).withColumn("_rv", v)
    totals = b.groupBy(*part, "_rb").agg(F.sum("_rv").alias("_bt"))
    offsets = totals.select(
        *part,
        "_rb",
        F.coalesce(
            F.sum("_bt").over(
                Window.partitionBy(*part).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_boff"),
    )
    w = Window.partitionBy(*part, "_rb").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        b.join(offsets, [*part, "_rb"])
        .withColumn(out, (F.col("_boff") + F.sum("_rv").over(w)).cast("bigint"))
        .drop("_rb", "_rv", "_boff")
    )


def batch_progress(batch_log: DataFrame, batch_size: int = DEFAULT_PAGE_SIZE, log_every: int = COMMIT_EVERY) -> DataFrame:
    """A5: per batch, rows done so far and percent of the table (capped at 100).

    ``logged`` marks the batches the legacy loader reports (every ``log_every`` and the
    last). Elapsed time and rows/s are run-time measurements, not data: not computed."""
    per_table = batch_log.groupBy("table_name").agg(
        F.sum("n_rows").cast("bigint").alias("total_rows"), F.max("batch_no").alias("_last")
    )
    done = F.when(F.col("ok"), F.col("n_rows")).otherwise(F.lit(0))
    with_run = running_sum(batch_log, ["table_name"], "batch_no", done, "rows_done")
    pct = F.least(
        F.lit(100.0) * F.col("batch_no").cast("double") * F.lit(float(batch_size))
        / F.col("total_rows").cast("double"),
        F.lit(100.0),
    )
    return with_run.join(per_table, "table_name").select(
        "table_name",
        "batch_no",
        "n_rows",
        "rows_done",
        "total_rows",
        pct.alias("percent"),
        ((F.col("batch_no") % log_every == 0) | (F.col("batch_no") == F.col("_last"))).alias("logged"),
    )
