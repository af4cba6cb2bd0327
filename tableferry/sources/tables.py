"""Table sources: a *database* is a schema name plus named, lazily read DataFrames.

A parquet folder (one ``<table>.parquet`` per table) and a JDBC connection are the two
carriers. Nothing is read until an action runs; every operator downstream keeps the
plan lazy so Catalyst can prune columns and push filters into the scan.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The driver fixture's tables.
TPCH_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
OTHER_TABLES = (
    "events", "documents", "labels", "pages", "benchmark", "conversations", "embeddings",
)
ALL_TABLES = TPCH_TABLES + OTHER_TABLES

# Declared primary keys of the fixture tables (uniqueness checked on the
# data). lineitem has none: (l_orderkey, l_linenumber) repeats and is the duplicate-key case.
PRIMARY_KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": [],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "labels": ["doc_id"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "conversations": ["conv_id", "turn"],
    "embeddings": ["vec_id"],
}

# Declared foreign keys (child table, child column, parent table, parent column).
FOREIGN_KEYS = (
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
)


@dataclass
class Database:
    """A named set of tables. ``tables`` keeps insertion order (the listing order)."""

    schema: str
    tables: dict[str, DataFrame] = field(default_factory=dict)
    primary_keys: dict[str, list[str]] = field(default_factory=dict)
    table_types: dict[str, str] = field(default_factory=dict)
    unreadable: dict[str, str] = field(default_factory=dict)  # listed, but could not be read

    def table(self, name: str) -> DataFrame:
        return self.tables[name]

    def names(self) -> list[str]:
        return list(self.tables)

    def keys(self, name: str) -> list[str]:
        return list(self.primary_keys.get(name, []))

    def subset(self, names) -> "Database":
        keep = [n for n in names if n in self.tables]
        return Database(
            self.schema,
            {n: self.tables[n] for n in keep},
            {n: self.primary_keys.get(n, []) for n in keep},
            {n: self.table_types.get(n, "BASE TABLE") for n in keep},
            {n: e for n, e in self.unreadable.items() if n in set(names)},
        )


def read_parquet_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """S1 full scan of one parquet table: all rows, all columns, NULLs kept."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_database(
    spark: SparkSession, sf_dir: str, tables=ALL_TABLES, schema: str = "dbo"
) -> Database:
    """The fixture folder as a source database (lazy; schemas are read from footers).

    A listed table that cannot be opened is kept in ``unreadable`` with its error, so
    listings can flag it while every other table stays usable."""
    def opened(t: str) -> DataFrame | str:
        try:
            return read_parquet_table(spark, sf_dir, t)
        except Exception as exc:  # noqa: BLE001 — the error is reported as data
            return (str(exc).strip().splitlines() or [type(exc).__name__])[0][:300]

    # Opening a table reads a footer: side by side.
    with ThreadPoolExecutor(max_workers=8) as pool:
        found = dict(zip(tables, pool.map(opened, tables)))
    frames = {t: f for t, f in found.items() if isinstance(f, DataFrame)}
    errors = {t: e for t, e in found.items() if isinstance(e, str)}
    return Database(
        schema,
        frames,
        {t: list(PRIMARY_KEYS.get(t, [])) for t in frames},
        {t: "BASE TABLE" for t in frames},
        errors,
    )


def scan_full(df: DataFrame) -> DataFrame:
    """Every row and column. Errors propagate (no silent empty result, quirk Q1)."""
    return df.select("*")


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict | None = None,
    partition_column: str | None = None,
    lower_bound=None,
    upper_bound=None,
    num_partitions: int | None = None,
    fetch_size: int = 10000,
) -> DataFrame:
    """JDBC scan of one table. With a numeric ``partition_column`` the read is split into
    ``num_partitions`` range queries that run in parallel on the executors."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.option("fetchsize", str(fetch_size))
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None:
            # One aggregate query run by the server; only two values come back.
            bounds = read_jdbc_query(
                spark, url, f"SELECT MIN({partition_column}) AS LO, MAX({partition_column}) AS HI FROM {table}", properties
            ).first()
            lower_bound, upper_bound = bounds[0], bounds[1]
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions or spark.sparkContext.defaultParallelism))
        )
    return reader.load()


def read_jdbc_query(spark: SparkSession, url: str, query: str, properties: dict | None = None) -> DataFrame:
    """A catalog or metadata query pushed to the server as a whole (``query=``)."""
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    return reader.load()


def count_rows(df: DataFrame, name: str) -> DataFrame:
    """A1 row count of one table as a one-row DataFrame (bigint, quirk Q18)."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count"
    )
