"""A deterministic *damaged target*: verification is only meaningful against a target
that differs from the source. The rule is a pure function of each row's key, so Spark
and an SQL oracle derive the same target from the same source.

For a table with key ``k``: rows whose ``md5(cast(k as string))`` starts with ``0`` are
dropped; rows whose md5 starts with ``ff`` get +1 on one double column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.sources.tables import Database

# The damaged column of each damaged table (others are copied unchanged).
DAMAGED_COLUMNS = {
    "customer": "c_acctbal",
    "supplier": "s_acctbal",
    "part": "p_retailprice",
    "orders": "o_totalprice",
}
DROP_PREFIX = "0"
CHANGE_PREFIX = "ff"


def key_digest(key: str):
    return F.md5(F.col(key).cast("string"))


def damage_table(df: DataFrame, key: str, column: str) -> DataFrame:
    digest = key_digest(key)
    kept = df.filter(F.substring(digest, 1, len(DROP_PREFIX)) != DROP_PREFIX)
    changed = F.when(
        F.substring(digest, 1, len(CHANGE_PREFIX)) == CHANGE_PREFIX, F.col(column) + F.lit(1.0)
    ).otherwise(F.col(column))
    return kept.withColumn(column, changed)


def damaged_target(source: Database, schema: str = "target") -> Database:
    """The target database: damaged copies of the damaged tables, exact copies otherwise."""
    tables = {}
    for name, df in source.tables.items():
        col = DAMAGED_COLUMNS.get(name)
        keys = source.keys(name)
        tables[name] = damage_table(df, keys[0], col) if col and len(keys) == 1 else df
    return Database(
        schema,
        tables,
        {n: source.keys(n) for n in tables},
        {n: "BASE TABLE" for n in tables},
    )


def scrambled_customer(customer: DataFrame) -> DataFrame:
    """The damaged customers with what a faulty copy adds: rows whose md5 starts with ``d``
    have their name in the segment column (and NULL as name), those with ``a`` are there
    twice, those with ``b`` also under a key that the source does not have."""
    first = F.substring(key_digest("c_custkey"), 1, 1)
    copied = damage_table(customer, "c_custkey", DAMAGED_COLUMNS["customer"])
    moved = copied.withColumns({
        "c_name": F.when(first != "d", F.col("c_name")),
        "c_mktsegment": F.when(first == "d", F.col("c_name")).otherwise(F.col("c_mktsegment")),
    })
    extra = moved.where(first == "b").withColumn("c_custkey", -1 - F.col("c_custkey"))
    return moved.unionByName(moved.where(first == "a")).unionByName(extra)


def near_copy(lineitem: DataFrame) -> DataFrame:
    """A nearly equal copy of a table without a key: by the md5 of order and line, rows that
    start with ``00`` are gone, with ``01`` there twice, with ``02`` have one more in quantity."""
    digest = F.md5(F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).cast("binary"))
    first = F.substring(digest, 1, 2)
    more = F.when(first == "02", F.col("l_quantity") + F.lit(1.0)).otherwise(F.col("l_quantity"))
    times = F.when(first == "00", 0).when(first == "01", 2).otherwise(1)
    copied = lineitem.withColumn("l_quantity", more).withColumn("_copy", F.explode(F.sequence(F.lit(0), times)))
    return copied.where("_copy > 0").drop("_copy")
