"""Table-list set operations and ordered previews.

The reference does these as list comprehensions in host code; here they are joins over
name DataFrames, so they work the same for ten tables or a catalog of millions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remaining_tables(all_tables: DataFrame, ordered: DataFrame) -> DataFrame:
    """Tables not in the ordered plan, in listing order (by name)."""
    return all_tables.join(ordered.select("table_name"), "table_name", "left_anti").orderBy("table_name")


def planned_tables(ordered: DataFrame, available: DataFrame) -> DataFrame:
    """The ordered plan restricted to available tables, plan order kept."""
    return ordered.join(available.select("table_name"), "table_name", "left_semi").orderBy("pos")


def ordered_plan(spark, names: list[str]) -> DataFrame:
    """A plan list as a DataFrame with its position (``posexplode`` keeps the order)."""
    return spark.createDataFrame([(names,)], "names array<string>").select(
        F.posexplode("names").alias("pos", "table_name")
    ).select((F.col("pos") + 1).cast("int").alias("pos"), "table_name")


def top_n_preview(df: DataFrame, columns: list[str], key: str, n: int = 3) -> DataFrame:
    """Named columns of the first n rows by key (a top-k: TakeOrderedAndProject,
    each task keeps only its n best rows)."""
    return df.select(*columns).orderBy(key).limit(n)
