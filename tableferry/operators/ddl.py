"""Target schema: type mapping over the catalog, column definitions and DDL text
(P1-P3, P9, W5, W6). One projection plus one aggregation over the catalog renders the
DDL of every table at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.functions import names, typemap

# Table options rendered after the column list.
CURRENT_TABLE_SUFFIX = "\n) ENGINE=InnoDB DEFAULT CHARSET=utf8mb4 COLLATE=utf8mb4_unicode_ci"
LEGACY_TABLE_SUFFIX = "\n) ENGINE=InnoDB DEFAULT CHARSET=utf8mb4 COLLATE=utf8mb4_bin"
LEGACY_COLUMN_SEPARATOR = ",\n  "


def map_types(catalog: DataFrame, profile: str = "current") -> DataFrame:
    """The catalog with ``target_type`` added."""
    fn = typemap.map_type if profile == "current" else typemap.map_type_legacy
    return catalog.withColumn(
        "target_type",
        fn("data_type", "character_maximum_length", "numeric_precision", "numeric_scale"),
    )


def column_definitions(catalog: DataFrame, preserve_values: bool = True) -> DataFrame:
    """Target column definitions (name, type, nullable, auto-increment)."""
    mapped = map_types(catalog)
    return mapped.select(
        "table_schema",
        "table_name",
        "ordinal_position",
        "column_name",
        F.col("target_type").alias("type_definition"),
        (F.upper("is_nullable") == "YES").alias("is_nullable"),
        typemap.auto_increment(F.col("is_identity") == 1, preserve_values).alias("is_auto_increment"),
    )


def _column_text(defs: DataFrame):
    return F.concat(
        F.lit("  `"),
        F.col("column_name"),
        F.lit("` "),
        F.col("type_definition"),
        F.when(F.col("is_nullable"), F.lit(" NULL")).otherwise(F.lit(" NOT NULL")),
        F.when(F.col("is_auto_increment"), F.lit(" AUTO_INCREMENT")).otherwise(F.lit("")),
    )


def _ordered_join(col_struct, sep: str):
    return F.array_join(
        F.transform(F.array_sort(F.collect_list(col_struct)), lambda s: s["text"]), sep
    )


def render_ddl(defs: DataFrame) -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS`` per target table, columns in catalog order.

    The target table name is the flattened source name (P4); a name that cannot be
    converted yields a NULL ``ddl`` and an ``error`` instead of aborting the run."""
    full = F.concat_ws(".", "table_schema", "table_name")
    grouped = defs.groupBy("table_schema", "table_name").agg(
        _ordered_join(F.struct(F.col("ordinal_position").alias("o"), _column_text(defs).alias("text")), ",\n").alias("cols")
    )
    target = names.target_table_name(full)
    return grouped.select(
        full.alias("source_table"),
        target.alias("target_table"),
        F.when(
            target.isNotNull(),
            F.concat(F.lit("CREATE TABLE IF NOT EXISTS `"), target, F.lit("` (\n"), F.col("cols"),
                     F.lit(CURRENT_TABLE_SUFFIX)),
        ).alias("ddl"),
        names.target_name_error(full).alias("error"),
    )


def render_ddl_legacy(catalog: DataFrame, primary_keys: DataFrame) -> DataFrame:
    """W6 DDL: legacy profile types, bare table name, ``PRIMARY KEY (...)`` appended.

    ``primary_keys``: (table_name, column_name, key_ordinal)."""
    mapped = map_types(catalog, "legacy")
    col_text = F.concat(
        F.lit("`"), F.col("column_name"), F.lit("` "), F.col("target_type"),
        F.when(F.col("is_nullable") == "YES", F.lit(" NULL")).otherwise(F.lit(" NOT NULL")),
    )
    cols = mapped.groupBy("table_name").agg(
        _ordered_join(F.struct(F.col("ordinal_position").alias("o"), col_text.alias("text")),
                      LEGACY_COLUMN_SEPARATOR).alias("cols")
    )
    pks = primary_keys.groupBy("table_name").agg(
        _ordered_join(
            F.struct(F.col("key_ordinal").alias("o"),
                     F.concat(F.lit("`"), F.col("column_name"), F.lit("`")).alias("text")),
            ", ",
        ).alias("pk")
    )
    body = F.when(
        F.col("pk").isNotNull(),
        F.concat(F.col("cols"), F.lit(LEGACY_COLUMN_SEPARATOR), F.lit("PRIMARY KEY ("), F.col("pk"), F.lit(")")),
    ).otherwise(F.col("cols"))
    return cols.join(pks, "table_name", "left").select(
        "table_name",
        F.concat(
            F.lit("CREATE TABLE `"), F.col("table_name"), F.lit("` (\n  "), body,
            F.lit(LEGACY_TABLE_SUFFIX),
        ).alias("ddl"),
    )


def spark_table_ddl(defs: DataFrame, fmt: str = "parquet") -> DataFrame:
    """W5 on the Spark side: ``CREATE TABLE IF NOT EXISTS ... USING <fmt>`` whose column
    types are the Spark carriers of the mapped target types."""
    carrier = F.when(F.lit(False), F.lit(None))
    for pattern, spark_name in (
        (r"^TINYINT\(1\)$|^BOOLEAN$", "BOOLEAN"),
        (r"^TINYINT$", "TINYINT"),
        (r"^SMALLINT$", "SMALLINT"),
        (r"^INT$", "INT"),
        (r"^BIGINT$", "BIGINT"),
        (r"^DOUBLE$", "DOUBLE"),
        (r"^FLOAT$", "FLOAT"),
        (r"^DATETIME", "TIMESTAMP_NTZ"),
        (r"^DATE$", "DATE"),
        (r"^(VAR)?BINARY|^LONGBLOB$", "BINARY"),
    ):
        carrier = carrier.when(F.regexp_like(F.upper("type_definition"), F.lit(pattern)), F.lit(spark_name))
    carrier = carrier.when(
        F.upper("type_definition").startswith("DECIMAL("), F.upper("type_definition")
    ).otherwise(F.lit("STRING"))
    col_text = F.concat(
        F.lit("`"), F.col("column_name"), F.lit("` "), carrier,
        F.when(~F.col("is_nullable"), F.lit(" NOT NULL")).otherwise(F.lit("")),
    )
    full = F.concat_ws(".", "table_schema", "table_name")
    grouped = defs.groupBy("table_schema", "table_name").agg(
        _ordered_join(F.struct(F.col("ordinal_position").alias("o"), col_text.alias("text")), ", ").alias("cols")
    )
    return grouped.select(
        names.target_table_name(full).alias("target_table"),
        F.concat(
            F.lit("CREATE TABLE IF NOT EXISTS `"), names.target_table_name(full), F.lit("` ("),
            F.col("cols"), F.lit(f") USING {fmt}"),
        ).alias("ddl"),
    )
