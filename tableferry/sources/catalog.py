"""Catalog DataFrames.

The column catalog stacks the columns of every table of a database into one DataFrame,
so type mapping, DDL rendering and name checks run once for all tables. For a parquet
source the declared text/binary lengths are profiled from the data: one aggregate per
table over only its text/binary columns (column pruning keeps the scan narrow; partial
aggregation means the shuffle carries one row per task).

For JDBC sources :func:`jdbc_information_schema` reads the server's own catalog, and the
``sys``-based fallbacks (S8, S10) are joins over catalog DataFrames.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions import typemap
from tableferry.sources.tables import Database

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("table_schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("length_kind", T.StringType()),
        T.StructField("numeric_precision", T.IntegerType()),
        T.StructField("numeric_scale", T.IntegerType()),
        T.StructField("is_nullable", T.StringType()),
        T.StructField("ordinal_position", T.IntegerType()),
        T.StructField("is_identity", T.IntegerType()),
        T.StructField("column_default", T.StringType()),
    ]
)

TABLES_SCHEMA = T.StructType(
    [
        T.StructField("table_schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("table_type", T.StringType()),
    ]
)


def table_catalog(spark: SparkSession, db: Database) -> DataFrame:
    """INFORMATION_SCHEMA.TABLES of a database (one row per table or view)."""
    rows = [(db.schema, t, db.table_types.get(t, "BASE TABLE")) for t in db.names()]
    return spark.createDataFrame(rows, TABLES_SCHEMA)


def _described(db: Database) -> list[tuple]:
    rows = []
    for t, df in db.tables.items():
        keys = db.keys(t)
        for pos, field in enumerate(df.schema.fields, start=1):
            data_type, prec, scale, kind = typemap.source_type_of(field.dataType)
            identity = int(
                keys == [field.name] and data_type in ("int", "bigint", "smallint", "tinyint")
            )
            rows.append(
                (db.schema, t, field.name, data_type, kind, prec, scale,
                 "YES" if field.nullable else "NO", pos, identity, None)
            )
    return rows


def schema_rows(spark: SparkSession, db: Database) -> DataFrame:
    """Column metadata read from the table schemas only (no data scanned)."""
    return spark.createDataFrame(_described(db), CATALOG_SCHEMA)


def measured_lengths(df: DataFrame) -> dict[str, int | None]:
    """The longest value of every text and binary column of one table: one aggregate, one row to the driver."""
    cols = [f.name for f in df.schema.fields if typemap.source_type_of(f.dataType)[3] is not None]
    if not cols:
        return {}
    row = df.agg(*[F.max(F.length(F.col(f"`{c}`"))).cast("bigint").alias(f"l{i}") for i, c in enumerate(cols)]).first()
    return dict(zip(cols, row))


def measured_catalog(spark: SparkSession, db: Database, lengths: dict[str, dict[str, int | None]]) -> DataFrame:
    """The column catalog of tables whose lengths were measured before (:func:`measured_lengths`): metadata only, no scan
    and no join, so whole-database jobs map all their tables in one plan. A table that is not in ``lengths`` is
    declared ``(max)``."""
    limits = {"chars": typemap.NVARCHAR_DECLARED_MAX, "bytes": typemap.VARBINARY_DECLARED_MAX}
    rows = []
    for row in _described(db):
        schema, table, column, data_type, kind, *rest = row
        longest = lengths[table].get(column) if table in lengths else -1
        declared = None if kind is None else -1 if longest is not None and longest > limits[kind] else longest
        rows.append((schema, table, column, data_type, declared, *rest))
    return spark.createDataFrame(rows, CATALOG_SCHEMA.simpleString()[7:-1].replace("length_kind:string", "character_maximum_length:bigint"))


def length_profile(db: Database) -> DataFrame | None:
    """Longest value (characters for text, bytes for binary) of every text/binary column.

    One aggregate per table, unpivoted to (table_name, column_name, max_length)."""
    parts = []
    for t, df in db.tables.items():
        cols = [
            f.name for f in df.schema.fields
            if typemap.source_type_of(f.dataType)[3] is not None
        ]
        if not cols:
            continue
        one = df.agg(*[F.max(F.length(F.col(f"`{c}`"))).cast("bigint").alias(c) for c in cols])
        parts.append(
            one.unpivot([], cols, "column_name", "max_length").withColumn("table_name", F.lit(t))
        )
    if not parts:
        return None
    return reduce(DataFrame.unionByName, parts)


def column_catalog(
    spark: SparkSession, db: Database, materialized: bool = True, profile_lengths: bool = True
) -> DataFrame:
    """INFORMATION_SCHEMA.COLUMNS of a parquet source, declared lengths from the data.

    Text longer than 4000 characters (binary longer than 8000 bytes) is declared as
    ``(max)``, reported as -1, as the source system does. The result (one row per
    column) is checkpointed so that its consumers do not re-run the profiling scan.

    ``profile_lengths=False`` skips the scan: text and binary are declared ``(max)`` (-1),
    which maps to LONGTEXT / LONGBLOB — nothing can be too long, and a transfer reads each
    table once."""
    base = schema_rows(spark, db)
    if not profile_lengths:
        base = base.withColumn(
            "character_maximum_length",
            F.when(F.col("length_kind").isNotNull(), F.lit(-1)).cast("bigint"),
        )
        return base.select(
            "table_schema", "table_name", "column_name", "data_type", "character_maximum_length",
            "numeric_precision", "numeric_scale", "is_nullable", "ordinal_position", "is_identity",
            "column_default",
        )
    profile = length_profile(db)
    if profile is None:
        base = base.withColumn("max_length", F.lit(None).cast("bigint"))
    else:
        # The profile has one row per text/binary column: its size is bounded by the schema.
        base = base.join(F.broadcast(profile), ["table_name", "column_name"], "left")
    limit = (
        F.when(F.col("length_kind") == "chars", F.lit(typemap.NVARCHAR_DECLARED_MAX))
        .when(F.col("length_kind") == "bytes", F.lit(typemap.VARBINARY_DECLARED_MAX))
    )
    declared = F.when(F.col("max_length") > limit, F.lit(-1).cast("bigint")).otherwise(
        F.col("max_length")
    )
    out = base.select(
        "table_schema",
        "table_name",
        "column_name",
        "data_type",
        F.when(F.col("length_kind").isNotNull(), declared).cast("bigint").alias("character_maximum_length"),
        "numeric_precision",
        "numeric_scale",
        "is_nullable",
        "ordinal_position",
        "is_identity",
        "column_default",
    )
    if materialized:
        from tableferry.session import materialize

        out = materialize(out)
    return out


def column_info(catalog: DataFrame) -> DataFrame:
    """The ColumnInfo form — type lower-cased, nullable and identity as booleans."""
    return catalog.select(
        "table_schema",
        "table_name",
        "column_name",
        F.lower(F.trim("data_type")).alias("data_type"),
        F.col("character_maximum_length").alias("max_length"),
        F.col("numeric_precision").alias("precision"),
        F.col("numeric_scale").alias("scale"),
        (F.upper("is_nullable") == "YES").alias("is_nullable"),
        "ordinal_position",
        (F.coalesce("is_identity", F.lit(0)) == 1).alias("is_identity"),
    )


def target_column_info(catalog: DataFrame) -> DataFrame:
    """S6, target variant: a length beyond the int range is reported as -1."""
    info = column_info(catalog)
    return info.withColumn(
        "max_length",
        F.when(F.col("max_length") > F.lit(2147483647), F.lit(-1).cast("bigint")).otherwise(
            F.col("max_length")
        ),
    )


def column_catalog_legacy(catalog: DataFrame) -> DataFrame:
    """The legacy 7-column form (adds the column default, nullable stays YES/NO)."""
    return catalog.select(
        "table_schema",
        "table_name",
        "column_name",
        "data_type",
        "character_maximum_length",
        "numeric_precision",
        "numeric_scale",
        "is_nullable",
        "column_default",
        "ordinal_position",
    )


def list_base_tables(tables: DataFrame) -> DataFrame:
    """S3: base tables as ``schema.table``, views excluded, ordered by schema and name."""
    return (
        tables.filter(F.col("table_type") == "BASE TABLE")
        .select(
            "table_schema",
            "table_name",
            F.concat_ws(".", "table_schema", "table_name").alias("full_name"),
        )
        .orderBy("table_schema", "table_name")
    )


def list_views(tables: DataFrame) -> DataFrame:
    """Views, ordered."""
    return (
        tables.filter(F.col("table_type") == "VIEW")
        .select("table_schema", "table_name")
        .orderBy("table_schema", "table_name")
    )


def row_counts(db: Database, names=None) -> DataFrame:
    """Exact row count per table, all tables in one job (bigint counts).
    Listed tables that could not be read appear with a NULL count."""
    names_given = list(names) if names is not None else None
    names = [t for t in names_given if t in db.tables] if names_given is not None else db.names()
    parts = [
        db.table(t).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(t).alias("table_name"), "row_count"
        )
        for t in names
    ]
    spark = SparkSession.getActiveSession()
    flagged = [t for t in (db.unreadable if names_given is None else names_given) if t in db.unreadable]
    if flagged:
        # Listed but unreadable: a row with a NULL count (S12 flags them).
        parts.append(spark.createDataFrame([(t, None) for t in flagged], "table_name string, row_count bigint"))
    if not parts:
        return spark.createDataFrame([], "table_name string, row_count bigint")
    return reduce(DataFrame.unionByName, parts)


def table_structure(spark: SparkSession, db: Database, names=None) -> DataFrame:
    """Ordered column names and the exact row count of each table."""
    names = list(names) if names is not None else db.names()
    cols = (
        schema_rows(spark, db.subset(names))
        .groupBy("table_schema", "table_name")
        .agg(
            F.array_sort(F.collect_list(F.struct("ordinal_position", "column_name"))).alias("cols"),
        )
        .select(
            "table_schema",
            "table_name",
            F.array_join(F.transform("cols", lambda s: s["column_name"]), ",").alias("column_list"),
            F.size("cols").cast("bigint").alias("column_count"),
        )
    )
    return cols.join(F.broadcast(row_counts(db, names)), "table_name", "inner")


def known_tables(requested: DataFrame, tables: DataFrame, name_col: str = "table_name") -> DataFrame:
    """Requested names that exist (exact, case-sensitive match)."""
    return requested.join(
        tables.select(F.col("table_name").alias(name_col)).distinct(), name_col, "left_semi"
    )


def unknown_tables(requested: DataFrame, tables: DataFrame, name_col: str = "table_name") -> DataFrame:
    """Requested names that do not exist."""
    return requested.join(
        tables.select(F.col("table_name").alias(name_col)).distinct(), name_col, "left_anti"
    )


def column_catalog_sys(
    sys_columns: DataFrame,
    sys_types: DataFrame,
    sys_tables: DataFrame,
    sys_schemas: DataFrame,
    sys_default_constraints: DataFrame,
) -> DataFrame:
    """The legacy ``sys`` catalog join (3 inner joins + 1 left join + CASE projections)."""
    c = sys_columns.alias("c")
    t = sys_types.alias("t")
    tb = sys_tables.alias("tb")
    s = sys_schemas.alias("s")
    d = sys_default_constraints.alias("d")
    tname = F.col("t.name")
    joined = (
        c.join(t, F.col("c.user_type_id") == F.col("t.user_type_id"))
        .join(tb, F.col("c.object_id") == F.col("tb.object_id"))
        .join(s, F.col("tb.schema_id") == F.col("s.schema_id"))
        .join(d, F.col("c.default_object_id") == F.col("d.object_id"), "left")
    )
    return joined.select(
        F.col("s.name").alias("table_schema"),
        F.col("tb.name").alias("table_name"),
        F.col("c.name").alias("column_name"),
        tname.alias("data_type"),
        F.when(
            tname.isin("varchar", "nvarchar", "char", "nchar"),
            F.when(F.col("c.max_length") != -1, F.col("c.max_length")),
        ).cast("bigint").alias("character_maximum_length"),
        F.when(tname.isin("decimal", "numeric", "float", "real"), F.col("c.precision"))
        .cast("int").alias("numeric_precision"),
        F.when(tname.isin("decimal", "numeric"), F.col("c.scale")).cast("int").alias("numeric_scale"),
        F.when(F.col("c.is_nullable") == 1, F.lit("YES")).otherwise(F.lit("NO")).alias("is_nullable"),
        F.col("d.definition").alias("column_default"),
        F.col("c.column_id").alias("ordinal_position"),
    )


# Storage bytes of fixed-size source types (sys.columns.max_length).
_FIXED_BYTES = {"int": 4, "bigint": 8, "smallint": 2, "tinyint": 1, "bit": 1, "float": 8, "real": 4,
                "datetime2": 8, "datetimeoffset": 10, "date": 3}


def sys_catalog_frames(catalog_df: DataFrame):
    """The catalog in the source system's ``sys.*`` form, derived with DataFrame ops:
    (sys_columns, sys_types, sys_tables, sys_schemas, sys_default_constraints).

    Ids are 64-bit hashes of the names; text lengths are in bytes as the system stores
    them (nvarchar: 2 per character; (max) = -1)."""
    spark = catalog_df.sparkSession
    obj = F.xxhash64("table_schema", "table_name")
    sch = F.xxhash64("table_schema")
    typ = F.xxhash64("data_type")
    fixed = F.try_element_at(
        F.create_map(*[x for k, v in _FIXED_BYTES.items() for x in (F.lit(k), F.lit(v))]), F.col("data_type")
    )
    length = F.col("character_maximum_length")
    max_length = (
        F.when(length == -1, F.lit(-1))
        .when(F.col("data_type").isin("nvarchar", "nchar"), length * 2)
        .when(length.isNotNull(), length)
        .otherwise(F.coalesce(fixed, F.lit(16)))
    ).cast("int")
    sys_columns = catalog_df.select(
        obj.alias("object_id"),
        F.col("ordinal_position").alias("column_id"),
        F.col("column_name").alias("name"),
        typ.alias("user_type_id"),
        max_length.alias("max_length"),
        F.coalesce("numeric_precision", F.lit(0)).alias("precision"),
        F.coalesce("numeric_scale", F.lit(0)).alias("scale"),
        (F.upper("is_nullable") == "YES").cast("int").alias("is_nullable"),
        F.lit(0).cast("bigint").alias("default_object_id"),
    )
    sys_types = catalog_df.select(typ.alias("user_type_id"), F.col("data_type").alias("name")).distinct()
    sys_tables = catalog_df.select(
        obj.alias("object_id"), sch.alias("schema_id"), F.col("table_name").alias("name")
    ).distinct()
    sys_schemas = catalog_df.select(sch.alias("schema_id"), F.col("table_schema").alias("name")).distinct()
    defaults = spark.createDataFrame([], "object_id bigint, definition string")
    return sys_columns, sys_types, sys_tables, sys_schemas, defaults


# ODBC type codes of a result-set description -> source type (legacy probe).
ODBC_TYPE_CODES = {
    1: "varchar",
    4: "int",
    6: "float",
    7: "real",
    8: "float",
    12: "varchar",
    91: "date",
    93: "datetime",
    -1: "text",
    -7: "bit",
}

# Spark types -> the ODBC code a driver would describe them with.
_SPARK_TO_ODBC = {
    "int": 4, "bigint": -5, "smallint": 5, "tinyint": -6, "boolean": -7, "double": 8,
    "float": 7, "string": 12, "timestamp_ntz": 93, "timestamp": 93, "date": 91, "binary": -3,
}


def schema_probe(spark: SparkSession, df: DataFrame, name: str = "t") -> DataFrame:
    """Names, coarse types and display sizes as a one-row probe's result description
    reports them. Names and types come from ``limit(0).schema``; unknown codes fall back
    to varchar; the display size of a text column is its longest value (one aggregate
    over the text columns, the same profile as the column catalog)."""
    fields = df.limit(0).schema.fields
    rows = [
        (pos, f.name, _SPARK_TO_ODBC.get(f.dataType.simpleString(), 1111),
         ODBC_TYPE_CODES.get(_SPARK_TO_ODBC.get(f.dataType.simpleString(), 1111), "varchar"),
         "YES" if f.nullable else "NO")
        for pos, f in enumerate(fields, start=1)
    ]
    described = spark.createDataFrame(
        rows, "ordinal_position int, column_name string, type_code int, data_type string, is_nullable string"
    )
    sizes = length_profile(Database("probe", {name: df}))
    if sizes is None:
        return described.withColumn("max_length", F.lit(None).cast("bigint"))
    # One row per text column: bounded by the schema.
    return described.join(F.broadcast(sizes.drop("table_name")), "column_name", "left").select(
        "ordinal_position", "column_name", "type_code", "data_type",
        F.when(F.col("max_length") > 0, F.col("max_length")).alias("max_length"), "is_nullable",
    )


def primary_keys(
    key_column_usage: DataFrame,
    sys_key_constraints: DataFrame | None = None,
    sys_index_columns: DataFrame | None = None,
    sys_columns: DataFrame | None = None,
    sys_tables: DataFrame | None = None,
    sys_schemas: DataFrame | None = None,
) -> DataFrame:
    """PK columns per table in key order.

    First route: constraints named ``PK%``. Fallback (used per table only where the first
    route found nothing): key_constraints ⋈ index_columns ⋈ columns ⋈ tables ⋈ schemas."""
    first = key_column_usage.filter(F.col("constraint_name").like("PK%")).select(
        "table_schema", "table_name", "column_name", F.col("ordinal_position").alias("key_ordinal")
    )
    if sys_key_constraints is None:
        return first
    k = sys_key_constraints.alias("k")
    ic = sys_index_columns.alias("ic")
    c = sys_columns.alias("c")
    t = sys_tables.alias("t")
    s = sys_schemas.alias("s")
    fallback = (
        k.filter(F.col("k.type") == "PK")
        .join(ic, (F.col("k.parent_object_id") == F.col("ic.object_id"))
              & (F.col("k.unique_index_id") == F.col("ic.index_id")))
        .join(c, (F.col("ic.object_id") == F.col("c.object_id"))
              & (F.col("ic.column_id") == F.col("c.column_id")))
        .join(t, F.col("k.parent_object_id") == F.col("t.object_id"))
        .join(s, F.col("t.schema_id") == F.col("s.schema_id"))
        .select(
            F.col("s.name").alias("table_schema"),
            F.col("t.name").alias("table_name"),
            F.col("c.name").alias("column_name"),
            F.col("ic.key_ordinal").alias("key_ordinal"),
        )
    )
    covered = first.select("table_schema", "table_name").distinct()
    return first.unionByName(fallback.join(covered, ["table_schema", "table_name"], "left_anti"))


def foreign_keys(
    referential_constraints: DataFrame, key_column_usage: DataFrame, compat: bool = False
) -> DataFrame:
    """FK column -> referenced table and column.

    The referencing and referenced key columns are paired by ordinal position, so a
    composite key of n columns yields n pairs. ``compat=True`` joins on constraint names
    only and reproduces the n x n pairs of the legacy query (quirk Q14)."""
    rc = referential_constraints.alias("rc")
    k1 = key_column_usage.alias("k1")
    k2 = key_column_usage.alias("k2")
    cond2 = F.col("rc.unique_constraint_name") == F.col("k2.constraint_name")
    if not compat:
        cond2 = cond2 & (F.col("k1.ordinal_position") == F.col("k2.ordinal_position"))
    return (
        rc.join(k1, F.col("rc.constraint_name") == F.col("k1.constraint_name"))
        .join(k2, cond2)
        .select(
            F.col("k1.table_schema").alias("table_schema"),
            F.col("k1.table_name").alias("table_name"),
            F.col("k1.column_name").alias("column_name"),
            F.col("k2.table_name").alias("referenced_table_name"),
            F.col("k2.column_name").alias("referenced_column_name"),
        )
    )


def jdbc_information_schema(spark: SparkSession, url: str, properties: dict | None = None) -> DataFrame:
    """The server's INFORMATION_SCHEMA.COLUMNS as a DataFrame (one query, run server-side)."""
    from tableferry.sources.tables import read_jdbc_query

    q = (
        "SELECT TABLE_SCHEMA, TABLE_NAME, COLUMN_NAME, DATA_TYPE, CHARACTER_MAXIMUM_LENGTH, "
        "NUMERIC_PRECISION, NUMERIC_SCALE, IS_NULLABLE, ORDINAL_POSITION, COLUMN_DEFAULT "
        "FROM INFORMATION_SCHEMA.COLUMNS"
    )
    df = read_jdbc_query(spark, url, q, properties)
    return df.toDF(*[c.lower() for c in df.columns])
