"""Type mapping as column expressions (P1 current profile, P2 legacy profile, P3).

The mapping is applied to a *catalog DataFrame* (one row per source column of many
tables), so a whole database is mapped in one projection. The fixed lookup is a literal
map expression: it stays inside whole-stage codegen and needs no join or shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source type -> target type, current profile (34 entries).
# Entries whose target is completed by a rule (length, precision) carry the bare name.
CURRENT_TYPE_MAP = {
    "int": "INT",
    "bigint": "BIGINT",
    "smallint": "SMALLINT",
    "tinyint": "TINYINT",
    "bit": "TINYINT(1)",
    "decimal": "DECIMAL",
    "numeric": "DECIMAL",
    "money": "DECIMAL(19,4)",
    "smallmoney": "DECIMAL(10,4)",
    "float": "DOUBLE",
    "real": "FLOAT",
    "datetime": "DATETIME",
    "datetime2": "DATETIME(6)",
    "smalldatetime": "DATETIME",
    "date": "DATE",
    "time": "TIME",
    "datetimeoffset": "DATETIME(6)",
    "varchar": "VARCHAR",
    "nvarchar": "VARCHAR",
    "char": "CHAR",
    "nchar": "CHAR",
    "text": "TEXT",
    "ntext": "LONGTEXT",
    "binary": "BINARY",
    "varbinary": "VARBINARY",
    "image": "LONGBLOB",
    "uniqueidentifier": "VARCHAR(36)",
    "xml": "LONGTEXT",
    "sql_variant": "TEXT",
    "hierarchyid": "VARCHAR(892)",
    "geography": "LONGTEXT",
    "geometry": "LONGTEXT",
    "timestamp": "BINARY(8)",
    "rowversion": "BINARY(8)",
}

# Source type -> target type, legacy profile (21 entries).
LEGACY_TYPE_MAP = {
    "int": "INT",
    "bigint": "BIGINT",
    "smallint": "SMALLINT",
    "tinyint": "TINYINT",
    "bit": "BOOLEAN",
    "decimal": "DECIMAL",
    "numeric": "DECIMAL",
    "money": "DECIMAL(19,4)",
    "float": "DOUBLE",
    "real": "FLOAT",
    "datetime": "DATETIME",
    "datetime2": "DATETIME",
    "date": "DATE",
    "time": "TIME",
    "varchar": "VARCHAR",
    "nvarchar": "VARCHAR",
    "char": "CHAR",
    "nchar": "CHAR",
    "text": "TEXT",
    "ntext": "LONGTEXT",
    "uniqueidentifier": "VARCHAR(36)",
}

# Boundaries of the parameterised rules.
VARCHAR_MAX = 16383      # longest VARCHAR before a text type
CHAR_MAX = 255           # longest CHAR before VARCHAR
VARBINARY_MAX = 65535    # longest VARBINARY before LONGBLOB
UNKNOWN_TARGET = "TEXT"

# Numeric source types whose extremes the legacy validation compares (quirk Q19).
EXTREME_SOURCE_TYPES = ("int", "bigint", "decimal", "numeric", "float", "real", "money")


def _lookup(mapping: dict, key: Column) -> Column:
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), key)


def _n(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def map_type(data_type, max_length, precision, scale) -> Column:
    """Target type text for a source column, current profile.

    Lookup is trimmed and case-insensitive; an unknown type maps to TEXT."""
    t = F.lower(F.trim(_n(data_type)))
    L = _n(max_length).cast("bigint")
    p, s = _n(precision), _n(scale)
    base = _lookup(CURRENT_TYPE_MAP, t)
    varchar = (
        F.when((L == -1) | (L > VARCHAR_MAX), F.lit("LONGTEXT"))
        .when(L > 0, F.concat(F.lit("VARCHAR("), L.cast("string"), F.lit(")")))
        .otherwise(F.lit("VARCHAR(255)"))
    )
    char = (
        F.when((L > 0) & (L <= CHAR_MAX), F.concat(F.lit("CHAR("), L.cast("string"), F.lit(")")))
        .when(L > CHAR_MAX, F.concat(F.lit("VARCHAR("), L.cast("string"), F.lit(")")))
        .otherwise(F.lit("CHAR(1)"))
    )
    decimal = F.concat(
        F.lit("DECIMAL("),
        F.coalesce(p.cast("string"), F.lit("18")),
        F.lit(","),
        F.coalesce(s.cast("string"), F.lit("0")),
        F.lit(")"),
    )
    binary = F.when(L > 0, F.concat(F.lit("BINARY("), L.cast("string"), F.lit(")"))).otherwise(
        F.lit("BINARY(1)")
    )
    varbinary = (
        F.when((L == -1) | (L > VARBINARY_MAX), F.lit("LONGBLOB"))
        .when(L > 0, F.concat(F.lit("VARBINARY("), L.cast("string"), F.lit(")")))
        .otherwise(F.lit("VARBINARY(255)"))
    )
    return (
        F.when(base.isNull(), F.lit(UNKNOWN_TARGET))
        .when(t.isin("varchar", "nvarchar"), varchar)
        .when(t.isin("char", "nchar"), char)
        .when(t.isin("decimal", "numeric"), decimal)
        .when(t == "binary", binary)
        .when(t == "varbinary", varbinary)
        .otherwise(base)
    )


def map_type_legacy(data_type, max_length, precision, scale) -> Column:
    """Target type text, legacy profile (lower-cased lookup, no trim)."""
    t = F.lower(_n(data_type))
    L = _n(max_length).cast("bigint")
    p, s = _n(precision), _n(scale)
    base = F.coalesce(_lookup(LEGACY_TYPE_MAP, t), F.lit(UNKNOWN_TARGET))
    # "precision truthy and scale not None": precision NULL or 0 falls back to DECIMAL(10,2).
    decimal = F.when(
        p.isNotNull() & (p != 0) & s.isNotNull(),
        F.concat(F.lit("DECIMAL("), p.cast("string"), F.lit(","), s.cast("string"), F.lit(")")),
    ).otherwise(F.lit("DECIMAL(10,2)"))
    varchar = (
        F.when(L > VARCHAR_MAX, F.lit("TEXT"))
        .when(L > 0, F.concat(F.lit("VARCHAR("), L.cast("string"), F.lit(")")))
        .otherwise(F.lit("TEXT"))
    )
    char = (
        F.when(L > CHAR_MAX, F.concat(F.lit("VARCHAR("), L.cast("string"), F.lit(")")))
        .when(L > 0, F.concat(F.lit("CHAR("), L.cast("string"), F.lit(")")))
        .otherwise(F.lit("CHAR(1)"))
    )
    return (
        F.when(t.isin("decimal", "numeric"), decimal)
        .when(t.isin("varchar", "nvarchar"), varchar)
        .when(t.isin("char", "nchar"), char)
        .otherwise(base)
    )


def auto_increment(is_identity, preserve_values: bool = True) -> Column:
    """AUTO_INCREMENT only for identity columns when values are not preserved."""
    ident = F.coalesce(_n(is_identity).cast("boolean"), F.lit(False))
    return ident & F.lit(not preserve_values)


# Signed integer ranges of the target integer types.
INTEGER_RANGES = {
    "TINYINT": (-128, 127),
    "SMALLINT": (-32768, 32767),
    "INT": (-2147483648, 2147483647),
    "BIGINT": (-9223372036854775808, 9223372036854775807),
}


def spark_type_for(target_type: str, time_enabled: bool = False) -> T.DataType:
    """The Spark type that carries values of a target type after loading."""
    t = target_type.strip().upper()
    if t in ("TINYINT(1)", "BOOLEAN", "BIT(1)"):
        return T.BooleanType()
    if t == "TINYINT":
        return T.ByteType()
    if t == "SMALLINT":
        return T.ShortType()
    if t == "INT":
        return T.IntegerType()
    if t == "BIGINT":
        return T.LongType()
    if t.startswith("DECIMAL("):
        p, s = (int(x) for x in t[len("DECIMAL("):-1].split(","))
        if p > 38 or s > 38:
            raise ValueError(f"{t}: more digits than a decimal of 38 holds")
        return T.DecimalType(p, s)
    if t == "DOUBLE":
        return T.DoubleType()
    if t == "FLOAT":
        return T.FloatType()
    if t.startswith("DATETIME"):
        return T.TimestampNTZType()
    if t == "DATE":
        return T.DateType()
    if t == "TIME":
        return T.TimeType(6) if time_enabled else T.StringType()
    if t.startswith(("BINARY", "VARBINARY")) or t == "LONGBLOB":
        return T.BinaryType()
    return T.StringType()


# Bytes that the text types hold.
TEXT_BYTES = {"TINYTEXT": 255, "TEXT": 65535, "MEDIUMTEXT": 16777215}


def over_long(v: Column, target_type: str) -> Column | None:
    """Whether a cast value is longer than its target type holds; None where nothing limits it."""
    t = target_type.strip().upper()
    declared = re.match(r"(?:VAR)?(CHAR|BINARY)\((\d+)\)", t)
    if declared:
        size = F.char_length(v) if declared[1] == "CHAR" else F.octet_length(v)
        return size > int(declared[2])
    return F.octet_length(v) > TEXT_BYTES[t] if t in TEXT_BYTES else None


def to_target(c: Column, target_type: str, strict: bool = False) -> Column:
    """A value as stored in ``target_type``: cast to the Spark carrier; DATETIME without
    fractional digits keeps whole seconds. A value that does not fit, by its type or by its
    length, becomes NULL, or fails the task when ``strict``."""
    v = c.cast(spark_type_for(target_type)) if strict else c.try_cast(spark_type_for(target_type))
    if target_type.strip().upper() == "DATETIME":
        v = F.date_trunc("second", v).cast("timestamp_ntz")
    if strict and isinstance(spark_type_for(target_type), T.DecimalType):  # NaN and infinity cast to NULL without an error
        v = F.when(c.isNotNull() & v.isNull(), F.raise_error(F.lit(f"no {target_type}")).cast(spark_type_for(target_type))).otherwise(v)
    over = over_long(v, target_type)
    if over is None:
        return v
    if strict:
        failed = F.raise_error(F.lit(f"value too long for {target_type}")).cast(spark_type_for(target_type))
        return F.when(over, failed).otherwise(v)
    return F.when(~over, v)


def source_type_of(dt: T.DataType) -> tuple[str, int | None, int | None, str | None]:
    """Catalog description of a Spark column in source-system terms.

    Returns (data_type, numeric_precision, numeric_scale, length_kind) where length_kind
    says whether the declared length is profiled from the data ('chars' / 'bytes')."""
    if isinstance(dt, T.IntegerType):
        return "int", 10, 0, None
    if isinstance(dt, T.LongType):
        return "bigint", 19, 0, None
    if isinstance(dt, T.ShortType):
        return "smallint", 5, 0, None
    if isinstance(dt, T.ByteType):
        return "tinyint", 3, 0, None
    if isinstance(dt, T.BooleanType):
        return "bit", None, None, None
    if isinstance(dt, T.DoubleType):
        return "float", 53, None, None
    if isinstance(dt, T.FloatType):
        return "real", 24, None, None
    if isinstance(dt, T.DecimalType):
        return "decimal", dt.precision, dt.scale, None
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return "nvarchar", None, None, "chars"
    if isinstance(dt, T.BinaryType):
        return "varbinary", None, None, "bytes"
    if isinstance(dt, T.TimestampNTZType):
        return "datetime2", None, None, None
    if isinstance(dt, T.TimestampType):
        return "datetimeoffset", None, None, None
    if isinstance(dt, T.DateType):
        return "date", None, None, None
    return dt.simpleString(), None, None, None


# Longest declared lengths before a source column counts as "(max)", reported as -1.
NVARCHAR_DECLARED_MAX = 4000
VARBINARY_DECLARED_MAX = 8000
