"""Type mapping golden cases (the reference's unit-test cases plus missed boundaries)."""

import pytest
from pyspark.sql import functions as F

from tableferry.functions import typemap
from tableferry.operators import ddl

# (type, max_length, precision, scale) -> current target
CURRENT = [
    ("int", None, None, None, "INT"),
    ("bigint", None, None, None, "BIGINT"),
    ("smallint", None, None, None, "SMALLINT"),
    ("tinyint", None, None, None, "TINYINT"),
    ("bit", None, None, None, "TINYINT(1)"),
    ("varchar", 50, None, None, "VARCHAR(50)"),
    ("varchar", 255, None, None, "VARCHAR(255)"),
    ("nvarchar", 100, None, None, "VARCHAR(100)"),
    ("varchar", -1, None, None, "LONGTEXT"),
    ("nvarchar", -1, None, None, "LONGTEXT"),
    ("nvarchar", 20000, None, None, "LONGTEXT"),
    ("varchar", None, None, None, "VARCHAR(255)"),
    ("varchar", 0, None, None, "VARCHAR(255)"),
    ("varchar", -2, None, None, "VARCHAR(255)"),
    ("varchar", 16383, None, None, "VARCHAR(16383)"),
    ("varchar", 16384, None, None, "LONGTEXT"),
    ("char", 10, None, None, "CHAR(10)"),
    ("nchar", 1, None, None, "CHAR(1)"),
    ("char", 255, None, None, "CHAR(255)"),
    ("char", 256, None, None, "VARCHAR(256)"),
    ("char", 300, None, None, "VARCHAR(300)"),
    ("char", None, None, None, "CHAR(1)"),
    ("text", None, None, None, "TEXT"),
    ("ntext", None, None, None, "LONGTEXT"),
    ("decimal", None, 18, 2, "DECIMAL(18,2)"),
    ("decimal", None, 10, 4, "DECIMAL(10,4)"),
    ("numeric", None, 5, 0, "DECIMAL(5,0)"),
    ("decimal", None, None, None, "DECIMAL(18,0)"),
    ("money", None, None, None, "DECIMAL(19,4)"),
    ("smallmoney", None, None, None, "DECIMAL(10,4)"),
    ("float", None, None, None, "DOUBLE"),
    ("real", None, None, None, "FLOAT"),
    ("datetime", None, None, None, "DATETIME"),
    ("datetime2", None, None, None, "DATETIME(6)"),
    ("smalldatetime", None, None, None, "DATETIME"),
    ("date", None, None, None, "DATE"),
    ("time", None, None, None, "TIME"),
    ("datetimeoffset", None, None, None, "DATETIME(6)"),
    ("binary", 8, None, None, "BINARY(8)"),
    ("binary", None, None, None, "BINARY(1)"),
    ("varbinary", 100, None, None, "VARBINARY(100)"),
    ("varbinary", -1, None, None, "LONGBLOB"),
    ("varbinary", 70000, None, None, "LONGBLOB"),
    ("varbinary", 65535, None, None, "VARBINARY(65535)"),
    ("varbinary", 65536, None, None, "LONGBLOB"),
    ("varbinary", None, None, None, "VARBINARY(255)"),
    ("image", None, None, None, "LONGBLOB"),
    ("timestamp", None, None, None, "BINARY(8)"),
    ("rowversion", None, None, None, "BINARY(8)"),
    ("uniqueidentifier", None, None, None, "VARCHAR(36)"),
    ("xml", None, None, None, "LONGTEXT"),
    ("hierarchyid", None, None, None, "VARCHAR(892)"),
    ("geography", None, None, None, "LONGTEXT"),
    ("geometry", None, None, None, "LONGTEXT"),
    ("sql_variant", None, None, None, "TEXT"),
    ("customtype", None, None, None, "TEXT"),
    ("INT", None, None, None, "INT"),
    ("Int", None, None, None, "INT"),
    ("VARCHAR", 50, None, None, "VARCHAR(50)"),
    (" int ", None, None, None, "INT"),
]

LEGACY = [
    ("bit", None, None, None, "BOOLEAN"),
    ("decimal", None, 18, 2, "DECIMAL(18,2)"),
    ("decimal", None, None, None, "DECIMAL(10,2)"),
    ("decimal", None, 0, 2, "DECIMAL(10,2)"),
    ("decimal", None, 12, None, "DECIMAL(10,2)"),
    ("varchar", 50, None, None, "VARCHAR(50)"),
    ("varchar", -1, None, None, "TEXT"),
    ("varchar", 16384, None, None, "TEXT"),
    ("varchar", None, None, None, "TEXT"),
    ("char", 300, None, None, "VARCHAR(300)"),
    ("char", None, None, None, "CHAR(1)"),
    ("datetime2", None, None, None, "DATETIME"),
    ("smallmoney", None, None, None, "TEXT"),
    ("image", None, None, None, "TEXT"),
    ("uniqueidentifier", None, None, None, "VARCHAR(36)"),
]

SCHEMA = "data_type string, character_maximum_length bigint, numeric_precision int, numeric_scale int, expected string"


def _check(spark, cases, profile):
    df = spark.createDataFrame(cases, SCHEMA)
    out = ddl.map_types(df, profile).collect()
    wrong = [(r.data_type, r.character_maximum_length, r.target_type, r.expected) for r in out if r.target_type != r.expected]
    assert not wrong


def test_current_profile(spark):
    _check(spark, CURRENT, "current")


def test_legacy_profile(spark):
    _check(spark, LEGACY, "legacy")


def test_current_map_has_34_entries():
    assert len(typemap.CURRENT_TYPE_MAP) == 34
    assert len(typemap.LEGACY_TYPE_MAP) == 21


@pytest.mark.parametrize("preserve,expected", [(True, False), (False, True)])
def test_identity_becomes_auto_increment_only_when_values_are_not_preserved(spark, preserve, expected):
    cat = spark.createDataFrame(
        [("dbo", "t", "id", "int", None, 10, 0, "NO", 1, 1, None), ("dbo", "t", "v", "int", None, 10, 0, "YES", 2, 0, None)],
        "table_schema string, table_name string, column_name string, data_type string, "
        "character_maximum_length bigint, numeric_precision int, numeric_scale int, is_nullable string, "
        "ordinal_position int, is_identity int, column_default string",
    )
    rows = {r.column_name: r for r in ddl.column_definitions(cat, preserve).collect()}
    assert rows["id"].is_auto_increment is expected
    assert rows["v"].is_auto_increment is False
    assert rows["id"].is_nullable is False and rows["v"].is_nullable is True


def test_to_target_datetime_keeps_whole_seconds(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 10:00:00.789' AS ts")
    v = df.select(typemap.to_target(F.col("ts"), "DATETIME").alias("x")).first().x
    assert v.microsecond == 0 and v.second == 0
    v6 = df.select(typemap.to_target(F.col("ts"), "DATETIME(6)").alias("x")).first().x
    assert v6.microsecond == 789000


def test_time_carrier_is_flagged():
    from pyspark.sql import types as T

    assert typemap.spark_type_for("TIME") == T.StringType()
    assert typemap.spark_type_for("TIME", time_enabled=True) == T.TimeType(6)
    assert typemap.spark_type_for("DECIMAL(19,4)") == T.DecimalType(19, 4)
    assert typemap.spark_type_for("TINYINT(1)") == T.BooleanType()
