"""A row is rejected exactly when it has a suspect cell; the ordered fallback equals a loop over the rows."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from tableferry.functions import typemap
from tableferry.operators import quality

VALUES = {
    "string": [None, "", "a", "12345", "300", "-129", "3.7", "99999999999", "1e3", "abc", "true", "2024-01-02", "2024-13-02", "2024-01-02 03:04:05", "ä" * 5, "x" * 70_000, "999.995", "-1000", "NaN"],
    "bigint": [None, 0, 127, 128, -129, 40_000, 2**31, -(2**31) - 1, 2**63 - 1, -(2**63)],
    "double": [None, 0.5, 127.9, 999.994, 999.995, -1000.0, 1e19, -1e300, float("nan"), float("inf")],
    "decimal(20,4)": [None, decimal.Decimal("1.2345"), decimal.Decimal("999.9949"), decimal.Decimal("999.9950"), decimal.Decimal("9999999999999999.9999")],
    "binary": [None, b"", b"ab", b"abc", b"\xff" * 300],
    "date": [None, datetime.date(2024, 1, 2)],
    "boolean": [None, True, False],
    "array<float>": [None, [], [1.5, 2.5]],
}
TARGETS = {
    "string": ["TINYINT", "SMALLINT", "INT", "BIGINT", "DECIMAL(5,2)", "DECIMAL(38,0)", "DOUBLE", "FLOAT", "TINYINT(1)", "DATE", "DATETIME", "DATETIME(6)", "CHAR(1)", "VARCHAR(5)", "TEXT", "LONGTEXT", "VARBINARY(2)", "BINARY(5)", "TINYTEXT"],
    "bigint": ["TINYINT", "SMALLINT", "INT", "BIGINT", "DECIMAL(5,2)", "DECIMAL(18,0)", "DOUBLE", "VARCHAR(3)", "TINYINT(1)"],
    "double": ["TINYINT", "INT", "BIGINT", "DECIMAL(5,2)", "FLOAT", "DOUBLE", "VARCHAR(4)"],
    "decimal(20,4)": ["DECIMAL(5,2)", "DECIMAL(20,4)", "INT", "BIGINT", "DOUBLE"],
    "binary": ["VARBINARY(2)", "BINARY(1)", "LONGBLOB", "TEXT"],
    "date": ["DATE", "DATETIME", "VARCHAR(8)"],
    "boolean": ["TINYINT(1)", "INT", "VARCHAR(4)"],
    "array<float>": ["TEXT", "VARCHAR(4)"],
}


@pytest.mark.parametrize("source", VALUES)
def test_rejected_exactly_when_suspect(spark, source):
    rows = list(enumerate(VALUES[source]))
    names = [f"c{i}" for i in range(len(TARGETS[source]))]
    base = spark.createDataFrame(rows, f"id int, v {source}")
    df = base.select("id", *[F.col("v").alias(n) for n in names])
    types = dict(zip(names, TARGETS[source]))
    # What the load does with each cell, cell by cell.
    lost = df.select("id", *[(F.col(n).isNotNull() & typemap.to_target(F.col(n), t).isNull()).alias(n) for n, t in types.items()])
    rejected = {(r["id"], n) for r in lost.collect() for n in names if r[n]}
    cells = quality.suspect_cells(df, "id", types).collect()
    assert {(r["id"], r["column_name"]) for r in cells} == rejected and len(cells) == len(rejected)
    assert {r["code"] for r in cells} <= {"1406", "1264", "1292", "1366"}
    tagged = quality.quarantine(df, types).where("reject_reasons IS NOT NULL").collect()
    assert {r["id"] for r in tagged} == {i for i, _ in rejected}
    assert {(r["id"], p.split(":")[0]) for r in tagged for p in r["reject_reasons"].split(",")} == rejected
    # The strict load fails on each such cell alone and takes every other.
    for n, t in types.items():
        good = df.where(~F.col("id").isin([i for i, m in rejected if m == n] or [-1])).select(typemap.to_target(F.col(n), t, strict=True).alias("v"))
        good.agg(F.count("v")).collect()
        for i in [i for i, m in rejected if m == n][:2]:
            with pytest.raises(Exception):
                df.where(F.col("id") == i).select(typemap.to_target(F.col(n), t, strict=True).alias("v")).agg(F.count("v")).collect()


def test_codes(spark):
    df = spark.createDataFrame([(1, "300", "abc", "2024-13-01", "toolong", bytearray(b"abc"), 1000.0)], "id int, a string, b string, c string, d string, e binary, f double")
    types = {"a": "TINYINT", "b": "INT", "c": "DATE", "d": "VARCHAR(5)", "e": "VARBINARY(2)", "f": "DECIMAL(5,2)"}
    got = {r.column_name: (r.code, r.value) for r in quality.suspect_cells(df, "id", types).collect()}
    assert got == {"a": ("1264", "300"), "b": ("1366", "abc"), "c": ("1292", "2024-13-01"), "d": ("1406", "toolong"), "e": ("1406", "616263"), "f": ("1264", "1000.0")}
    limits, ranges = quality.target_rules(df, {**types, "b": "TEXT"})
    assert limits == {"d": 5, "e": 2, "b": "TEXT"} and ranges["f"] == "DECIMAL(5,2)"
    assert [r.column_name for r in quality.too_long(df, "id", limits).collect()] == ["d", "e"]
    assert {(r.column_name, r.value) for r in quality.out_of_range(df, "id", ranges).collect()} == {("a", "300"), ("f", "1000.0")}


def loop(rows, bad, max_errors):
    kept, errors = [], 0
    for row in rows:
        if bad(row):
            errors += 1
            if errors > max_errors:
                break
        else:
            kept.append(row)
    return kept, errors


@pytest.mark.parametrize("every, max_errors", [(7, 10), (3, 10), (1, 0), (1000, 10), (2, 3)])
def test_fallback_equals_a_loop_over_the_rows(spark, every, max_errors):
    rows = [(i * 37 % 500, 300 if i * 37 % 500 % every == 0 else 5) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, v long").repartition(5)
    out = quality.load_in_order(df, {"v": "TINYINT"}, ["id"], max_errors)
    kept, errors = loop(sorted(rows), lambda r: r[1] > 127, max_errors)
    assert sorted((r.id, r.v) for r in out.kept.collect()) == kept
    assert out.errors.count() == errors and (out.stop_row is None) == (errors <= max_errors)
    assert [r.row_no for r in out.kept.orderBy("row_no").collect()] == [i + 1 for i, r in enumerate(sorted(rows)) if r in set(kept)]


def test_fallback_of_odd_tables(spark):
    empty = quality.load_in_order(spark.createDataFrame([], "id long, v long"), {"v": "TINYINT"}, [])
    assert empty.kept.count() == 0 and empty.errors.count() == 0 and empty.stop_row is None
    nulls = spark.createDataFrame([(None, 300), (None, 1), (1, 300), (1, 300), (1, None)], "id long, v long")
    out = quality.load_in_order(nulls, {"v": "TINYINT"}, ["id"], 1)
    assert out.errors.count() == 2 and out.kept.count() <= 2 and out.stop_row in (3, 4)
