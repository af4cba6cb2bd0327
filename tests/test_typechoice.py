"""Target types from values, against casting every candidate there and back."""

import datetime as dt
import decimal
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions import typemap
from tableferry.operators import conform, typechoice

INTEGERS = ["TINYINT", "SMALLINT", "INT", "BIGINT"]
MOMENTS = ["DATE", "DATETIME", "DATETIME(6)"]


def chosen(df):
    return {r.column_name: r.target_type for r in typechoice.choose_types(typechoice.type_facts(df, "t")).collect()}


def survivors(df, column, candidates):
    """Candidates that no value is lost in."""
    out = []
    for c in candidates:
        lost = conform.lossy_audit(df.select(F.col(f"`{column}`").alias("v")), {"v": c}).first().lossy_rows
        out += [c] if lost == 0 else []
    return out


def test_types_of_typical_columns(spark):
    day, moment = dt.datetime(2024, 2, 29), dt.datetime(2024, 2, 29, 1, 2, 3)
    D = decimal.Decimal
    df = spark.createDataFrame(
        [(1, 1.0, 0.1, "1", "2024-02-29", "2024-02-29 01:02:03", "1.50", "01", "", day, moment, moment.replace(microsecond=5), b"ab", b"", D("1.20"), D("7"), True, None),
         (300, -5.0, 0.5, "-40000", "1999-01-01", "2024-02-29 01:02:03.5", "-22.75", "1", "é", day, moment, moment, b"cd", b"x", D("-10.00"), D("9"), None, None)],
        "i bigint, whole double, frac double, t_int string, t_date string, t_time string, t_dec string, t_lead string, t_empty string, "
        "day timestamp_ntz, sec timestamp_ntz, mic timestamp_ntz, fixed binary, var binary, d decimal(18,4), d0 decimal(18,4), flag boolean, nothing double",
    )
    assert chosen(df) == {
        "i": "SMALLINT", "whole": "TINYINT", "frac": "DOUBLE", "t_int": "INT", "t_date": "DATE", "t_time": "DATETIME(6)",
        "t_dec": "DECIMAL(4,2)", "t_lead": "VARCHAR(2)", "t_empty": "VARCHAR(1)", "day": "DATE", "sec": "DATETIME",
        "mic": "DATETIME(6)", "fixed": "BINARY(2)", "var": "VARBINARY(1)", "d": "DECIMAL(3,1)", "d0": "TINYINT",
        "flag": "TINYINT(1)", "nothing": "DOUBLE",
    }


def test_long_texts_by_bytes(spark):
    df = spark.range(1).select(*[F.repeat(F.lit("é"), n).alias(f"c{n}") for n in (16383, 16384, 40000)])
    assert chosen(df) == {"c16383": "VARCHAR(16383)", "c16384": "TEXT", "c40000": "MEDIUMTEXT"}


def test_special_numbers(spark):
    df = spark.createDataFrame([(math.nan, 0.5, 1e300, 2.0**53, -0.0)], "a double, b double, c double, d double, e double")
    assert chosen(df) == {"a": "FLOAT", "b": "FLOAT", "c": "DOUBLE", "d": "BIGINT", "e": "TINYINT"}
    text = spark.createDataFrame([("-0.0", "9223372036854775808", " 1", "1e3", "0.10")], "a string, b string, c string, d string, e string")
    assert chosen(text) == {"a": "VARCHAR(4)", "b": "VARCHAR(19)", "c": "VARCHAR(2)", "d": "VARCHAR(3)", "e": "DECIMAL(2,2)"}


TEXTS = st.lists(st.sampled_from(["0", "7", "-129", "40000", "9999999999", "1.5", "2.25", "0.05", "-0.5", "2024-01-31", "2024-1-31", "2024-01-31 00:00:00", "2024-01-31 05:06:07.25", "x", "", None]), min_size=1, max_size=3)
NUMBERS = st.lists(st.sampled_from([0.0, 127.0, 128.0, -32769.0, 2.0**31, 2.0**40, 0.5, 0.1, 1e30, math.inf, None]), min_size=1, max_size=3)
DECIMALS = st.lists(st.sampled_from([decimal.Decimal(x) for x in ("0", "0.5", "-127", "128.25", "99999999.001")] + [None]), min_size=1, max_size=3)
TIMES = st.lists(st.sampled_from([dt.datetime(2024, 1, 31), dt.datetime(2024, 1, 31, 5), dt.datetime(2024, 1, 31, 5, 6, 7, 8), None]), min_size=1, max_size=3)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(TEXTS, NUMBERS, DECIMALS, TIMES)
def test_agrees_with_casting_every_candidate(spark, texts, numbers, decimals, times):
    decimals_of = [f"DECIMAL({p},{s})" for p in range(1, 12) for s in range(0, min(p, 3) + 1)]
    for kind, values, candidates in (
        ("string", texts, INTEGERS + decimals_of + MOMENTS), ("double", numbers, [*INTEGERS, "FLOAT", "DOUBLE"]),
        ("decimal(12,4)", decimals, INTEGERS + decimals_of), ("timestamp_ntz", times, MOMENTS),
    ):
        df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
        found = chosen(df)["v"]
        if all(v is None for v in values):
            assert found == {"string": "VARCHAR(255)", "double": "DOUBLE", "decimal(12,4)": "DECIMAL(12,4)", "timestamp_ntz": "DATETIME(6)"}[kind]
            continue
        kept = survivors(df, "v", candidates)
        expected = kept[0] if kept else f"VARCHAR({max(1, max(len(v) for v in values if v is not None))})"
        if expected.startswith("DECIMAL") and found.startswith("DECIMAL"):  # one of the types of the fewest digits
            fewest = min(typemap.spark_type_for(t).precision for t in kept if t.startswith("DECIMAL"))
            assert found in kept and typemap.spark_type_for(found).precision == fewest
        else:
            assert found == expected, values


def test_facts_merge_in_any_order(spark, source):
    df = source.table("orders").withColumn("text", F.col("o_orderdate").cast("string")).withColumn("gone", F.lit(None).cast("string"))
    whole = chosen(df)
    parts = [typechoice.type_facts(df.where(F.col("o_orderkey") % 3 == x), "t") for x in (2, 0, 1)]
    empty = typechoice.type_facts(df.limit(0), "t")
    for facts in (typechoice.merge_facts(*parts, empty), typechoice.merge_facts(parts[1], typechoice.merge_facts(empty, parts[0], parts[2]))):
        assert {r.column_name: r.target_type for r in typechoice.choose_types(facts).collect()} == whole
    assert {r.target_type for r in typechoice.choose_types(empty).collect()} >= {"BIGINT", "DOUBLE", "VARCHAR(255)"}


def test_a_table_under_its_chosen_types_loses_nothing(source):
    for name in ("orders", "events", "documents", "part"):
        df = source.table(name)
        assert all(r.lossy_rows == 0 for r in conform.lossy_audit(df, chosen(df)).collect())


def test_no_columns(spark):
    with pytest.raises(ValueError):
        typechoice.type_facts(spark.range(1).select(), "t")


def test_texts_that_a_match_keeps_from_the_casts_are_none(spark):
    years = [f"{z}{y}{end}" for y in (1, 12345, 99999, 194247, 290000, 294199, 294239, 294246, 294247, 294248, 294250, 294300, 295000, 299999, 300000, 999999, 1000000, 9999999, 10000000) for z in ("", "0", "00", "-", "+", " ") for end in ("", " ", "\n", "-01-01", "-01-10 04:00:54", "-02-01")]
    odd = ["", " ", "+", "-", "7", "+7", "-7 ", "\t7\n", "\x007", "7\x7f", "7.", ".7", "7.0", "1 2", "1e3", "0x1f", "7L", "\u0667", "\uff17", "a", "9223372036854775807", "9223372036854775808", "-9223372036854775808", "00012", "1-2", "1_000", "1,000", "2020-01-01", "2020-01-01T10:00", None]
    v = F.col("v")
    df = spark.createDataFrame([(x,) for x in years + odd], "v string")
    rows = df.select("v", typechoice._number(v, T.StringType()).alias("n"), v.try_cast("bigint").alias("n0"), typechoice._moment(v).cast("string").alias("m"), v.try_cast("timestamp_ntz").cast("string").alias("m0")).collect()
    assert [r for r in rows if r.n != r.n0 or r.m != r.m0] == []
    assert sum(r.n is not None for r in rows) > 50 and sum(r.m is not None for r in rows) > 50
