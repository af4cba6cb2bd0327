"""Target types chosen from values (P1, P14): the narrowest type that loses nothing.

The declared type of a source column often says little: keys in floats, dates and whole
numbers in text, long declared lengths. :func:`type_facts` reads a table once and keeps, per
column, a fixed set of facts in one aggregate (partial aggregation per task, one row per
column). Facts form a lattice: :func:`merge_facts` joins those of two batches, files or
servers by minima, maxima, conjunctions and sums, in any order, without reading a value
again, and :func:`choose_types` turns them into target types.

A type loses nothing where every value, stored in it and cast back, is equal to itself
(``conform.lossy_audit`` finds no row). Candidates, narrowest first: TINYINT, SMALLINT, INT,
BIGINT for whole numbers, also in floats, decimals and text; FLOAT, DOUBLE; DECIMAL with the
digits that occur (in text only where all values show the same number of decimals); DATE,
DATETIME, DATETIME(6), also in text; VARCHAR by the longest text, then TEXT, MEDIUMTEXT and
LONGTEXT by bytes; BINARY where all lengths are equal, VARBINARY, LONGBLOB.

Defined results: NULLs say nothing; a column without values, or of a type without
candidates, keeps the type that P1 maps it to. NaN and infinities need FLOAT. An empty text
needs VARCHAR(1). A table without rows gives a row per column, a table without columns none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions import typemap

#: Facts and the aggregate that joins them; NULL where a column's type has no such fact.
JOINS = {
    "n_values": F.sum, "whole": F.bool_and, "lo": F.min, "hi": F.max, "single": F.bool_and,
    "decimal_text": F.bool_and, "digits": F.max, "scale_lo": F.min, "scale_hi": F.max,
    "is_date": F.bool_and, "is_datetime": F.bool_and, "whole_seconds": F.bool_and,
    "chars": F.max, "bytes_lo": F.min, "bytes_hi": F.max,
}
FACT_TYPES = {
    **dict.fromkeys(("n_values", "lo", "hi", "chars", "bytes_lo", "bytes_hi"), "bigint"),
    **dict.fromkeys(("digits", "scale_lo", "scale_hi"), "int"),
    **dict.fromkeys(("whole", "single", "decimal_text", "is_date", "is_datetime", "whole_seconds"), "boolean"),
}
# A decimal number as a decimal column prints it, without a sign before zero.
DECIMAL_TEXT = r"^-?(?:0|[1-9][0-9]*)\.[0-9]+$"
NEGATIVE_ZERO = r"^-0\.0+$"
# A failed cast of text costs an exception, a match does not. Only text with one run of digits can be a whole number; six
# or seven digits alone are a year, and a timestamp holds none after 294247.
ONE_RUN = r"^[^0-9]*+[0-9]++[^0-9]*+\z"
LATE_YEAR = r"^(?:0?(?:29424[89]|2942[5-9][0-9]|294[3-9][0-9]{2}|29[5-9][0-9]{3}|[3-9][0-9]{5})|[1-9][0-9]{6})\z"


def _same(back: Column, v: Column) -> Column:
    """Whether a value cast to a type and back is itself; NULL for NULL."""
    return F.when(v.isNotNull(), F.coalesce(back.eqNullSafe(v), F.lit(False)))


def _number(v: Column, dt: T.DataType) -> Column:
    """A value as BIGINT; NULL where it is none."""
    return (F.when(v.rlike(ONE_RUN), v) if isinstance(dt, T.StringType) else v).try_cast("bigint")


def _moment(v: Column) -> Column:
    """A text as TIMESTAMP; NULL where it is none."""
    return F.when(~v.rlike(LATE_YEAR), v).try_cast("timestamp_ntz")


def _whole(v: Column, dt: T.DataType) -> dict[str, Column]:
    number = _number(v, dt)
    return {"whole": _same(number.try_cast(dt), v), "lo": number, "hi": number}


def _digits(number: Column) -> Column:
    """Digits before the point of a plain decimal text; none for a zero."""
    return F.char_length(F.regexp_extract(number, r"^-?0*([0-9]*)", 1))


def _seconds(v: Column) -> Column:
    return F.date_trunc("second", v).cast("timestamp_ntz") == v


def _facts(v: Column, dt: T.DataType) -> dict[str, Column]:
    """The facts of one value, by the type of its column."""
    if isinstance(dt, T.IntegralType):
        return _whole(v, dt)
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return {**_whole(v, dt), "single": _same(v.cast("float").cast(dt), v)}
    if isinstance(dt, T.DecimalType):
        text = v.cast("string")
        scale = F.char_length(F.regexp_extract(text, r"\.([0-9]*[1-9])0*$", 1)) if dt.scale else F.when(v.isNotNull(), F.lit(0))
        return {**_whole(v, dt), "digits": _digits(text), "scale_lo": scale, "scale_hi": scale}
    if isinstance(dt, T.StringType):
        moment = _moment(v)
        scale = F.char_length(F.regexp_extract(v, r"\.([0-9]+)$", 1))
        length = F.octet_length(v).cast("bigint")
        return {
            **_whole(v, dt),
            "decimal_text": v.rlike(DECIMAL_TEXT) & ~v.rlike(NEGATIVE_ZERO),
            "digits": _digits(v), "scale_lo": scale, "scale_hi": scale,
            "is_date": _same(v.try_cast("date").cast("string"), v),
            "is_datetime": _same(moment.cast("string"), v),
            "whole_seconds": F.coalesce(_seconds(moment), v.isNull()),
            "chars": F.char_length(v).cast("bigint"), "bytes_lo": length, "bytes_hi": length,
        }
    if isinstance(dt, (T.TimestampNTZType, T.DateType)):
        moment = v.cast("timestamp_ntz")
        day = F.date_trunc("day", moment).cast("timestamp_ntz") == moment
        return {"is_date": day, "is_datetime": F.lit(True), "whole_seconds": _seconds(moment)}
    if isinstance(dt, T.BinaryType):
        length = F.octet_length(v).cast("bigint")
        return {"bytes_lo": length, "bytes_hi": length}
    return {}


def type_facts(df: DataFrame, table_name: str) -> DataFrame:
    """One row per column: its source type and the facts about its values, from one aggregate."""
    if not df.columns:
        raise ValueError(f"{table_name} has no columns")
    aggs, rows = [], []
    for i, field in enumerate(df.schema.fields):
        v = F.col(f"`{field.name}`")
        facts = _facts(v, field.dataType)
        aggs.append(F.count(v).alias(f"n_values_{i}"))
        aggs += [JOINS[name](fact).alias(f"{name}_{i}") for name, fact in facts.items()]
        kind, precision, scale, _ = typemap.source_type_of(field.dataType)
        rows.append(F.struct(
            F.lit(table_name).alias("table_name"), F.lit(field.name).alias("column_name"), F.lit(kind).alias("source_type"),
            F.lit(precision).cast("int").alias("precision"), F.lit(scale).cast("int").alias("scale"),
            *[(F.col(f"{n}_{i}") if n == "n_values" or n in facts else F.lit(None)).cast(FACT_TYPES[n]).alias(n) for n in JOINS],
        ))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def merge_facts(*facts: DataFrame) -> DataFrame:
    """The facts of several parts of the same tables, joined."""
    both = reduce(DataFrame.unionByName, facts)
    names = ["table_name", "column_name", "source_type", "precision", "scale"]
    return both.groupBy(*names).agg(*[join(name).alias(name) for name, join in JOINS.items()])


def choose_types(facts: DataFrame) -> DataFrame:
    """The narrowest target type of each column, beside the type that P1 gives it."""
    is_ = F.col("source_type")
    text, binary = is_ == "nvarchar", is_ == "varbinary"
    integer = F.lit(None).cast("string")
    for name, (lo, hi) in reversed(typemap.INTEGER_RANGES.items()):
        integer = F.when(F.col("lo").between(lo, hi) & F.col("hi").between(lo, hi), F.lit(name)).otherwise(integer)
    digits, scale = F.col("digits"), F.col("scale_hi")
    decimal = F.format_string("DECIMAL(%d,%d)", F.greatest(digits + scale, F.lit(1)), scale)
    floating = F.when(F.col("single"), "FLOAT").otherwise("DOUBLE")
    moment = F.when(F.col("is_date"), "DATE").when(F.col("whole_seconds"), "DATETIME").otherwise("DATETIME(6)")
    longest = F.col("bytes_hi")
    by_bytes = F.lit("LONGTEXT")
    for name in ("MEDIUMTEXT", "TEXT"):
        by_bytes = F.when(longest <= typemap.TEXT_BYTES[name], name).otherwise(by_bytes)
    varchar = F.when(
        F.col("chars") <= typemap.VARCHAR_MAX, F.format_string("VARCHAR(%d)", F.greatest(F.col("chars"), F.lit(1)))
    ).otherwise(by_bytes)
    bytes_type = (
        F.when((F.col("bytes_lo") == longest) & longest.between(1, 255), F.format_string("BINARY(%d)", longest))
        .when(longest <= typemap.VARBINARY_MAX, F.format_string("VARBINARY(%d)", F.greatest(longest, F.lit(1))))
        .otherwise("LONGBLOB")
    )
    mapped = typemap.map_type("source_type", F.lit(None).cast("bigint"), "precision", "scale")
    chosen = (
        F.when(F.col("n_values") == 0, mapped)
        .when(F.col("whole"), integer)
        .when(is_ == "decimal", decimal)
        .when(text & F.col("decimal_text") & (F.col("scale_lo") == scale) & (digits + scale <= 38), decimal)
        .when(is_.isin("float", "real"), floating)
        .when(is_.isin("datetime2", "date") | text & (F.col("is_date") | F.col("is_datetime")), moment)
        .when(text, varchar)
        .when(binary, bytes_type)
        .otherwise(mapped)
    )
    return facts.select(
        "table_name", "column_name", "source_type", "n_values", mapped.alias("mapped_type"), chosen.alias("target_type")
    )
