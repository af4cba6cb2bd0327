"""Conforming a table to its target schema.

Each function is one projection over the table — no shuffle, inside whole-stage
codegen. Casts use ``try_cast`` so a value that does not fit becomes NULL and is counted
(:func:`conform_failures`) instead of failing the task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions import typemap, values


def _c(name: str):
    return F.col(f"`{name}`")


def conform_table(df: DataFrame, target_types: dict[str, str], guid_columns=()) -> DataFrame:
    """P14 (+P10): cast every column to the Spark type of its mapped target type.

    Columns without a target type are kept unchanged; uniqueidentifier columns become
    lower-case text."""
    out = []
    for c in df.columns:
        if c in guid_columns:
            out.append(values.guid_text(_c(c)).alias(c))
        elif c in target_types:
            out.append(typemap.to_target(_c(c), target_types[c]).alias(c))
        else:
            out.append(_c(c))
    return df.select(*out)


def conform_failures(df: DataFrame, target_types: dict[str, str]) -> DataFrame:
    """P14 counters: per column, non-NULL values that do not fit the target type."""
    cols = [c for c in df.columns if c in target_types]
    one = df.agg(
        *[
            F.count_if(_c(c).isNotNull() & typemap.to_target(_c(c), target_types[c]).isNull())
            .cast("bigint").alias(c)
            for c in cols
        ]
    )
    return one.unpivot([], cols, "column_name", "failed_casts").select(
        "column_name", F.lit(None).cast("string").alias("target_type"), "failed_casts"
    ).withColumn(
        "target_type",
        F.try_element_at(
            F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(target_types[c]))]),
            F.col("column_name"),
        ),
    )


def normalize_nulls(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every float/double column."""
    return df.select(
        *[
            values.nan_to_null(_c(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else _c(f.name)
            for f in df.schema.fields
        ]
    )


def format_timestamps(df: DataFrame) -> DataFrame:
    """Every timestamp column as ``yyyy-MM-dd HH:mm:ss`` text."""
    return df.select(
        *[
            values.timestamp_text(_c(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else _c(f.name)
            for f in df.schema.fields
        ]
    )


def parse_date_columns(df: DataFrame) -> DataFrame:
    """In text columns whose name contains ``date``, values that are dates are rendered
    ``yyyy-MM-dd``; every other value stays as it is."""
    return df.select(
        *[
            F.coalesce(F.when(values.looks_like_date(_c(f.name)), values.parse_date_text(_c(f.name))), _c(f.name)).alias(f.name)
            if "date" in f.name.lower() and isinstance(f.dataType, T.StringType) else _c(f.name)
            for f in df.schema.fields
        ]
    )


def preprocess_legacy(df: DataFrame, timestamps_as_text: bool = False) -> DataFrame:
    """The legacy per-page preprocessing as one projection: P11, P13, and P12 where asked for
    (timestamps keep their type and microseconds otherwise)."""
    df = normalize_nulls(df)
    return parse_date_columns(format_timestamps(df) if timestamps_as_text else df)


def align_columns(frames: list[DataFrame], columns: list[str]) -> DataFrame:
    """Rows of differently shaped frames aligned to a column list.

    Missing columns become NULL, extra columns are dropped."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return merged.select(
        *[_c(c) if c in merged.columns else F.lit(None).alias(c) for c in columns]
    )


def lossy_audit(df: DataFrame, target_types: dict[str, str]) -> DataFrame:
    """Per column, rows whose value changes when stored in the mapped target type
    (compared after casting back to the source type)."""
    cols = [c for c in df.columns if c in target_types]
    aggs = []
    for c in cols:
        src_t = df.schema[c].dataType
        back = typemap.to_target(_c(c), target_types[c]).try_cast(src_t)
        aggs.append(F.count_if(_c(c).isNotNull() & ~back.eqNullSafe(_c(c))).cast("bigint").alias(c))
    one = df.agg(*aggs)
    return one.unpivot([], cols, "column_name", "lossy_rows").withColumn(
        "target_type",
        F.try_element_at(
            F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(target_types[c]))]),
            F.col("column_name"),
        ),
    ).select("column_name", "target_type", "lossy_rows")
