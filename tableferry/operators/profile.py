"""Table profiles (A1, A2): counts and column extremes in one pass per table.

The legacy validation runs two queries per numeric column per side; here every
aggregate of a table is fused into one ``agg`` (one scan, partial aggregation per
task, a one-row result), then unpivoted for reporting.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions import typemap



def side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row aggregates as one row: the right side's values enter as scalar
    subqueries (computed once, merged into a single subquery job) — no join."""
    return left.select("*", *[right.select(F.col(f"`{c}`")).scalar().alias(c) for c in right.columns])


def numeric_columns(df: DataFrame, source_types=typemap.EXTREME_SOURCE_TYPES) -> list[str]:
    """Columns whose source type is among ``source_types`` (default: the seven the
    legacy check compares — int, bigint, decimal, numeric, float, real, money)."""
    return [
        f.name for f in df.schema.fields
        if typemap.source_type_of(f.dataType)[0] in source_types
    ]


def _clean(df: DataFrame, c: str) -> Column:
    col = F.col(f"`{c}`")
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), col)  # NaN sorts last: it would win max (F11)
    return col


def _as_double(c: Column) -> Column:
    """Report value as double; ``+ 0.0`` turns -0.0 into 0.0 (equal values, one spelling)."""
    return c.cast("double") + F.lit(0.0)


def profile_aggs(df: DataFrame, columns: list[str], prefix: str = "") -> list[Column]:
    aggs = [F.count(F.lit(1)).alias(f"{prefix}row_count")]
    for c in columns:
        aggs.append(F.min(_clean(df, c)).alias(f"{prefix}min__{c}"))
        aggs.append(F.max(_clean(df, c)).alias(f"{prefix}max__{c}"))
    return aggs


def extreme_values(df: DataFrame, table_name: str, columns: list[str] | None = None) -> DataFrame:
    """A2: MIN and MAX of each numeric column (NULLs skipped), one row per column.

    Values are reported as double for a uniform column; comparisons (V5) happen in the
    native types before this projection."""
    columns = numeric_columns(df) if columns is None else columns
    one = df.agg(*profile_aggs(df, columns))
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(i + 1).alias("ordinal"),
                _as_double(F.col(f"min__{c}")).alias("min_value"),
                _as_double(F.col(f"max__{c}")).alias("max_value"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return one.select(F.lit(table_name).alias("table_name"), F.inline(rows))


def paired_profile(src: DataFrame, tgt: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the fused profile of source (``s_``) and target (``t_``) side by side.

    Each side is one aggregate (a one-row result); the target's enters as scalar subqueries."""
    s = src.agg(*profile_aggs(src, columns, "s_"))
    # Compare in the source's types (quirk Q20): cast target columns first.
    tgt_cast = tgt.select(
        *[F.col(f"`{c}`").cast(src.schema[c].dataType).alias(c) for c in columns if c in tgt.columns]
    ) if columns else tgt.select(F.lit(1).alias("_x"))
    missing = [c for c in columns if c not in tgt.columns]
    for c in missing:
        tgt_cast = tgt_cast.withColumn(c, F.lit(None).cast(src.schema[c].dataType))
    t = tgt_cast.agg(*profile_aggs(tgt_cast, columns, "t_"))
    return side_by_side(s, t)


def extremes_equal(columns: list[str]) -> Column:
    """Every column's min and max equal on both sides (NULL-safe)."""
    conds = [F.lit(True)]
    for c in columns:
        conds.append(F.col(f"s_min__{c}").eqNullSafe(F.col(f"t_min__{c}")))
        conds.append(F.col(f"s_max__{c}").eqNullSafe(F.col(f"t_max__{c}")))
    return reduce(lambda a, b: a & b, conds)


def extreme_pairs(paired: DataFrame, table_name: str, columns: list[str]) -> DataFrame:
    """V5 detail: per numeric column both sides' extremes and whether they match."""
    if not columns:
        return paired.select(F.lit(table_name).alias("table_name")).limit(0)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                _as_double(F.col(f"s_min__{c}")).alias("source_min"),
                _as_double(F.col(f"s_max__{c}")).alias("source_max"),
                _as_double(F.col(f"t_min__{c}")).alias("target_min"),
                _as_double(F.col(f"t_max__{c}")).alias("target_max"),
                (
                    F.col(f"s_min__{c}").eqNullSafe(F.col(f"t_min__{c}"))
                    & F.col(f"s_max__{c}").eqNullSafe(F.col(f"t_max__{c}"))
                ).alias("match"),
            )
            for c in columns
        ]
    )
    return paired.select(F.lit(table_name).alias("table_name"), F.inline(rows))
