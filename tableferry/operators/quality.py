"""Pre-load quality checks (D1-D5) and the quarantine split.

The reference reacts to server error codes after a failed insert (duplicate key 1062,
too long 1406, out of range 1264, bad value 1292). Here each code is a predicate
evaluated for *every* row before loading, in one pass over the table: per-row
violations are built as an array of structs and exploded, so a table is scanned once
however many columns are checked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions import typemap, values
from tableferry.sources import paging

# Fixed values of the legacy error analysis.
LEGACY_TEXT_LIMIT = 255
LEGACY_INT_LIMIT = 2147483647
MAX_REJECTS_SHOWN = 5
MAX_ERRORS = 10


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _numeric_view(df: DataFrame, name: str) -> Column:
    """The column as a number for range checks: numeric columns as they are, anything
    else through ``try_cast`` (a non-number is a type problem, not a range problem)."""
    dt = df.schema[name].dataType
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType,
                       T.DoubleType, T.FloatType)):
        return _c(name)
    return _c(name).try_cast("decimal(38,0)")


def _out_of(df: DataFrame, name: str, lo: int, hi: int) -> Column:
    v = _numeric_view(df, name)
    return (v < F.lit(lo)) | (v > F.lit(hi))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once (partial aggregation: a hot key is
    pre-counted in every task before the shuffle)."""
    return (
        df.groupBy(*[_c(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a NULL in any key column (a key that cannot be loaded)."""
    cond = F.lit(False)
    for k in keys:
        cond = cond | _c(k).isNull()
    return df.filter(cond)


def _violations(df: DataFrame, key: str, checks: list[tuple[str, Column, Column, str]]) -> DataFrame:
    """checks: (column, violated?, measured value as string, code)."""
    if not checks:
        return df.sparkSession.createDataFrame(
            [], f"{key} bigint, column_name string, value string, code string"
        )
    arr = F.array(
        *[
            F.struct(
                F.lit(col).alias("column_name"),
                F.coalesce(bad, F.lit(False)).alias("_bad"),
                measured.alias("value"),
                F.lit(code).alias("code"),
            )
            for col, bad, measured, code in checks
        ]
    )
    return (
        df.select(_c(key).alias(key), F.filter(arr, lambda s: s["_bad"]).alias("_v"))
        .where(F.size("_v") > 0)
        .select(key, F.inline("_v"))
        .drop("_bad")
    )


def _size(df: DataFrame, name: str, limit: int | str) -> tuple[Column, int]:
    """(measured size, most) of a length rule: characters of text and bytes of binary, or the bytes of a TEXT type."""
    if isinstance(limit, str):
        return F.octet_length(_c(name)), typemap.TEXT_BYTES[limit]
    return F.length(_c(name)), limit


def too_long(df: DataFrame, key: str, limits: dict[str, int | str]) -> DataFrame:
    """D2 (error 1406): values longer than their target holds, one row per offending cell."""
    checks = []
    for c, limit in limits.items():
        size, most = _size(df, c, limit)
        checks.append((c, size > F.lit(most), size.cast("string"), "1406"))
    rows = _violations(df, key, checks)
    return rows.select(key, "column_name", F.col("value").cast("bigint").alias("length"))


def out_of_range(df: DataFrame, key: str, ranges: dict[str, tuple[int, int] | str]) -> DataFrame:
    """D3 (error 1264): numbers outside the target type's range (an integer range, or a DECIMAL type)."""
    checks = [
        (c, reject_code(df, c, r) == "1264" if isinstance(r, str) else _out_of(df, c, *r), _c(c).cast("string"), "1264")
        for c, r in ranges.items()
    ]
    return _violations(df, key, checks).select(key, "column_name", "value")


def date_like_columns(df: DataFrame) -> list[str]:
    """Columns the legacy analysis suspects for error 1292: name contains date or time."""
    return [c for c in df.columns if "date" in c.lower() or "time" in c.lower()]


def bad_dates(df: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """D4 (error 1292): date/time-named values that parse as no date or timestamp."""
    columns = date_like_columns(df) if columns is None else columns
    checks = [(c, values.bad_datetime_text(_c(c)), _c(c).cast("string"), "1292") for c in columns]
    return _violations(df, key, checks).select(key, "column_name", "value")


_SOURCE_RANGES = {
    T.ByteType: typemap.INTEGER_RANGES["TINYINT"],
    T.ShortType: typemap.INTEGER_RANGES["SMALLINT"],
    T.IntegerType: typemap.INTEGER_RANGES["INT"],
    T.LongType: typemap.INTEGER_RANGES["BIGINT"],
}


def target_rules(df: DataFrame, target_types: dict[str, str]):
    """Length limits (CHAR, VARCHAR, BINARY, VARBINARY by their size, TEXT types by name) and number ranges (integers by their
    ends, DECIMAL by its type) implied by target types. A range check is left out when the source integer
    type cannot exceed the target's range."""
    limits, ranges = {}, {}
    for c, t in target_types.items():
        if c not in df.columns:
            continue
        tt = t.strip().upper()
        if tt in typemap.INTEGER_RANGES:
            lo, hi = typemap.INTEGER_RANGES[tt]
            src = _SOURCE_RANGES.get(type(df.schema[c].dataType))
            if src is None or src[0] < lo or src[1] > hi:
                ranges[c] = (lo, hi)
        elif tt.startswith("DECIMAL("):
            ranges[c] = tt
        elif tt.startswith(("VARCHAR(", "CHAR(", "VARBINARY(", "BINARY(")):
            limits[c] = int(tt[tt.index("(") + 1:-1])
        elif tt in typemap.TEXT_BYTES:
            limits[c] = tt
    return limits, ranges


def reject_code(df: DataFrame, name: str, target_type: str) -> Column:
    """The server's error for a cell that the load rejects, NULL for one that it takes: 1406 too long, 1264 a number out
    of range, 1292 no date or time, 1366 any other value that the type can't hold.

    Decided by the conversion of the load itself (:func:`typemap.to_target`), so a cell is suspect exactly when its row
    would be rejected."""
    value, tt = _c(name), target_type.strip().upper()
    carrier = typemap.spark_type_for(target_type)
    failed = value.isNotNull() & typemap.to_target(value, target_type).isNull()
    over = typemap.over_long(value.try_cast(carrier), target_type)
    code = F.when(F.lit(False), F.lit(None).cast("string"))
    if over is not None:
        code = code.when(over, F.lit("1406"))
    if isinstance(carrier, (T.TimestampNTZType, T.DateType)):
        return F.when(failed, code.otherwise(F.lit("1292")))
    if tt in typemap.INTEGER_RANGES or isinstance(carrier, T.DecimalType):
        source = df.schema[name].dataType
        castable = isinstance(source, (T.NumericType, T.StringType, T.BooleanType))
        number = value.try_cast("double") if castable else F.lit(None).cast("double")
        if tt in typemap.INTEGER_RANGES:
            lo, hi = (float(x) for x in typemap.INTEGER_RANGES[tt])
            wide = (number <= lo - 1) | (number >= hi + 1) | ((F.abs(number) >= 2.0**63) if tt == "BIGINT" else F.lit(False))
        else:
            wide = F.abs(number) >= 10.0 ** (carrier.precision - carrier.scale) - 0.5 * 10.0**-carrier.scale
        code = code.when(~F.isnan(F.coalesce(number, F.lit(0.0))) & wide, F.lit("1264"))
    return F.when(failed, code.otherwise(F.lit("1366")))


def _shown(df: DataFrame, name: str) -> Column:
    """A cell's value as a report shows it, shortened; bytes as hexadecimal digits."""
    binary = isinstance(df.schema[name].dataType, T.BinaryType)
    return values.preview_text(F.hex(_c(name)) if binary else _c(name).cast("string"))


def rejected_cells(df: DataFrame, key: str, target_types: dict[str, str]) -> DataFrame:
    """D5 against a target: (key, column, value, code) of every cell that the load rejects, one pass."""
    found = [
        F.struct(F.lit(c).alias("column_name"), _shown(df, c).alias("value"), reject_code(df, c, t).alias("code"))
        for c, t in target_types.items() if c in df.columns
    ]
    if not found:
        return _violations(df, key, [])
    cells = F.filter(F.array(*found), lambda s: s["code"].isNotNull())
    return df.select(_c(key).alias(key), F.inline(cells))


def legacy_rules(df: DataFrame):
    """The legacy error analysis' fixed rules: any text longer than 255 characters,
    any number whose absolute value exceeds 2147483647."""
    limits, ranges = {}, {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            limits[f.name] = LEGACY_TEXT_LIMIT
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                                     T.DecimalType, T.DoubleType, T.FloatType)):
            ranges[f.name] = (-LEGACY_INT_LIMIT, LEGACY_INT_LIMIT)
    return limits, ranges


def key_suspects(df: DataFrame) -> list[str]:
    """D1 suspects of the legacy analysis: columns whose name contains ``id`` or ``name``."""
    return [c for c in df.columns if "id" in c.lower() or "name" in c.lower()]


def suspect_cells(df: DataFrame, key: str, target_types: dict[str, str] | None = None) -> DataFrame:
    """(key, column, value, code) for every cell that D2-D4 flag, one pass.

    With ``target_types`` the cells are those that the load rejects (:func:`rejected_cells`); without, the
    legacy analysis' fixed rules apply (:func:`legacy_rules`)."""
    if target_types is not None:
        return rejected_cells(df, key, target_types)
    limits, ranges = legacy_rules(df)
    checks = [
        (c, F.length(_c(c)) > F.lit(n), values.preview_text(_c(c)), "1406") for c, n in limits.items()
    ]
    checks += [
        (c, _out_of(df, c, lo, hi), _c(c).cast("string"), "1264")
        for c, (lo, hi) in ranges.items()
    ]
    checks += [
        (c, values.bad_datetime_text(_c(c)), _c(c).cast("string"), "1292")
        for c in date_like_columns(df)
        if dict(df.dtypes)[c] == "string"
    ]
    return _violations(df, key, checks)


# Names of the error codes in a row's reject reasons.
_REASONS = {"1406": "length", "1264": "range", "1292": "type", "1366": "type"}


def row_problems(df: DataFrame, target_types: dict[str, str]) -> Column:
    """W4 validity: the names of the checks a row fails, comma-joined ('' = loadable).

    A value fails when the load's own conversion rejects it (:func:`reject_code`)."""
    parts = []
    for c, t in target_types.items():
        if c not in df.columns:
            continue
        code = reject_code(df, c, t)
        named = F.when(code.isNull(), F.lit(None).cast("string"))
        for number, name in _REASONS.items():
            named = named.when(code == number, F.lit(f"{c}:{name}"))
        parts.append(named)
    return F.concat_ws(",", *parts) if parts else F.lit("")


def quarantine(df: DataFrame, target_types: dict[str, str]) -> DataFrame:
    """Every row tagged with ``reject_reasons`` (NULL when the row loads cleanly).

    ``good = filter(reject_reasons is null)``, ``bad = filter(is not null)``; the two
    parts are complementary, so good ∪ bad is the input. Write both in one pass with
    :func:`tableferry.plans.load.write_quarantined`."""
    reasons = row_problems(df, target_types)
    return df.withColumn("reject_reasons", F.when(reasons != "", reasons))


def quarantine_good(df: DataFrame, target_types: dict[str, str]) -> DataFrame:
    return quarantine(df, target_types).filter(F.col("reject_reasons").isNull()).drop("reject_reasons")


def quarantine_bad(df: DataFrame, target_types: dict[str, str]) -> DataFrame:
    return quarantine(df, target_types).filter(F.col("reject_reasons").isNotNull())


def reject_preview(bad: DataFrame, key: str, text_columns: list[str], n: int = MAX_REJECTS_SHOWN) -> DataFrame:
    """W4 log: the first n rejected rows by key, long text shortened.

    The limit is the feature here: the reference shows the first five failures."""
    return bad.orderBy(key).limit(n).select(
        key, *[values.preview_text(_c(c)).alias(c) for c in text_columns], "reject_reasons"
    )


def reject_summary(bad: DataFrame, max_errors: int = MAX_ERRORS) -> DataFrame:
    """W4 stop rule: the legacy fallback gives up after more than ``max_errors`` errors."""
    return bad.agg(F.count(F.lit(1)).alias("rejected_rows")).withColumn(
        "too_many_errors", F.col("rejected_rows") > max_errors
    )


@dataclass
class OrderedLoad:
    """Outcome of :func:`load_in_order`: rows with their ``row_no`` in load order."""

    kept: DataFrame
    errors: DataFrame
    stop_row: int | None


def load_in_order(df: DataFrame, target_types: dict[str, str], order: list[str], max_errors: int = MAX_ERRORS) -> OrderedLoad:
    """W4, the row-by-row fallback: rows are taken in load order, bad ones are skipped, and the error after ``max_errors``
    ends the load; the good rows before it are kept, all later ones are not tried.

    No row loop: the distributed row index (:func:`paging.row_index`) gives every row its place, the place of the
    ending error is the (max_errors + 1)th smallest of the bad rows, and one comparison splits the rest. Rows
    equal in ``order`` go by a hash of their other columns; without an order the first column is taken, as the
    legacy loader's paging does."""
    indexed = paging.row_index(quarantine(df, target_types), order or df.columns[:1], "row_no")
    bad = indexed.where(F.col("reject_reasons").isNotNull())
    first = bad.select("row_no").orderBy("row_no").limit(max_errors + 1).collect()  # max_errors + 1 numbers
    stop = first[-1]["row_no"] if len(first) > max_errors else None
    tried = F.lit(True) if stop is None else F.col("row_no") <= stop
    good = indexed.where(F.col("reject_reasons").isNull() & tried)
    return OrderedLoad(good.drop("reject_reasons"), bad.where(tried), stop)
