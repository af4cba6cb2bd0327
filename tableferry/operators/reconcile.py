"""Reconciliation of a source database against a target.

Every result is a DataFrame keyed by table. Counts and extremes come from one fused
aggregate per table per side; content comparisons avoid shuffling unchanged data by
first comparing per-bucket digests (see :func:`content_diff`).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.operators import profile
from tableferry.session import materialize
from tableferry.sources import catalog
from tableferry.sources.tables import Database

SAMPLE_SIZE = 100


# --------------------------------------------------------------------------- V1, V2


#: Tables that whole-database checks work on side by side.
PARALLEL_TABLES = 8


def each_table(spark: SparkSession, names: list, build: Callable[[Any], list], schema: str, parallel: int = PARALLEL_TABLES) -> DataFrame:
    """The report rows that ``build`` gives for each name (a table's one row, or one for each of its columns), from a small
    pool: a plan for each table and none that grows with the catalog."""
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        rows = [r for found in pool.map(build, names) for r in found]
    return spark.createDataFrame(rows, schema)


def verify_tables(
    spark: SparkSession, source: Database, target: Database, pairs: list[tuple[str, str]]
) -> DataFrame:
    """V1 (with J2): row and column counts on both sides, per (source, target) pair.

    A side that cannot be read has NULL counts and makes the pair invalid (quirk Q2:
    the reference would report 0 = 0 as valid)."""

    def counts(db: Database, name: str) -> tuple[int | None, int | None]:
        try:
            return db.table(name).count(), len(db.table(name).columns)
        except Exception:  # not there or not readable: unknown, and so no match
            return None, None

    def pair(names: tuple[str, str]) -> list[tuple]:
        (rows, columns), (t_rows, t_columns) = counts(source, names[0]), counts(target, names[1])
        same_rows, same_columns = rows is not None and rows == t_rows, columns is not None and columns == t_columns
        return [(f"{source.schema}.{names[0]}", names[1], rows, t_rows, columns, t_columns, same_rows, same_columns, same_rows and same_columns)]

    return each_table(
        spark, pairs, pair,
        "source_table string, target_table string, source_rows bigint, target_rows bigint, source_columns bigint, "
        "target_columns bigint, row_count_match boolean, column_count_match boolean, is_valid boolean",
    )


def verification_summary(verification: DataFrame, transfers: DataFrame | None = None) -> DataFrame:
    """V2 / A4: passed, failed, total; overall success = no failed table and no failed
    verification."""
    v = verification.agg(
        F.count_if(F.col("is_valid")).cast("bigint").alias("verify_passed"),
        F.count_if(~F.col("is_valid")).cast("bigint").alias("verify_failed"),
        F.count(F.lit(1)).alias("verify_total"),
    )
    if transfers is None:
        return v.withColumn("overall_success", F.col("verify_failed") == 0)
    t = transfers.agg(F.count_if(~F.col("success")).cast("bigint").alias("transfer_failed"))
    return profile.side_by_side(v, t).select(
        "verify_passed",
        "verify_failed",
        "verify_total",
        "transfer_failed",
        ((F.col("transfer_failed") == 0) & (F.col("verify_failed") == 0)).alias("overall_success"),
    )


# --------------------------------------------------------------------------- V3 - V6


def _table_validation(src: DataFrame, tgt: DataFrame, name: str, empty_ok: bool) -> DataFrame:
    cols = profile.numeric_columns(src)
    paired = profile.paired_profile(src, tgt, cols)
    sc, tc = F.col("s_row_count"), F.col("t_row_count")
    count_match = sc == tc
    gate = count_match & (sc > 0)
    empty = count_match & (sc == 0)
    sample = F.least(sc, F.lit(SAMPLE_SIZE)) == F.least(tc, F.lit(SAMPLE_SIZE))
    extremes = profile.extremes_equal(cols)
    sample_ok = F.when(gate, sample).otherwise(empty & F.lit(empty_ok))
    extreme_ok = F.when(gate, extremes).otherwise(empty & F.lit(empty_ok))
    return paired.select(
        F.lit(name).alias("table_name"),
        sc.alias("source_count"),
        tc.alias("target_count"),
        count_match.alias("record_count_match"),
        sample_ok.alias("sample_data_match"),
        extreme_ok.alias("extreme_values_match"),
        (count_match & sample_ok & extreme_ok).alias("data_consistency"),
    )


def _missing_target(src: DataFrame, name: str) -> DataFrame:
    """The row of a table without a target: nothing matches."""
    no = F.lit(False)
    return src.agg(F.count(F.lit(1)).alias("source_count")).select(
        F.lit(name).alias("table_name"),
        "source_count",
        F.lit(None).cast("bigint").alias("target_count"),
        no.alias("record_count_match"),
        no.alias("sample_data_match"),
        no.alias("extreme_values_match"),
        no.alias("data_consistency"),
    )


def validate_tables(
    source: Database, target: Database, names=None, empty_ok: bool = True, exclude=()
) -> DataFrame:
    """V3: legacy per-table validation.

    Count match first; sample and extremes are checked only when counts match and are
    > 0 (an empty pair counts as consistent when ``empty_ok``; ``False`` reproduces the
    reference, quirk Q11). Tables in ``exclude`` are reported consistent unchecked."""
    names = list(names) if names is not None else source.names()

    def check(n: str) -> list:
        if n in exclude:
            return [(n, 0, 0, True, True, True, True)]
        if n in target.tables:
            return _table_validation(source.table(n), target.table(n), n, empty_ok).collect()
        return _missing_target(source.table(n), n).collect()

    return each_table(
        _session(source), names, check,
        "table_name string, source_count bigint, target_count bigint, record_count_match boolean, "
        "sample_data_match boolean, extreme_values_match boolean, data_consistency boolean",
    )


def _session(db: Database) -> SparkSession:
    return next(iter(db.tables.values())).sparkSession if db.tables else SparkSession.getActiveSession()


def sample_match(source: Database, target: Database, names=None) -> DataFrame:
    """V4: both sides' sample sizes (up to 100 rows); equal sizes pass. The legacy check
    compares lengths only — :func:`sample_diff` compares the sampled rows by key."""
    names = list(names) if names is not None else source.names()

    def check(n: str) -> list:
        s = min(source.table(n).count(), SAMPLE_SIZE)
        t = min(target.table(n).count(), SAMPLE_SIZE) if n in target.tables else None
        return [(n, s, t, s == t)]

    return each_table(_session(source), names, check, "table_name string, source_sample bigint, target_sample bigint, sample_match boolean")


def extreme_match(source: Database, target: Database, names=None) -> DataFrame:
    """V5: per numeric column, both sides' MIN/MAX and whether they agree."""
    names = list(names) if names is not None else source.names()

    def check(n: str) -> list:
        src = source.table(n)
        # Without a target: the source's columns without any row, so every extreme is NULL there.
        tgt = target.tables.get(n, src.where("false"))
        cols = profile.numeric_columns(src)
        return profile.extreme_pairs(profile.paired_profile(src, tgt, cols), n, cols).collect() if cols else []

    return each_table(
        _session(source), names, check,
        "table_name string, column_name string, source_min double, source_max double, target_min double, "
        "target_max double, match boolean",
    )


def validate_database(validation: DataFrame) -> DataFrame:
    """V6: whole-database verdict — every table consistent."""
    return validation.agg(
        F.count(F.lit(1)).alias("tables"),
        F.count_if(F.col("data_consistency")).cast("bigint").alias("consistent_tables"),
        F.coalesce(F.bool_and("data_consistency"), F.lit(True)).alias("overall_success"),
    )


# --------------------------------------------------------------------------- J3, J4


def missing_tables(source_names: DataFrame, target_names: DataFrame) -> DataFrame:
    """Source tables with no case-insensitively equal target table."""
    t = target_names.select(F.lower("table_name").alias("_lname")).distinct()
    return (
        source_names.withColumn("_lname", F.lower("table_name"))
        .join(t, "_lname", "left_anti")
        .drop("_lname")
    )


def boundary_rows(pages: DataFrame, target: DataFrame, key: str | list[str]) -> DataFrame:
    """The first and last row of each page must exist in the target by key.

    ``pages`` is a page summary (batch_no, first_key, last_key), stored first so that it is
    numbered once. ``key`` is a column or, where the summary's ends are structs, a list of
    them; NULL parts equal each other. One semi join reduces the target to the boundary
    keys, two per page, before anything else is done with it."""
    keys = _listed(key)
    names = [f"_w{i}" for i in range(len(keys))]
    bounds = materialize(pages.select("batch_no", "first_key", "last_key"))

    def end(side: str) -> DataFrame:
        parts = [side] if isinstance(key, str) else [f"{side}.`{k}`" for k in keys]
        return bounds.select(
            "batch_no", "first_key", "last_key", F.lit(side).alias("_side"), *[F.col(p).alias(n) for p, n in zip(parts, names)]
        )

    ends = end("first_key").unionByName(end("last_key"))
    wanted = ends.select(*names).distinct()
    pairs = [_comparable(target, k, wanted, n) for k, n in zip(keys, names)]
    there = target.select(*[x[0].alias(f"_t{i}") for i, x in enumerate(pairs)])
    looked_up = wanted.select(*[x[1].alias(n) for x, n in zip(pairs, names)])
    present = there.join(
        looked_up, reduce(lambda a, b: a & b, [F.col(f"_t{i}").eqNullSafe(F.col(n)) for i, n in enumerate(names)]), "left_semi"
    ).distinct().withColumn("_found", F.lit(True))
    same = reduce(lambda a, b: a & b, [x[1].eqNullSafe(F.col(f"_t{i}")) for i, x in enumerate(pairs)])

    def found(side: str) -> Column:
        return F.coalesce(F.bool_or(F.when(F.col("_side") == side, F.col("_found"))), F.lit(False))

    return (
        ends.join(present, same, "left")
        .groupBy("batch_no", "first_key", "last_key")
        .agg(found("first_key").alias("first_present"), found("last_key").alias("last_present"))
        .withColumn("batch_ok", F.col("first_present") & F.col("last_present"))
    )


# --------------------------------------------------------------------------- L3, L4, X2


def sample_rows(df: DataFrame, key: str, n: int = SAMPLE_SIZE) -> DataFrame:
    """L4, reproducible form: the n rows first by ``md5('sample:' || key)`` then key (the
    reference draws ``ORDER BY NEWID()``, which no two runs repeat)."""
    return df.orderBy(F.md5(F.concat(F.lit("sample:"), F.col(key).cast("string"))), F.col(key)).limit(n)


def limit_n(df: DataFrame, n: int = SAMPLE_SIZE) -> DataFrame:
    """L3: any n rows (unordered)."""
    return df.limit(n)


def _plain(df: DataFrame, name: str) -> Column:
    """A value as it is compared: -0.0 is 0.0 (NaN equals NaN in Spark's comparisons and hashes)."""
    c = F.col(f"`{name}`")
    return c + F.lit(0.0).cast(df.schema[name].dataType) if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)) else c


def _value_hash(df: DataFrame, name: str) -> Column:
    """64 bits of one value; NULL has a hash of its own (``xxhash64`` skips NULLs)."""
    return F.xxhash64(_plain(df, name), F.col(f"`{name}`").isNull())


def _row_digest(df: DataFrame, cols: list[str]) -> Column:
    return F.xxhash64(*[_value_hash(df, c) for c in cols]) if cols else F.lit(0).cast("bigint")


def _status_expr(src_cols: list[str]) -> tuple[Column, Column]:
    changed_names = F.concat_ws(
        ",",
        *[F.when(~F.col(f"s.`{c}`").eqNullSafe(F.col(f"t.`{c}`")), F.lit(c)) for c in src_cols],
    )
    status = (
        F.when(F.col("_s").isNull(), F.lit("extra"))
        .when(F.col("_t").isNull(), F.lit("missing"))
        .when(changed_names != "", F.lit("changed"))
    )
    return status, changed_names


def sample_diff(source: DataFrame, target: DataFrame, key: str, n: int = SAMPLE_SIZE) -> DataFrame:
    """The reproducible sample of the source, looked up in the target by key.

    Status per sampled row: ``match``, ``changed`` (with the differing columns),
    ``missing`` or ``duplicate`` (the key occurs more than once in the target; its rows
    are counted, not paired). Only the n sampled keys reach the join: the target is
    semi-joined to them and reduced to one row per key first."""
    sample = materialize(sample_rows(source, key, n))  # n rows, drawn once
    value_cols = [c for c in source.columns if c != key]
    tgt = _aligned_target(source, target).join(sample.select(key), key, "left_semi")
    per_key = tgt.groupBy(key).agg(
        F.count(F.lit(1)).alias("_nt"), F.any_value(F.struct(*value_cols)).alias("_row")
    )
    t = per_key.select(key, "_nt", *[F.col("_row")[c].alias(c) for c in value_cols]).withColumn("_t", F.lit(1))
    s = sample.withColumn("_s", F.lit(1)).alias("s")
    joined = s.join(t.alias("t"), F.col(f"s.{key}") == F.col(f"t.{key}"), "left")
    status, changed = _status_expr(value_cols)
    final = F.when(F.col("t._nt") > 1, F.lit("duplicate")).otherwise(F.coalesce(status, F.lit("match")))
    return joined.select(
        F.col(f"s.{key}").alias(key),
        final.alias("status"),
        F.when(final == "changed", changed).alias("changed_columns"),
    )


# --------------------------------------------------------------------------- X1


def _aligned_target(source: DataFrame, target: DataFrame) -> DataFrame:
    """The target in the source's column order and types (compare in one type, Q20)."""
    cols = []
    for c in source.columns:
        t = source.schema[c].dataType
        cols.append(F.col(f"`{c}`").cast(t).alias(c) if c in target.columns else F.lit(None).cast(t).alias(c))
    return target.select(*cols)


def _full_by_key(one: DataFrame, two: DataFrame, keys: list[str]) -> DataFrame:
    """Full join on equal keys, NULL key parts equal to each other; one column per key."""
    two = two.withColumnsRenamed({k: f"_t_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_t_{k}`")) for k in keys])
    joined = one.join(two, same, "full")
    rest = [F.col(f"`{c}`") for c in joined.columns if c not in keys and c not in {f"_t_{k}" for k in keys}]
    return joined.select(*[F.coalesce(f"`{k}`", f"`_t_{k}`").alias(k) for k in keys], *rest)


def _key_status(changed: Column) -> Column:
    return (
        F.when(F.col("_ns").isNull(), F.lit("extra"))
        .when(F.col("_nt").isNull(), F.lit("missing"))
        .when((F.col("_ns") > 1) | (F.col("_nt") > 1), F.lit("duplicate"))
        .when(changed != "", F.lit("changed"))
    )


def _diff_per_key(src: DataFrame, tgt: DataFrame, keys: list[str], value_cols: list[str], exact: bool) -> DataFrame:
    """Each side reduced to one row per key by partial aggregation (count, and per value
    column its value or its hash), joined 1:1 and compared column by column."""

    def side(df: DataFrame, tag: str) -> DataFrame:
        held = [
            (F.any_value(F.struct(_plain(df, c))) if exact else F.min(_value_hash(df, c))).alias(f"_{tag}{i}")
            for i, c in enumerate(value_cols)
        ]
        return df.groupBy(*[f"`{k}`" for k in keys]).agg(F.count(F.lit(1)).alias(f"_n{tag}"), *held)

    joined = _full_by_key(side(src, "s"), side(tgt, "t"), keys)
    changed = F.concat_ws(
        ",", *[F.when(~F.col(f"_s{i}").eqNullSafe(F.col(f"_t{i}")), F.lit(c)) for i, c in enumerate(value_cols)]
    )
    status = _key_status(changed)
    return joined.select(
        *[f"`{k}`" for k in keys], status.alias("status"), F.when(status == "changed", changed).alias("changed_columns")
    ).filter(F.col("status").isNotNull())


def _dirty_buckets(src: DataFrame, tgt: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Ids of key buckets (at most ``buckets``) whose rows differ or that hold a key twice."""

    def bucket(df: DataFrame) -> Column:
        return F.pmod(_row_digest(df, keys), F.lit(buckets))

    def digest(df: DataFrame, tag: str) -> DataFrame:
        return (
            df.select(bucket(df).alias("_b"), _row_digest(df, df.columns).alias("_h"))
            .groupBy("_b")
            .agg(
                F.count(F.lit(1)).alias(f"{tag}_n"),
                F.bit_xor("_h").alias(f"{tag}_x"),
                F.sum(F.shiftright("_h", 32)).alias(f"{tag}_hi"),
                F.sum(F.col("_h").bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"{tag}_lo"),
            )
        )

    def twice(df: DataFrame) -> DataFrame:
        """Only 8 bytes per key cross the shuffle; a hash shared by two keys is looked at for nothing."""
        held = df.select(_row_digest(df, keys).alias("_k")).groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
        return held.filter("_n > 1").select(F.pmod("_k", F.lit(buckets)).alias("_b"))

    same = reduce(
        lambda a, b: a & b,
        [F.col(f"s_{x}").eqNullSafe(F.col(f"t_{x}")) for x in ("n", "x", "hi", "lo")],
    )
    differ = digest(src, "s").join(digest(tgt, "t"), "_b", "full").filter(~same).select("_b")
    return differ.unionByName(twice(src)).unionByName(twice(tgt)).distinct()


def content_diff(
    source: DataFrame,
    target: DataFrame,
    keys: list[str],
    mode: str = "hash",
    buckets: int = 1 << 16,
    exact: bool = False,
) -> DataFrame:
    """Per key, rows ``missing`` from the target, ``extra`` in the target, ``changed``
    (with the names of the differing columns) or ``duplicate`` (the key is not unique on
    a side — e.g. a table loaded twice; such keys are reported, never paired row by row).
    NULL key parts are equal to each other, as are NULL values, NaNs and signed zeros.

    Each side is read once and reduced to one row per key (count and a 64-bit hash of each
    value column, NULL hashed apart); status and changed columns come from one 1:1 join
    whatever the key distribution, and no value crosses the shuffle.

    ``mode="hash"`` (default) misses a changed value only on a 64-bit collision;
    ``mode="exact"`` (or ``exact=True``) carries the values instead of their hashes.
    ``mode="digest"`` is for nearly identical tables: both sides are first summarised per
    key bucket (count, xor and sums of the row hash), and only rows of buckets that differ
    or hold a key twice are compared. All modes report the same rows."""
    mode = "exact" if exact else mode
    value_cols = [c for c in source.columns if c not in keys]
    src, tgt = source, _aligned_target(source, target)
    if mode == "digest":
        ids = F.broadcast(materialize(_dirty_buckets(src, tgt, keys, buckets)))  # at most `buckets` ids
        src, tgt = (
            df.withColumn("_b", F.pmod(_row_digest(df, keys), F.lit(buckets))).join(ids, "_b", "left_semi").drop("_b")
            for df in (src, tgt)
        )
    return _diff_per_key(src, tgt, keys, value_cols, mode == "exact")


def content_diff_keyless(source: DataFrame, target: DataFrame) -> DataFrame:
    """X1 without a key: multiset difference both ways (``exceptAll``)."""
    tgt = target.select(*[F.col(f"`{c}`").cast(source.schema[c].dataType).alias(c) for c in source.columns])
    return source.exceptAll(tgt).withColumn("status", F.lit("missing")).unionByName(
        tgt.exceptAll(source).withColumn("status", F.lit("extra"))
    )


# --------------------------------------------------------------------------- X4


def _listed(columns) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def _comparable(child: DataFrame, c: str, parent: DataFrame, p: str) -> tuple[Column, Column]:
    """Both key columns in one type that loses nothing: their own if equal or both numeric
    (compared in the wider one), else text."""
    one, two = child.schema[c].dataType, parent.schema[p].dataType
    if one == two or isinstance(one, T.NumericType) and isinstance(two, T.NumericType):
        return F.col(f"`{c}`"), F.col(f"`{p}`")
    return F.col(f"`{c}`").cast("string"), F.col(f"`{p}`").cast("string")


def _reported(df: DataFrame, columns: list[str]) -> Column:
    """A key as reported: bigint where it is one whole number, else its parts as text."""
    if len(columns) == 1 and isinstance(df.schema[columns[0]].dataType, T.IntegralType):
        return F.col(f"`{columns[0]}`").cast("bigint")
    return F.concat_ws(",", *[F.col(f"`{c}`").cast("string") for c in columns])


def _dealt(one: DataFrame, keys: list[str], two: DataFrame, other_keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join by four partitions for each that the larger one reads, where that is more than the session's
    shuffles have; smaller tables, and keys of two types, are left to the session."""
    n = 4 * max(one.rdd.getNumPartitions(), two.rdd.getNumPartitions())
    kinds = [(one.schema[a].dataType, two.schema[b].dataType) for a, b in zip(keys, other_keys)]
    if n <= int(one.sparkSession.conf.get("spark.sql.shuffle.partitions")) or any(a != b for a, b in kinds) or two.rdd.getNumPartitions() == 1:
        return one, two
    return one.repartition(n, *keys), two.repartition(n, *other_keys)


def orphan_rows(
    database: Database, foreign_keys, child_key: dict[str, str] | None = None
) -> DataFrame:
    """Child rows whose foreign key has no parent row (a key with a NULL part refers to
    nothing and is left out). Keys are single columns or lists of them, compared in their
    own types.

    The child's key columns alone are anti-joined with the parent keys; both sides of a large table are dealt to
    partitions in proportion to its input, so that what a task sorts does not grow with the table."""
    parts = []
    for child, fk, parent, pk in foreign_keys:
        if child not in database.tables or parent not in database.tables:
            continue
        c, p = database.table(child), database.table(parent)
        fk_cols, pk_cols = _listed(fk), _listed(pk)
        pairs = [_comparable(c, a, p, b) for a, b in zip(fk_cols, pk_cols)]
        names = [f"_v{i}" for i in range(len(pairs))]
        ck = _listed((child_key or {}).get(child) or database.keys(child) or fk_cols)
        held = list(dict.fromkeys([*fk_cols, *ck]))
        rows = c.select(*[F.col(f"`{x}`") for x in held], *[x[0].alias(n) for x, n in zip(pairs, names)]).dropna(how="any", subset=names)
        parents = p.select(*[x[1].alias(f"_p{i}") for i, x in enumerate(pairs)])
        rows, parents = _dealt(rows, names, parents, parents.columns)
        same = reduce(lambda a, b: a & b, [F.col(n) == F.col(f"_p{i}") for i, n in enumerate(names)])
        parts.append(
            rows.join(parents, same, "left_anti").select(
                F.lit(child).alias("child_table"),
                F.lit(",".join(fk_cols)).alias("fk_column"),
                F.lit(parent).alias("parent_table"),
                _reported(c, ck).alias("child_key"),
                _reported(c, fk_cols).alias("fk_value"),
            )
        )
    kinds = {f.dataType for x in parts for f in x.schema.fields if f.name in ("child_key", "fk_value")}
    if len(kinds) > 1:
        parts = [x.withColumns({n: F.col(n).cast("string") for n in ("child_key", "fk_value")}) for x in parts]
    return reduce(DataFrame.unionByName, parts)
