"""Whole-table and whole-database jobs (JOB1-JOB7) and their summaries.

A job is driver-side composition only: for each table it builds one lazy pipeline whose
single action is the write, and it returns its outcome as DataFrames (one row per
table). Table loads are submitted concurrently from a small thread pool, so small
tables do not wait behind big ones; one table's failure is its own result row.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tableferry.functions import typemap
from tableferry.operators import conform, ddl, quality, reconcile
from tableferry.plans import load, report
from tableferry.sources import catalog as cat
from tableferry.sources import paging, versioned
from tableferry.sources.tables import Database

RESULT_SCHEMA = (
    "source_table string, target_table string, success boolean, row_count bigint, error string"
)


@dataclass
class TransferRun:
    """Outcome of :func:`transfer_all`: every part is a DataFrame."""

    results: DataFrame
    verification: DataFrame
    summary: DataFrame
    verification_summary: DataFrame
    target: Database


def _short(exc: Exception) -> str:
    text = str(exc).strip().splitlines()
    return (text[0] if text else type(exc).__name__)[:300]


def target_name(schema: str, table: str) -> str | None:
    """P4 for one name on the driver (same rule as :func:`names.target_table_name`)."""
    full = f"{schema}.{table}".replace("[", "").replace("]", "")
    conv = full.replace(".", "_")
    ok = bool(conv) and all(ch.isalpha() or ch.isdecimal() or ch == "_" for ch in conv)
    return conv if ok and full.strip() else None


def table_target_types(mapped_catalog: DataFrame, table: str) -> dict[str, str]:
    """The mapped target type of each column of one table (metadata: one row per column)."""
    rows = (
        mapped_catalog.filter(F.col("table_name") == table)
        .select("column_name", "target_type", "ordinal_position")
        .orderBy("ordinal_position")
        .collect()
    )
    return {r["column_name"]: r["target_type"] for r in rows}


def all_target_types(mapped_catalog: DataFrame) -> dict[str, dict[str, str]]:
    """Target types of every table in one collect (metadata: one row per column)."""
    out: dict[str, dict[str, str]] = {}
    rows = mapped_catalog.select("table_name", "column_name", "target_type", "ordinal_position").collect()
    for r in sorted(rows, key=lambda r: (r["table_name"], r["ordinal_position"])):
        out.setdefault(r["table_name"], {})[r["column_name"]] = r["target_type"]
    return out


def strict_conform(df: DataFrame, target_types: dict[str, str]) -> DataFrame:
    """Cast every column to its target carrier with ANSI ``cast``: a value that does not fit
    fails the task, so the table's write commits nothing (W1 rollback semantics)."""
    return df.select(
        *[
            typemap.to_target(F.col(f"`{c}`"), target_types[c], strict=True).alias(c)
            if c in target_types else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def transfer_table(
    spark: SparkSession,
    source: Database,
    table: str,
    target_root: str,
    mapped_catalog: DataFrame | dict,
    on_bad_values: str = "fail",
    max_errors: int = 10,
    sink: str = "parquet",
) -> dict:
    """JOB1: catalog -> map -> create -> conform -> load -> result row.

    Zero columns = failure; zero rows = success (an empty target table is written); an
    illegal target name or any error = a failed result row (quirks Q1, Q4).

    ``on_bad_values``: ``"fail"`` (a value that does not fit fails the table, nothing is
    committed), ``"null"`` (it becomes NULL) or ``"quarantine"`` (rows that do not fit go
    to ``<target>__rejects`` with their reasons; more than ``max_errors`` rejects fail the
    table, as the legacy row-by-row fallback gives up after ten errors).

    ``sink="versioned"`` creates the mapped table first (W5, columns counted in what was created) and loads it in one
    transaction of :mod:`tableferry.sources.versioned`; ``"parquet"`` writes a plain folder."""
    full = f"{source.schema}.{table}"
    tname = target_name(source.schema, table)
    result = {"source_table": full, "target_table": tname, "success": False, "row_count": None, "error": None}
    if tname is None:
        result["error"] = "invalid target table name"
        return result
    try:
        types = (
            mapped_catalog.get(table, {}) if isinstance(mapped_catalog, dict)
            else table_target_types(mapped_catalog, table)
        )
        if not types:
            result["error"] = "no column information"
            return result
        df = source.table(table)
        if on_bad_values == "quarantine":
            return _transfer_quarantined(df, types, result, f"{target_root}/{tname}", max_errors)
        conformed = (
            strict_conform(df, types) if on_bad_values == "fail" else conform.conform_table(df, types)
        )
        if sink == "versioned":
            path = f"{target_root}/{tname}"
            made = versioned.create_table(path, versioned.mapped_columns({c: types[c] for c in df.columns if c in types}), source.keys(table))
            if made != len(df.columns):
                raise ValueError(f"{made} columns in the target, {len(df.columns)} in the source")
            result["row_count"] = versioned.load_table(conformed, path, "overwrite")["rows"]
        else:
            result["row_count"] = load.write_table(conformed, f"{target_root}/{tname}")
        result["success"] = True
    except Exception as exc:  # isolate the table: its failure is data, not a crash
        result["error"] = _short(exc)
    return result


def _transfer_quarantined(df: DataFrame, types: dict, result: dict, path: str, max_errors: int) -> dict:
    """W4 inside JOB1: rejects are counted first, so that a load which the stop rule fails
    leaves the target as it was; then good rows are conformed into the target.

    Rejects go with their original values and the reasons to ``<target>__rejects`` — the
    target table keeps exactly the source columns."""
    tagged = quality.quarantine(df, types)
    bad = tagged.where(F.col("reject_reasons").isNotNull()).count()
    if bad:
        load.write_table(quality.quarantine_bad(df, types), f"{path}__rejects")
        result["error"] = f"{bad} rows quarantined"
    else:
        load.drop_path(df.sparkSession, f"{path}__rejects")  # of an earlier load
    if bad <= max_errors:
        good = conform.conform_table(tagged.filter(F.col("reject_reasons").isNull()).drop("reject_reasons"), types)
        result["row_count"] = load.write_table(good, path)
        result["success"] = True
    return result


def run_summary(results: DataFrame) -> DataFrame:
    """A3: successes, failures, tables, rows of successful tables, failed list."""
    return results.agg(
        F.count_if(F.col("success")).cast("bigint").alias("success_count"),
        F.count_if(~F.col("success")).cast("bigint").alias("fail_count"),
        F.count(F.lit(1)).alias("table_count"),
        F.coalesce(F.sum(F.when(F.col("success"), F.col("row_count"))), F.lit(0)).cast("bigint").alias("total_rows"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("success"), F.col("source_table")))), ",").alias(
            "failed_tables"
        ),
    )


def read_target(spark: SparkSession, target_root: str, names: list[str], schema: str = "target") -> Database:
    """The tables of a target folder, plain or versioned. One that is not there is missing; any other error of reading
    is kept in ``unreadable`` with its cause."""
    tables, errors = {}, {}
    for n in names:
        if not n:
            continue
        path = f"{target_root}/{n}"
        try:
            tables[n] = versioned.read_table(spark, path) if versioned.header(path) is not None else spark.read.parquet(path)
        except AnalysisException as exc:
            if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                errors[n] = _short(exc)
        except Exception as exc:  # noqa: BLE001 — kept as data
            errors[n] = _short(exc)
    return Database(schema, tables, {}, {n: "BASE TABLE" for n in tables}, errors)


def measured_types(
    spark: SparkSession, db: Database, names: list[str], parallel_tables: int = 8, profile: str = "current", profile_lengths: bool = True
) -> tuple[dict[str, dict[str, str]], dict[str, str]]:
    """(target types of every table, errors): one length aggregate for each table, side by side, each failure its own; then all
    tables are mapped in one plan over their metadata."""
    errors: dict[str, str] = {}

    def measure(t: str) -> dict:
        try:
            return cat.measured_lengths(db.table(t))
        except Exception as exc:  # the profile's failure is this table's own
            errors[t] = _short(exc)
            return {}

    lengths = {}
    if profile_lengths:
        with ThreadPoolExecutor(max_workers=max(1, parallel_tables)) as pool:
            lengths = dict(zip(names, pool.map(measure, names)))
    good = [t for t in names if t not in errors]
    types = all_target_types(ddl.map_types(cat.measured_catalog(spark, db.subset(good), lengths), profile)) if good else {}
    return types, errors


def transfer_all(
    spark: SparkSession,
    source: Database,
    target_root: str,
    names: list[str] | None = None,
    parallel_tables: int = 8,
    on_bad_values: str = "fail",
    profile_lengths: bool = True,
    error_log: str | None = None,
    sink: str = "parquet",
) -> TransferRun:
    """JOB2: every table of the source, failures isolated, then summary and verification.

    Each table is profiled and loaded on its own, side by side; the metadata of all is mapped in one plan.
    ``profile_lengths=False`` declares text as (max) instead of profiling it first, so
    each table is read once (for very large sources). ``error_log`` is a folder to which
    the errors of this run are added as JSON lines (W9)."""
    names = list(names) if names is not None else source.names()
    db = source.subset(names)
    listed = list(names) + [t for t in source.unreadable if t not in names and names == source.names()]
    # Widest tables first: the longest load starts first and small ones fill in around it.
    order = sorted(listed, key=lambda t: -len(db.tables[t].columns) if t in db.tables else 0)
    # Sources that would share a target folder are refused before anything is loaded.
    taken: dict[str, list[str]] = {}
    for t in listed:
        taken.setdefault((target_name(source.schema, t) or "").lower(), []).append(t)

    def refused(t: str) -> str | None:
        if t in source.unreadable:
            return source.unreadable[t]
        if t not in db.tables:
            return "no such table"
        name = target_name(source.schema, t)
        others = [x for x in taken[(name or "").lower()] if x != t] if name else []
        return f"target name {name} is also that of {', '.join(others)}" if others else None

    errors = {t: refused(t) for t in listed}
    types, unprofiled = measured_types(spark, db, [t for t in order if errors[t] is None], parallel_tables, profile_lengths=profile_lengths)
    errors.update(unprofiled)

    def load_and_open(t):
        # One scheduler pool per table: under spark.scheduler.mode=FAIR the tables share
        # executors instead of queueing behind each other (no effect under FIFO).
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"tableferry-{t}")
        row = {
            "source_table": f"{source.schema}.{t}", "target_table": target_name(source.schema, t),
            "success": False, "row_count": None, "error": errors[t],
        }
        if row["error"] is None:
            row = transfer_table(spark, db, t, target_root, types, on_bad_values, sink=sink)
        frame = None
        if row["success"]:
            frame = read_target(spark, target_root, [row["target_table"]]).tables.get(row["target_table"])
        return row, frame

    with ThreadPoolExecutor(max_workers=max(1, parallel_tables)) as pool:
        done = dict(zip(order, pool.map(load_and_open, order)))
    rows = [done[t][0] for t in listed]
    results = spark.createDataFrame(rows, RESULT_SCHEMA)
    if error_log and any(r["error"] for r in rows):
        report.write_error_log(report.load_errors(results), error_log)
    ok = [(r["source_table"].split(".", 1)[1], r["target_table"]) for r in rows if r["success"]]
    target = Database(
        "target",
        {done[t][0]["target_table"]: done[t][1] for t in listed if done[t][1] is not None},
    )
    if ok:
        verification = reconcile.verify_tables(spark, db, target, ok)
    else:
        verification = spark.createDataFrame(
            [],
            "source_table string, target_table string, source_rows bigint, target_rows bigint, "
            "source_columns bigint, target_columns bigint, row_count_match boolean, "
            "column_count_match boolean, is_valid boolean",
        )
    return TransferRun(
        results,
        verification,
        run_summary(results),
        reconcile.verification_summary(verification, results),
        target,
    )


def transfer_report(run: TransferRun) -> DataFrame:
    """The flagship result: one row per table — the transfer outcome and its verification."""
    v = run.verification.drop("source_table")
    return run.results.join(v, "target_table", "left").select(
        "source_table",
        "target_table",
        "success",
        "row_count",
        "error",
        "source_rows",
        "target_rows",
        "source_columns",
        "target_columns",
        F.coalesce("row_count_match", F.lit(False)).alias("row_count_match"),
        F.coalesce("column_count_match", F.lit(False)).alias("column_count_match"),
        F.coalesce("is_valid", F.lit(False)).alias("is_valid"),
    )


# --------------------------------------------------------------------------- legacy


def migrate_table(
    spark: SparkSession,
    source: Database,
    table: str,
    target_root: str,
    page_size: int = paging.DEFAULT_PAGE_SIZE,
    types: dict[str, str] | None = None,
) -> dict:
    """JOB4: legacy copy — count, pre-process (P11-P13), load, counts.

    The legacy tool reads ``page_size``-row pages; on Spark the pages are partitions of
    one pipeline, and ``batches`` reports the page count the legacy run would have made.

    With ``types`` (P2) the rows go into the versioned table that the structure phase created, in one transaction. If
    values do not fit, the rows are taken in load order instead (W4): bad ones are skipped, the error after the tenth ends the
    load, the good rows before it are in the table and the table counts as failed."""
    out = {"table_name": table, "total_records": 0, "migrated_rows": 0, "batches": 0,
           "success": False, "error": None}
    try:
        read = load.observation("read")
        df = source.table(table)
        prepared = conform.preprocess_legacy(df.observe(read, F.count(F.lit(1)).alias("rows")))
        if types is None:
            written = load.write_table(prepared, f"{target_root}/{table}")
            out.update(total_records=int(read.get["rows"]), success=True)
        else:
            path = f"{target_root}/{table}"
            try:
                written = versioned.load_table(strict_conform(prepared, types), path, "overwrite")["rows"]
                out.update(total_records=int(read.get["rows"]), success=True)
            except Exception:
                ordered = quality.load_in_order(conform.preprocess_legacy(df), types, source.keys(table))
                failed = ordered.errors.count()
                if not failed:  # not a matter of values
                    raise
                kept = conform.conform_table(ordered.kept.drop("row_no"), types)
                written = versioned.load_table(kept, path, "overwrite")["rows"]
                where = f", stopped at row {ordered.stop_row}" if ordered.stop_row else ""
                out.update(total_records=df.count(), error=f"{failed} rows failed{where}")
        out.update(migrated_rows=written, batches=math.ceil(written / page_size))
    except Exception as exc:
        out["error"] = _short(exc)
    return out


MIGRATION_SCHEMA = (
    "table_name string, phase string, pos int, structure_ok boolean, data_ok boolean, "
    "total_records bigint, migrated_rows bigint, batches bigint, error string"
)


def migrate_database(
    spark: SparkSession,
    source: Database,
    target_root: str,
    plan: list[str],
    parallel_tables: int = 4,
) -> DataFrame:
    """JOB3: planned tables first, then the remaining ones, in two phases. Structures: every table is created anew under its
    legacy types (P2) and primary key (W6), and the columns of the created table are counted against the source. Data:
    tables with a structure are copied (JOB4). One row per table; :func:`migration_verdict` summarises."""
    available = source.names()
    planned = [t for t in plan if t in available]
    remaining = sorted(t for t in available if t not in plan)
    order = [("planned", i + 1, t) for i, t in enumerate(planned)] + [
        ("remaining", len(planned) + i + 1, t) for i, t in enumerate(remaining)
    ]
    types, errors = measured_types(spark, source, available, parallel_tables, profile="legacy")

    def create(t):
        try:
            fields = source.table(t).schema.fields
            nullable = {f.name: f.nullable for f in fields}
            made = versioned.create_table(
                f"{target_root}/{t}", versioned.mapped_columns(types.get(t, {}), nullable), source.keys(t), replace=True
            )
            return None if made == len(fields) else f"{made} of {len(fields)} columns created"
        except Exception as exc:
            return _short(exc)

    with ThreadPoolExecutor(max_workers=max(1, parallel_tables)) as pool:
        errors.update({t: e for t, e in zip(available, pool.map(lambda t: errors.get(t) or create(t), available)) if e})

    def run(item):
        phase, pos, t = item
        if t in errors:
            return (t, phase, pos, False, False, 0, 0, 0, errors[t])
        r = migrate_table(spark, source, t, target_root, types=types[t])
        return (t, phase, pos, True, r["success"], r["total_records"], r["migrated_rows"],
                r["batches"], r["error"])

    # File targets enforce no foreign keys: tables run concurrently, submitted in plan order.
    with ThreadPoolExecutor(max_workers=max(1, parallel_tables)) as pool:
        rows = list(pool.map(run, order))
    rows += [
        (t, "unreadable", len(order) + i + 1, False, False, 0, 0, 0, e)
        for i, (t, e) in enumerate(sorted(source.unreadable.items()))
    ]
    return spark.createDataFrame(rows, MIGRATION_SCHEMA)


def migration_verdict(migration: DataFrame) -> DataFrame:
    """structure/data counts, failed list, verdict all / partial / none; success =
    at least one table copied (the reference's rule, quirk Q21) and a strict flag."""
    agg = migration.agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.count_if("structure_ok").cast("bigint").alias("structures_ok"),
        F.count_if("data_ok").cast("bigint").alias("data_ok"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("data_ok"), F.col("table_name")))), ",").alias(
            "failed_tables"
        ),
    )
    return agg.select(
        "*",
        F.when(F.col("data_ok") == F.col("total_tables"), F.lit("all"))
        .when(F.col("data_ok") > 0, F.lit("partial"))
        .otherwise(F.lit("none"))
        .alias("verdict"),
        (F.col("data_ok") > 0).alias("success"),
        (F.col("data_ok") == F.col("total_tables")).alias("strict_success"),
    )


def list_target_tables(spark: SparkSession, target_root: str, candidates: list[str]) -> DataFrame:
    """The target listing (SHOW TABLES): candidate names with a data file, or a version, in their folder.

    One look at each folder; a folder that is not there is no table, and any other listing
    error rises (a target that can't be listed must not read as empty)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def holds_data(table: str) -> bool:
        path = jvm.org.apache.hadoop.fs.Path(f"{target_root}/{table}")
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            return False
        files = fs.listFiles(path, True)
        while files.hasNext():
            at = files.next().getPath()
            if at.getName().endswith(".parquet") or at.getParent().getName() == "_log":
                return True
        return False

    return spark.createDataFrame([(t,) for t in candidates if holds_data(t)], "table_name string")


def validate_action(
    spark: SparkSession, source: Database, target_root: str, plan: list[str], empty_ok: bool = True
) -> tuple[DataFrame, DataFrame]:
    """JOB5: migrate first if any source table is missing from the target, then validate.

    Returns (per-table validation, database verdict)."""
    names = source.names()
    src_names = spark.createDataFrame([(t,) for t in names], "table_name string")
    tgt_names = list_target_tables(spark, target_root, names)
    if reconcile.missing_tables(src_names, tgt_names).count() > 0:
        migrate_database(spark, source, target_root, plan)
    target = read_target(spark, target_root, names)
    # Against the source as it is; only NaN counts as the NULL it is stored as.
    plain = Database(
        source.schema,
        {t: conform.normalize_nulls(source.table(t)) for t in names},
        source.primary_keys,
        source.table_types,
    )
    validation = reconcile.validate_tables(plain, target, names, empty_ok=empty_ok)
    return validation, reconcile.validate_database(validation)


def maintenance_report(spark: SparkSession, target_root: str, names: list[str], target_bytes: int = versioned.TARGET_BYTES) -> DataFrame:
    """Merge small files, analyze and recount every target table: (table_name, row_count, status, error, files_before,
    files_after). ``optimized`` means that no files are left to merge and the statistics stand; a table
    that is not there is ``missing``, one that failed is ``error`` with its cause."""
    import hashlib

    run = hashlib.md5(target_root.encode()).hexdigest()[:10]  # catalog names unique per target

    def maintain(n):
        return {**load.maintain_table(spark, f"tf_{run}_{n}", f"{target_root}/{n}", target_bytes=target_bytes), "table_name": n}

    with ThreadPoolExecutor(max_workers=4) as pool:
        status = list(pool.map(maintain, names))
    status_df = spark.createDataFrame(
        status, "table_name string, status string, error string, files_before int, files_after int"
    )
    target = read_target(spark, target_root, names)
    counts = cat.row_counts(target) if target.tables else spark.createDataFrame([], "table_name string, row_count bigint")
    return status_df.join(counts, "table_name", "left").select(
        "table_name", "row_count", "status", "error", "files_before", "files_after"
    )


def optimize_action(spark: SparkSession, source: Database, target_root: str, plan: list[str]) -> DataFrame:
    """JOB6: migrate first when the target has no tables, then maintain every table."""
    names = source.names()
    if list_target_tables(spark, target_root, names).isEmpty():
        migrate_database(spark, source, target_root, plan)
    return maintenance_report(spark, target_root, names)


def run_all(spark: SparkSession, source: Database, target_root: str, plan: list[str]) -> DataFrame:
    """JOB7: migrate -> validate -> optimize, continuing after partial failure.

    One row per table: data copied, consistent, maintenance status."""
    migration = migrate_database(spark, source, target_root, plan)
    validation, _ = validate_action(spark, source, target_root, plan)
    maint = maintenance_report(spark, target_root, source.names())
    return (
        migration.select("table_name", "data_ok", "migrated_rows")
        .join(validation.select("table_name", "data_consistency"), "table_name", "left")
        .join(maint.select("table_name", "status"), "table_name", "left")
    )
