"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query runs one operator of the inventory over the fixture tables (whole tables).
Verification queries compare the source with a deterministic damaged target
(:mod:`tableferry.fixtures`); transfer queries write to a fresh folder below the shared
folder and read the result back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry import fixtures
from tableferry.functions import names as N
from tableferry.functions import values as V
from tableferry.operators import conform, ddl, diffsketch, difftree, discovery, profile, quality, reconcile, setops, typechoice
from tableferry.plans import jobs, load, report
from tableferry.session import apply_defaults, materialize, new_run_dir
from tableferry.sources import catalog as cat
from tableferry.sources import paging, versioned
from tableferry.sources.tables import (
    ALL_TABLES,
    FOREIGN_KEYS,
    PRIMARY_KEYS,
    read_database,
)

# Load order of the legacy plan: parents before children; ``partsupp`` is planned but
# absent from the source, so planning must filter it out.
PLAN = ["region", "nation", "supplier", "customer", "part", "orders", "lineitem", "partsupp"]

# Declared source types that differ from what the parquet schema implies (the source
# system's DDL): documents.text without a declared length (-> VARCHAR(255)),
# part.p_partkey as tinyint, part.p_retailprice as real, events.ts as datetime.
DECLARED = {
    ("documents", "text"): ("nvarchar", None, None, None),
    ("part", "p_partkey"): ("tinyint", None, 3, 0),
    ("part", "p_retailprice"): ("real", None, 24, None),
    ("events", "ts"): ("datetime", None, None, None),
}


def _db(spark, sf_dir, tables=ALL_TABLES):
    apply_defaults(spark)
    return read_database(spark, sf_dir, tables)


def _target(spark, sf_dir):
    return fixtures.damaged_target(_db(spark, sf_dir, ALL_TABLES))


def _declared_catalog(spark, db) -> DataFrame:
    c = cat.column_catalog(spark, db)
    for (t, col), (dtype, length, prec, scale) in DECLARED.items():
        hit = (F.col("table_name") == t) & (F.col("column_name") == col)
        c = c.withColumns(
            {
                "data_type": F.when(hit, F.lit(dtype)).otherwise(F.col("data_type")),
                "character_maximum_length": F.when(hit, F.lit(length).cast("bigint")).otherwise(
                    F.col("character_maximum_length")
                ),
                "numeric_precision": F.when(hit, F.lit(prec).cast("int")).otherwise(F.col("numeric_precision")),
                "numeric_scale": F.when(hit, F.lit(scale).cast("int")).otherwise(F.col("numeric_scale")),
            }
        )
    return c


def _target_types(spark, sf_dir, table) -> dict[str, str]:
    db = _db(spark, sf_dir, [table])
    return jobs.table_target_types(ddl.map_types(_declared_catalog(spark, db)), table)


# --------------------------------------------------------------------------- sources


def q_scan_full(spark, sf_dir):
    from tableferry.sources.tables import scan_full

    return scan_full(_db(spark, sf_dir, ["orders"]).table("orders"))


def q_scan_paged(spark, sf_dir):
    paged = paging.page_index(_db(spark, sf_dir, ["orders"]).table("orders"), ["o_orderkey"])
    return paging.page_summary(paged, "o_orderkey")


def q_list_base_tables(spark, sf_dir):
    db = _db(spark, sf_dir)
    listed = cat.list_base_tables(cat.table_catalog(spark, db))
    return listed.join(cat.row_counts(db), "table_name").select(
        "table_schema", "table_name", "full_name", "row_count"
    )


def q_table_structure(spark, sf_dir):
    return cat.table_structure(spark, _db(spark, sf_dir))


def q_column_catalog(spark, sf_dir):
    return cat.column_info(cat.column_catalog(spark, _db(spark, sf_dir)))


def q_column_catalog_legacy(spark, sf_dir):
    return cat.column_catalog_legacy(cat.column_catalog(spark, _db(spark, sf_dir)))


def q_column_catalog_sys(spark, sf_dir):
    frames = cat.sys_catalog_frames(cat.column_catalog(spark, _db(spark, sf_dir)))
    return cat.column_catalog_sys(*frames)


def q_schema_probe(spark, sf_dir):
    return cat.schema_probe(spark, _db(spark, sf_dir, ["documents"]).table("documents"), "documents")


def q_table_row_counts(spark, sf_dir):
    return cat.row_counts(_db(spark, sf_dir))


def q_top_n_preview(spark, sf_dir):
    df = _db(spark, sf_dir, ["customer"]).table("customer")
    return setops.top_n_preview(df, ["c_custkey", "c_name", "c_acctbal"], "c_custkey", 3)


def _listing(db) -> DataFrame:
    """The tables that can be read and counted (S12), and one table per customer, as a source
    that is split by customer would list them."""
    tables = cat.row_counts(db).filter(F.col("row_count").isNotNull()).select("table_name")
    return tables.union(db.table("customer").select(F.concat(F.lit("customer_"), F.col("c_custkey").cast("string"))))


def _name_frames(spark, sf_dir):
    return _listing(_db(spark, sf_dir)), _listing(_target(spark, sf_dir))


def _plan_frame(spark, sf_dir):
    """The legacy plan, then the tables of every fourth customer."""
    split = _db(spark, sf_dir, ["customer"]).table("customer").where("c_custkey % 4 = 0")
    rest = split.select(
        F.concat(F.lit("customer_"), F.col("c_custkey").cast("string")).alias("table_name"),
        (F.col("c_custkey") + len(PLAN) + 1).cast("int").alias("pos"),
    )
    return setops.ordered_plan(spark, PLAN).select("table_name", F.col("pos").cast("int")).unionByName(rest)


def q_known_tables(spark, sf_dir):
    src, tgt = _name_frames(spark, sf_dir)
    return cat.known_tables(src, tgt)


def q_unknown_tables(spark, sf_dir):
    src, tgt = _name_frames(spark, sf_dir)
    return cat.unknown_tables(src, tgt)


# --------------------------------------------------------------------------- loads


def q_load_batched(spark, sf_dir):
    db = _db(spark, sf_dir, ["customer"])
    types = jobs.table_target_types(ddl.map_types(cat.column_catalog(spark, db)), "customer")
    path = new_run_dir(spark, "load_batched") + "/dbo_customer"
    load.write_table(jobs.strict_conform(db.table("customer"), types), path)
    return spark.read.parquet(path)


def q_load_transactional(spark, sf_dir):
    """Customer in one transaction, then a load whose row with the largest key does not fit: the table stays as it was."""
    customer = _db(spark, sf_dir, ["customer"]).table("customer")
    types = jobs.measured_types(spark, _db(spark, sf_dir, ["customer"]), ["customer"])[0]["customer"]
    path = new_run_dir(spark, "load_transactional") + "/dbo_customer"
    versioned.create_table(path, versioned.mapped_columns(types), ["c_custkey"])
    versioned.load_table(jobs.strict_conform(customer, types), path)
    last = F.col("c_custkey") == customer.agg(F.max("c_custkey")).scalar()
    bad = customer.withColumn("c_mktsegment", F.when(last, F.repeat("c_mktsegment", 50)).otherwise(F.col("c_mktsegment")))
    try:
        versioned.load_table(bad.repartitionByRange(4, "c_custkey"), path, "overwrite")
        failed = False
    except Exception:
        failed = True
    told = versioned.header(path)
    return versioned.read_table(spark, path).withColumns({"version": F.lit(told["version"]), "second_load_failed": F.lit(failed)})


def _created(spark, root: str, folders: dict[str, str]) -> DataFrame:
    """The columns of created tables, from their published headers (metadata: one row for each column)."""
    rows = []
    for name, folder in folders.items():
        told = versioned.header(f"{root}/{folder}")
        for i, c in enumerate(told["columns"], start=1):
            rows.append((name, c["name"], i, c["type"], told["key"].index(c["name"]) + 1 if c["name"] in told["key"] else None, c["nullable"]))
    return spark.createDataFrame(
        rows, "table_name string, column_name string, ordinal_position int, target_type string, key_ordinal int, takes_null boolean"
    )


def q_created_tables(spark, sf_dir):
    """Every table created under its mapped types, lengths measured in the data, and read back."""
    db, root = _db(spark, sf_dir), new_run_dir(spark, "created")
    types, _ = jobs.measured_types(spark, db, db.names())
    for t in db.names():
        versioned.create_table(f"{root}/{t}", versioned.mapped_columns(types[t]), PRIMARY_KEYS[t])
    return _created(spark, root, {t: t for t in db.names()})


def q_migrate_structures(spark, sf_dir):
    """JOB3, structures: the legacy types (P2) and keys of the tables that a whole migration created."""
    db, root = _db(spark, sf_dir), new_run_dir(spark, "migrate_structures")
    jobs.migrate_database(spark, db, root, PLAN)
    return _created(spark, root, {t: t for t in db.names()})


def _spread(df: DataFrame, files: int) -> DataFrame:
    """``df`` dealt to ``files`` tasks; a larger table to four for each of its partitions, so that none reads more as it grows."""
    return df.repartition(max(files, 4 * df.rdd.getNumPartitions()))


def q_optimize_files(spark, sf_dir):
    """Every table loaded in eight files (more for a large table), merged to what its bytes fill, and recounted."""
    db, root = _db(spark, sf_dir), new_run_dir(spark, "optimize_files")
    for t in db.names():
        versioned.load_table(_spread(db.table(t), 8), f"{root}/{t}")
    report = jobs.maintenance_report(spark, root, db.names())
    return report.select(
        "table_name", "row_count", "status", "error", (F.col("files_before") > 1).alias("was_split"), "files_after"
    )


def q_file_extremes(spark, sf_dir):
    """Rows, nulls and extremes of the integer columns of every table, from the file lists of versioned tables alone."""
    db, root = _db(spark, sf_dir), new_run_dir(spark, "file_extremes")
    parts = []
    for t in db.names():
        whole = [f.name for f in db.table(t).schema.fields if f.dataType.simpleString() in ("int", "bigint")]
        if whole:
            versioned.load_table(_spread(db.table(t), 4), f"{root}/{t}")
            listed = versioned.file_list(spark, f"{root}/{t}").select(F.lit(t).alias("table_name"), "rows", F.inline("stats"))
            parts.append(listed.where(F.col("column").isin(whole)))
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("table_name", F.col("column").alias("column_name")).agg(
        F.sum("rows").alias("row_count"), F.sum("nulls").alias("null_count"),
        F.min(F.col("low").cast("bigint")).alias("min_value"), F.max(F.col("high").cast("bigint")).alias("max_value"),
    )


def _ragged_frames(spark, sf_dir):
    c = _db(spark, sf_dir, ["customer"]).table("customer")
    first = F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")
    a = c.filter(first).select(
        "c_custkey", "c_name", "c_mktsegment", F.length("c_name").cast("bigint").alias("c_name_len")
    )
    b = c.filter(~first).select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return a, b


def q_load_rowwise(spark, sf_dir):
    a, b = _ragged_frames(spark, sf_dir)
    path = new_run_dir(spark, "load_rowwise") + "/dbo_customer"
    load.load_rowwise([a, b], path)
    return spark.read.parquet(path)


def q_align_columns(spark, sf_dir):
    a, b = _ragged_frames(spark, sf_dir)
    return conform.align_columns([a, b], ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])


def q_load_chunk_plan(spark, sf_dir):
    paged = paging.page_index(_db(spark, sf_dir, ["orders"]).table("orders"), ["o_orderkey"])
    return paging.chunk_plan(paging.page_summary(paged, "o_orderkey"))


def _documents(spark, sf_dir):
    return _db(spark, sf_dir, ["documents"]).table("documents")


def q_quarantine_good(spark, sf_dir):
    return quality.quarantine_good(_documents(spark, sf_dir), _target_types(spark, sf_dir, "documents"))


def q_quarantine_bad(spark, sf_dir):
    return quality.quarantine_bad(_documents(spark, sf_dir), _target_types(spark, sf_dir, "documents"))


def q_reject_preview(spark, sf_dir):
    bad = quality.quarantine_bad(_documents(spark, sf_dir), _target_types(spark, sf_dir, "documents"))
    return quality.reject_preview(bad, "doc_id", ["text"])


def q_reject_summary(spark, sf_dir):
    bad = quality.quarantine_bad(_documents(spark, sf_dir), _target_types(spark, sf_dir, "documents"))
    return quality.reject_summary(bad)


def _part_in_order(spark, sf_dir):
    part = _db(spark, sf_dir, ["part"]).table("part")
    return quality.load_in_order(part, _target_types(spark, sf_dir, "part"), ["p_partkey"])


def q_fallback_rows(spark, sf_dir):
    """The rows that a load row by row keeps, up to the error that ends it."""
    return _part_in_order(spark, sf_dir).kept.select("row_no", "p_partkey", "p_name")


def q_fallback_errors(spark, sf_dir):
    """The errors of that load, the last one being where it stops."""
    out = _part_in_order(spark, sf_dir)
    return out.errors.select("row_no", "p_partkey", "reject_reasons", (F.col("row_no") == F.lit(out.stop_row)).alias("stops"))


def q_rejected_cells(spark, sf_dir):
    """D5 against given target types: numbers, bytes, text and dates that the load rejects."""
    part = _db(spark, sf_dir, ["part"]).table("part")
    types = {"p_partkey": "TINYINT", "p_name": "VARCHAR(8)", "p_brand": "BINARY(7)", "p_type": "DATE", "p_retailprice": "DECIMAL(5,2)"}
    return quality.suspect_cells(part, "p_partkey", types)


# --------------------------------------------------------------------------- typemap / ddl


def q_map_types(spark, sf_dir):
    return ddl.map_types(cat.column_catalog(spark, _db(spark, sf_dir))).select(
        "table_name", "column_name", "ordinal_position", "data_type", "character_maximum_length",
        "numeric_precision", "numeric_scale", "target_type",
    )


def q_map_types_legacy(spark, sf_dir):
    return ddl.map_types(cat.column_catalog(spark, _db(spark, sf_dir)), "legacy").select(
        "table_name", "column_name", "ordinal_position", "data_type", "character_maximum_length",
        "numeric_precision", "numeric_scale", "target_type",
    )


def q_column_definitions(spark, sf_dir):
    c = cat.column_catalog(spark, _db(spark, sf_dir))
    keep = ddl.column_definitions(c, True)
    create = ddl.column_definitions(c, False).select(
        "table_name", "column_name", F.col("is_auto_increment").alias("auto_increment_create")
    )
    return keep.withColumnRenamed("is_auto_increment", "auto_increment_preserve").join(
        create, ["table_name", "column_name"]
    ).drop("table_schema")


def q_render_ddl(spark, sf_dir):
    return ddl.render_ddl(ddl.column_definitions(cat.column_catalog(spark, _db(spark, sf_dir))))


def _pk_frame(spark, db):
    rows = [(t, c, i + 1) for t in db.names() for i, c in enumerate(PRIMARY_KEYS.get(t, []))]
    return spark.createDataFrame(rows, "table_name string, column_name string, key_ordinal int")


def q_render_ddl_legacy(spark, sf_dir):
    db = _db(spark, sf_dir)
    return ddl.render_ddl_legacy(cat.column_catalog(spark, db), _pk_frame(spark, db))


# --------------------------------------------------------------------------- names


def _name_inputs(spark, sf_dir):
    c = cat.column_catalog(spark, _db(spark, sf_dir))
    dotted = c.select(F.concat_ws(".", "table_schema", "table_name", "column_name").alias("name"))
    tables = c.select(F.concat_ws(".", "table_schema", "table_name").alias("name"))
    bracketed = c.select(F.concat(F.lit("["), "table_schema", F.lit("].["), "table_name", F.lit("]")).alias("name"))
    bare = c.select(F.col("table_name").alias("name"))
    db = _db(spark, sf_dir, ["customer", "supplier"])
    # Names made of rows: dots and underscores that meet in one target name, blanks, signs
    # that no name may hold, dots at either end, letters beyond ASCII.
    per_customer = db.table("customer").select(F.concat(
        F.col("c_mktsegment"), F.when(F.col("c_custkey") % 2 == 0, F.lit(".")).otherwise(F.lit("_")),
        F.lit("C"), F.floor(F.col("c_custkey") / 3).cast("string"),
    ).alias("name"))
    key, number = F.col("s_suppkey") % 5, F.col("s_suppkey").cast("string")
    per_supplier = db.table("supplier").select(
        F.when(key == 0, F.lit("  "))
        .when(key == 1, F.concat(F.lit("[dbo].["), "s_name", F.lit("]")))
        .when(key == 2, F.concat(F.lit(".S"), number))
        .when(key == 3, F.concat(F.lit("S"), number, F.lit(".")))
        .otherwise(F.concat(F.lit("dbo.Händler_"), number)).alias("name")
    )
    return dotted.union(tables).union(bracketed).union(bare).union(per_customer).union(per_supplier).distinct()


def q_target_names(spark, sf_dir):
    n = _name_inputs(spark, sf_dir)
    return n.select("name", N.target_table_name("name").alias("target_table"),
                    N.target_table_name("name").isNotNull().alias("is_valid"))


def q_source_names(spark, sf_dir):
    n = _name_inputs(spark, sf_dir).select(N.target_table_name("name").alias("name"))
    return n.distinct().select("name", N.source_table_name("name").alias("source_table"))


def q_valid_names(spark, sf_dir):
    n = _name_inputs(spark, sf_dir)
    flat = n.select(N.target_table_name("name").alias("name")).where(F.col("name").isNotNull())
    return n.union(flat).distinct().select("name", N.is_valid_target_name("name").alias("is_valid"))


def q_schema_part(spark, sf_dir):
    return _name_inputs(spark, sf_dir).select("name", N.schema_part("name").alias("schema_part"))


def q_table_part(spark, sf_dir):
    return _name_inputs(spark, sf_dir).select("name", N.table_part("name").alias("table_part"))


def q_name_collisions(spark, sf_dir):
    # Distinct source objects: bracket spellings of one name are the same object.
    n = (
        _name_inputs(spark, sf_dir).select(N.strip_brackets("name").alias("name")).distinct()
        .select("name", N.target_table_name("name").alias("target_table"))
    )
    return (
        n.where(F.col("target_table").isNotNull())
        .groupBy("target_table")
        .agg(F.count(F.lit(1)).alias("n_sources"),
             F.array_join(F.array_sort(F.collect_list("name")), ",").alias("sources"))
        .filter(F.col("n_sources") > 1)
    )


# --------------------------------------------------------------------------- quality


def q_duplicate_keys(spark, sf_dir):
    li = _db(spark, sf_dir, ["lineitem"]).table("lineitem")
    return quality.duplicate_keys(li, ["l_orderkey", "l_linenumber"])


def q_too_long(spark, sf_dir):
    types = _target_types(spark, sf_dir, "documents")
    limits, _ = quality.target_rules(_documents(spark, sf_dir), types)
    return quality.too_long(_documents(spark, sf_dir), "doc_id", limits)


def q_out_of_range(spark, sf_dir):
    part = _db(spark, sf_dir, ["part"]).table("part")
    _, ranges = quality.target_rules(part, _target_types(spark, sf_dir, "part"))
    return quality.out_of_range(part, "p_partkey", ranges)


def q_bad_dates(spark, sf_dir):
    o = _db(spark, sf_dir, ["orders"]).table("orders")
    text = (
        F.when(F.col("o_orderkey") % 7 == 0, F.date_format("o_orderdate", "yyyy-'13'-dd"))
        .when(F.col("o_orderkey") % 11 == 0, F.lit("n/a"))
        .otherwise(F.col("o_orderdate").cast("string"))
    )
    as_text = o.select("o_orderkey", text.alias("o_orderdate"))
    return quality.bad_dates(as_text, "o_orderkey")


def q_suspect_cells(spark, sf_dir):
    return quality.suspect_cells(_documents(spark, sf_dir), "doc_id", _target_types(spark, sf_dir, "documents"))


# --------------------------------------------------------------------------- conform


def q_conform_table(spark, sf_dir):
    part = _db(spark, sf_dir, ["part"]).table("part")
    return conform.conform_table(part, _target_types(spark, sf_dir, "part"))


def q_conform_failures(spark, sf_dir):
    part = _db(spark, sf_dir, ["part"]).table("part")
    return conform.conform_failures(part, _target_types(spark, sf_dir, "part"))


def q_normalize_nulls(spark, sf_dir):
    li = _db(spark, sf_dir, ["lineitem"]).table("lineitem")
    with_nan = li.withColumn("l_tax", F.when(F.col("l_orderkey") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")))
    return conform.normalize_nulls(with_nan)


def q_format_timestamps(spark, sf_dir):
    return conform.format_timestamps(_db(spark, sf_dir, ["events"]).table("events"))


def q_parse_date_text(spark, sf_dir):
    o = _db(spark, sf_dir, ["orders"]).table("orders")
    text = o.select("o_orderkey", F.date_format("o_orderdate", "yyyy/M/d").alias("o_orderdate_text"))
    return text.select("o_orderkey", "o_orderdate_text", V.parse_date_text("o_orderdate_text").alias("o_orderdate"))


def q_lossy_rows(spark, sf_dir):
    parts = []
    for t in ("part", "events"):
        df = _db(spark, sf_dir, [t]).table(t)
        parts.append(conform.lossy_audit(df, _target_types(spark, sf_dir, t)).withColumn("table_name", F.lit(t)))
    return parts[0].unionByName(parts[1]).select("table_name", "column_name", "target_type", "lossy_rows")


# --------------------------------------------------------------------------- types from values


def q_narrowest_types(spark, sf_dir):
    """The narrowest lossless target type of every column of all tables."""
    db = _db(spark, sf_dir)
    facts = [typechoice.type_facts(df, name) for name, df in db.tables.items()]
    return typechoice.choose_types(reduce(DataFrame.unionByName, facts))


def q_narrowest_types_text(spark, sf_dir):
    """The types that tables delivered as text turn out to have; facts of both halves of a table merged."""
    db = _db(spark, sf_dir, ["orders", "lineitem", "events"])
    facts = []
    for name, df in db.tables.items():
        texts = [
            F.col(f.name).cast("decimal(18,2)" if isinstance(f.dataType, T.DoubleType) else f.dataType).cast("string").alias(f.name)
            for f in df.schema.fields
        ]
        half = F.col(df.columns[0]) % 2
        facts += [typechoice.type_facts(df.where(half == x).select(*texts), name) for x in (0, 1)]
    return typechoice.choose_types(typechoice.merge_facts(*facts))


# --------------------------------------------------------------------------- keys and references from data


def q_minimal_keys(spark, sf_dir):
    """S10 without a catalog: minimal keys of up to three columns of every table."""
    return discovery.minimal_keys(spark, _db(spark, sf_dir))


def q_inclusion_dependencies(spark, sf_dir):
    """S11 without a catalog: every column whose values are all in another column, over all tables."""
    return discovery.inclusion_dependencies(spark, _db(spark, sf_dir))


def _discovered(spark, sf_dir):
    db = _db(spark, sf_dir)
    keys = materialize(discovery.minimal_keys(spark, db))
    return keys, materialize(discovery.reference_candidates(discovery.inclusion_dependencies(spark, db), keys))


def q_primary_keys(spark, sf_dir):
    """The primary keys that the constraint rows made of discovered keys name, in key order."""
    usage, _ = discovery.key_usage("dbo", *_discovered(spark, sf_dir))
    return cat.primary_keys(usage)


def q_foreign_keys(spark, sf_dir):
    """The foreign keys of the constraint rows made of discovered keys and inclusions."""
    usage, constraints = discovery.key_usage("dbo", *_discovered(spark, sf_dir))
    return cat.foreign_keys(constraints, usage)


def q_load_levels(spark, sf_dir):
    """T2, JOB3: the load order that the discovered references of agreeing names ask for."""
    _, references = _discovered(spark, sf_dir)
    tables = spark.createDataFrame([(t,) for t in ALL_TABLES], "table_name string")
    return discovery.load_levels(tables, references.where("same_name"))


# --------------------------------------------------------------------------- profile / reconcile


def q_extreme_values(spark, sf_dir):
    return profile.extreme_values(_db(spark, sf_dir, ["orders"]).table("orders"), "orders")


def _pairs(names):
    return [(t, t) for t in names]


def q_verify_tables(spark, sf_dir):
    src = _db(spark, sf_dir, ALL_TABLES)
    return reconcile.verify_tables(spark, src, fixtures.damaged_target(src), _pairs(ALL_TABLES))


def q_verification_summary(spark, sf_dir):
    return reconcile.verification_summary(q_verify_tables(spark, sf_dir))


def q_validate_tables(spark, sf_dir):
    src = _db(spark, sf_dir, ALL_TABLES)
    return reconcile.validate_tables(src, fixtures.damaged_target(src))


def q_sample_match(spark, sf_dir):
    src = _db(spark, sf_dir, ALL_TABLES)
    return reconcile.sample_match(src, fixtures.damaged_target(src))


def q_extreme_match(spark, sf_dir):
    src = _db(spark, sf_dir, ALL_TABLES)
    return reconcile.extreme_match(src, fixtures.damaged_target(src))


def q_validate_database(spark, sf_dir):
    return reconcile.validate_database(q_validate_tables(spark, sf_dir))


def _customer_diff(spark, sf_dir, mode):
    customer = _db(spark, sf_dir, ["customer"]).table("customer")
    return reconcile.content_diff(customer, fixtures.scrambled_customer(customer), ["c_custkey"], mode=mode)


def q_content_diff(spark, sf_dir):
    return _customer_diff(spark, sf_dir, "hash")


def q_content_diff_digest(spark, sf_dir):
    """X1, the digest plan (for nearly identical large tables)."""
    return _customer_diff(spark, sf_dir, "digest")


def q_content_diff_exact(spark, sf_dir):
    """X1, the exact plan (column-by-column, no hashing)."""
    return _customer_diff(spark, sf_dir, "exact")


def q_content_diff_tree(spark, sf_dir):
    """X1 by descending digest trees: the scrambled customers and the damaged tables."""
    src = _db(spark, sf_dir, ["customer", *fixtures.DAMAGED_COLUMNS])
    tgt = fixtures.damaged_target(src)
    parts = []
    for name in fixtures.DAMAGED_COLUMNS:
        df, key = src.table(name), src.keys(name)
        target = fixtures.scrambled_customer(df) if name == "customer" else tgt.table(name)
        rows = difftree.content_diff_tree(df, target, key)
        parts.append(rows.select(F.lit(name).alias("table_name"), F.col(key[0]).alias("key_value"), "status", "changed_columns"))
    return reduce(DataFrame.unionByName, parts)


def q_content_diff_sketch(spark, sf_dir):
    """X1 without a key: a nearly equal copy of the line items, by an invertible sketch."""
    lines = _db(spark, sf_dir, ["lineitem"]).table("lineitem")
    return diffsketch.content_diff_sketch(lines, fixtures.near_copy(lines))


def q_content_diff_sketch_full(spark, sf_dir):
    """X1 without a key, more differing rows than the sketch holds: signed counts per hash."""
    lines = _db(spark, sf_dir, ["lineitem"]).table("lineitem")
    return diffsketch.content_diff_sketch(lines, fixtures.near_copy(lines), cells=2)


def q_sample_diff(spark, sf_dir):
    src = _db(spark, sf_dir, ["orders"])
    tgt = fixtures.damaged_target(src)
    return reconcile.sample_diff(src.table("orders"), tgt.table("orders"), "o_orderkey")


def q_boundary_rows(spark, sf_dir):
    src = _db(spark, sf_dir, ["orders"])
    tgt = fixtures.damaged_target(src)
    pages = paging.page_summary(paging.page_index(src.table("orders"), ["o_orderkey"]), "o_orderkey")
    return reconcile.boundary_rows(pages, tgt.table("orders"), "o_orderkey")


def q_boundary_rows_composite(spark, sf_dir):
    """J4 on a key of two columns; the target lacks rows by the md5 of both."""
    turns, keys = _db(spark, sf_dir, ["conversations"]).table("conversations"), ["conv_id", "turn"]
    digest = F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys]).cast("binary"))
    target = turns.where(F.substring(digest, 1, 1) != fixtures.DROP_PREFIX)
    pages = paging.page_summary(paging.page_index(turns, keys, 100), keys)
    return reconcile.boundary_rows(pages, target, keys).select(
        "batch_no", "first_key.*", "first_present",
        *[F.col(f"last_key.{k}").alias(f"last_{k}") for k in keys], "last_present", "batch_ok",
    )


def q_missing_tables(spark, sf_dir):
    src, tgt = _name_frames(spark, sf_dir)
    return reconcile.missing_tables(src, tgt.select(F.upper("table_name").alias("table_name")))


def q_orphan_rows(spark, sf_dir):
    return reconcile.orphan_rows(_target(spark, sf_dir), FOREIGN_KEYS)


def q_remaining_tables(spark, sf_dir):
    _, tgt = _name_frames(spark, sf_dir)
    return setops.remaining_tables(tgt, _plan_frame(spark, sf_dir))


def q_planned_tables(spark, sf_dir):
    _, tgt = _name_frames(spark, sf_dir)
    return setops.planned_tables(_plan_frame(spark, sf_dir), tgt)


def q_limit_n(spark, sf_dir):
    """L3 as a checkable fact: how many rows came, how many differ, how many are source rows."""
    orders = _db(spark, sf_dir, ["orders"]).table("orders")
    some = reconcile.limit_n(orders)
    return some.join(orders.select("o_orderkey").distinct().withColumn("known", F.lit(1)), "o_orderkey", "left").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("o_orderkey").alias("n_keys"),
        F.count("known").alias("n_known"),
    )


def q_sample_rows(spark, sf_dir):
    return reconcile.sample_rows(_db(spark, sf_dir, ["orders"]).table("orders"), "o_orderkey")


# --------------------------------------------------------------------------- jobs


def q_stream_transfer(spark, sf_dir):
    from tableferry.streaming.incremental import stream_copy

    db = _db(spark, sf_dir, ["orders"])
    types = jobs.table_target_types(ddl.map_types(cat.column_catalog(spark, db)), "orders")
    root = new_run_dir(spark, "stream_transfer")
    stream_copy(spark, sf_dir, "orders.parquet", db.table("orders").schema, f"{root}/dbo_orders",
                f"{root}/_checkpoint", types, max_files_per_trigger=1)
    return spark.read.parquet(f"{root}/dbo_orders")


def q_stream_progress(spark, sf_dir):
    """A5: the progress rows of a copy in micro-batches of one file: what does not depend on the clock, and whether the rate
    is that of the rows and the time that passed."""
    from tableferry.streaming.incremental import stream_copy, throughput

    orders = _db(spark, sf_dir, ["orders"]).table("orders")
    root = new_run_dir(spark, "stream_progress")
    load.write_table(orders.repartitionByRange(4, "o_orderkey"), f"{root}/in")
    log = stream_copy(spark, f"{root}/in", "*.parquet", orders.schema, f"{root}/out", f"{root}/_checkpoint", max_files_per_trigger=1)
    found = throughput(log, orders.count())
    rate = F.abs(F.col("rows_per_second") * F.col("passed_ms") / 1000 - F.col("rows_done")) <= 0.001 * F.col("rows_done") + F.col("passed_ms") / 10_000
    return found.agg(
        F.count(F.lit(1)).alias("batches"), F.sum("n_rows").alias("n_rows"), F.max("rows_done").alias("rows_done"),
        F.max("percent").alias("percent"), F.bool_and((F.col("passed_ms") > 0) & rate).alias("rates_agree"),
    )


def q_transfer_table(spark, sf_dir):
    db = _db(spark, sf_dir, ["orders"])
    mapped = ddl.map_types(cat.column_catalog(spark, db))
    row = jobs.transfer_table(spark, db, "orders", new_run_dir(spark, "transfer_table"), mapped)
    return spark.createDataFrame([row], jobs.RESULT_SCHEMA)


def _transfer_run(spark, sf_dir):
    db = _db(spark, sf_dir, ALL_TABLES)
    return jobs.transfer_all(spark, db, new_run_dir(spark, "transfer_all"))


def q_transfer_all(spark, sf_dir):
    return jobs.transfer_report(_transfer_run(spark, sf_dir))


def q_transfer_all_single_pass(spark, sf_dir):
    """JOB2 without the length profile: text declared (max), each table read once."""
    db = _db(spark, sf_dir, ALL_TABLES)
    run = jobs.transfer_all(spark, db, new_run_dir(spark, "transfer_all_1p"), profile_lengths=False)
    return jobs.transfer_report(run)


def q_transfer_transactional(spark, sf_dir):
    """JOB2 into versioned tables: each is created under its mapped types and loaded in one transaction."""
    db = _db(spark, sf_dir, ALL_TABLES)
    return jobs.transfer_report(jobs.transfer_all(spark, db, new_run_dir(spark, "transfer_tx"), sink="versioned"))


def q_run_summary(spark, sf_dir):
    return _transfer_run(spark, sf_dir).summary


def q_migrate_table(spark, sf_dir):
    row = jobs.migrate_table(spark, _db(spark, sf_dir, ["orders"]), "orders", new_run_dir(spark, "migrate_table"))
    return spark.createDataFrame(
        [row], "table_name string, total_records bigint, migrated_rows bigint, batches bigint, success boolean, error string"
    )


def q_migrate_database(spark, sf_dir):
    return jobs.migrate_database(spark, _db(spark, sf_dir), new_run_dir(spark, "migrate_database"), PLAN)


def q_migration_verdict(spark, sf_dir):
    return jobs.migration_verdict(q_migrate_database(spark, sf_dir))


def q_batch_progress(spark, sf_dir):
    paged = paging.page_index(_db(spark, sf_dir, ["orders"]).table("orders"), ["o_orderkey"])
    log = paging.page_summary(paged, "o_orderkey").select(
        F.lit("orders").alias("table_name"), "batch_no", "n_rows", F.lit(True).alias("ok")
    )
    return paging.batch_progress(log)


def q_validate_action(spark, sf_dir):
    validation, _ = jobs.validate_action(
        spark, _db(spark, sf_dir, ALL_TABLES), new_run_dir(spark, "validate_action"), PLAN
    )
    return validation


def q_maintenance_report(spark, sf_dir):
    root = new_run_dir(spark, "maintenance")
    db = _db(spark, sf_dir, ALL_TABLES)
    jobs.migrate_database(spark, db, root, PLAN)
    return jobs.maintenance_report(spark, root, db.names()).select("table_name", "row_count", "status")


def q_optimize_action(spark, sf_dir):
    done = jobs.optimize_action(spark, _db(spark, sf_dir, ALL_TABLES), new_run_dir(spark, "optimize"), PLAN)
    return done.select("table_name", "row_count", "status")


def q_run_all(spark, sf_dir):
    return jobs.run_all(spark, _db(spark, sf_dir, ALL_TABLES), new_run_dir(spark, "run_all"), PLAN)


def q_validation_report(spark, sf_dir):
    return report.validation_report_rows(q_validate_tables(spark, sf_dir))


def q_error_log_json(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    tagged = quality.quarantine(docs, _target_types(spark, sf_dir, "documents"))
    paged = paging.scan_paged(tagged.select("doc_id", "reject_reasons"), ["doc_id"])
    return report.error_log_rows(report.batch_errors(paged, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
