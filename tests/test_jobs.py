"""Jobs: transfer results, idempotent reruns, failure isolation, JDBC staged load."""

from pyspark.sql import functions as F

from tableferry.operators import ddl, reconcile
from tableferry.plans import jobs, load
from tableferry.session import new_run_dir
from tableferry.sources import catalog as cat
from tableferry.sources.tables import TPCH_TABLES, Database


def test_transfer_all_verifies_and_is_idempotent(spark, source):
    db = source.subset(TPCH_TABLES)
    root = new_run_dir(spark, "test-transfer")
    first = jobs.transfer_report(jobs.transfer_all(spark, db, root)).collect()
    assert len(first) == 7 and all(r.success and r.is_valid for r in first)
    again = jobs.transfer_all(spark, db, root)  # overwrite: a rerun does not duplicate rows
    assert all(r.is_valid for r in again.verification.collect())
    s = again.summary.first()
    assert s.success_count == 7 and s.fail_count == 0
    assert s.total_rows == sum(db.table(t).count() for t in TPCH_TABLES)
    tgt = again.target
    assert reconcile.content_diff(db.table("customer"), tgt.table("dbo_customer"), ["c_custkey"]).count() == 0


def test_failures_are_isolated(spark):
    ok = spark.createDataFrame([(1, 5)], "id long, v long")
    too_big = spark.createDataFrame([(1, 300)], "id long, v long")
    src = Database("dbo", {"good": ok, "bad name": ok, "overflow": too_big},
                   {"good": ["id"], "bad name": ["id"], "overflow": ["id"]})
    mapped = ddl.map_types(cat.column_catalog(spark, src))
    # Declare overflow.v as tinyint in the source catalog: 300 does not fit the target.
    mapped = mapped.withColumn(
        "target_type",
        F.when((F.col("table_name") == "overflow") & (F.col("column_name") == "v"), F.lit("TINYINT")).otherwise(
            F.col("target_type")
        ),
    )
    root = new_run_dir(spark, "test-fail")
    rows = {t: jobs.transfer_table(spark, src, t, root, mapped) for t in src.names()}
    assert rows["good"]["success"] and rows["good"]["row_count"] == 1
    assert not rows["bad name"]["success"] and rows["bad name"]["target_table"] is None
    assert not rows["overflow"]["success"] and rows["overflow"]["error"]
    lenient = jobs.transfer_table(spark, src, "overflow", root, mapped, on_bad_values="null")
    assert lenient["success"]


def test_run_summary_and_verdict(spark):
    results = spark.createDataFrame(
        [("dbo.a", "dbo_a", True, 10, None), ("dbo.b", "dbo_b", False, None, "boom"), ("dbo.c", "dbo_c", True, 5, None)],
        jobs.RESULT_SCHEMA,
    )
    s = jobs.run_summary(results).first()
    assert (s.success_count, s.fail_count, s.table_count, s.total_rows, s.failed_tables) == (2, 1, 3, 15, "dbo.b")
    mig = spark.createDataFrame(
        [("a", "planned", 1, True, True, 1, 1, 1, None), ("b", "planned", 2, True, False, 0, 0, 0, "x")],
        jobs.MIGRATION_SCHEMA,
    )
    v = jobs.migration_verdict(mig).first()
    assert v.verdict == "partial" and v.success and not v.strict_success


def test_migrate_and_validate_action(spark, source):
    db = source.subset(["region", "nation", "orders"])
    root = new_run_dir(spark, "test-migrate")
    migration = jobs.migrate_database(spark, db, root, ["nation", "region", "missing"]).collect()
    assert [(r.table_name, r.phase, r.pos) for r in sorted(migration, key=lambda r: r.pos)] == [
        ("nation", "planned", 1), ("region", "planned", 2), ("orders", "remaining", 3),
    ]
    validation, overall = jobs.validate_action(spark, db, root, ["nation", "region"])
    assert overall.first().overall_success
    report = jobs.maintenance_report(spark, root, db.names()).collect()
    assert {r.status for r in report} == {"optimized"}


def test_jdbc_staged_load_round_trip(spark, source):
    url = "jdbc:derby:memory:tftest;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = source.table("customer")
    assert load.write_jdbc_atomic(df, url, "CUSTOMER_T", props) == df.count()
    assert load.write_jdbc_atomic(df, url, "CUSTOMER_T", props) == df.count()  # rerun replaces
    back = spark.read.format("jdbc").option("url", url).option("dbtable", "CUSTOMER_T").options(**props).load()
    back = back.toDF(*df.columns)
    assert back.count() == df.count()
    assert df.exceptAll(back).count() == 0 and back.exceptAll(df).count() == 0
    assert reconcile.content_diff(df, back, ["c_custkey"]).count() == 0  # X1 empty after the round trip


def test_spark_ddl_creates_mapped_table(spark, source):
    db = source.subset(["customer"])
    defs = ddl.column_definitions(cat.column_catalog(spark, db))
    stmt = ddl.spark_table_ddl(defs).first()
    assert stmt.target_table == "dbo_customer"
    spark.sql("DROP TABLE IF EXISTS dbo_customer")
    spark.sql(stmt.ddl)
    cols = {c.name: c.dataType for c in spark.catalog.listColumns("dbo_customer")}
    assert cols == {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int",
                    "c_acctbal": "double", "c_mktsegment": "string"}
    spark.sql("DROP TABLE dbo_customer")


def test_report_and_quarantine_sinks(spark, source):
    from tableferry import fixtures
    from tableferry.operators import quality
    from tableferry.plans import report

    src = source.subset(["region", "customer"])
    validation = reconcile.validate_tables(src, fixtures.damaged_target(src))
    root = new_run_dir(spark, "test-report")
    report.write_validation_report(validation, reconcile.validate_database(validation), root + "/report")
    lines = [r.value for r in spark.read.text(root + "/report").collect()]
    assert lines[0].startswith("<table>") and lines[-1] == "</table>" and len(lines) == 4
    assert "status-error" in lines[1] and "status-ok" in lines[2]
    tagged = quality.quarantine(source.table("documents"), {"text": "VARCHAR(255)"})
    counts = load.write_quarantined(tagged, root + "/docs")
    assert counts["good"] + counts["bad"] == source.table("documents").count()
    assert spark.read.parquet(root + "/docs").filter("cast(rejected as boolean)").count() == counts["bad"]


def test_jdbc_partitioned_source_read(spark, source):
    from tableferry.sources.tables import read_jdbc_table

    url = "jdbc:derby:memory:tfsrc;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    orders = source.table("orders")
    load.write_jdbc_atomic(orders, url, "ORDERS_S", props)
    df = read_jdbc_table(spark, url, "ORDERS_S", props, partition_column='"o_orderkey"', num_partitions=4)
    assert df.rdd.getNumPartitions() == 4
    assert df.count() == orders.count()
    assert df.toDF(*orders.columns).exceptAll(orders).count() == 0
    pushed = df.filter(F.col("o_orderkey") < 10).select("o_orderkey")
    plan = pushed._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "o_orderkey" in plan
    assert pushed.count() == orders.filter("o_orderkey < 10").count()


def test_stream_copy_is_exactly_once_on_rerun(spark, source):
    from tests.conftest import SF_SMALL
    from tableferry.streaming.incremental import stream_copy

    orders = source.table("orders")
    root = new_run_dir(spark, "test-stream")
    log = stream_copy(spark, SF_SMALL, "orders.parquet", orders.schema, root + "/out", root + "/_ckpt",
                      {"o_totalprice": "DOUBLE"}, max_files_per_trigger=1)
    assert sum(r.n_rows for r in log.collect()) == orders.count()
    assert all(r.elapsed_ms >= 0 and r.started is not None for r in log.collect())
    again = stream_copy(spark, SF_SMALL, "orders.parquet", orders.schema, root + "/out", root + "/_ckpt")
    assert sum(r.n_rows for r in again.collect()) == 0  # checkpoint: nothing is copied twice
    out = spark.read.parquet(root + "/out")
    assert out.count() == orders.count() and out.exceptAll(orders).count() == 0


def test_transfer_with_quarantine_keeps_good_rows(spark):
    rows = [(i, 300 if i % 4 == 0 else i % 100) for i in range(1, 41)]
    src = Database("dbo", {"t": spark.createDataFrame(rows, "id long, v long")}, {"t": ["id"]})
    types = {"t": {"id": "BIGINT", "v": "TINYINT"}}
    root = new_run_dir(spark, "test-quarantine")
    r = jobs.transfer_table(spark, src, "t", root, types, on_bad_values="quarantine")
    assert r["row_count"] == 30 and r["error"] == "10 rows quarantined" and r["success"]
    good = spark.read.parquet(f"{root}/dbo_t")
    assert good.count() == 30 and good.columns == ["id", "v"] and dict(good.dtypes)["v"] == "tinyint"
    bad = spark.read.parquet(f"{root}/dbo_t__rejects")
    assert {x.reject_reasons for x in bad.collect()} == {"v:range"} and {x.v for x in bad.collect()} == {300}
    strict = jobs.transfer_table(spark, src, "t", root, types, on_bad_values="quarantine", max_errors=5)
    assert not strict["success"]


def test_transfer_without_length_profile(spark, source):
    db = source.subset(["customer", "documents"])
    c = cat.column_catalog(spark, db, profile_lengths=False)
    mapped = {r.column_name: r.target_type for r in ddl.map_types(c).collect()}
    assert mapped["c_name"] == "LONGTEXT" and mapped["text"] == "LONGTEXT" and mapped["c_custkey"] == "BIGINT"
    run = jobs.transfer_all(spark, db, new_run_dir(spark, "test-noprofile"), profile_lengths=False)
    assert all(r.is_valid for r in jobs.transfer_report(run).collect())


def test_throughput_rows(spark):
    from datetime import datetime

    from tableferry.streaming import incremental

    def at(ms):
        return datetime(2024, 1, 1, 0, 0, ms // 1000, ms % 1000 * 1000)

    log = incremental.batch_log(spark, [(0, 100, at(0), 0), (1, 300, at(500), 1500), (2, 0, at(4000), 0)])
    got = [tuple(r) for r in incremental.throughput(log, 400).orderBy("batch_id").collect()]
    assert got == [(0, 100, 100, 25.0, 0, 0.0), (1, 300, 400, 100.0, 2000, 200.0), (2, 0, 400, 100.0, 4000, 100.0)]
    assert incremental.throughput(incremental.batch_log(spark, []), 0).count() == 0


def test_a_failed_stream_leaves_no_listener_and_no_setting(spark):
    import pytest

    from tableferry.streaming.incremental import stream_copy

    root = new_run_dir(spark, "test-stream-fail")
    spark.createDataFrame([(1, 300)], "id long, v long").write.parquet(root + "/in")
    before = dict(spark.conf.getAll)
    with pytest.raises(Exception):
        stream_copy(spark, root + "/in", "*.parquet", spark.read.parquet(root + "/in").schema, root + "/out", root + "/_ckpt", {"v": "TINYINT"})
    assert dict(spark.conf.getAll) == before


def test_migration_takes_rows_in_order_where_values_do_not_fit(spark):
    from tableferry.sources import versioned

    rows = [(i, "x" * 70_000 if i % 2 else f"row {i}") for i in range(40)]  # longer than the legacy TEXT holds
    src = Database("dbo", {"t": spark.createDataFrame(rows, "id long, body string").repartition(3), "fine": spark.range(3)}, {"t": ["id"]})
    root = new_run_dir(spark, "test-ordered")
    got = {r.table_name: r for r in jobs.migrate_database(spark, src, root, ["t"]).collect()}
    assert got["t"].structure_ok and not got["t"].data_ok and got["t"].error == "11 rows failed, stopped at row 22"
    assert got["t"].migrated_rows == 11 and got["t"].total_records == 40 and got["fine"].data_ok
    assert sorted(r.id for r in versioned.read_table(spark, f"{root}/t").collect()) == list(range(0, 22, 2))
    told = versioned.header(f"{root}/t")
    assert [(c["name"], c["type"], c["nullable"]) for c in told["columns"]] == [("id", "BIGINT", False), ("body", "TEXT", True)]
    again = jobs.migrate_database(spark, src, root, ["t"]).collect()  # drop and recreate: nothing twice
    assert {r.table_name: r.migrated_rows for r in again} == {"t": 11, "fine": 3}


def test_maintenance_says_what_it_did(spark):
    root = new_run_dir(spark, "test-maintain")
    spark.range(50).repartition(5).write.parquet(root + "/plain")
    spark.createDataFrame([("x",)], "v string").write.text(root + "/broken")
    report = {r.table_name: r for r in jobs.maintenance_report(spark, root, ["plain", "broken", "absent"]).collect()}
    assert (report["plain"].status, report["plain"].files_before, report["plain"].files_after, report["plain"].row_count) == ("optimized", 5, 1, 50)
    assert report["absent"].status == "missing" and report["absent"].error and report["absent"].row_count is None
    assert report["broken"].status in ("missing", "error") and report["broken"].error
    assert sorted(r.id for r in spark.read.parquet(root + "/plain").collect()) == list(range(50))
