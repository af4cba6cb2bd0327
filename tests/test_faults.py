"""Cases that once went wrong without notice: nulls and duplicates in the diff, lost values, missing tables, collisions."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tableferry.functions import names
from tableferry.operators import conform, reconcile
from tableferry.plans import jobs
from tableferry.session import new_run_dir
from tableferry.sources import paging
from tableferry.sources.tables import Database
from tableferry.streaming.incremental import stream_copy

MODES = ("hash", "exact", "digest")


def plain_diff(one: list[tuple], two: list[tuple], names: list[str]) -> set:
    out = set()
    for k in {r[0] for r in one} | {r[0] for r in two}:
        a, b = ([r for r in x if r[0] == k] for x in (one, two))
        if not a or not b:
            out.add((k, "missing" if a else "extra", None))
        elif len(a) > 1 or len(b) > 1:
            out.add((k, "duplicate", None))
        elif a != b:
            out.add((k, "changed", ",".join(n for n, x, y in zip(names, a[0][1:], b[0][1:]) if x != y)))
    return out


@pytest.mark.parametrize("mode", MODES)
def test_diff_equals_brute_force(spark, mode):
    r = random.Random(4)

    def rows(n):
        return [(r.choice([None, *range(40)]), r.choice([None, "x", "y"]), r.choice([None, "x", "y"]), r.choice([None, 0.0, 1.5])) for _ in range(n)]

    one = rows(30)
    two = [x if r.random() < 0.6 else (x[0], *rows(1)[0][1:]) for x in one if r.random() < 0.9] + rows(3)
    two.append((one[0][0], one[0][2], one[0][1], one[0][3]))
    schema = "id long, a string, b string, c double"
    found = reconcile.content_diff(spark.createDataFrame(one, schema), spark.createDataFrame(two, schema), ["id"], mode=mode, buckets=16)
    assert set(map(tuple, found.collect())) == plain_diff(one, two, ["a", "b", "c"])


@pytest.mark.parametrize("mode", MODES)
def test_diff_sees_moved_nulls_null_keys_and_duplicates(spark, mode):
    schema = "k long, p string, a string, b string"
    one = spark.createDataFrame([(1, None, None, "x"), (2, "q", "s", "t"), (2, "q", "s", "t"), (None, None, "u", "v")], schema)
    two = spark.createDataFrame([(1, None, "x", None), (2, "q", "s", "t"), (2, "q", "s", "t"), (None, None, "u", "v")], schema)
    found = {tuple(r) for r in reconcile.content_diff(one, two, ["k", "p"], mode=mode).collect()}
    assert found == {(1, None, "changed", "a,b"), (2, "q", "duplicate", None)}


def test_legacy_preprocessing_keeps_what_is_no_date(spark):
    rows = [("Alice", "free text", "2024-01-05 10:00:00", "2024/1/5"), ("Bob", None, "x", None)]
    df = spark.createDataFrame(rows, "candidate_name string, update_note string, order_date string, birth_date string")
    df = df.withColumn("ts", F.lit("2024-01-01 10:00:05.123456").cast("timestamp"))
    out = conform.preprocess_legacy(df).collect()
    assert [r.candidate_name for r in out] == ["Alice", "Bob"] and out[0].update_note == "free text"
    assert out[0].order_date == "2024-01-05 10:00:00" and out[0].birth_date == "2024-01-05" and out[0].ts.microsecond == 123456


def test_migration_reports_every_table_and_validation_sees_a_loss(spark):
    db = Database("dbo", {"a": spark.range(20).withColumn("v", F.col("id") * 2), "b": spark.range(5)}, {}, {}, {"gone": "cannot read"})
    root = new_run_dir(spark, "test-faults")
    out = {r.table_name: r for r in jobs.migrate_database(spark, db, root, ["b"]).collect()}
    assert out["a"].data_ok and out["a"].total_records == out["a"].migrated_rows == 20 and not out["gone"].data_ok and out["gone"].error == "cannot read"
    spark.range(19).withColumn("v", F.col("id") * 2).write.mode("overwrite").parquet(f"{root}/a")
    validation, verdict = jobs.validate_action(spark, db, root, [])
    assert {r.table_name: r.data_consistency for r in validation.collect()} == {"a": False, "b": True} and not verdict.first().overall_success


def test_validation_without_a_target(spark):
    src, tgt = Database("dbo", {"a": spark.range(3), "b": spark.range(4)}), Database("t", {"a": spark.range(3)})
    rows = {r.table_name: r for r in reconcile.validate_tables(src, tgt).collect()}
    assert rows["a"].data_consistency and rows["b"].target_count is None and not rows["b"].data_consistency
    assert {r.table_name: r.sample_match for r in reconcile.sample_match(src, tgt).collect()} == {"a": True, "b": False}
    assert reconcile.extreme_match(src, tgt).count() == 2


def test_transfer_isolates_collisions_and_unreadable_tables(spark):
    broken = spark.range(3).select(F.col("id"), F.raise_error(F.lit("no disk")).cast("string").alias("s"))
    db = Database("dbo", {"x.y": spark.range(5), "x_y": spark.range(3), "ok": spark.range(7), "broken": broken}, {}, {}, {"lost": "cannot read"})
    log = new_run_dir(spark, "test-errors")
    run = jobs.transfer_all(spark, db, new_run_dir(spark, "test-faults"), error_log=log)
    logged = spark.read.json(log).collect()
    assert {r.table_name for r in logged} == {"dbo.x.y", "dbo.x_y", "dbo.broken", "dbo.lost"} and all(r.timestamp and r.error_message for r in logged)
    out = {r.source_table: r for r in run.results.collect()}
    assert set(out) == {"dbo.x.y", "dbo.x_y", "dbo.ok", "dbo.broken", "dbo.lost"}
    assert [t for t, r in out.items() if r.success] == ["dbo.ok"] and out["dbo.ok"].row_count == 7
    assert "dbo_x_y" in out["dbo.x.y"].error and out["dbo.lost"].error == "cannot read"
    assert run.summary.first().fail_count == 4 and run.verification.count() == 1


def test_over_long_values_do_not_fit(spark):
    db = Database("dbo", {"t": spark.createDataFrame([(1, "abc"), (2, "0123456789")], "id long, s string")})
    types, root = {"t": {"id": "BIGINT", "s": "VARCHAR(5)"}}, new_run_dir(spark, "test-faults")
    assert not jobs.transfer_table(spark, db, "t", root, types)["success"]
    with pytest.raises(PySparkException):
        spark.read.parquet(f"{root}/dbo_t").count()
    assert jobs.transfer_table(spark, db, "t", root, types, on_bad_values="null")["success"]
    assert {r.id: r.s for r in spark.read.parquet(f"{root}/dbo_t").collect()} == {1: "abc", 2: None}
    assert {r.column_name: r.failed_casts for r in conform.conform_failures(db.table("t"), types["t"]).collect()} == {"id": 0, "s": 1}


def test_stop_rule_leaves_the_target(spark):
    root = new_run_dir(spark, "test-faults")
    good = Database("dbo", {"t": spark.range(100).select("id", F.lit(1).alias("v"))})
    bad = Database("dbo", {"t": spark.range(20).select("id", F.when(F.col("id") < 15, 300).otherwise(1).alias("v"))})
    types = {"t": {"id": "BIGINT", "v": "TINYINT"}}
    assert jobs.transfer_table(spark, good, "t", root, types, on_bad_values="quarantine")["success"]
    assert not jobs.transfer_table(spark, bad, "t", root, types, on_bad_values="quarantine")["success"]
    assert spark.read.parquet(f"{root}/dbo_t").count() == 100 and spark.read.parquet(f"{root}/dbo_t__rejects").count() == 15


def test_orphans_by_text_decimal_and_composite_keys(spark):
    db = Database("dbo", {
        "p": spark.createDataFrame([("a", 1, 1), ("b", 2, 7)], "t string, i long, j long"),
        "c": spark.sql("SELECT * FROM VALUES (1L, 'a', 1.5BD, 1L), (2L, 'z', 1.0BD, 7L), (3L, NULL, 2.0BD, 7L), (4L, NULL, NULL, NULL) AS x(id, t, d, j)"),
    }, {"c": ["id"]})
    text = {(r.child_key, r.fk_value) for r in reconcile.orphan_rows(db, [("c", "t", "p", "t")]).collect()}
    number = {int(r.child_key) for r in reconcile.orphan_rows(db, [("c", "d", "p", "i")]).collect()}
    pair = {int(r.child_key) for r in reconcile.orphan_rows(db, [("c", ["d", "j"], "p", ["i", "j"])]).collect()}
    assert {(int(a), b) for a, b in text} == {(2, "z")} and number == {1} and pair == {1, 2}


def test_stream_log_holds_every_batch(spark, tmp_path):
    for i in range(8):
        spark.range(5).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    log = stream_copy(spark, str(tmp_path / "in"), "*.parquet", spark.range(1).schema, str(tmp_path / "out"), str(tmp_path / "ck"), max_files_per_trigger=1)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    assert log.agg(F.sum("n_rows")).first()[0] == spark.read.parquet(str(tmp_path / "out")).count() == 40


def test_name_with_a_newline_is_invalid(spark):
    df = spark.createDataFrame([("dbo_t\n",), ("dbo_t",)], "n string").select(names.is_valid_target_name("n").alias("v"))
    assert [r.v for r in df.collect()] == [False, True]


def test_boundary_rows_of_composite_text_and_null_keys(spark):
    schema = "a string, b long"
    rows = [(None, 1), (None, 2), ("x", None), ("x", 1), ("y", 5), ("y", 6)]
    keys, one, two = ["a", "b"], spark.createDataFrame(rows, schema), spark.createDataFrame(rows[:2] + rows[3:] + rows[-1:], schema)
    pages = paging.page_summary(paging.page_index(one, keys, 2), keys)
    out = {r.batch_no: (r.first_present, r.last_present, r.batch_ok) for r in reconcile.boundary_rows(pages, two, keys).collect()}
    assert out == {1: (True, True, True), 2: (False, True, False), 3: (True, True, True)}


def test_orphan_search_has_more_tasks_for_more_input(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(kept, ("2", "-1")):
        spark.conf.set(k, v)
    try:
        child = spark.range(0, 2000, 1, 10).select("id", F.when(F.col("id") % 5 != 0, F.col("id")).alias("ref"))
        db = Database("dbo", {"p": spark.range(0, 1990, 1, 10).toDF("key"), "c": child}, {"c": ["id"]})
        found = reconcile.orphan_rows(db, [("c", "ref", "p", "key")])
        assert found.rdd.getNumPartitions() == 40
        assert sorted((r.child_key, r.fk_value) for r in found.collect()) == [(i, i) for i in range(1991, 2000) if i % 5]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
