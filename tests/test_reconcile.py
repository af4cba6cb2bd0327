"""Reconciliation: verification semantics, content diff paths agree, validation gating."""

from pyspark.sql import functions as F

from tableferry import fixtures
from tableferry.operators import reconcile
from tableferry.sources.tables import Database


def _db(spark, name, rows, schema):
    return Database("dbo", {name: spark.createDataFrame(rows, schema)}, {name: ["id"]}, {name: "BASE TABLE"})


def test_verification_cases(spark):
    # equal -> valid; 100 vs 99 rows -> invalid; 5 vs 4 columns -> invalid; 0/0 -> valid
    mk = lambda n, cols: spark.range(n).select(*[F.col("id").alias(f"c{i}") for i in range(cols)])
    src = Database("dbo", {"eq": mk(10, 5), "rows": mk(100, 5), "cols": mk(10, 5), "empty": mk(0, 3)})
    tgt = Database("t", {"eq": mk(10, 5), "rows": mk(99, 5), "cols": mk(10, 4), "empty": mk(0, 3)})
    out = {r.target_table: r for r in reconcile.verify_tables(spark, src, tgt, [(n, n) for n in src.names()]).collect()}
    assert out["eq"].is_valid
    assert not out["rows"].is_valid and not out["rows"].row_count_match and out["rows"].column_count_match
    assert not out["cols"].is_valid and out["cols"].row_count_match
    assert out["empty"].is_valid


def test_unreadable_side_is_invalid_not_zero(spark):
    src = Database("dbo", {"a": spark.range(3)})
    tgt = Database("t", {})
    r = reconcile.verify_tables(spark, src, tgt, [("a", "a_missing")]).first()
    assert r.target_rows is None and r.is_valid is False


def test_content_diff_digest_equals_exact(spark, source):
    tgt = fixtures.damaged_target(source)
    fast = reconcile.content_diff(source.table("orders"), tgt.table("orders"), ["o_orderkey"])
    exact = reconcile.content_diff(source.table("orders"), tgt.table("orders"), ["o_orderkey"], exact=True)
    digest = reconcile.content_diff(source.table("orders"), tgt.table("orders"), ["o_orderkey"], mode="digest")
    fallback = reconcile.content_diff(
        source.table("orders"), tgt.table("orders"), ["o_orderkey"], mode="digest", buckets=4
    )
    a, b, c, d = (sorted(map(tuple, x.collect())) for x in (fast, exact, digest, fallback))
    assert a == b == c == d
    assert {r[1] for r in a} == {"missing", "changed"}


def test_content_diff_extra_rows_and_identical(spark):
    schema = "id long, v string"
    s = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], schema)
    t = spark.createDataFrame([(1, "a"), (3, "c"), (4, "d")], schema)
    out = {r.id: (r.status, r.changed_columns) for r in reconcile.content_diff(s, t, ["id"]).collect()}
    assert out == {2: ("missing", None), 3: ("changed", "v"), 4: ("extra", None)}
    assert reconcile.content_diff(s, s, ["id"]).count() == 0
    assert reconcile.content_diff(s, s, ["id"], mode="digest").count() == 0
    dig = {r.id: (r.status, r.changed_columns) for r in reconcile.content_diff(s, t, ["id"], mode="digest").collect()}
    assert dig == out


def test_duplicate_keys_are_reported_not_paired(spark):
    # A target loaded twice plus a hot key: no key group is expanded into row pairs.
    s = spark.range(2000).select(F.col("id"), (F.col("id") % 7).alias("v"))
    hot = spark.range(3000).select(F.lit(5).cast("long").alias("id"), F.lit(5).cast("long").alias("v"))
    t = s.union(s.filter("id < 10")).union(hot)
    for mode in ("hash", "exact", "digest"):
        out = reconcile.content_diff(s, t, ["id"], mode=mode)
        rows = {r.id: r.status for r in out.collect()}
        assert rows == {i: "duplicate" for i in range(10)}, mode
    tgt_dup = reconcile.sample_diff(s, t, "id", n=2000)
    assert {r.status for r in tgt_dup.filter("id < 10").collect()} == {"duplicate"}
    assert tgt_dup.count() == 2000


def test_keyless_diff_counts_duplicates(spark):
    s = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    t = spark.createDataFrame([(1,), (3,)], "v int")
    out = sorted((r.v, r.status) for r in reconcile.content_diff_keyless(s, t).collect())
    assert out == [(1, "missing"), (2, "missing"), (3, "extra")]


def test_validation_gating_and_empty_tables(spark):
    schema = "id long, x double"
    src = Database("dbo", {
        "same": spark.createDataFrame([(1, 1.0), (2, 5.0)], schema),
        "ext": spark.createDataFrame([(1, 1.0), (2, 5.0)], schema),
        "empty": spark.createDataFrame([], schema),
    })
    tgt = Database("t", {
        "same": spark.createDataFrame([(2, 5.0), (1, 1.0)], schema),
        "ext": spark.createDataFrame([(1, 1.0), (2, 6.0)], schema),
        "empty": spark.createDataFrame([], schema),
    })
    out = {r.table_name: r for r in reconcile.validate_tables(src, tgt).collect()}
    assert out["same"].data_consistency
    assert out["ext"].record_count_match and not out["ext"].extreme_values_match
    assert out["empty"].data_consistency  # empty_ok default
    strict = {r.table_name: r for r in reconcile.validate_tables(src, tgt, empty_ok=False).collect()}
    assert not strict["empty"].data_consistency  # the reference's behaviour (quirk Q11)
    skipped = {r.table_name: r for r in reconcile.validate_tables(src, tgt, exclude=("ext",)).collect()}
    assert skipped["ext"].data_consistency


def test_nan_does_not_win_max(spark):
    schema = "id long, x double"
    src = Database("dbo", {"t": spark.createDataFrame([(1, 1.0), (2, float("nan"))], schema)})
    tgt = Database("t", {"t": spark.createDataFrame([(1, 1.0), (2, None)], schema)})
    r = [r for r in reconcile.extreme_match(src, tgt).collect() if r.column_name == "x"][0]
    assert r.source_max == 1.0 and r.match


def test_sample_diff_and_boundary(spark, source):
    from tableferry.sources import paging

    tgt = fixtures.damaged_target(source)
    sd = reconcile.sample_diff(source.table("orders"), tgt.table("orders"), "o_orderkey").collect()
    assert len(sd) == 100
    assert all((r.changed_columns is None) == (r.status != "changed") for r in sd)
    pages = paging.page_summary(paging.scan_paged(source.table("orders"), ["o_orderkey"], 100), "o_orderkey")
    b = reconcile.boundary_rows(pages, tgt.table("orders"), "o_orderkey").collect()
    assert len(b) == pages.count()
    assert all(r.batch_ok == (r.first_present and r.last_present) for r in b)
