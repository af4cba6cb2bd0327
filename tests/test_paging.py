"""The distributed row index equals a global row_number; pages add up to the table."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tableferry.sources import paging


def _global(df, cols):
    return df.withColumn("expected", F.row_number().over(Window.orderBy(*[F.col(c).asc_nulls_first() for c in cols])))


def test_row_index_matches_global_window_numeric(spark, source):
    o = source.table("orders").select("o_orderkey", "o_custkey")
    got = paging.row_index(o, ["o_orderkey"], n_buckets=7)
    joined = got.join(_global(o, ["o_orderkey"]), "o_orderkey")
    assert joined.filter(F.col("row_no") != F.col("expected")).count() == 0
    assert got.count() == o.count()


def test_row_index_string_and_composite_keys_with_nulls(spark):
    rows = [(None, 1), ("b", 2), ("a", 2), ("a", 1), ("c", None), (None, 0)] * 3
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], "k string, v int, i int")
    got = paging.row_index(df, ["k", "v", "i"], n_buckets=3).orderBy("row_no").select("k", "v", "i").collect()
    exp = _global(df, ["k", "v", "i"]).orderBy("expected").select("k", "v", "i").collect()
    assert got == exp


def test_row_index_hot_leading_value_is_split(spark):
    # (k, id) is unique, but k = 7 holds a third of the rows: buckets stay small.
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), "id")
    sizes = paging.ranged(df, ["k", "id"], 12).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 6000 / 3
    got = paging.row_index(df, ["k", "id"], n_buckets=12)
    exp = _global(df, ["k", "id"])
    assert got.join(exp, ["k", "id"]).filter(F.col("row_no") != F.col("expected")).count() == 0


def test_row_index_skewed_key(spark):
    # A third of all rows share one key value: positions must still be exact and dense.
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), "id")
    got = paging.row_index(df, ["k", "id"], n_buckets=16)
    assert sorted(r.row_no for r in got.select("row_no").collect()) == list(range(1, 3001))
    exp = _global(df, ["k", "id"])
    assert got.join(exp, ["k", "id"]).filter(F.col("row_no") != F.col("expected")).count() == 0


def test_pages_sum_to_count_and_chunk_plan(spark, source):
    o = source.table("orders")
    pages = paging.page_summary(paging.scan_paged(o, ["o_orderkey"], 400), "o_orderkey")
    rows = pages.orderBy("batch_no").collect()
    assert sum(r.n_rows for r in rows) == o.count()
    assert all(r.n_rows == 400 for r in rows[:-1])
    plan = {r.batch_no: r for r in paging.chunk_plan(pages).collect()}
    last = max(plan)
    assert plan[last].commit_after
    assert plan[1].insert_mode == "chunked" and plan[1].n_chunks == 4


def test_no_key_is_one_plain_batch(spark, source):
    paged = paging.scan_paged(source.table("lineitem"), [])
    assert paged.select("batch_no").distinct().count() == 1


def test_batch_progress_running_sum(spark):
    log = spark.createDataFrame(
        [("t", i, 1000 if i < 30 else 500, i != 3) for i in range(1, 31)],
        "table_name string, batch_no long, n_rows long, ok boolean",
    )
    out = {r.batch_no: r for r in paging.batch_progress(log).collect()}
    assert out[2].rows_done == 2000 and out[3].rows_done == 2000 and out[4].rows_done == 3000
    assert out[30].percent == 100.0 and out[30].logged and not out[2].logged
    small = {r.batch_no: r for r in paging.batch_progress(log.withColumn("table_name", F.lit("u"))).collect()}
    assert small[30].total_rows == 29500
    two_level = paging.running_sum(log, ["table_name"], "batch_no", "n_rows", "cum", bucket_width=7)
    assert {r.batch_no: r.cum for r in two_level.collect()}[30] == 29500


def test_row_index_timestamp_key(spark, source):
    ev = source.table("events").select("event_id", "ts")
    got = paging.row_index(ev, ["ts", "event_id"], n_buckets=5)
    exp = _global(ev, ["ts", "event_id"])
    assert got.join(exp, ["event_id", "ts"]).filter(F.col("row_no") != F.col("expected")).count() == 0
    assert got.count() == ev.count()


def test_row_index_keys_beyond_double_precision(spark):
    # 64-bit neighbours that are one double; a hot value among them.
    base = 2**53
    key = F.when(F.col("id") % 2 == 0, F.lit(base + 40)).otherwise(F.col("id") + F.lit(base))
    df = spark.range(5000).select(key.alias("k"), F.md5(F.col("id").cast("string")).alias("t"), "id")
    got = paging.row_index(df, ["k", "t"], n_buckets=9).orderBy("row_no").select("id", "row_no").collect()
    assert got == _global(df, ["k", "t"]).orderBy("expected").select("id", "expected").collect()


def test_row_index_hot_values_of_any_type_are_split(spark):
    # Half the rows share the only key column; a text column tells them apart.
    df = spark.range(6000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").cast("string").alias("v")
    ).withColumn("k", F.when(F.col("v") != "9", F.col("k")))
    sizes = paging.ranged(df, ["k"], 12).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 8 and max(r["count"] for r in sizes) < 6000 / 4
    got = paging.row_index(df, ["k"], n_buckets=12).orderBy("row_no").collect()
    assert [r.row_no for r in got] == list(range(1, 6001)) and got[0].k is None
    assert [r.k for r in got[1:]] == sorted(r.k for r in got[1:])


def test_row_index_of_no_rows(spark):
    assert paging.row_index(spark.range(0), ["id"]).collect() == []
