"""Quality checks, quarantine properties and value conforming."""

import math

from pyspark.sql import functions as F

from tableferry.functions import values as V
from tableferry.operators import conform, quality

DOC_TYPES = {"doc_id": "BIGINT", "text": "VARCHAR(255)", "lang": "CHAR(2)", "source": "VARCHAR(16)", "n_chars": "INT"}


def test_quarantine_partitions_the_input(spark, source):
    docs = source.table("documents")
    good = quality.quarantine_good(docs, DOC_TYPES)
    bad = quality.quarantine_bad(docs, DOC_TYPES)
    assert good.count() + bad.count() == docs.count()
    assert good.unionByName(bad.drop("reject_reasons")).exceptAll(docs).count() == 0
    assert bad.filter(~F.col("reject_reasons").contains("text:length")).count() == 0
    prev = quality.reject_preview(bad, "doc_id", ["text"]).collect()
    assert len(prev) == 5 and all(len(r.text) <= 50 for r in prev)
    assert quality.reject_summary(bad).first().too_many_errors


def test_range_type_and_length_checks(spark):
    df = spark.createDataFrame(
        [(1, 200, "abc", "x"), (2, 5, "abcdef", "12"), (3, -129, None, "z")],
        "id long, small long, s string, n string",
    )
    types = {"small": "TINYINT", "s": "VARCHAR(4)", "n": "INT"}
    out = {r.id: r.reject_reasons for r in quality.quarantine(df, types).collect()}
    assert out[1] == "small:range,n:type"
    assert out[2] == "s:length"
    assert out[3] == "small:range,n:type"
    rng = quality.out_of_range(df, "id", {"small": (-128, 127)}).collect()
    assert sorted(r.id for r in rng) == [1, 3]
    assert [r.id for r in quality.too_long(df, "id", {"s": 4}).collect()] == [2]


def test_duplicate_and_null_keys(spark, source):
    li = source.table("lineitem")
    dups = quality.duplicate_keys(li, ["l_orderkey", "l_linenumber"])
    exp = li.groupBy("l_orderkey", "l_linenumber").count().filter("count > 1").count()
    assert dups.count() == exp
    df = spark.createDataFrame([(1, None), (2, 2)], "a long, b long")
    assert quality.null_keys(df, ["a", "b"]).count() == 1


def test_date_text_fixture(spark):
    rows = [(1, "2024-01-05"), (2, "2024/1/5"), (3, "2024-13-01"), (4, "x"), (5, None), (6, "2024-02-30 10:00")]
    df = spark.createDataFrame(rows, "id int, order_date string")
    out = {r.id: r.order_date for r in conform.parse_date_columns(df).collect()}
    assert out == {1: "2024-01-05", 2: "2024-01-05", 3: "2024-13-01", 4: "x", 5: None, 6: "2024-02-30 10:00"}
    bad = {r.id for r in quality.bad_dates(df, "id").collect()}
    assert bad == {3, 4, 6}
    assert [r.v for r in df.select(V.looks_like_date("order_date").alias("v")).collect()] == [
        True, True, True, False, False, True,
    ]


def test_nan_values_and_timestamps(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5), (3, None)], "id int, x double")
    assert {r.id: r.x for r in conform.normalize_nulls(df).collect()} == {1: None, 2: 1.5, 3: None}
    ts = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 10:00:05.123456' AS ts")
    assert conform.format_timestamps(ts).first().ts == "2024-01-01 10:00:05"


def test_guid_and_align(spark):
    df = spark.createDataFrame([("6F9619FF-8B86-D011-B42D-00C04FC964FF",), (None,)], "g string")
    out = conform.conform_table(df, {}, guid_columns=("g",)).collect()
    assert out[0].g == "6f9619ff-8b86-d011-b42d-00c04fc964ff" and out[1].g is None
    a = spark.createDataFrame([(1, "x", 9)], "a long, b string, extra int")
    b = spark.createDataFrame([(2, 3.5)], "a long, c double")
    rows = conform.align_columns([a, b], ["a", "b", "c"]).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, "x", None), (2, None, 3.5)]


def test_lossy_audit(spark, source):
    part = source.table("part")
    out = {r.column_name: r.lossy_rows for r in conform.lossy_audit(part, {"p_retailprice": "FLOAT", "p_partkey": "TINYINT"}).collect()}
    exp_float = part.filter(F.col("p_retailprice").cast("float").cast("double") != F.col("p_retailprice")).count()
    assert out["p_retailprice"] == exp_float
    assert out["p_partkey"] == part.filter("p_partkey > 127").count()


def test_preview_text(spark):
    df = spark.createDataFrame([("a" * 50,), ("b" * 51,)], "s string")
    out = [r.p for r in df.select(V.preview_text("s").alias("p")).collect()]
    assert out[0] == "a" * 50 and out[1] == "b" * 47 + "..." and not math.isnan(len(out[1]))


def test_legacy_suspect_rules(spark):
    df = spark.createDataFrame(
        [(1, "x" * 256, 5, "ok"), (2, "y", 3_000_000_000, "ok"), (3, "z", -3_000_000_000, "fine")],
        "order_id long, note string, amount long, customer_name string",
    )
    cells = {(r.order_id, r.column_name, r.code) for r in quality.suspect_cells(df, "order_id").collect()}
    assert cells == {(1, "note", "1406"), (2, "amount", "1264"), (3, "amount", "1264")}
    assert quality.key_suspects(df) == ["order_id", "customer_name"]


def test_target_column_info_caps_lengths(spark):
    from tableferry.sources import catalog as cat

    c = spark.createDataFrame(
        [("dbo", "t", "a", "longtext", 4294967295, None, None, "YES", 1, 0, None),
         ("dbo", "t", "b", "VARCHAR", 20, None, None, "NO", 2, 0, None)],
        "table_schema string, table_name string, column_name string, data_type string, "
        "character_maximum_length bigint, numeric_precision int, numeric_scale int, is_nullable string, "
        "ordinal_position int, is_identity int, column_default string",
    )
    out = {r.column_name: r for r in cat.target_column_info(c).collect()}
    assert out["a"].max_length == -1 and out["b"].max_length == 20
    assert out["b"].data_type == "varchar" and out["b"].is_nullable is False
