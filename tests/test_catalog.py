"""Catalog operators over literal catalogs (S3, S4, S8, S10, S11, S14) and the profiled
column catalog of the fixture tables (S5, S6, S9)."""

from pyspark.sql import functions as F

from tableferry.sources import catalog as cat

TABLES = [
    ("Sales", "Currency", "BASE TABLE"),
    ("dbo", "Users", "BASE TABLE"),
    ("Sales", "vOrders", "VIEW"),
    ("a", "b_c", "BASE TABLE"),
    ("a_b", "c", "BASE TABLE"),
]


def test_list_base_tables_and_views(spark):
    t = spark.createDataFrame(TABLES, cat.TABLES_SCHEMA)
    assert [r.full_name for r in cat.list_base_tables(t).collect()] == [
        "Sales.Currency", "a.b_c", "a_b.c", "dbo.Users",
    ]
    assert [(r.table_schema, r.table_name) for r in cat.list_views(t).collect()] == [("Sales", "vOrders")]


def test_known_and_unknown_tables_are_case_sensitive(spark):
    t = spark.createDataFrame([("dbo", "Users", "BASE TABLE")], cat.TABLES_SCHEMA)
    req = spark.createDataFrame([("Users",), ("users",), ("Missing",)], "table_name string")
    assert {r.table_name for r in cat.known_tables(req, t).collect()} == {"Users"}
    assert {r.table_name for r in cat.unknown_tables(req, t).collect()} == {"users", "Missing"}


def _sys(spark):
    sys_tables = spark.createDataFrame([(100, 1, "Orders"), (200, 1, "Lines")], "object_id int, schema_id int, name string")
    sys_schemas = spark.createDataFrame([(1, "dbo")], "schema_id int, name string")
    sys_types = spark.createDataFrame(
        [(56, "int"), (231, "nvarchar"), (106, "decimal"), (62, "float"), (167, "varchar")],
        "user_type_id int, name string",
    )
    sys_columns = spark.createDataFrame(
        [
            (100, 1, "id", 56, 4, 10, 0, 0, 0),
            (100, 2, "note", 231, -1, 0, 0, 1, 0),
            (100, 3, "amount", 106, 9, 12, 2, 1, 500),
            (100, 4, "rate", 62, 8, 53, 0, 1, 0),
            (200, 1, "order_id", 56, 4, 10, 0, 0, 0),
            (200, 2, "line_no", 56, 4, 10, 0, 0, 0),
            (200, 3, "code", 167, 20, 0, 0, 1, 0),
        ],
        "object_id int, column_id int, name string, user_type_id int, max_length int, precision int, "
        "scale int, is_nullable int, default_object_id int",
    )
    defaults = spark.createDataFrame([(500, "((0))")], "object_id int, definition string")
    return sys_columns, sys_types, sys_tables, sys_schemas, defaults


def test_column_catalog_sys(spark):
    out = cat.column_catalog_sys(*_sys(spark)).orderBy("table_name", "ordinal_position").collect()
    by = {(r.table_name, r.column_name): r for r in out}
    assert len(out) == 7
    assert by[("Orders", "note")].character_maximum_length is None  # -1 -> NULL
    assert by[("Lines", "code")].character_maximum_length == 20
    assert by[("Orders", "id")].character_maximum_length is None  # not a text type
    assert by[("Orders", "amount")].numeric_precision == 12 and by[("Orders", "amount")].numeric_scale == 2
    assert by[("Orders", "rate")].numeric_precision == 53 and by[("Orders", "rate")].numeric_scale is None
    assert by[("Orders", "id")].numeric_precision is None
    assert by[("Orders", "id")].is_nullable == "NO" and by[("Orders", "note")].is_nullable == "YES"
    assert by[("Orders", "amount")].column_default == "((0))"
    assert by[("Orders", "note")].column_default is None


def _kcu(spark):
    return spark.createDataFrame(
        [
            ("PK_Lines", "dbo", "Lines", "order_id", 1),
            ("PK_Lines", "dbo", "Lines", "line_no", 2),
            ("UQ_Orders", "dbo", "Orders", "id", 1),
            ("FK_Ship_Lines", "dbo", "Ship", "s_order", 1),
            ("FK_Ship_Lines", "dbo", "Ship", "s_line", 2),
            ("FK_Lines_Orders", "dbo", "Lines", "order_id", 1),
        ],
        "constraint_name string, table_schema string, table_name string, column_name string, ordinal_position int",
    )


def test_primary_keys_with_fallback(spark):
    sys_columns, _, sys_tables, sys_schemas, _ = _sys(spark)
    kc = spark.createDataFrame([(100, 7, "PK"), (200, 9, "PK")], "parent_object_id int, unique_index_id int, type string")
    ic = spark.createDataFrame([(100, 7, 1, 1), (200, 9, 1, 1)], "object_id int, index_id int, column_id int, key_ordinal int")
    out = cat.primary_keys(_kcu(spark), kc, ic, sys_columns, sys_tables, sys_schemas)
    keys = {}
    for r in out.orderBy("table_name", "key_ordinal").collect():
        keys.setdefault(r.table_name, []).append(r.column_name)
    # Lines is named PK% (first route, composite, in key order); Orders only via the sys fallback.
    assert keys == {"Lines": ["order_id", "line_no"], "Orders": ["id"]}


def test_foreign_keys_pair_composite_keys_by_position(spark):
    kcu = _kcu(spark)
    rc = spark.createDataFrame(
        [("FK_Ship_Lines", "PK_Lines"), ("FK_Lines_Orders", "UQ_Orders")],
        "constraint_name string, unique_constraint_name string",
    )
    fixed = cat.foreign_keys(rc, kcu).collect()
    compat = cat.foreign_keys(rc, kcu, compat=True).collect()
    pairs = {(r.column_name, r.referenced_column_name) for r in fixed if r.table_name == "Ship"}
    assert pairs == {("s_order", "order_id"), ("s_line", "line_no")}
    assert len([r for r in compat if r.table_name == "Ship"]) == 4  # n x n, quirk kept on request
    assert len(fixed) == 3


def test_profiled_catalog(spark, source):
    c = cat.column_catalog(spark, source)
    docs = {r.column_name: r for r in c.filter(F.col("table_name") == "documents").collect()}
    assert docs["text"].data_type == "nvarchar" and docs["text"].character_maximum_length == -1
    assert docs["lang"].character_maximum_length == 2
    assert docs["doc_id"].is_identity == 1 and docs["n_chars"].is_identity == 0
    conv = {r.column_name: r.is_identity for r in c.filter(F.col("table_name") == "conversations").collect()}
    assert not any(conv.values())  # composite key: no identity column
    assert c.count() == sum(len(df.columns) for df in source.tables.values())


def test_table_structure_and_probe(spark, source):
    s = {r.table_name: r for r in cat.table_structure(spark, source).collect()}
    assert s["customer"].column_list == "c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment"
    assert s["customer"].row_count == source.table("customer").count()
    probe = cat.schema_probe(spark, source.table("orders")).collect()
    assert [(r.column_name, r.data_type) for r in probe][:2] == [("o_orderkey", "varchar"), ("o_custkey", "varchar")]
    assert dict((r.column_name, r.type_code) for r in probe)["o_totalprice"] == 8


def test_unreadable_tables_are_flagged(spark):
    from tests.conftest import SF_SMALL
    from tableferry.sources.tables import read_database

    db = read_database(spark, SF_SMALL, ["region", "no_such_table"])
    assert db.names() == ["region"] and "no_such_table" in db.unreadable
    counts = {r.table_name: r.row_count for r in cat.row_counts(db).collect()}
    assert counts == {"region": 5, "no_such_table": None}
