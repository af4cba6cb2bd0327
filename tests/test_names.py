"""Table-name conversion golden cases."""

from tableferry.functions import names as N


def _run(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "name string")
    return {r.name: r.out for r in df.select("name", fn("name").alias("out")).collect()}


def test_target_names(spark):
    got = _run(spark, N.target_table_name, [
        "Sales.Currency", "Person.Address", "HumanResources.Employee", "[Sales].[Currency]",
        "[dbo].[Users]", "Currency", "", "   ", None, "my table", "a.b.c", "販売.通貨",
    ])
    assert got["Sales.Currency"] == "Sales_Currency"
    assert got["Person.Address"] == "Person_Address"
    assert got["HumanResources.Employee"] == "HumanResources_Employee"
    assert got["[Sales].[Currency]"] == "Sales_Currency"
    assert got["[dbo].[Users]"] == "dbo_Users"
    assert got["Currency"] == "Currency"
    assert got[""] is None and got["   "] is None and got[None] is None
    assert got["my table"] is None
    assert got["a.b.c"] == "a_b_c"
    assert got["販売.通貨"] == "販売_通貨"


def test_source_names(spark):
    got = _run(spark, N.source_table_name, ["Sales_Currency", "Person_Address", "", None])
    assert got["Sales_Currency"] == "Sales.Currency"
    assert got["Person_Address"] == "Person.Address"
    assert got[""] is None and got[None] is None


def test_validity(spark):
    got = _run(spark, N.is_valid_target_name, [
        "Sales_Currency", "Users", "table123", "Sales.Currency", "my table", "table-name", "", "通貨_1",
    ])
    assert got["Sales_Currency"] and got["Users"] and got["table123"] and got["通貨_1"]
    assert not got["Sales.Currency"] and not got["my table"] and not got["table-name"] and not got[""]


def test_schema_part(spark):
    got = _run(spark, N.schema_part, [
        "Sales.Currency", "dbo.Users", "[Sales].[Currency]", "Currency", ".Currency", "Currency.", "a.b.c", "", None,
    ])
    assert got["Sales.Currency"] == "Sales" and got["dbo.Users"] == "dbo"
    assert got["[Sales].[Currency]"] == "Sales"
    assert got["Currency"] is None and got[".Currency"] is None
    assert got["Currency."] == "Currency"
    assert got["a.b.c"] == "a.b"
    assert got[""] is None and got[None] is None


def test_table_part(spark):
    got = _run(spark, N.table_part, [
        "Sales.Currency", "dbo.Users", "[Sales].[Currency]", "Currency", ".Currency", "Currency.", "a.b.c", "",
    ])
    assert got["Sales.Currency"] == "Currency" and got["dbo.Users"] == "Users"
    assert got["[Sales].[Currency]"] == "Currency"
    assert got["Currency"] == "Currency"
    assert got[".Currency"] == "Currency"
    assert got["Currency."] == "Currency."
    assert got["a.b.c"] == "c"
    assert got[""] is None


def test_collisions_are_found(spark):
    df = spark.createDataFrame([("a.b_c",), ("a_b.c",), ("x.y",)], "name string")
    flat = df.select("name", N.target_table_name("name").alias("t"))
    groups = flat.groupBy("t").count().filter("count > 1").collect()
    assert [(g.t, g["count"]) for g in groups] == [("a_b_c", 2)]
