"""Keys, inclusions and load order from data, against brute force."""

import math
from itertools import combinations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tableferry.operators import discovery
from tableferry.sources import catalog as cat
from tableferry.sources.tables import Database


def brute_keys(rows, columns, max_size):
    whole = [i for i, c in enumerate(columns) if all(r[i] is not None for r in rows)]
    keys = []
    for size in range(1, max_size + 1):
        for s in combinations(whole, size):
            if len({tuple(r[i] for i in s) for r in rows}) == len(rows) and not any(set(k) <= set(s) for k in keys):
                keys.append(s)
    return sorted(",".join(columns[i] for i in k) for k in keys)


@pytest.mark.parametrize("sample", [10_000, 3])
def test_minimal_keys(spark, sample):
    rows = [(i // 6, i % 6, i % 4, "x" * 40 + str(i % 12), None if i == 3 else i, 1.5 * (i % 2)) for i in range(24)]
    columns = "a b c long_text with_null f".split()
    db = Database("dbo", {"t": spark.createDataFrame(rows, "a int, b long, c int, long_text string, with_null int, f double")})
    db.tables["twice"] = spark.createDataFrame([(1, "x"), (1, "x")], "a int, b string")
    db.tables["empty"] = spark.createDataFrame([], "a int, b array<int>")
    db.tables["nested"] = spark.createDataFrame([([1],)], "a array<int>")
    found = {}
    for r in discovery.minimal_keys(spark, db, 3, sample).collect():
        found.setdefault(r.table_name, []).append(r.key_columns)
    assert sorted(found["t"]) == brute_keys(rows, columns, 3) and found["empty"] == ["a"] and set(found) == {"t", "empty"}


def test_minimal_keys_by_slices(spark, monkeypatch):
    """Repeats that the sample misses are found in slices; the check of all rows is left to the keys."""
    checked = []
    whole = discovery._repeats
    monkeypatch.setattr(discovery, "_repeats", lambda df, cells: checked.append(len(cells)) or whole(df, cells))
    rows = [(i // 2, i // 2 % 50, float(i // 2 % 41), f"{i}" + "x" * 40, i % 2, None if i == 5 else i) for i in range(4000)]
    columns = "a b c id half with_null".split()
    db = Database("dbo", {"t": spark.createDataFrame(rows, "a int, b long, c double, id string, half int, with_null int")})
    found = sorted(r.key_columns for r in discovery.minimal_keys(spark, db, 3, 1, 100).collect())
    assert found == brute_keys(rows, columns, 3) == ["a,half", "b,c,half", "id"]
    assert sorted(checked) == [1, 2, 3]


def brute_inclusions(tables):
    cells = {(t, c): {r[i] for r in rows} - {None} for t, (columns, rows) in tables.items() for i, c in enumerate(columns)}
    kind = {k: {type(x) for x in v} for k, v in cells.items()}
    return {(*a, *b, len(cells[a])) for a in cells for b in cells if a != b and cells[a] and kind[a] == kind[b] and cells[a] <= cells[b]}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.sampled_from(["a", "b" * 70, None])), max_size=6), st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["a", "b" * 70, "c", ""])), max_size=6))
def test_inclusions_of_random_tables(spark, one, two):
    db = Database("dbo", {"one": spark.createDataFrame(one, "a int, b long, s string"), "two": spark.createDataFrame(two, "a short, t string")})
    got = {tuple(r) for r in discovery.inclusion_dependencies(spark, db).collect()}
    assert got == brute_inclusions({"one": (["a", "b", "s"], one), "two": (["a", "t"], two)})


def test_inclusions_of_numbers(spark):
    nan = math.nan
    db = Database("dbo", {"x": spark.createDataFrame([(nan, 0.0, 1), (None, 2.5, 2)], "a double, b double, i int"), "y": spark.createDataFrame([(nan, -0.0), (7.0, 2.5)], "a float, b float")})
    got = {tuple(r)[:4] for r in discovery.inclusion_dependencies(spark, db).collect()}
    assert got == {("x", "a", "y", "a"), ("x", "b", "y", "b"), ("y", "b", "x", "b")}


def test_discovered_keys_read_like_declared_ones(spark):
    db = Database("dbo", {
        "parent": spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "p_id int, name string"),
        "child": spark.createDataFrame([(1, 1, 9), (1, 2, 9), (2, 1, 9)], "c_id int, line int, other int"),
    })
    keys, found = discovery.minimal_keys(spark, db), discovery.inclusion_dependencies(spark, db)
    references = discovery.reference_candidates(found, keys)
    assert {(r.child_column, r.parent_column, r.same_name) for r in references.collect()} == {("c_id", "p_id", True), ("line", "p_id", False)}
    usage, constraints = discovery.key_usage("dbo", keys, references)
    pks = {(r.table_name, r.column_name, r.key_ordinal) for r in cat.primary_keys(usage).collect()}
    assert pks == {("parent", "p_id", 1), ("child", "c_id", 1), ("child", "line", 2)}
    fks = [tuple(r) for r in cat.foreign_keys(constraints, usage).collect()]
    assert fks == [("dbo", "child", "c_id", "parent", "p_id")]


def levels(spark, tables, edges):
    frame = discovery.load_levels(spark.createDataFrame([(t,) for t in tables], "table_name string"), spark.createDataFrame(edges, "child_table string, parent_table string"))
    return {r.table_name: (r.level, r.ring) for r in frame.collect()}


def test_load_levels(spark):
    got = levels(spark, "abcde", [("b", "a"), ("c", "b"), ("c", "a"), ("d", "d"), ("e", "not there"), ("c", "a")])
    assert got == {"a": (0, None), "b": (1, None), "c": (2, None), "d": (0, None), "e": (0, None)}
    assert levels(spark, [], []) == {}


def test_rings_are_named_and_share_a_level(spark):
    # a <- (b <-> c) <- d <- (e -> f -> g -> e) <- h
    edges = [("b", "a"), ("b", "c"), ("c", "b"), ("d", "c"), ("e", "d"), ("e", "f"), ("f", "g"), ("g", "e"), ("h", "g")]
    got = levels(spark, "abcdefgh", edges)
    assert got == {"a": (0, None), "b": (1, "b"), "c": (1, "b"), "d": (2, None), "e": (3, "e"), "f": (3, "e"), "g": (3, "e"), "h": (4, None)}
