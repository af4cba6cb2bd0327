"""Diffs of nearly equal tables (digest tree, invertible sketch) against brute force."""

import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableferry.operators import diffsketch, difftree
from tableferry.operators.difftree import content_diff_tree, diff_stores, digest_store
from tableferry.session import new_run_dir

SCHEMA = "a int, b string, v double, w string"
ROWS = st.lists(
    st.tuples(st.sampled_from([1, 2, 3, None]), st.sampled_from(["x", "y", None]),
              st.sampled_from([0.0, -0.0, 1.5, math.nan, None]), st.sampled_from(["p", "q", "", None])),
    max_size=7,
)


def plain(x):
    """A value as it is compared: NaN equal to itself, -0.0 equal to 0.0."""
    return "nan" if isinstance(x, float) and math.isnan(x) else 0.0 if x == 0.0 else x


def brute_diff(source, target):
    rows = {}
    for side, table in enumerate((source, target)):
        for r in table:
            rows.setdefault(r[:2], ([], []))[side].append(tuple(map(plain, r[2:])))
    out = {}
    for key, (s, t) in rows.items():
        if not t:
            out[key] = ("missing", None)
        elif not s:
            out[key] = ("extra", None)
        elif Counter(s) != Counter(t):
            names = ",".join(n for n, x, y in zip("vw", s[0], t[0]) if x != y)
            out[key] = ("duplicate", None) if len(s) > 1 or len(t) > 1 else ("changed", names)
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS, ROWS)
def test_both_diffs_of_random_tables(spark, one, two):
    s, t = spark.createDataFrame(one, SCHEMA), spark.createDataFrame(two, SCHEMA)
    tree = content_diff_tree(s, t, ["a", "b"], leaf_rows=1).collect()
    assert {(r.a, r.b): (r.status, r.changed_columns) for r in tree} == brute_diff(one, two)
    assert len(tree) == len(brute_diff(one, two))
    counts = Counter(tuple(map(plain, r)) for r in one)
    counts.subtract(tuple(map(plain, r)) for r in two)
    expected = {k: ("missing" if n > 0 else "extra", abs(n)) for k, n in counts.items() if n}
    for cells in (64, 1):
        found = diffsketch.content_diff_sketch(s, t, cells).collect()
        assert {tuple(map(plain, r[:4])): (r.status, r.n_rows) for r in found} == expected
        assert len(found) == len(expected)


def _pair(spark, n, changed):
    s = spark.range(n).select(F.concat(F.lit("k"), "id").alias("id"), (F.col("id") % 97).alias("v"), F.lit("same").alias("w"))
    number = F.substring("id", 2, 20).cast("long")
    return s, s.withColumn("v", F.when(number.isin(changed), -1).otherwise(F.col("v"))).where(number != 1)


def test_rows_compared_grow_with_the_difference(spark):
    below = {}
    for n in (20_000, 200_000):
        for changed in ([7], list(range(10, 30))):
            s, t = _pair(spark, n, changed)
            path = new_run_dir(spark, "near-equal")
            stores = [digest_store(x, ["id"], f"{path}/{i}") for i, x in enumerate((s, t))]
            rows, levels = diff_stores(*stores, ["id"], ["v", "w"], leaf_rows=16)
            found = {r.id: (r.status, r.changed_columns) for r in rows.collect()}
            assert found == {"k1": ("missing", None)} | {f"k{i}": ("changed", "v") for i in changed}
            assert levels[0].rows_below < 2.5 * n * levels[0].differing / 256 and levels[-1].differing == len(found)
            below[n, len(found)] = levels[-1].rows_below
    assert max(below.values()) <= 16 * 21 and below[200_000, 2] <= 32


def test_a_deep_level_reads_ranges_of_the_store(spark):
    s, t = _pair(spark, 20_000, [7])
    path = new_run_dir(spark, "near-equal")
    stores = [digest_store(x, ["id"], f"{path}/{i}") for i, x in enumerate((s, t))]
    plan = diff_stores(*stores, ["id"], ["v", "w"], leaf_rows=16)[0]._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_key_hash" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    written = digest_store(s, ["id"], f"{path}/2")
    assert written.count() == 20_000


def test_many_differing_nodes_are_joined(spark):
    s, t = _pair(spark, 20_000, list(range(2, 900)))
    rows = content_diff_tree(s, t, ["id"], leaf_rows=16)
    assert rows.count() == 899 and rows.where("status = 'changed'").count() == 898


def test_rows_that_both_sides_repeat_are_no_difference(spark):
    hot = spark.range(3000).select(F.lit(5).alias("id"), F.lit(1).alias("v"))
    s = spark.range(100).select(F.col("id").cast("int"), F.lit(1).alias("v")).union(hot)
    assert content_diff_tree(s, s, ["id"]).count() == 0 and diffsketch.content_diff_sketch(s, s).count() == 0
    more = s.union(hot.limit(7))
    assert [tuple(r) for r in content_diff_tree(s, more, ["id"]).collect()] == [(5, "duplicate", None)]
    assert [tuple(r) for r in diffsketch.content_diff_sketch(s, more).collect()] == [(5, 1, "extra", 7)]


def test_empty_tables_and_absent_columns(spark):
    s = spark.createDataFrame([(1, "x", [1.0, None])], "id int, v string, `a.b` array<double>")
    none = s.limit(0)
    for diff in (lambda a, b: content_diff_tree(a, b, ["id"]), diffsketch.content_diff_sketch):
        assert diff(none, none).count() == 0 and diff(s, s.withColumn("more", F.lit(1))).count() == 0
        assert diff(s, none).first().status == "missing" and diff(none, s).first().status == "extra"
    assert content_diff_tree(s, s.drop("v"), ["id"]).first().changed_columns == "v"
    with pytest.raises(ValueError, match="map"):
        diffsketch.content_diff_sketch(s.withColumn("m", F.create_map("id", "v")), s)


def test_sketch_decodes_what_it_holds_and_says_when_not(spark):
    s = spark.range(100_000).select("id", (F.col("id") * 3).alias("v"))
    t = s.where("id % 100 <> 1")
    hashes, whole = diffsketch.differing_hashes(s, t, cells=600)
    assert whole and hashes.distinct().count() == 1000
    more, whole = diffsketch.differing_hashes(s, t, cells=300)
    assert not whole and more.exceptAll(hashes).count() == 0 and more.count() == 1000


def test_sketches_of_parts_merge(spark):
    s = spark.range(1000).select("id", (F.col("id") % 3).alias("v"))
    parts = [diffsketch.sketch(s.where(F.col("id") % 2 == x), 64) for x in (0, 1)]
    assert diffsketch.merged(*parts, diffsketch.sketch(s, 64, -1)).count() == 0


def test_decode_refuses_cells_that_do_not_add_up():
    cells = 8
    h = -(1 << 62) + 12345
    held = {}
    for row in range(3):
        place = (row, diffsketch._contents(h, 1)[row + 1] % cells)
        held[place] = diffsketch._contents(h, 2)
    assert diffsketch.decode(held, cells) == {h: 2}
    first = next(iter(held))
    assert diffsketch.decode({**held, first: [x + 1 for x in held[first]]}, cells) is None
    assert diffsketch.decode({first: held[first]}, cells) is None and diffsketch.decode({}, cells) == {}


def test_node_ranges_cover_all_hashes():
    spans = [(difftree._signed(n << 56), difftree._signed((n << 56) + (1 << 56) - 1)) for n in range(256)]
    assert all(a < b for a, b in spans) and sum(b - a + 1 for a, b in spans) == 1 << 64
