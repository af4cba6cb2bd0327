"""Physical-plan properties the scale design relies on (checked with explain output)."""

from tableferry import fixtures
from tableferry.operators import ddl, reconcile
from tableferry.plans import jobs
from tableferry.sources import catalog as cat
from tableferry.sources import paging
from tableferry.sources.tables import TPCH_TABLES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_paging_reads_only_the_key_and_sorts_no_whole_table(spark, source):
    orders = source.table("orders").select("o_orderkey")
    plan = _plan(paging.ranged(orders, ["o_orderkey"], 8))
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan and "rangepartitioning(o_orderkey" in plan
    assert paging.page_index(source.table("orders"), ["o_orderkey"]).columns == ["o_orderkey", "row_no", "batch_no"]


def test_table_load_has_no_shuffle(spark, source):
    db = source.subset(["lineitem"])
    types = jobs.all_target_types(ddl.map_types(cat.column_catalog(spark, db, materialized=False)))
    plan = _plan(jobs.strict_conform(db.table("lineitem"), types["lineitem"]))
    assert "Exchange" not in plan


def test_validation_combines_aggregates_without_joins(spark, source):
    src = source.subset(TPCH_TABLES)
    plan = _plan(reconcile.validate_tables(src, fixtures.damaged_target(src)))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_hash_diff_shuffles_only_narrow_rows(spark, source):
    src = source.subset(["orders"])
    tgt = fixtures.damaged_target(src)
    diff = reconcile.content_diff(src.table("orders"), tgt.table("orders"), ["o_orderkey"])
    plan = _plan(diff)
    # Map-side partial aggregates keyed by the key emit (key, count, min hash, max hash):
    # that is all the key-level shuffle carries — no value columns.
    partial = [line for line in plan.splitlines() if "keys=[o_orderkey" in line and "partial_count" in line]
    assert partial
    for line in partial:
        output = line.split("output=[", 1)[1]
        assert "o_totalprice" not in output and "o_orderstatus" not in output
