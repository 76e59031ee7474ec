"""Plan properties: no Python UDFs in the hot path, partition pruning, pushdown,
hot keys handled without collecting a group into one task."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from shelfwise import schemas
from shelfwise.operators import clean as C
from shelfwise.operators.reports import latest_ranking
from shelfwise.plans.dedup import expand_counts, split_first
from shelfwise.queries import QUERIES
from shelfwise.sinks.tables import load_result
from shelfwise.sources.files import result_table

STREAMING = {"stream_pos_sales", "stream_inventory", "stream_pos_resume", "stream_replay", "stream_dedup"}
NEWEST_ONLY = ["kpi_delays", "supplier_delay_summary", "supplier_delay_distinct", "latest_delays", "latest_inventory",
               "kpi_low_stock", "lowest_stock", "critical_items"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMING - {"feed_files", "load_result",
                                                                           "result_scan"}))
def test_no_row_python_udf(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "MapInArrow" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_prunes_columns(spark):
    plan = _plan(entry.queries()["store_list"](spark, SF_SMALL))
    lineitem_scans = [ln for ln in plan.splitlines() if "lineitem.parquet" in ln]
    assert lineitem_scans and all("l_shipdate" not in ln and "l_comment" not in ln for ln in lineitem_scans)


def test_latest_batch_is_partition_filter(spark, tmp_dir):
    rows = [(b, f"P{b}", "n", 1.0, 1, 1) for b in range(5)]
    df = spark.createDataFrame(rows, "batch_id int, product_id string, product_name string, "
                                     "total_revenue double, units_sold bigint, rank bigint")
    load_result(df, tmp_dir, "product_ranking")
    q = latest_ranking(result_table(spark, tmp_dir, "product_ranking"))
    assert [r.product_id for r in q.collect()] == ["P4"]
    filters = [ln.split("PartitionFilters: [")[1].split("]")[0] for ln in _plan(q).splitlines() if "PartitionFilters" in ln]
    assert any("batch_id" in f and "ubquery" in f for f in filters), filters


def test_hot_txn_id_dedup_and_rejects(spark):
    # a third of all rows share one txn_id, with several distinct values and exact copies
    hot = [("HOT", f"P{i % 5}", "n", "S", 1 + i % 3, 2.0, "2024-01-01T00:00:00", 1) for i in range(3000)]
    cold = [(f"t{i}", "P1", "n", "S", 1, 2.0, "2024-01-01T00:00:00", 1) for i in range(6000)]
    df = spark.createDataFrame(hot + cold, schemas.POS_BATCHED)
    clean = C.clean_pos(df)
    assert clean.count() == 6001
    winner = clean.filter("txn_id = 'HOT'").collect()[0]
    assert (winner.product_id, winner.quantity_sold) == ("P0", 1)
    rej = C.pos_rejects(df)
    assert rej.count() == 2999 and rej.filter("reason = 'duplicate'").count() == 2999
    plan = _plan(clean)
    assert "Window" not in plan  # group reduced by partial aggregation, not sorted in one task


def test_split_first_counts_exact_copies(spark):
    rows = [("k", 1)] * 7 + [("k", 0)] * 2 + [("j", 5)]
    df = spark.createDataFrame(rows, "key string, v int")
    kept, extra = split_first(df, ["key"], ["v"])
    assert sorted(map(tuple, kept.collect())) == [("j", 5), ("k", 0)]
    assert sorted(map(tuple, extra.collect())) == [("k", 0)] + [("k", 1)] * 7


def test_expand_counts_in_chunks(spark):
    df = spark.createDataFrame([("a", 10), ("b", 3), ("c", 0)], "k string, n long")
    out = expand_counts(df, "n", chunk=4)
    got = {r.k: r["count"] for r in out.groupBy("k").count().collect()}
    assert got == {"a": 10, "b": 3}


def test_inventory_batches_without_cross_join(spark):
    plan = _plan(entry.queries()["inventory_status"](spark, SF_SMALL))
    assert "Generate explode" in plan and "Subquery" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", NEWEST_ONLY)
def test_reports_dont_multiply_by_batches(spark, name):
    assert "Generate explode" not in _plan(entry.queries()[name](spark, SF_SMALL))


def test_no_forced_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("pos_view", "feed_chunks", "inventory_status"):
            assert "BroadcastHashJoin" not in _plan(entry.queries()[name](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_rank_reads_the_feed_once(spark):
    """The totals are written once; bounds, counts and rows read that, and nothing scans the feed again."""
    df = entry.queries()["product_ranking"](spark, SF_SMALL)
    assert "lineitem.parquet" not in _plan(df)
    assert df.inputFiles() and all("/rank-totals-" in f for f in df.inputFiles())
