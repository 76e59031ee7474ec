"""Rows that are the same for every batch of a load are stored once (K4, X7) and read once a batch."""

import glob
import json
import os

import pytest

from shelfwise import schemas
from shelfwise.operators import clean as C
from shelfwise.operators import transforms as T
from shelfwise.sinks import tables as K
from shelfwise.sources import files as S
from shelfwise.streaming import microbatch as P

NAME = "supplier_delay_alerts"


def load(spark, out, batches, orders=4, **kw):
    pos = spark.createDataFrame([(f"t{b}", "P1", "n", "East", 1, 2.0, "2024-01-01T00:00:00", b) for b in batches],
                                schemas.POS_BATCHED)
    stock = spark.createDataFrame([("P1", 100, 20)], schemas.WAREHOUSE)
    sup = spark.createDataFrame([(f"PO{i}", "P1", "S1", "2024-01-01", "2024-01-05") for i in range(orders)], schemas.SUPPLIER)
    with P.keeping() as keep:
        results = P.batch_results(keep(pos), C.clean_warehouse(stock), T.supplier_delay_detection(C.clean_supplier(sup)), keep)
        return K.load_results(results, out, **kw)


def pairs(df):
    return sorted((r.batch_id, r.po_id) for r in df.collect())


def test_alerts_are_stored_once_a_load_and_read_once_a_batch(spark, tmp_dir):
    record = load(spark, tmp_dir, [3, 5, 8, None])
    load(spark, tmp_dir, [8, 9], orders=2)
    stored = sum(spark.read.parquet(f).count() for f in glob.glob(f"{tmp_dir}/{NAME}/*/"))
    assert stored == 4 + 2
    assert (record["tables"][NAME]["rows"], record["tables"][NAME]["batches"]) == (12, [3, 5, 8])
    table = S.result_table(spark, tmp_dir, NAME)
    assert table.schema == S.result_table(spark, tmp_dir + "-none", NAME).schema
    assert pairs(table) == sorted([(b, f"PO{i}") for b in (3, 5, 8) for i in range(4)]
                                  + [(b, f"PO{i}") for b in (8, 9) for i in range(2)])
    assert pairs(S.latest_result(spark, tmp_dir, NAME)) == [(9, "PO0"), (9, "PO1")]
    assert pairs(S.result_table(spark, tmp_dir, NAME, batch=8)) == sorted([(8, f"PO{i}") for i in range(4)] + [(8, "PO0"), (8, "PO1")])


def test_partitioned_loads_of_the_same_table_are_read_beside_them(spark, tmp_dir):
    load(spark, tmp_dir, [3, 5], orders=1)
    row = S.result_table(spark, tmp_dir, NAME).drop("loaded_at", "load_id").where("batch_id = 5")
    K.load_result(row.localCheckpoint(), tmp_dir, NAME)
    assert pairs(S.result_table(spark, tmp_dir, NAME)) == [(3, "PO0"), (5, "PO0"), (5, "PO0")]


def test_no_alerts_or_no_batches_load_nothing(spark, tmp_dir):
    assert load(spark, tmp_dir, [1, 2], orders=0)["tables"][NAME]["rows"] == 0
    assert load(spark, tmp_dir, [], orders=3)["tables"][NAME]["rows"] == 0
    assert S.result_table(spark, tmp_dir, NAME).count() == 0 and S.latest_result(spark, tmp_dir, NAME).count() == 0


def test_catalog_shows_shared_rows_once_a_batch(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS shared_test")
    try:
        load(spark, tmp_dir, [3, 5], orders=2)
        K.create_result_tables(spark, tmp_dir, "shared_test")
        load(spark, tmp_dir, [7], orders=1, catalog="shared_test")
        assert pairs(spark.table(f"shared_test.{NAME}")) == [(3, "PO0"), (3, "PO1"), (5, "PO0"), (5, "PO1"), (7, "PO0")]
        assert pairs(spark.table(f"shared_test.{NAME}").where("batch_id = 5")) == [(5, "PO0"), (5, "PO1")]
    finally:
        spark.sql("DROP DATABASE shared_test CASCADE")


def test_rows_that_differ_in_their_batches_are_refused(spark, tmp_dir):
    df = spark.createDataFrame([("PO1", [1]), ("PO2", [1, 2])], "po_id string, batch_ids array<int>")
    with pytest.raises(ValueError, match="batch_ids"):
        K.load_results({NAME: lambda: df}, tmp_dir)
    assert not os.path.exists(f"{tmp_dir}/load_log")


def test_records_without_the_mark_are_read_as_before(spark, tmp_dir):
    K.load_result(spark.createDataFrame([(1, "a", 5, 20, True)], "batch_id int, product_id string, current_stock bigint,"
                                        " reorder_threshold int, low_stock_flag boolean"), tmp_dir, "low_stock_alerts")
    (log,) = glob.glob(f"{tmp_dir}/load_log/*.json")
    assert "shared" not in json.load(open(log))["tables"]["low_stock_alerts"]
    assert S.result_table(spark, tmp_dir, "low_stock_alerts").count() == 1


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_repeated_stock_is_not_shuffled(spark):
    """the join and the window per product use one dealing by product, made before stock is repeated."""
    stock = spark.range(40).selectExpr("concat('P', id) AS product_id", "100 AS warehouse_stock", "20 AS reorder_threshold")
    sales = spark.range(400).selectExpr("cast(id % 5 AS int) AS batch_id", "concat('P', id % 37) AS product_id",
                                        "id % 3 AS units_sold")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(T.inventory_cumulative(T.inventory_calculation(sales, stock)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    between = plan[plan.index("Window ["):plan.index("Generate explode")]
    assert "Exchange" not in between and "SortMergeJoin" not in between
    got = T.inventory_cumulative(T.inventory_calculation(sales, stock)).where("product_id = 'P3'").orderBy("batch_id").collect()
    units = [sum(i % 3 for i in range(400) if i % 37 == 3 and i % 5 == b) for b in range(5)]
    assert [(r.units_sold_batch, r.cumulative_stock) for r in got] == [(u, 100 - sum(units[:b + 1])) for b, u in enumerate(units)]


def test_rows_that_come_once_are_not_counted_in_full(spark):
    """F16: only rows of repeated keys reach the count of full rows; null keys are a key."""
    from shelfwise.plans.dedup import split_first
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("b", 1, "z"), ("b", 1, "z"), (None, 3, "u"), (None, 3, "u")],
                               "k string, v int, w string")
    kept, extra = split_first(df, ["k"], ["v"])
    rows = lambda d: sorted((str(r.k), r.v, r.w) for r in d.collect())
    assert rows(kept) == [("None", 3, "u"), ("a", 1, "x"), ("b", 1, "z")]
    assert rows(extra) == [("None", 3, "u"), ("b", 1, "z"), ("b", 2, "y")]
    assert "LeftSemi" in plan_of(extra)


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in disk.getAllFiles().mkString(",").split(",") if "/shuffle_" in f}


def test_a_load_leaves_no_shuffle_files_or_kept_frames(spark, tmp_dir):
    """What several results read is written once and dropped with the load, and so are its shuffle files."""
    pos = spark.createDataFrame([(f"t{i}", f"P{i % 7}", "n", "East", 1, 2.0, "2024-01-01T00:00:00", i % 3) for i in range(60)],
                                schemas.POS_BATCHED)
    stock = spark.createDataFrame([(f"P{i}", 100, 20) for i in range(7)], schemas.WAREHOUSE)
    sup = spark.createDataFrame([("PO1", "P1", "S1", "2024-01-01", "2024-01-05")], schemas.SUPPLIER)
    before = shuffle_files(spark)
    loader = P.BatchLoader(tmp_dir, lambda: stock, lambda: sup, run="r")
    loader(pos, 0)
    loader.refs.clear()
    left = {f.rsplit("/", 1)[1] for f in shuffle_files(spark) - before}
    assert not left
    assert not glob.glob(f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/shelfwise-work/spool-*")
    assert S.result_table(spark, tmp_dir, "inventory_status").count() == 21
    assert S.result_table(spark, tmp_dir, "product_ranking").count() == 21


def test_results_of_a_load_are_computed_once(spark):
    """Frames that several results read are kept: sales, batch ids, stock by product, totals; none twice, none repeated."""
    pos = spark.createDataFrame([("t1", "P1", "n", "East", 1, 2.0, "2024-01-01T00:00:00", 1)], schemas.POS_BATCHED)
    stock = spark.createDataFrame([("P1", 100, 20)], schemas.WAREHOUSE)
    alerts = spark.createDataFrame([("PO1",)], "po_id string")
    held = []
    results = P.batch_results(pos, stock, alerts, lambda df: held.append(df.columns) or df)
    assert not held
    for name in P.RESULT_NAMES:
        results[name]()
    assert [c[-1] for c in held] == ["txn_count", "batch_id", "_units", "units_sold"]
