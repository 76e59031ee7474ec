"""Business transformations on hand-made rows."""

import pytest

from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.operators import transforms as T


def _sales(spark, rows):
    schema = "product_id string, product_name string, store_id string, units_sold bigint, " \
             "total_revenue double, txn_count bigint"
    return spark.createDataFrame(rows, schema)


def test_f3_inventory_and_low_stock(spark):
    wh = spark.createDataFrame(
        [("P1", 25, 20), ("P2", 25, 20), ("P3", 20, None), ("P4", 19, None), ("P5", 3, 15)],
        schemas.WAREHOUSE)
    sales = _sales(spark, [("P1", "a", "S", 5, 1.0, 1), ("P2", "b", "S", 6, 1.0, 1),
                           ("P5", "c", "S", 10, 1.0, 1), ("P9", "z", "S", 4, 1.0, 1)])
    inv = {r.product_id: r for r in T.inventory_calculation(sales, wh).collect()}
    assert set(inv) == {"P1", "P2", "P3", "P4", "P5"}
    assert [inv[p].current_stock for p in ("P1", "P2", "P3", "P4", "P5")] == [20, 19, 20, 19, -7]
    assert inv["P3"].units_sold_batch == 0
    low = {r.product_id: r for r in T.low_stock_detection(T.inventory_calculation(sales, wh)).collect()}
    assert set(low) == {"P2", "P4", "P5"}
    assert low["P4"].reorder_threshold is None and low["P4"].low_stock_flag is True


def test_inventory_repeats_warehouse_for_every_batch(spark):
    wh = spark.createDataFrame([("P1", 25, 20), ("P2", 5, 20)], schemas.WAREHOUSE)
    sales = _sales(spark, [("P1", "a", "S", 5, 1.0, 1)]).withColumn("batch_id", F.lit(3))
    batches = spark.createDataFrame([(3,), (4,)], "batch_id int")
    got = sorted((r.batch_id, r.product_id, r.current_stock)
                 for r in T.inventory_calculation(sales, wh, batches).collect())
    assert got == [(3, "P1", 20), (3, "P2", 5), (4, "P1", 25), (4, "P2", 5)]


def test_f4_ranking_ties_and_names(spark):
    sales = _sales(spark, [("P1", "a", "S", 1, 100.0, 1), ("P2", "b", "S", 1, 80.0, 1),
                           ("P3", "c", "S", 1, 80.0, 1), ("P4", "d", "S", 1, 50.0, 1),
                           ("P4", "d2", "S", 1, 10.0, 1)])
    got = sorted((r.rank, r.product_id, r.product_name) for r in T.product_ranking(sales).collect())
    assert [g[0] for g in got] == [1, 2, 2, 4, 5]
    assert ("P4", "d2") in [(g[1], g[2]) for g in got]


def test_f4_ranking_sums_stores(spark):
    sales = _sales(spark, [("P1", "a", "S1", 1, 30.0, 1), ("P1", "a", "S2", 2, 40.0, 1),
                           ("P2", "b", "S1", 1, 50.0, 1)])
    got = {r.product_id: (r.rank, r.total_revenue, r.units_sold) for r in T.product_ranking(sales).collect()}
    assert got == {"P1": (1, 70.0, 3), "P2": (2, 50.0, 1)}


def test_f5_supplier_delay(spark):
    rows = [("PO1", "P", "S", "2024-01-10", "2024-01-09"), ("PO2", "P", "S", "2024-01-10", "2024-01-12"),
            ("PO3", "P", "S", "2024-01-10", "2024-01-13")]
    sup = spark.createDataFrame(rows, schemas.SUPPLIER).select(
        "po_id", "product_id", "supplier_id",
        F.to_date("expected_delivery_date").alias("expected_delivery_date"),
        F.to_date("actual_delivery_date").alias("actual_delivery_date"))
    got = [(r.po_id, r.delay_days) for r in T.supplier_delay_detection(sup).collect()]
    assert got == [("PO3", 3)]


def test_f6_sales_aggregation(spark):
    rows = [("t1", "P1", "n", "S1", 2, 10.0, None), (None, "P1", "n", "S1", 3, 10.0, None),
            ("t3", "P1", "n", None, 1, 10.0, None)]
    df = spark.createDataFrame(rows, schemas.POS)
    got = {r.store_id: (r.units_sold, r.total_revenue, r.txn_count) for r in T.sales_aggregation(df).collect()}
    assert got == {"S1": (5, 50.0, 1), None: (1, 10.0, 1)}


def test_revenue_is_exact_decimal(spark):
    rows = [(f"t{i}", "P1", "n", "S", 1, 0.1, None) for i in range(10)]
    got = T.sales_aggregation(spark.createDataFrame(rows, schemas.POS)).collect()[0]
    assert got.total_revenue == 1.0


def test_cumulative_stock(spark):
    inv = spark.createDataFrame(
        [(1, "P1", 100, 20, 10), (2, "P1", 100, 20, 5), (3, "P1", 100, 20, 0)],
        "batch_id int, product_id string, warehouse_stock int, reorder_threshold int, units_sold_batch bigint")
    got = [r.cumulative_stock for r in T.inventory_cumulative(inv).orderBy("batch_id").collect()]
    assert got == [90, 85, 85]


@pytest.mark.parametrize("qty, price, want", [(1000, 0.004, 4.0), (1000, 1.005, 1005.0), (10, 1.999, 19.99),
                                              (1, 2e10, 2e10), (2, 2e20, 4e20), (1, float("inf"), float("inf"))])
def test_revenue_is_not_rounded_to_cents(spark, qty, price, want):
    df = spark.createDataFrame([("t", "P1", "n", "S", qty, price, None)], schemas.POS)
    sales = T.sales_aggregation(df)
    assert sales.first().total_revenue == want
    assert T.product_ranking(sales.withColumn("batch_id", F.lit(1))).first().total_revenue == want
