"""F7, F8 and the dashboard reports on small hand-made tables."""

from pyspark.sql import functions as F

from shelfwise.operators import reports as R

SALES = ("batch_id int, product_id string, product_name string, store_id string, "
         "units_sold bigint, total_revenue double, txn_count bigint")


def _sales(spark):
    rows = [(1, "P001", "Sneaker - AirLite", "East", 2, 20.0, 2),
            (1, "P002", None, "West", 1, 5.0, 1),
            (2, None, None, "East", 3, 30.0, 3),
            (2, "P003", "Boot", None, 4, 40.0, 4)]
    return spark.createDataFrame(rows, SALES)


def test_f7_search(spark):
    s = _sales(spark)
    assert [r.product_id for r in R.search_products(s, "sneak.*lite").collect()] == ["P001"]
    got = sorted(r.product_id for r in R.search_products(s, "p00").collect())
    assert got == ["P001", "P002", "P003"]
    assert R.search_products(s, "zzz").count() == 0


def test_store_filter_and_list(spark):
    s = _sales(spark)
    assert R.filter_store(s, "All Regions").count() == 4
    assert R.filter_store(s, "East").count() == 2
    assert [r.store_id for r in R.store_list(s).collect()] == ["East", "West"]


def test_kpis(spark):
    s = _sales(spark)
    k = R.kpi_totals(R.filter_store(s, "East")).collect()[0]
    assert (k.total_revenue, k.total_units, k.total_txns) == (50.0, 5, 5)
    empty = R.kpi_totals(R.filter_store(s, "Nowhere")).collect()[0]
    assert (empty.total_revenue, empty.total_units, empty.total_txns) == (0.0, 0, 0)
    assert R.active_batches(s).collect()[0].active_batches == 2


def _inv(spark):
    rows = [(1, "P1", 30, 20, 0, 30), (2, "P1", 30, 20, 25, 5), (1, "P2", 12, None, 2, 10),
            (2, "P2", 12, None, 3, 9), (2, "P3", 50, 20, 0, 50)]
    return spark.createDataFrame(rows, "batch_id int, product_id string, warehouse_stock int, "
                                       "reorder_threshold int, units_sold_batch bigint, current_stock bigint")


def test_f8_status_and_latest(spark):
    latest = R.latest_inventory(_inv(spark))
    got = {r.product_id: r.current_stock for r in latest.collect()}
    assert got == {"P1": 5, "P2": 9, "P3": 50}
    crit = [(r.product_id, r.stock_status) for r in R.critical_items(latest, 20).collect()]
    assert crit == [("P1", "CRITICAL"), ("P2", "CRITICAL")]
    crit10 = {r.current_stock: r.stock_status for r in R.critical_items(
        latest.withColumn("current_stock", F.lit(10).cast("bigint")), 20).collect()}
    assert crit10 == {10: "LOW STOCK"}
    k = R.kpi_low_stock(latest, 20).collect()[0]
    assert (k.low_stock_count, k.severity) == (2, "amber")
    assert [r.product_id for r in R.lowest_stock(latest, 2).collect()] == ["P1", "P2"]


def test_top_products_groups_by_name(spark):
    s = _sales(spark)
    got = [(r.product_name, r.total_revenue) for r in R.top_products(s, 15).collect()]
    assert got == [("Boot", 40.0), ("Sneaker - AirLite", 20.0)]


def test_latest_batch_queries(spark):
    ranking = spark.createDataFrame(
        [(1, "P1", "a", 10.0, 1, 1), (2, "P2", "b", 5.0, 2, 1), (2, "P1", "a", 3.0, 1, 2)],
        "batch_id int, product_id string, product_name string, total_revenue double, units_sold bigint, rank bigint")
    got = [(r.rank, r.product_id) for r in R.latest_ranking(ranking).collect()]
    assert got == [(1, "P2"), (2, "P1")]


def test_supplier_summaries(spark):
    alerts = spark.createDataFrame(
        [(b, "PO1", "P", "S1", None, None, 3) for b in (1, 2)] + [(1, "PO2", "P", "S1", None, None, 5)],
        "batch_id int, po_id string, product_id string, supplier_id string, "
        "expected_delivery_date date, actual_delivery_date date, delay_days int")
    s = R.supplier_delay_summary(alerts).collect()[0]
    assert (s.delayed_orders, round(s.avg_delay, 4)) == (3, round(11 / 3, 4))
    d = R.supplier_delay_distinct(alerts).collect()[0]
    assert (d.delayed_orders, d.avg_delay) == (2, 4.0)
    assert R.kpi_delays(alerts).collect()[0].total_delays == 3
