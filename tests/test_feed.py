"""catalog numbering and fixed-size chunks."""

import os

from pyspark.sql import functions as F

from shelfwise.operators import feed as FD
from shelfwise.sources.files import file_listing, raw_sales_csv

RAW = "row_id bigint, product_name string, region string, order_quantity int, unit_price double, order_date string"


def test_f9_catalog_first_appearance(spark):
    rows = [(1, "b", "E", 1, 1.0, "2024-01-02"), (2, "a", "E", 1, 1.0, "2024-01-01"),
            (3, "b", "E", 1, 1.0, "2024-01-03"), (4, "c", "E", 1, 1.0, "2024-01-01")]
    clean = FD.raw_sales_clean(spark.createDataFrame(rows, RAW))
    got = sorted((r.product_name, r.product_id) for r in FD.product_catalog(clean).collect())
    assert got == [("a", "P0002"), ("b", "P0001"), ("c", "P0003")]


def test_f9_chunks_of_700(spark):
    rows = [(i, f"n{i % 7}", "East", 1, 2.0, f"2024-01-{1 + i % 28:02d}") for i in range(1401)]
    clean = FD.raw_sales_clean(spark.createDataFrame(rows, RAW))
    chunks = FD.feed_chunks(clean, FD.product_catalog(clean))
    sizes = sorted((r.feed_batch, r["count"]) for r in chunks.groupBy("feed_batch").count().collect())
    assert sizes == [(1, 700), (2, 700), (3, 1)]
    first = chunks.filter("feed_batch = 1").agg(F.max("txn_timestamp")).collect()[0][0]
    last = chunks.filter("feed_batch = 2").agg(F.min("txn_timestamp")).collect()[0][0]
    assert first <= last
    one = chunks.filter("txn_id = 'TXN-5'").collect()[0]
    assert one.txn_timestamp == "2024-01-06T00:00:00" and one.store_id == "East"


def test_raw_clean_rules(spark):
    rows = [(1, "x", "E", 0, 1.0, "2024-01-01"), (2, "x", "E", 1, None, "2024-01-01"),
            (3, "x", "E", 1, 1.0, "n/a"), (4, None, "E", 1, 1.0, "2024-01-01"), (5, "x", "E", 1, 1.0, "2024-01-01")]
    got = [r.row_id for r in FD.raw_sales_clean(spark.createDataFrame(rows, RAW)).collect()]
    assert got == [5]


def test_latin1_csv_and_feed_listing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw.csv")
    with open(path, "wb") as fh:
        fh.write("Row ID,Product Name,Region,Order Quantity,Unit Price,Order Date\n".encode("latin-1"))
        fh.write("1,Café crème,West,2,3.5,2024-01-01\n".encode("latin-1"))
    df = raw_sales_csv(spark, path)
    r = df.collect()[0]
    assert r.product_name == "Café crème" and r.order_quantity == 2
    clean = FD.raw_sales_clean(df)
    chunks = FD.feed_chunks(clean, FD.product_catalog(clean))
    out = os.path.join(tmp_dir, "pos_sales")
    FD.write_feed(chunks, out)
    from shelfwise.operators.reports import feed_files
    listed = feed_files(file_listing(spark, out)).collect()
    assert len(listed) == 1 and listed[0].size_kb > 0


def test_csv_columns_are_found_by_name(spark, tmp_dir):
    import pytest

    from shelfwise.sources.files import raw_sales_csv, warehouse_csv
    w = os.path.join(tmp_dir, "w.csv")
    with open(w, "w") as f:
        f.write("note,reorder_threshold,product_id,warehouse_stock\nx,15,P1,300\ny,,P2,many\n")
    assert [tuple(r) for r in warehouse_csv(spark, w).collect()] == [("P1", 300, 15), ("P2", None, None)]
    r = os.path.join(tmp_dir, "r.csv")
    with open(r, "w", encoding="latin-1") as f:
        f.write("Region,Order ID,Order Date,Row ID,Unit Price,Product Name,Order Quantity\n"
                "West,9,2010-10-13,1,1.5,Caf\u00e9,3\n")
    got = raw_sales_csv(spark, r).first()
    assert (got.row_id, got.product_name, got.region, got.order_quantity, got.unit_price) == (1, "Caf\u00e9", "West", 3, 1.5)
    with open(w, "w") as f:
        f.write("product_id,stock\nP1,3\n")
    with pytest.raises(ValueError, match="warehouse_stock"):
        warehouse_csv(spark, w)


def test_newest_chunks_by_number(spark):
    from shelfwise.operators.reports import feed_file_count, feed_files
    listing = spark.createDataFrame([(f"file:/f/feed_batch={n}/part-{k}.json", 1024) for n in range(1, 10012) for k in (0, 1)
                                     if n < 5 or n > 9990], "path string, length bigint")
    assert [(r.file_name, r.size_kb) for r in feed_files(listing).collect()] == [
        (f"feed_batch={n}", 2.0) for n in range(10002, 10012)]
    assert feed_file_count(listing).first().file_count == 25
