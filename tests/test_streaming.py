"""The stream over staged files."""

import json
import os

from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.streaming import staging
from shelfwise.sources.files import result_table
from shelfwise.streaming import microbatch as P


def forget_last_commit(checkpoint):
    """Remove the newest commit marker of a stream checkpoint, as a crash right
    before the commit would leave it; the next run replays that micro-batch."""
    last = max(int(f) for f in os.listdir(f"{checkpoint}/commits") if f.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{name}"):
            os.unlink(f"{checkpoint}/commits/{name}")


def _write(folder, name, rows, mtime):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    keys = [f.name for f in schemas.POS_BATCHED.fields]
    with open(path, "w") as fh:
        for r in rows:
            fh.write(json.dumps(dict(zip(keys, r))) + "\n")
    os.utime(path, (mtime, mtime))


def _row(txn, batch, product="P1", qty=1):
    return (txn, product, "n", "East", qty, 2.0, "2024-01-01T00:00:00", batch)


def _refs(spark):
    wh = spark.createDataFrame([("P1", 100, 20), ("P2", 10, 20)], schemas.WAREHOUSE)
    sup = spark.createDataFrame([("PO1", "P1", "S1", "2024-01-01", "2024-01-05")], schemas.SUPPLIER)
    return (lambda: wh), (lambda: sup)


def _f10_files(feed):
    # three files, each repeating the previous file's last txn_id
    _write(feed, "a.json", [_row("t1", 1), _row("t2", 1)], 1_600_000_000)
    _write(feed, "b.json", [_row("t2", 2), _row("t3", 2)], 1_600_000_100)
    _write(feed, "c.json", [_row("t3", 3), _row("t4", 3, "P2", 4)], 1_600_000_200)


def test_f10_per_batch_dedup_keeps_every_copy(spark, tmp_dir):
    feed, out, ckpt = (os.path.join(tmp_dir, x) for x in ("feed", "out", "ckpt"))
    _f10_files(feed)
    wh, sup = _refs(spark)
    P.run_stream(spark, feed, out, ckpt, wh, sup)
    sales = result_table(spark, out, "sales_aggregation")
    assert sales.agg(F.sum("txn_count")).collect()[0][0] == 6
    assert sorted(r.batch_id for r in sales.select("batch_id").distinct().collect()) == [1, 2, 3]
    inv = result_table(spark, out, "inventory_status")
    assert inv.count() == 6  # whole warehouse per batch
    low = {(r.batch_id, r.product_id) for r in result_table(spark, out, "low_stock_alerts").collect()}
    assert low == {(1, "P2"), (2, "P2"), (3, "P2")}
    assert result_table(spark, out, "supplier_delay_alerts").count() == 3  # recurs every batch
    assert result_table(spark, out, "product_ranking").filter("rank = 1").count() == 3
    # M2: a rerun with no new files adds nothing
    P.run_stream(spark, feed, out, ckpt, wh, sup)
    assert result_table(spark, out, "sales_aggregation").agg(F.sum("txn_count")).collect()[0][0] == 6


def test_f10_cross_batch_dedup_keeps_one(spark, tmp_dir):
    feed = os.path.join(tmp_dir, "feed")
    _f10_files(feed)
    kept = os.path.join(tmp_dir, "kept")
    P.dedup_stream(spark, feed, kept, os.path.join(tmp_dir, "ckpt"))
    got = sorted(r.txn_id for r in spark.read.parquet(kept).collect())
    assert got == ["t1", "t2", "t3", "t4"]


def test_new_files_only_and_replay(spark, tmp_dir):
    feed, out, ckpt = (os.path.join(tmp_dir, x) for x in ("feed", "out", "ckpt"))
    wh, sup = _refs(spark)
    _write(feed, "a.json", [_row("t1", 1)], 1_600_000_000)
    P.run_stream(spark, feed, out, ckpt, wh, sup)
    _write(feed, "b.json", [_row("t2", 2, qty=3)], 1_600_000_100)
    P.run_stream(spark, feed, out, ckpt, wh, sup)
    forget_last_commit(ckpt)
    P.run_stream(spark, feed, out, ckpt, wh, sup)  # replays batch 2
    got = sorted((r.batch_id, r.units_sold) for r in result_table(spark, out, "sales_aggregation").collect())
    assert got == [(1, 1), (2, 3)]


def test_epoch_id_when_no_batch_column_and_empty_batch(spark, tmp_dir):
    feed, out, ckpt = (os.path.join(tmp_dir, x) for x in ("feed", "out", "ckpt"))
    os.makedirs(feed)
    path = os.path.join(feed, "a.json")
    with open(path, "w") as fh:
        fh.write(json.dumps({"txn_id": "t1", "product_id": "P1", "quantity_sold": 2, "unit_price": 1.5}) + "\n")
    with open(os.path.join(feed, "b.json"), "w") as fh:
        fh.write("\n")  # an empty feed file
    os.utime(path, (1_600_000_000, 1_600_000_000))
    wh, sup = _refs(spark)
    P.run_stream(spark, feed, out, ckpt, wh, sup, with_batch_column=False)
    got = [(r.batch_id, r.units_sold) for r in result_table(spark, out, "sales_aggregation").collect()]
    assert got == [(0, 2)]


def test_missing_result_table_is_empty(spark, tmp_dir):
    df = result_table(spark, tmp_dir, "product_ranking")
    assert df.count() == 0 and "rank" in df.columns and "batch_id" in df.columns


def test_m3_processing_time_trigger(spark, tmp_dir):
    feed, out, ckpt = (os.path.join(tmp_dir, x) for x in ("feed", "out", "ckpt"))
    _write(feed, "a.json", [_row("t1", 1, qty=2)], 1_600_000_000)
    wh, sup = _refs(spark)
    q = P.start_stream(spark, feed, out, ckpt, wh, sup, processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = [(r.batch_id, r.units_sold) for r in result_table(spark, out, "sales_aggregation").collect()]
    assert got == [(1, 2)]


def test_s3_supplier_multiline_json(spark, tmp_dir):
    from shelfwise.sources.files import supplier_json
    path = os.path.join(tmp_dir, "supplier_updates.json")
    with open(path, "w") as fh:
        json.dump([{"po_id": "PO-1", "product_id": "P1", "supplier_id": "SUP-A",
                    "expected_delivery_date": "2024-01-10", "actual_delivery_date": "2024-01-13"},
                   {"po_id": "PO-2", "product_id": "P2", "supplier_id": "SUP-B",
                    "expected_delivery_date": "2024-01-10", "actual_delivery_date": "2024-01-11"}], fh, indent=2)
    rows = supplier_json(spark, path).collect()
    assert sorted(r.po_id for r in rows) == ["PO-1", "PO-2"]


def test_reference_cache_sees_edits(spark, tmp_dir):
    from shelfwise.operators import clean as C
    from shelfwise.sources.files import warehouse_csv
    path = os.path.join(tmp_dir, "warehouse.csv")

    def write(stock, mtime):
        with open(path, "w") as fh:
            fh.write(f"product_id,warehouse_stock,reorder_threshold\nP1,{stock},20\n")
        os.utime(path, (mtime, mtime))

    cache = P.ReferenceCache()
    write(10, 1_600_000_000)
    first = cache.get("wh", warehouse_csv(spark, path), C.clean_warehouse)
    again = cache.get("wh", warehouse_csv(spark, path), C.clean_warehouse)
    assert first is again and first.collect()[0].warehouse_stock == 10
    write(99, 1_600_000_500)
    edited = cache.get("wh", warehouse_csv(spark, path), C.clean_warehouse)
    assert edited is not first and edited.collect()[0].warehouse_stock == 99
    cache.clear()


POS_ROW = "txn_id string, product_id string, product_name string, store_id string, quantity_sold int, " \
          "unit_price double, txn_timestamp string, batch_id int"


def _feed(spark, folder, rows, start_ms):
    staging.stage_pos_feed(spark, spark.createDataFrame(rows, POS_ROW), folder, 1, start_ms)


def _pos(txn, product, qty, price, ts="2024-01-01T00:00:00", batch=1):
    return (txn, product, "n", "S", qty, price, ts, batch)


def test_batch_in_two_files_keeps_both_loads(spark, tmp_dir):
    feed, out, ckpt = (os.path.join(tmp_dir, x) for x in ("feed", "out", "ckpt"))
    _feed(spark, feed, [_pos("a", "P1", 1, 2.0)], 1_600_000_000_000)
    _feed(spark, feed, [_pos("b", "P1", 2, 2.0), _pos("c", "P2", 3, 1.0)], 1_700_000_000_000)
    stock = spark.createDataFrame([("P1", 30, 20)], schemas.WAREHOUSE)
    orders = spark.createDataFrame([], schemas.SUPPLIER)
    P.run_stream(spark, feed, out, ckpt, lambda: stock, lambda: orders)
    got = result_table(spark, out, "sales_aggregation").agg({"units_sold": "sum", "total_revenue": "sum"}).first()
    assert sorted(got) == [6, 9.0]


def test_dedup_keeps_late_rows(spark, tmp_dir):
    feed, kept, ckpt = (os.path.join(tmp_dir, x) for x in ("feed", "kept", "ckpt"))
    _feed(spark, feed, [_pos("a", "P1", 1, 1.0, "2024-12-01T00:00:00")], 1_600_000_000_000)
    _feed(spark, feed, [_pos("b", "P1", 1, 1.0, "2024-01-01T00:00:00"), _pos("a", "P1", 1, 1.0, "2024-12-01T00:00:00")],
          1_700_000_000_000)
    P.dedup_stream(spark, feed, kept, ckpt)
    assert sorted(r.txn_id for r in spark.read.parquet(kept).collect()) == ["a", "b"]
