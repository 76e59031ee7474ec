"""What a stream keeps on disk at once: slices of the feed, the alerts once a stream, files not yet read."""

import glob
import json
import os

from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from shelfwise import schemas
from shelfwise.operators import clean as C
from shelfwise.operators import transforms as T
from shelfwise.sinks import tables as K
from shelfwise.sources import files as S
from shelfwise.streaming import microbatch as P
from shelfwise.streaming import staging

ALERTS = "supplier_delay_alerts"


def sale(txn, batch, product="P1"):
    return (txn, product, "n", "East", 1, 2.0, "2024-01-01T00:00:00", batch)


def feed_rows(spark):
    rows = [sale(f"t{i}", None if i < 30 else i % 40, f"P{i % 7}") for i in range(2000)]
    return spark.createDataFrame(rows, schemas.POS_BATCHED)


def spy(monkeypatch, name):
    """The numbers of rows of the frames that a method is called on."""
    real, seen = getattr(DataFrame, name), []

    def counting(self, *args):
        seen.append(self.count())
        return real(self, *args)

    monkeypatch.setattr(DataFrame, name, counting)
    return seen


def refs(spark):
    wh = spark.createDataFrame([("P1", 100, 20), ("P2", 10, 20)], schemas.WAREHOUSE)
    sup = spark.createDataFrame([(f"PO{i}", "P1", "S1", "2024-01-01", "2024-01-05") for i in range(3)], schemas.SUPPLIER)
    return (lambda: wh), (lambda: sup)


def write(feed, name, rows, mtime):
    os.makedirs(feed, exist_ok=True)
    path = os.path.join(feed, name)
    with open(path, "w") as fh:
        fh.writelines(json.dumps(dict(zip(schemas.POS_BATCHED.names, r))) + "\n" for r in rows)
    os.utime(path, (mtime, mtime))


def test_a_feed_is_shuffled_slice_by_slice(spark, tmp_dir, monkeypatch):
    rows = feed_rows(spark)
    shuffled = spy(monkeypatch, "repartitionByRange")
    files = staging.stage_pos_feed(spark, rows, os.path.join(tmp_dir, "feed"), 8)
    assert max(shuffled) <= 0.4 * 2000 and sum(shuffled) == 2000
    back = spark.read.schema(schemas.POS_BATCHED).json(files)
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
    held = {}
    for r in back.select(F.input_file_name().alias("f"), F.coalesce("batch_id", F.lit(-1)).alias("b")).distinct().collect():
        held.setdefault(r.f, []).append(r.b)
    order = [b for f in sorted(held) for b in sorted(held[f])]
    assert order == sorted(order) == [-1, *range(40)]  # whole batches, ascending


def test_batch_files_are_shuffled_slice_by_slice(spark, tmp_dir, monkeypatch):
    rows = feed_rows(spark)
    shuffled = spy(monkeypatch, "repartition")
    files = staging.stage_batch_files(spark, rows, os.path.join(tmp_dir, "feed"))
    assert max(shuffled) < 0.6 * 2000 and sum(shuffled) == 2000
    assert len(files) == 41 and spark.read.schema(schemas.POS).json(files).count() == 2000


def test_one_batch_and_no_batch_are_staged(spark, tmp_dir):
    for i, batch in enumerate((3, None)):
        files = staging.stage_pos_feed(spark, spark.createDataFrame([sale("t", batch)], schemas.POS_BATCHED),
                                       os.path.join(tmp_dir, f"feed{i}"), 8)
        assert [r.batch_id for r in spark.read.schema(schemas.POS_BATCHED).json(files).collect()] == [batch]


def test_a_reference_table_is_cleaned_slice_by_slice(spark):
    raw = spark.createDataFrame([(None if i % 50 == 0 else f"PO{i % 300}", f"P{i}", "S1", "2024-01-01", f"2024-01-0{1 + i % 9}")
                                 for i in range(1000)], schemas.SUPPLIER)
    derive = lambda df: T.supplier_delay_detection(C.clean_supplier(df))
    whole, given = derive(raw), []
    cache = P.ReferenceCache()
    got = cache.get("supplier", raw, lambda df: (given.append(df.count()), derive(df))[1], key="po_id")
    assert max(given) < 500 and sum(given) == 1000
    assert got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty() and got.count() > 100
    cache.clear()


def test_a_load_is_cleaned_slice_by_slice(spark):
    rows, given = feed_rows(spark), []
    cleaned = lambda df: (given.append(df.count()), df)[1]
    wh, sup = (get() for get in refs(spark))
    build = lambda **kw: P.batch_results(rows, C.clean_warehouse(wh), T.supplier_delay_detection(C.clean_supplier(sup)), **kw)
    whole, got = build()["sales_aggregation"](), build(cleaned=cleaned, slices=4)["sales_aggregation"]()
    assert max(given) < 1200 and sum(given) == 2000
    assert got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty()


def test_counts_of_slices_that_keep_nothing(spark, tmp_dir):
    bad = ("x", None, "n", "East", 1, 2.0, "2024-01-01T00:00:00")
    rows = [sale("t", 0), sale("t", 0), sale("u", 1)] + [(*bad, b) for b in range(2, 20)]
    loader = P.BatchLoader(tmp_dir, *refs(spark), run="r")
    loader(spark.createDataFrame(rows, schemas.POS_BATCHED), 0)
    loader.refs.clear()
    row = P.load_metrics(spark, tmp_dir).first()
    assert (row.raw_rows, row.null_rows, row.invalid_rows, row.duplicate_rows, row.clean_rows) == (21, 18, 0, 1, 2)
    assert row.inventory_status_rows == 2 * 20


def test_alerts_are_stored_once_a_stream(spark, tmp_dir):
    feed, out, ckpt = (os.path.join(tmp_dir, x) for x in ("feed", "out", "ckpt"))
    for b in range(3):
        write(feed, f"{b}.json", [sale(f"t{b}", b)], 1_600_000_000 + b)
    P.run_stream(spark, feed, out, ckpt, *refs(spark))
    assert len(glob.glob(f"{out}/{ALERTS}/load_id=*")) == 1
    table = S.result_table(spark, out, ALERTS)
    assert sorted((r.batch_id, r.po_id) for r in table.collect()) == [(b, f"PO{i}") for b in range(3) for i in range(3)]
    # each load keeps its id and time, as its other results have them
    sales = S.result_table(spark, out, "sales_aggregation")
    assert {(r.batch_id, r.load_id) for r in table.collect()} == {(r.batch_id, r.load_id) for r in sales.collect()}
    times = [r.t for r in table.groupBy("batch_id").agg(F.min("loaded_at").alias("t")).orderBy("batch_id").collect()]
    assert times == sorted(set(times)) and len(times) == 3
    assert [r.po_id for r in S.latest_result(spark, out, ALERTS).orderBy("po_id").collect()] == ["PO0", "PO1", "PO2"]
    assert K.vacuum(spark, out) == [] and S.result_table(spark, out, ALERTS).count() == 9


def test_alerts_that_changed_or_are_gone_are_stored_again(spark, tmp_dir):
    wh, sup = refs(spark)
    change = {"sup": sup()}
    loader = P.BatchLoader(tmp_dir, wh, lambda: change["sup"], run="r")
    batch = lambda b: spark.createDataFrame([sale("t", b)], schemas.POS_BATCHED)
    loader(batch(0), 0)
    loader.refs.clear()  # as after a change of the supplier's files
    change["sup"] = sup().where("po_id = 'PO1'")
    loader(batch(1), 1)
    assert len(glob.glob(f"{tmp_dir}/{ALERTS}/load_id=*")) == 2
    kept = lambda: sorted((r.batch_id, r.po_id) for r in S.result_table(spark, tmp_dir, ALERTS).collect())
    assert kept() == [(0, "PO0"), (0, "PO1"), (0, "PO2"), (1, "PO1")]
    folder = K.load_results({ALERTS: lambda: T.supplier_alerts_per_batch(S.result_table(spark, tmp_dir, ALERTS).where("batch_id = 1")
                                                                          .drop("batch_id", "loaded_at", "load_id"), batch(2), True)},
                            tmp_dir, stored={ALERTS: "load_id=gone"})["tables"][ALERTS]["folder"]
    assert folder != "load_id=gone" and kept()[-1] == (2, "PO1")
    loader.refs.clear()


def test_files_go_when_the_next_micro_batch_begins(spark, tmp_dir):
    feed, out, ckpt = (os.path.join(tmp_dir, x) for x in ("feed", "out", "ckpt"))
    for b in range(4):
        write(feed, f"{b}.json", [sale(f"t{b}", b)], 1_600_000_000 + b)
    P.run_stream(spark, feed, out, ckpt, *refs(spark), files_per_trigger=2, drop_read=True)
    assert {"2.json", "3.json"} <= set(os.listdir(feed)) and "0.json" not in os.listdir(feed)
    assert S.result_table(spark, out, "sales_aggregation").agg(F.sum("txn_count")).first()[0] == 4
