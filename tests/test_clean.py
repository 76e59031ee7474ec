"""Cleaning rules on hand-made rows."""

import json
import math
import os

from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.operators import clean as C
from shelfwise.sources.files import pos_batch, warehouse_csv

OK_TS = "2024-01-01T10:00:00"


def _f1_rows():
    return [
        ("t1", "P1", "n1", "S1", 2, 10.0, OK_TS),
        ("t1", "P1", "n1", "S1", 2, 10.0, OK_TS),
        ("t2", "P1", "n1", "S1", None, 10.0, OK_TS),
        ("t3", None, "n1", "S1", 1, 10.0, OK_TS),
        ("t4", "P2", "n2", "S1", -3, 10.0, OK_TS),
        ("t5", "P2", "n2", "S1", 1, 0.0, OK_TS),
        ("t6", "P2", "n2", "S1", 1, float("nan"), OK_TS),
        ("t7", "P2", "n2", "S1", 4, 2.5, "not-a-date"),
        (None, "P3", "n3", "S1", 1, 1.0, OK_TS),
        (None, "P4", "n4", "S1", 1, 1.0, OK_TS),
    ]


def _f1_file(tmp_dir):
    path = os.path.join(tmp_dir, "pos_batch_0001.json")
    keys = [f.name for f in schemas.POS.fields]
    with open(path, "w") as fh:
        for r in _f1_rows():
            rec = {k: v for k, v in zip(keys, r) if v is not None}
            if isinstance(rec.get("unit_price"), float) and math.isnan(rec["unit_price"]):
                rec["unit_price"] = "NaN"
            fh.write(json.dumps(rec) + "\n")
        fh.write("\n")
        fh.write('{"txn_id": "t8", "product_id": \n')  # malformed line
    return path


def test_f1_clean_pos_from_json(spark, tmp_dir):
    df = pos_batch(spark, _f1_file(tmp_dir))
    got = {(r.txn_id, r.product_id): r for r in C.clean_pos(df).collect()}
    assert set(got) == {("t1", "P1"), ("t7", "P2"), (None, "P3")}
    assert got[("t7", "P2")].txn_timestamp is None
    assert str(got[("t1", "P1")].txn_timestamp) == "2024-01-01 10:00:00"


def test_f1_rejects_reasons(spark):
    df = spark.createDataFrame(_f1_rows(), schemas.POS)
    got = sorted((r.txn_id or "", r.product_id or "", r.reason) for r in C.pos_rejects(df).collect())
    assert got == sorted([
        ("t1", "P1", "duplicate"), ("t2", "P1", "null"), ("t3", "", "null"),
        ("t4", "P2", "invalid"), ("t5", "P2", "invalid"), ("t6", "P2", "null"),
        ("", "P4", "duplicate"),
    ])


def test_raw_equals_clean_plus_rejects(spark):
    df = spark.createDataFrame(_f1_rows() * 3, schemas.POS).withColumn("batch_id", F.lit(1))
    clean, rejects = C.clean_pos(df), C.pos_rejects(df)
    assert clean.count() + rejects.count() == df.count()
    rep = C.clean_report(df).collect()[0]
    assert rep.raw_rows == 30 and rep.clean_rows == 3
    assert rep.null_rows == 9 and rep.invalid_rows == 6 and rep.duplicate_rows == 12


def test_clean_is_idempotent(spark):
    df = spark.createDataFrame(_f1_rows(), schemas.POS)
    once = C.pos_dedup(C.pos_valid(C.pos_drop_nulls(df)))
    twice = C.pos_dedup(C.pos_valid(C.pos_drop_nulls(once)))
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_dedup_is_per_batch(spark):
    rows = [("t1", "P1", "n", "S", 1, 1.0, OK_TS, b) for b in (1, 2)]
    df = spark.createDataFrame(rows, schemas.POS_BATCHED)
    assert C.clean_pos(df).count() == 2


def test_f2_clean_warehouse_csv(spark, tmp_dir):
    path = os.path.join(tmp_dir, "warehouse.csv")
    with open(path, "w") as fh:
        fh.write("product_id,warehouse_stock,reorder_threshold\nP1,10,20\nP1,10,20\nP2,,20\nP3,7,\n")
    got = sorted(tuple(r) for r in C.clean_warehouse(warehouse_csv(spark, path)).collect())
    assert got == [("P1", 10, 20), ("P3", 7, None)]


def test_supplier_clean_parses_and_dedups(spark):
    rows = [("PO1", "P1", "S", "2024-01-10", "2024-01-13"),
            ("PO1", "P1", "S", "2024-01-10", "2024-01-13"),
            ("PO2", "P1", "S", "2024-01-10", None),
            ("PO3", "P2", "S", "2024-01-10", "garbage")]
    got = C.clean_supplier(spark.createDataFrame(rows, schemas.SUPPLIER)).collect()
    by_po = {r.po_id: r for r in got}
    assert set(by_po) == {"PO1", "PO3"}
    assert str(by_po["PO1"].actual_delivery_date) == "2024-01-13"
    assert by_po["PO3"].actual_delivery_date is None
