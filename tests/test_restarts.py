"""F2-F8: streams that run more than once clean a reference table once; deduplicating ones hold their ids on disk."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.functions.columns import padded_id
from shelfwise.operators import clean as C
from shelfwise.operators import transforms as T
from shelfwise.plans.dedup import keep_first
from shelfwise.plans.materialise import spooling
from shelfwise.sinks import tables as K
from shelfwise.sources import files as S
from shelfwise.streaming import microbatch as P
from shelfwise.streaming import staging

ALERTS = "supplier_delay_alerts"


def sale(txn, batch, product="P1", day="2024-01-01"):
    return (txn, product, "n", "East", 1, 2.0, f"{day}T00:00:00", batch)


def pos(spark, rows):
    return spark.createDataFrame(rows, schemas.POS_BATCHED)


def write(feed, name, rows, mtime):
    os.makedirs(feed, exist_ok=True)
    path = os.path.join(feed, name)
    with open(path, "w") as fh:
        fh.writelines(json.dumps(dict(zip(schemas.POS_BATCHED.names, r))) + "\n" for r in rows)
    os.utime(path, (mtime, mtime))


@pytest.fixture()
def cleanings(monkeypatch):
    """How often the supplier table is cleaned: slices of it, each once."""
    real, seen = C.clean_supplier, []
    monkeypatch.setattr(C, "clean_supplier", lambda df: (seen.append(1), real(df))[1])
    return seen


@pytest.fixture()
def refs(spark):
    wh = spark.createDataFrame([("P1", 100, 20), ("P2", 10, 20)], schemas.WAREHOUSE)
    sup = spark.createDataFrame([(f"PO{i}", "P1", "S1", "2024-01-01", "2024-01-05") for i in range(3)], schemas.SUPPLIER)
    return wh, sup


def alerts_of(spark, out):
    return sorted((r.batch_id, r.po_id) for r in S.result_table(spark, out, ALERTS).collect())


def test_runs_that_share_a_cache_clean_and_store_the_supplier_table_once(spark, tmp_dir, refs, cleanings):
    feed, out, ckpt = (os.path.join(tmp_dir, x) for x in ("feed", "out", "ckpt"))
    wh, sup = refs
    load = (lambda: wh), (lambda: sup)
    with P.references() as shared:
        for b in range(2):
            write(feed, f"{b}.json", [sale(f"t{b}", b)], 1_600_000_000 + b)
            P.run_stream(spark, feed, out, ckpt, *load, refs=shared)
        P.BatchLoader(out, *load, run=run_of(spark, out), refs=shared)(pos(spark, [sale("t1", 1)]), 1)  # replayed
    assert len(cleanings) == P.SLICES and len(glob.glob(f"{out}/{ALERTS}/load_id=*")) == 1
    assert alerts_of(spark, out) == [(b, f"PO{i}") for b in range(2) for i in range(3)]


def run_of(spark, out):
    return P.load_log(spark, out).first().run


def test_an_edit_between_runs_is_seen(spark, tmp_dir, refs):
    feed, out, ckpt, po = (os.path.join(tmp_dir, x) for x in ("feed", "out", "ckpt", "po"))
    wh, sup = refs
    sup.write.parquet(po)
    read = lambda: spark.read.schema(sup.schema).parquet(po)
    with P.references() as shared:
        for b in range(2):
            write(feed, f"{b}.json", [sale(f"t{b}", b)], 1_600_000_000 + b)
            P.run_stream(spark, feed, out, ckpt, lambda: wh, read, refs=shared)
            sup.where("po_id = 'PO0'").write.mode("overwrite").parquet(po)
    assert alerts_of(spark, out) == [(0, "PO0"), (0, "PO1"), (0, "PO2"), (1, "PO0")]


def test_ledger_calls_share_references(spark, tmp_dir, refs, cleanings):
    feed, out = os.path.join(tmp_dir, "feed"), os.path.join(tmp_dir, "out")
    with P.references() as shared:
        for b in range(2):
            write(feed, f"{b}.json", [sale(f"t{b}", b), sale(f"t{b}", b)], 1_600_000_000 + b)
            P.load_new_files(spark, feed, out, *refs, refs=shared)
        assert P.load_new_files(spark, feed, out, *refs, refs=shared) is None
    assert len(cleanings) == P.SLICES and len(glob.glob(f"{out}/{ALERTS}/load_id=*")) == 1
    assert alerts_of(spark, out) == [(b, f"PO{i}") for b in range(2) for i in range(3)]
    assert S.result_table(spark, out, "sales_aggregation").agg(F.sum("txn_count")).first()[0] == 2


def test_stored_rows_are_not_read_again(spark, tmp_dir):
    """A load whose shared rows lie in an earlier folder takes their number from the log."""
    bad = F.raise_error(F.lit("read again")).cast("int")
    alerts = spark.range(5).select(F.concat(F.lit("PO"), "id").alias("po_id"), F.lit("P1").alias("product_id"),
                                   F.lit("S1").alias("supplier_id"), F.lit(None).cast("date").alias("expected_delivery_date"),
                                   F.lit(None).cast("date").alias("actual_delivery_date"), F.lit(3).alias("delay_days"))
    listed = lambda df, *ids: df.withColumn("batch_ids", F.array(*[F.lit(i) for i in ids]))
    first = K.load_results({ALERTS: lambda: listed(alerts, 1, 2)}, tmp_dir)
    folder = first["tables"][ALERTS]["folder"]
    again = alerts.withColumn("delay_days", F.when(F.col("po_id") != "PO0", bad).otherwise(3))
    second = K.load_results({ALERTS: lambda: listed(again, 3, 4, 5)}, tmp_dir, stored={ALERTS: folder})["tables"][ALERTS]
    assert (second["folder"], second["rows"], second["batches"]) == (folder, 15, [3, 4, 5])
    assert S.result_table(spark, tmp_dir, ALERTS).count() == 25


def test_parts_of_a_feed_are_made_from_one_copy(spark, tmp_dir, monkeypatch):
    rows = pos(spark, [sale(f"t{i}", None if i < 5 else i % 8) for i in range(200)])
    made, real = [], staging.Spool.__call__
    monkeypatch.setattr(staging.Spool, "__call__", lambda self, df: (made.append(df.count()), real(self, df))[1])
    low = F.coalesce(F.col("batch_id") < 4, F.lit(True))
    feed = os.path.join(tmp_dir, "feed")
    parts = staging.stage_in_parts(spark, rows, [low, ~low], feed, 4)
    assert made == [200] and not os.path.exists(feed)
    files = [staging.hand_over(spark, p, feed) for p in parts]
    read = lambda f: spark.read.schema(schemas.POS_BATCHED).json(f)
    for got, want in ((read(files[0]), rows.where(low)), (read(files[1]), rows.where(~low)), (read(feed), rows)):
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    times = [max(os.path.getmtime(f.removeprefix("file:")) for f in fs) for fs in files]
    assert times[0] < min(os.path.getmtime(f.removeprefix("file:")) for f in files[1])


def test_a_large_feed_has_more_files(spark, tmp_dir):
    rows = pos(spark, [sale(f"t{i}", i % 40) for i in range(400)])
    count = lambda n, **kw: len(staging.stage_pos_feed(spark, rows, os.path.join(tmp_dir, n), 4, **kw))
    assert count("few") == 4 and count("same", rows_a_file=1000) == 4 and count("many", rows_a_file=20) > 12


def test_ids_seen_are_kept_on_disk(spark, tmp_dir):
    feed = os.path.join(tmp_dir, "feed")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    for n in range(2):
        write(feed, f"{n}.json", [sale("a", n), sale("b", n), sale(f"c{n}", n), sale(None, n)], 1_600_000_000 + n)
    for name, run in (("all", lambda *a: P.dedup_stream(*a)), ("within", lambda s, f, o, c: P.dedup_stream_within(s, f, o, c))):
        out, ckpt = os.path.join(tmp_dir, name), os.path.join(tmp_dir, f"ckpt-{name}")
        run(spark, feed, out, ckpt)
        kept = spark.read.parquet(out if name == "all" else f"{out}/kept")
        assert sorted(r.txn_id or "-" for r in kept.collect()) == ["-", "a", "b", "c0", "c1"]
        assert glob.glob(f"{ckpt}/state/**/*.sst", recursive=True) and not glob.glob(f"{ckpt}/state/**/*.delta", recursive=True)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_late_ids_slice_by_slice(spark):
    rows = pos(spark, [sale(None if i % 9 == 0 else f"t{i % 300}", i % 7, f"P{i % 5}") for i in range(900)]
               + [sale("hot", 1, f"P{i}") for i in range(400)])
    kept = rows.where("txn_id in ('t1', 't2', 't5')")
    key = lambda df: sorted(map(str, df.collect()))
    for known in ([], [kept], [kept, rows.where("txn_id is null")], [rows.limit(0), kept.unionByName(kept)]):
        gone = [r.txn_id for k in known for r in k.select("txn_id").distinct().collect()]
        want = keep_first(rows, ["txn_id"], ["batch_id", *C.POS_ORDER])
        want = [r for r in want.collect() if r.txn_id not in gone]
        with spooling() as spool:
            sizes = []
            got = P._late_ids(rows, known, lambda df: (sizes.append(df.count()), spool(df))[1])
            assert key(got) == sorted(map(str, want)) and len(sizes) == 1 + P.SLICES
            assert max(sizes[1:]) < 0.6 * len(want)


def test_padded_ids_are_those_of_the_formatter(spark):
    ids = spark.createDataFrame([(n,) for n in (0, 7, 999, 1000, 9999, 10000, 123456789012, -5, -12345, None)], "n bigint")
    got = ids.select(padded_id("P", "n").alias("a"), F.format_string("P%04d", "n").alias("b")).collect()
    assert all(r.a == r.b for r in got) and {"P0007", "P1000", "P123456789012"} <= {r.a for r in got}


def test_cumulative_stock_moves_no_repeated_row(spark, refs):
    """After stock was written and read back, its window per product needs no shuffle of the rows of every batch."""
    rows = pos(spark, [sale(f"t{i}", i % 8, f"P{i % 3}") for i in range(90)])
    with spooling() as spool:
        build = lambda **kw: P.batch_results(rows, C.clean_warehouse(refs[0]), refs[1], spool, **kw)["inventory_status"]()
        plain, dealt = T.inventory_cumulative(build()), T.inventory_cumulative(build(by_product=True))
        assert plain.exceptAll(dealt).isEmpty() and dealt.exceptAll(plain).isEmpty() and dealt.count() == 16

        def above_window(df):
            plan = df._jdf.queryExecution().executedPlan().toString()
            below = plan[plan.index("Window"):]
            return below[:below.index("Generate")]

        assert "Exchange" in above_window(plain) and "Exchange" not in above_window(dealt)
