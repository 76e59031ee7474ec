"""Micro-batch ETL on Structured Streaming (M1-M4, K4, H1, H3).

POS files stream in; for each micro-batch ``foreachBatch`` cleans the rows
once (persisted), re-reads the warehouse and supplier tables so edits show up
(M4), computes the five results and commits them together as one load (K4, H1),
named by the stream's id and the epoch. The stream checkpoint records which
files were consumed (M2), so a rerun handles only new files, and a replay of an
unfinished batch replaces that load instead of adding rows. A new checkpoint has
a new id: its loads are added beside earlier ones, as a plain append would.

Batch identity: when the records carry ``batch_id`` that value is used, so
results can be matched to the feed whatever order files arrive in (X9); else the
number in the file's name, where a pattern is given; otherwise the micro-batch
(epoch) id is, as in a plain file feed. A batch may come in several files: each
micro-batch adds its own results for it, as the plain appending loader does.

Counts (C9, G13) are observed where the rows pass anyway and are kept in the load
log: raw, null, invalid, duplicate and clean rows, and the rows of each result.
Rows that tasks read again after an executor is lost may count twice there;
``clean.clean_report`` counts exactly.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import parse_timestamp
from ..operators import clean as C
from ..operators import transforms as T
from ..plans.dedup import keep_first
from ..plans.materialise import Spool, spooling
from ..session import shuffles_cleaned, state_on_disk
from ..sinks.log import committed, load_log
from ..sinks.tables import load_results, stream_load
from ..sources.files import file_listing, pos_batch, pos_stream, result_table

BATCH = "batch_id"
ALERTS = "supplier_delay_alerts"
RESULT_NAMES = ("sales_aggregation", "inventory_status", "product_ranking",
                "low_stock_alerts", ALERTS)

#: Slices of keys in which a large reference table is cleaned, and of batches in which a load's rows are:
#: the disk holds the shuffle files of one slice at a time.
SLICES = 4

Loader = Callable[[], DataFrame]


def _slice(key: str, slices: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slices))


def batch_slices(pos_batch: DataFrame, slices: int) -> list[DataFrame]:
    """The rows in at most ``slices`` parts of whole batches; parts without a row that cleaning keeps are left out.

    Nothing would come of those, and Spark observes no counts in a plan that turns out empty.
    """
    if slices == 1:
        return [pos_batch]
    part = _slice(BATCH, slices)
    some = C.pos_valid(C.pos_drop_nulls(pos_batch)).select(part.alias("n")).distinct().collect()
    return [pos_batch.where(part == n) for n in sorted(r.n for r in some)] or [pos_batch]


def batch_results(pos_batch: DataFrame, warehouse_clean: DataFrame, delay_alerts: DataFrame,
                  keep: Callable[[DataFrame], DataFrame] = lambda df: df,
                  cleaned: Callable[[DataFrame], DataFrame] = lambda df: df,
                  slices: int = 1, by_product: bool = False) -> dict[str, Callable[[], DataFrame]]:
    """Builders of the five results of one (or several) batches (K4 body).

    Takes the cleaned warehouse and the supplier delay alerts (see
    :class:`ReferenceCache`); ``keep`` is applied to frames that are read more than
    once (sales, batch ids, stock with its units a product, ranked totals); loads
    pass ``spooling``; ``cleaned`` to the clean rows. Rows are cleaned and summed in ``slices``
    of whole batches, by hash, one after the other where ``keep`` writes; ``by_product``: see
    :func:`~shelfwise.operators.transforms.inventory_calculation`. The alerts come once, with the
    list of their batches. Builders are returned so that each result can be produced
    when it is written; what several need is computed when the first is built.
    """
    @functools.cache
    def sales() -> DataFrame:
        return functools.reduce(DataFrame.unionByName, [keep(T.sales_aggregation(cleaned(C.clean_pos(part))))
                                                        for part in batch_slices(pos_batch, slices)])

    @functools.cache
    def batches() -> DataFrame:
        sales()  # first: it reads every row, each counted once
        return keep(T.batch_ids(pos_batch))

    @functools.cache
    def inventory() -> DataFrame:
        return T.inventory_calculation(sales(), warehouse_clean, batches(), keep, by_product)

    return {
        "sales_aggregation": sales,
        "inventory_status": inventory,
        "product_ranking": lambda: T.product_ranking(sales(), keep),
        "low_stock_alerts": lambda: T.low_stock_detection(inventory()),
        ALERTS: lambda: T.supplier_alerts_per_batch(delay_alerts, batches(), listed=True),
    }


@contextmanager
def keeping() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that persists frames until the end of the block."""
    held: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        held.append(df.persist())
        return df

    try:
        yield keep
    finally:
        for df in held:
            df.unpersist()


def input_fingerprint(df: DataFrame) -> tuple:
    """(path, size, modification time) of every file a frame reads.

    One listing per folder, not one status call per file, so a reference
    table of many files costs a few listings per micro-batch.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    by_dir: dict[str, set[str]] = {}
    for f in df.inputFiles():
        folder, name = f.rsplit("/", 1)
        by_dir.setdefault(folder, set()).add(name)
    out = []
    for folder, wanted in sorted(by_dir.items()):
        p = jvm.org.apache.hadoop.fs.Path(folder)
        for st in p.getFileSystem(conf).listStatus(p):
            name = st.getPath().getName()
            if name in wanted:
                out.append((folder, name, st.getLen(), st.getModificationTime()))
    missing = sum(len(w) for w in by_dir.values()) - len(out)
    return tuple(sorted(out)) + (("unlisted", missing),)


class ReferenceCache:
    """Cleaned reference tables, re-derived only when their input files change.

    M4 re-reads warehouse and supplier every micro-batch so edits are seen. A
    changed, added or removed file changes the fingerprint and the table is
    cleaned again; otherwise the written result of the last clean is reused,
    instead of re-shuffling a large reference table for every micro-batch. Runs
    that follow one another may share a cache (:func:`references`).
    """

    def __init__(self):
        self._held: dict[str, tuple[tuple, DataFrame, Spool]] = {}
        #: By result base: the alerts that were stored there last, and their folder.
        self.stored: dict[str, tuple[DataFrame, str]] = {}

    def get(self, name: str, raw: DataFrame, derive: Callable[[DataFrame], DataFrame], key: str | None = None) -> DataFrame:
        """``derive(raw)``, written. With ``key``, whose values ``derive`` treats each by itself, it is derived in slices
        of keys, one after the other: the disk holds the shuffle files of a slice, and the files are read once a slice."""
        fp = input_fingerprint(raw)
        hit = self._held.get(name)
        if hit is not None and hit[0] == fp:
            return hit[1]
        if hit is not None:
            hit[2].drop()
        spool = Spool()
        parts = [raw] if key is None else [raw.where(_slice(key, SLICES) == n) for n in range(SLICES)]
        df = functools.reduce(DataFrame.unionByName, [spool(derive(part)) for part in parts])
        self._held[name] = (fp, df, spool)
        return df

    def cleaned(self, warehouse: DataFrame, supplier: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The cleaned warehouse and the delay alerts of the cleaned supplier table."""
        return (self.get("warehouse", warehouse, C.clean_warehouse),
                self.get("supplier", supplier, lambda df: T.supplier_delay_detection(C.clean_supplier(df)), key="po_id"))

    def stored_alerts(self, base: str, alerts: DataFrame) -> dict[str, str] | None:
        """The folder of ``base`` that holds these very alerts, for ``load_results``."""
        held = self.stored.get(base)
        return {ALERTS: held[1]} if held is not None and held[0] is alerts else None

    def clear(self) -> None:
        for _, _, spool in self._held.values():
            spool.drop()
        self._held.clear()
        self.stored.clear()


@contextmanager
def references() -> Iterator[ReferenceCache]:
    """A :class:`ReferenceCache` for several runs over the same reference tables, until the end of the block."""
    refs = ReferenceCache()
    try:
        yield refs
    finally:
        refs.clear()


def carry_over(inventory: DataFrame, before: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    """H4 kept incrementally: stock carried from ``before`` (product, units_sold_to_date) through this load's batches.

    The load adds its own units to the totals, so each epoch reads one row per
    product and its own inventory, not the history. Products without stock rows
    in this load keep their totals.
    """
    earlier = before.select("product_id", F.col("units_sold_to_date").alias("_before"))
    known = F.coalesce("_before", F.lit(0).cast("bigint"))

    def cumulative() -> DataFrame:
        here = T.inventory_cumulative(inventory)
        joined = here.join(earlier, "product_id", "left")
        return joined.withColumn("units_sold_to_date", F.col("units_sold_to_date") + known) \
            .withColumn("cumulative_stock", F.col("cumulative_stock") - known).select(*here.columns)

    def totals() -> DataFrame:
        sold = inventory.groupBy("product_id").agg(F.sum("units_sold_batch").alias("_sold"))
        return sold.join(earlier, "product_id", "full").select(
            "product_id", (F.coalesce("_sold", F.lit(0).cast("bigint")) + known).alias("units_sold_to_date"))

    return {"inventory_cumulative": cumulative, "units_to_date": totals}


class BatchLoader:
    """The ``foreachBatch`` function: clean once, five results, one commit.

    ``run`` names the stream; by default its own id, which its checkpoint keeps.
    ``carry`` also keeps the cumulative inventory (H4). ``catalog`` is passed on to the load.
    ``refs`` is the cache of the reference tables, by default one of its own.
    """

    def __init__(self, out_dir: str, warehouse: Loader, supplier: Loader, run: str | None = None,
                 carry: bool = False, catalog: str | None = None, refs: ReferenceCache | None = None):
        self.out_dir = out_dir
        self.warehouse = warehouse
        self.supplier = supplier
        self.run = run
        self.carry = carry
        self.catalog = catalog
        self.refs = refs if refs is not None else ReferenceCache()

    def _totals_before(self, spark: SparkSession, run: str, epoch_id: int) -> DataFrame:
        """The totals after the newest earlier epoch of this stream: the same for every replay of this one."""
        earlier = [(r.epoch, r.load) for r in committed(spark, self.out_dir, "units_to_date")
                   if r.run == run and r.epoch < epoch_id]
        return result_table(spark, self.out_dir, "units_to_date", max(earlier)[1] if earlier else "")

    def __call__(self, batch_df: DataFrame, epoch_id: int) -> None:
        spark = batch_df.sparkSession
        if BATCH not in batch_df.columns:
            batch_df = batch_df.withColumn(BATCH, F.lit(epoch_id).cast("int"))
        # A trigger with no new rows (or a no-data batch) loads nothing.
        if batch_df.isEmpty():
            return
        run = self.run or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        seen, passed = Observation(), []

        def cleaned(df: DataFrame) -> DataFrame:
            passed.append(Observation())
            return df.observe(passed[-1], F.count(F.lit(1)).alias("clean_rows"))

        def counts() -> dict[str, int]:
            got = {**seen.get, "clean_rows": sum(o.get["clean_rows"] for o in passed)}
            return got | {"duplicate_rows": got["raw_rows"] - got["null_rows"] - got["invalid_rows"] - got["clean_rows"]}

        with keeping() as keep, spooling() as spool:
            raw = keep(batch_df.observe(
                seen, F.count(F.lit(1)).alias("raw_rows"),
                F.count_if(C.null_condition()).alias("null_rows"),
                F.count_if(~C.null_condition() & C.invalid_condition()).alias("invalid_rows")))
            wh, alerts = self.refs.cleaned(self.warehouse(), self.supplier())
            results = batch_results(raw, wh, alerts, spool, cleaned, SLICES, by_product=self.carry)
            if self.carry:
                results |= carry_over(results["inventory_status"](), self._totals_before(spark, run, epoch_id))
            # sales first: it fills what the others share, and each row is counted once
            # alerts that are those of the load before lie there already; a catalog's partitions have their own rows
            known = self.refs.stored_alerts(self.out_dir, alerts) if self.catalog is None else None
            record = load_results(results, self.out_dir, stream_load(run, epoch_id), run, epoch_id,
                                  first=("sales_aggregation",), metrics=counts, catalog=self.catalog, stored=known)
            self.refs.stored[self.out_dir] = alerts, record["tables"][ALERTS]["folder"]


def start_stream(spark: SparkSession, pos_dir: str, out_dir: str, checkpoint: str,
                 warehouse: Loader, supplier: Loader, *, with_batch_column: bool = True,
                 files_per_trigger: int | None = 1, processing_time: str | None = None,
                 batch_of_file: str | None = None, carry: bool = False, catalog: str | None = None, drop_read: bool = False,
                 refs: ReferenceCache | None = None):
    """M1 / M3: start the stream. ``processing_time`` (e.g. "10 seconds") runs it
    continuously; otherwise it drains what is there (availableNow) and stops. ``drop_read``: see ``pos_stream``;
    ``refs``: see :class:`BatchLoader`."""
    schema = schemas.POS_BATCHED if with_batch_column and batch_of_file is None else schemas.POS
    stream = pos_stream(spark, pos_dir, files_per_trigger, schema, batch_of_file, drop_read)
    loader = BatchLoader(out_dir, warehouse, supplier, carry=carry, catalog=catalog, refs=refs)
    writer = (stream.writeStream.foreachBatch(loader)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    q = writer.start()
    q._shelfwise_loader = loader
    return q


def run_stream(spark: SparkSession, pos_dir: str, out_dir: str, checkpoint: str,
               warehouse: Loader, supplier: Loader, *, refs: ReferenceCache | None = None, **kw) -> None:
    """Drain every POS file not yet recorded in ``checkpoint`` and stop (M1, M2). A cache that is handed in stays filled."""
    q = start_stream(spark, pos_dir, out_dir, checkpoint, warehouse, supplier, refs=refs, **kw)
    try:
        q.awaitTermination()
    finally:
        loader = getattr(q, "_shelfwise_loader", None)
        if loader is not None and refs is None:
            loader.refs.clear()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def dedup_stream(spark: SparkSession, pos_dir: str, out_dir: str, checkpoint: str,
                 files_per_trigger: int | None = 1) -> None:
    """H3: drop a transaction resent in a later file, across micro-batches.

    Null and invalid rows are removed first (as C1/C2 do), so a dirty copy can
    never shadow a good one. There is no watermark: every id seen stays in the
    state, so files may come in any order and no row is lost for being late.
    The state is kept on disk (RocksDB), unless the session names a state store.
    Kept rows go to a parquet file sink (exactly-once through its commit log).
    """
    stream = pos_stream(spark, pos_dir, files_per_trigger, schemas.POS_BATCHED)
    _drain(spark, C.pos_valid(C.pos_drop_nulls(stream)).dropDuplicates(["txn_id"]), out_dir, checkpoint, counted=False)


def _drain(spark: SparkSession, kept: DataFrame, out_dir: str, checkpoint: str, counted: bool = True):
    """Run a stream with state over what is there, into parquet files; the finished query. ``counted``: see
    :func:`~shelfwise.session.state_on_disk`."""
    with state_on_disk(spark, counted), shuffles_cleaned(spark):
        q = (kept.writeStream.format("parquet").option("path", out_dir).option("compression", "zstd")
             .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def _late_ids(valid: DataFrame, known: list[DataFrame], keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The first row of each transaction id (null is one) of ``valid`` that no frame of ``known`` has.

    Rows are reduced to one an id before they meet the known ids, so a frequent id moves one row a task, and the
    join needs no shuffle of its own for them. This goes in slices of ids, one after the other, where ``keep`` writes.
    """
    parts = []
    rows = keep(valid)
    for n in range(SLICES):
        part = keep_first(rows.where(_slice("txn_id", SLICES) == n), ["txn_id"], [BATCH, *C.POS_ORDER])
        for ids in known:
            held = ids.select(F.col("txn_id").alias("_known")).where(_slice("_known", SLICES) == n)
            no_id = held.where("_known is null").limit(1).agg(F.count(F.lit(1))).scalar()
            part = part.join(held, F.col("txn_id") == F.col("_known"), "left_anti") \
                .where(F.col("txn_id").isNotNull() | (no_id == 0))
        parts.append(keep(part))
    return functools.reduce(DataFrame.unionByName, parts)


def dedup_stream_within(spark: SparkSession, pos_dir: str, out_dir: str, checkpoint: str, delay: str = "31 days",
                        files_per_trigger: int | None = 1) -> list[dict]:
    """H3 with bounded state: as :func:`dedup_stream`, but ids older than the watermark leave the state.

    Rows come by their transaction time; ``delay`` is how far a row may lie behind
    the newest one seen. The stream keeps the first row of each id in
    ``<out_dir>/kept`` and drops rows that come later than that, or without a
    time. Those aren't lost: after the drain, the ids of the files it read that
    were never kept go to the table ``late_rows`` of ``out_dir``, one row an id,
    together with the names of the files, in one load. Kept and late ids together
    are all ids. Returns the state's figures of every trigger (rows held, rows dropped).
    """
    before = file_listing(spark, pos_dir).join(result_table(spark, out_dir, "loaded_files").select("path"), "path",
                                               "left_anti")
    before = before.persist()
    try:
        paths = [r.path for r in before.select("path").collect()]  # names, as a file source's own log holds
        valid = lambda df: C.pos_valid(C.pos_drop_nulls(df))
        timed = valid(pos_stream(spark, pos_dir, files_per_trigger, schemas.POS_BATCHED)) \
            .withColumn("_event_time", parse_timestamp("txn_timestamp").cast("timestamp"))
        kept = (timed.where("_event_time is not null").withWatermark("_event_time", delay)
                .dropDuplicatesWithinWatermark(["txn_id"]).drop("_event_time"))
        q = _drain(spark, kept, f"{out_dir.rstrip('/')}/kept", checkpoint)
        if paths:
            with spooling() as spool:
                known = [spark.read.parquet(f"{out_dir.rstrip('/')}/kept"), result_table(spark, out_dir, "late_rows")]
                late = _late_ids(valid(pos_batch(spark, paths, schemas.POS_BATCHED)), known, spool)
                load_results({"late_rows": lambda: late, "loaded_files": lambda: before}, out_dir)
    finally:
        before.unpersist()
    return [{"rows": s["numRowsTotal"], "dropped": s["numRowsDroppedByWatermark"]}
            for p in q.recentProgress for s in p["stateOperators"]]


def load_new_files(spark: SparkSession, pos_dir: str, out_dir: str, warehouse: DataFrame, supplier: DataFrame,
                   schema=schemas.POS_BATCHED, refs: ReferenceCache | None = None) -> dict | None:
    """N3 without a stream: load the feed files that no load has finished; the commit record, or None if there are none.

    The ledger is the table ``loaded_files``, committed together with the results:
    a load that stops half-way leaves its files unfinished, and the next call
    takes them again. A file is known by its path; size and time are kept for
    :func:`changed_files`. ``refs``: see :class:`BatchLoader`.
    """
    if refs is None:
        with references() as refs:
            return load_new_files(spark, pos_dir, out_dir, warehouse, supplier, schema, refs)
    done = result_table(spark, out_dir, "loaded_files")
    with keeping() as keep, spooling() as spool:
        new = keep(file_listing(spark, pos_dir).join(done.select("path"), "path", "left_anti"))
        paths = [r.path for r in new.select("path").collect()]
        if not paths:
            return None
        wh, alerts = refs.cleaned(warehouse, supplier)
        results = batch_results(keep(pos_batch(spark, paths, schema)), wh, alerts, spool, slices=SLICES)
        record = load_results(results | {"loaded_files": lambda: new}, out_dir, first=("sales_aggregation",),
                              stored=refs.stored_alerts(out_dir, alerts))
        refs.stored[out_dir] = alerts, record["tables"][ALERTS]["folder"]
        return record


def changed_files(spark: SparkSession, pos_dir: str, out_dir: str) -> DataFrame:
    """Feed files that differ in size or time from what was loaded under their path."""
    done = result_table(spark, out_dir, "loaded_files").select("path", "length", "modificationTime")
    new = file_listing(spark, pos_dir)
    return new.join(done.select("path"), "path", "left_semi").join(done, new.columns, "left_anti")


def load_metrics(spark: SparkSession, out_dir: str) -> DataFrame:
    """C9 + G13: one row per committed load: its counts of cleaning, and the rows of the five results."""
    counts = [F.col("metrics")[c].alias(c) for c in ("raw_rows", "null_rows", "invalid_rows", "duplicate_rows", "clean_rows")]
    rows = [F.col("tables")[n]["rows"].alias(f"{n}_rows") for n in RESULT_NAMES]
    return load_log(spark, out_dir).select("load", "run", "epoch", *counts, *rows)
