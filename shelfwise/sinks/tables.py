"""Result-table and JDBC writers (K1-K4, H1).

A result base holds a folder per table and the load log (:mod:`.log`). A table's
folder holds one folder per attempt of a load, ``load_id=<load>.<attempt>``, with
the load's batches as partitions below it. Rows that are the same for every batch of
a load are written once, without partitions, and the log holds their batches
(``shared``): readers see each row once a batch. A later load with the same such rows
names the folder that holds them, beside its own id and time.

- A load without a name gets one of its own: it only adds rows (K1).
- A load with a name, as a stream's (run, epoch), replaces what the same load
  wrote before, also when a result is empty now, and nothing else (H1).
- All tables of a load become visible with one commit file (K4): a load that
  stops between two writes leaves every reader with the state before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..session import shuffles_cleaned
from .log import LOG, commit, committed, folders, hadoop_path, load_log

BATCH = "batch_id"
LOAD = "load_id"
BATCHES = "batch_ids"
PRODUCT = "product_id"


def stamp(df: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Add ``batch_id`` (when given) and ``loaded_at`` = load time."""
    if batch_id is not None:
        df = df.withColumn(BATCH, F.lit(batch_id).cast("int"))
    return df.withColumn("loaded_at", F.current_timestamp())


def stream_load(run: str, epoch: int) -> str:
    """The name of the load of one epoch of one stream (its checkpoint's id)."""
    return f"{run}-{epoch:09d}"


def _write(df: DataFrame, base: str, name: str, folder: str, stored: tuple[str, int] | None = None) -> dict:
    """Write one table of a load; its entry of the commit record.

    A frame with the column ``batch_ids``, the same list on every row, stands for
    its rows once a batch of that list: they are written once, as they are dealt,
    or not at all where a folder has them: ``stored`` is its name and its rows.
    """
    spark, counted = df.sparkSession, Observation()
    if BATCHES in df.columns:
        if stored is None:
            counts = [F.count(F.lit(1)).alias("rows"), F.min(BATCHES).alias("least"), F.max(BATCHES).alias("most")]
            stamp(df).observe(counted, *counts).drop(BATCHES).write.parquet(f"{base}/{name}/{folder}", compression="zstd")
            rows, least, most = (counted.get[c] for c in ("rows", "least", "most"))
            if least != most:
                raise ValueError(f"{name}: rows of one load that differ in {BATCHES}")
            own = {}
        else:  # the rows lie there and were counted then; one row tells the batches
            one = stamp(df).select(BATCHES, F.unix_micros("loaded_at").alias("at")).first()
            rows, most, own = stored[1], one[BATCHES], {"load_id": folder.split("=", 1)[1], "loaded_at": one["at"]}
            folder = stored[0]
        batches = list(most or [])
        return {"folder": folder, "rows": rows * len(batches), "batches": batches, "shared": True, **own}
    by = [BATCH] if BATCH in df.columns else []
    # rows of a batch go to few files, and a batch that holds most rows is split, by size after the shuffle
    out = stamp(df).hint("rebalance", *[F.col(c) for c in by]).observe(counted, F.count(F.lit(1)).alias("rows"))
    # the writer sorts by batch anyway; by product below it, like values lie together and compress
    sort = [c for c in (*by, PRODUCT) if c in df.columns]
    out = out.sortWithinPartitions(*sort) if sort else out
    out.write.partitionBy(*by).parquet(f"{base}/{name}/{folder}", compression="zstd")
    parts = [f.split("=", 1)[1] for f in folders(spark, f"{base}/{name}/{folder}") if f.startswith(f"{BATCH}=")]
    return {"folder": folder, "rows": counted.get["rows"], "batches": [int(p) for p in parts if p.lstrip("-").isdigit()]}


def _stored(spark: SparkSession, base: str, name: str, folder: str | None) -> tuple[str, int] | None:
    """The folder and its rows, by the log, where it is there and some load is committed with it."""
    if folder is None:
        return None
    p, fs = hadoop_path(spark, f"{base}/{name}/{folder}")
    rows = [r.rows // len(r.batches) for r in committed(spark, base, name) if r.folder == folder and r.shared]
    return (folder, rows[0]) if rows and fs.exists(p) else None


def load_results(results: Mapping[str, Callable[[], DataFrame]], base: str, load: str | None = None,
                 run: str | None = None, epoch: int | None = None, first: tuple[str, ...] = (),
                 metrics: Callable[[], dict[str, int]] = dict, catalog: str | None = None,
                 stored: Mapping[str, str] | None = None) -> dict:
    """K1 + K4 + H1: write the results of one load and commit them together; returns the commit record.

    ``results`` maps table names to builders. Those named in ``first`` are written before the rest. One result is
    written at a time, so the shuffle files of one are gone before the next. ``metrics`` is called after the writes.
    ``catalog`` (a database) registers the load's partitions there as well. ``stored`` names, by table, the folder of an
    earlier load that holds the same shared rows; where it still exists they aren't written again.
    """
    base, load = base.rstrip("/"), load or f"load-{uuid.uuid4().hex}"
    folder = f"{LOAD}={load}.{uuid.uuid4().hex[:12]}"
    tables = {}
    for n in (*first, *[n for n in results if n not in first]):
        df = results[n]()
        spark = df.sparkSession
        held = _stored(spark, base, n, (stored or {}).get(n))
        with shuffles_cleaned(spark):
            tables[n] = _write(df, base, n, folder, held)
    record = {"load": load, "run": run, "epoch": epoch, "tables": tables, "metrics": metrics()}
    commit(spark, base, record)
    if catalog:
        register_load(spark, base, record, catalog)
    return record


def load_result(df: DataFrame, base: str, name: str, batch_id: int | None = None, load: str | None = None) -> str:
    """K1 + H1: one result of one or more batches as a load of its own; returns the table path.

    An empty frame leaves no partition (X8), so "latest batch" of the table keeps meaning "latest batch with rows".
    """
    if batch_id is not None:
        df = df.withColumn(BATCH, F.lit(batch_id).cast("int"))
    load_results({name: lambda: df}, base, load)
    return f"{base.rstrip('/')}/{name}"


def vacuum(spark: SparkSession, base: str) -> list[str]:
    """Remove the folders of attempts that no commit names. Not while a load or a reader is at work."""
    base = base.rstrip("/")
    live = {f"{n}/{t.folder}" for r in load_log(spark, base).select("tables").collect() for n, t in r.tables.items()}
    gone = []
    for table in folders(spark, base):
        for folder in folders(spark, f"{base}/{table}") if table != LOG else ():
            if folder.startswith(f"{LOAD}=") and f"{table}/{folder}" not in live:
                p, fs = hadoop_path(spark, f"{base}/{table}/{folder}")
                fs.delete(p, True)
                gone.append(f"{table}/{folder}")
    return gone


def create_result_tables(spark: SparkSession, base: str, database: str = "default") -> list[str]:
    """K2: the five result tables in the catalog (parquet, partitioned by load_id, batch_id), with all committed loads."""
    created = []
    for name, schema in schemas.RESULT_TABLES.items():
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.stored(schema).fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({cols}) USING parquet "
                  f"PARTITIONED BY ({LOAD}, {BATCH}) LOCATION '{base.rstrip('/')}/{name}'")
        created.append(f"{database}.{name}")
    for record in load_log(spark, base).collect():
        tables = {n: t.asDict() for n, t in record.tables.items()}
        register_load(spark, base, {"load": record.load, "tables": tables}, database)
    return created


def register_load(spark: SparkSession, base: str, record: dict, database: str = "default") -> None:
    """K2: a committed load's partitions in the catalog, in place of those of its earlier attempts."""
    for name, table in record["tables"].items():
        qualified = f"`{database}`.`{name}`"
        if not spark.catalog.tableExists(f"{database}.{name}"):
            continue
        mine = table.get("load_id") or table["folder"].split("=", 1)[1]
        held = spark.sql(f"SHOW PARTITIONS {qualified}").where(F.startswith("partition", F.lit(f"{LOAD}={record['load']}.")))
        for old in [r.partition for r in held.collect() if not r.partition.startswith(f"{LOAD}={mine}/")]:
            load, batch = (part.split("=", 1)[1] for part in old.split("/"))
            batch = batch if batch.lstrip("-").isdigit() else "null"
            spark.sql(f"ALTER TABLE {qualified} DROP IF EXISTS PARTITION ({LOAD}='{load}', {BATCH}={batch})")
        at = f"{base.rstrip('/')}/{name}/{table['folder']}"
        parts = " ".join(f"PARTITION ({LOAD}='{mine}', {BATCH}={b}) LOCATION "
                         f"'{at if table.get('shared') else f'{at}/{BATCH}={b}'}'" for b in table["batches"])
        if parts:
            spark.sql(f"ALTER TABLE {qualified} ADD IF NOT EXISTS {parts}")


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict[str, str] | None = None, num_partitions: int | None = None,
               batch_size: int = 10000) -> None:
    """K3: write straight from the executors over JDBC (no driver-side copy).

    ``num_partitions`` caps concurrent connections; ``batch_size`` sets rows per
    insert batch. Credentials and driver class come in ``properties``.
    """
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    if num_partitions:
        props.setdefault("numPartitions", str(num_partitions))
    df.write.jdbc(url=url, table=table, mode=mode, properties=props)


__all__ = ["stamp", "stream_load", "load_results", "load_result", "vacuum", "create_result_tables", "register_load",
           "write_jdbc", "committed"]
