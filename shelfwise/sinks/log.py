"""The load log: which folders of a result base are committed.

A load writes each of its tables to a folder of its own and then puts one small
JSON file into ``<base>/load_log``, under the load's name, by an atomic rename. The file
names the folders of all its tables, so a reader that goes by the log sees all
results of a load or none. A load that runs again under the same name replaces its
file, and with it all its results at once; the folders of the earlier attempt are
no longer read and :func:`~shelfwise.sinks.tables.vacuum` removes them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

LOG = "load_log"
SCHEMA = ("load string, run string, epoch bigint,"
          " tables map<string, struct<folder: string, batches: array<int>, rows: bigint, shared: boolean,"
          " load_id: string, loaded_at: bigint>>,"
          " metrics map<string, bigint>")


def hadoop_path(spark: SparkSession, path: str):
    """(path, its file system) as Hadoop objects."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path``; none where it doesn't exist."""
    p, fs = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def commit(spark: SparkSession, base: str, record: dict) -> None:
    """Make a load visible: one file, renamed into place over the load's earlier one."""
    target, fs = hadoop_path(spark, f"{base.rstrip('/')}/{LOG}/{record['load']}.json")
    draft, _ = hadoop_path(spark, f"{base.rstrip('/')}/{LOG}/.{record['load']}.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray((json.dumps(record) + "\n").encode()))
    finally:
        out.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, how)


def load_log(spark: SparkSession, base: str) -> DataFrame:
    """One row per committed load: name, run, epoch, folders, batches and rows of its tables, metrics."""
    path = f"{base.rstrip('/')}/{LOG}"
    p, fs = hadoop_path(spark, path)
    if not fs.exists(p):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).json(path)


def committed(spark: SparkSession, base: str, name: str) -> list:
    """Rows (load, run, epoch, folder, batches, rows, shared, load_id, loaded_at) of the loads that hold rows of one table.

    The last two, where not null, are the load's own id and time (microseconds): its rows lie in another load's folder.
    One row per load, as many as a file-sink log keeps; no table data.
    """
    t = f"tables['{name}']"
    return (load_log(spark, base).where(f"{t}.rows > 0")
            .selectExpr("load", "run", "epoch", f"{t}.folder as folder", f"{t}.batches as batches", f"{t}.rows as rows",
                        f"coalesce({t}.shared, false) as shared", f"{t}.load_id as load_id", f"{t}.loaded_at as loaded_at")
            .collect())
