"""Readers of the feeds and of the result tables.

Every reader takes an explicit schema: no inference job per micro-batch, and
a malformed record becomes an all-null row (PERMISSIVE) that cleaning drops.
"""

from __future__ import annotations

import functools
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..sinks.log import committed

RAW_RENAMES = {
    "Row ID": "row_id",
    "Product Name": "product_name",
    "Region": "region",
    "Order Quantity": "order_quantity",
    "Unit Price": "unit_price",
    "Order Date": "order_date",
}


def pos_stream(spark: SparkSession, path: str, files_per_trigger: int | None = 1,
               schema=schemas.POS, batch_of_file: str | None = None, drop_read: bool = False) -> DataFrame:
    """The POS folder as a stream of JSON-lines files.

    ``batch_of_file`` (a regex with one group of digits) takes the batch id from
    each file's name (X9), so it doesn't depend on when a file came or on which
    files share a micro-batch; a name that doesn't match gives a null id. ``drop_read``
    deletes a micro-batch's files when the next one begins, for a feed that nothing else reads.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if drop_read:
        reader = reader.option("cleanSource", "delete")
    feed = reader.json(path)
    return feed if batch_of_file is None else feed.withColumn("batch_id", file_batch(batch_of_file))


def file_batch(pattern: str) -> F.Column:
    """The batch id in the name of the file a row comes from."""
    return F.regexp_extract(F.col("_metadata.file_name"), pattern, 1).try_cast("int")


def pos_batch(spark: SparkSession, paths: str | list[str], schema=schemas.POS) -> DataFrame:
    """POS JSON-lines files as one batch (blank lines are skipped by the reader)."""
    return spark.read.schema(schema).json(paths)


def _csv_by_name(spark: SparkSession, path: str, schema, encoding: str = "UTF-8") -> DataFrame:
    """The columns of ``schema`` from CSV files, found by header name; others are ignored.

    Only the header is read up front. A cell that isn't of the wanted type
    becomes null. A missing column is an error, and so is a file whose header
    differs from the first one's.
    """
    options = {"header": True, "encoding": encoding, "enforceSchema": False}
    header = spark.read.options(**options).csv(path).schema
    missing = [f.name for f in schema if f.name not in header.fieldNames()]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header {header.fieldNames()}")
    df = spark.read.options(**options).schema(header).csv(path)
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])


def warehouse_csv(spark: SparkSession, path: str) -> DataFrame:
    """Warehouse snapshot CSV with header; empty cells read as null."""
    return _csv_by_name(spark, path, schemas.WAREHOUSE)


def supplier_json(spark: SparkSession, path: str) -> DataFrame:
    """S3: supplier updates, one JSON array spread over many lines."""
    return spark.read.option("multiLine", True).schema(schemas.SUPPLIER).json(path)


def raw_sales_csv(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """Raw sales export (latin-1, header names with spaces) with snake-case names."""
    df = _csv_by_name(spark, path, schemas.RAW_SALES_CSV, encoding)
    return df.select(*[F.col(f"`{k}`").alias(v) for k, v in RAW_RENAMES.items()])


def result_table(spark: SparkSession, base: str, name: str, load: str | None = None,
                 batch: int | None = None) -> DataFrame:
    """The committed rows of a stored table; a table never written is an empty frame.

    Same columns either way: the table's own, ``batch_id`` (tables kept by batch), ``loaded_at``, ``load_id``.
    Only the folders that the load log names are read. ``load`` picks one load by name, ``batch`` one batch.
    Rows stored once for several batches come once a batch.
    """
    schema = schemas.stored({**schemas.RESULT_TABLES, **schemas.KEPT_TABLES}[name], name not in schemas.BY_LOAD)
    full = f"{base.rstrip('/')}/{name}"
    found = [r for r in committed(spark, base, name) if load in (None, r.load) and (batch is None or batch in r.batches)]
    read = lambda rows, s: spark.read.schema(s).option("basePath", full).parquet(*[f"{full}/{r.folder}" for r in rows])
    parts = []
    if own := [r for r in found if not r.shared]:
        parts.append(read(own, schema).select(*schema.names))
    if shared := [r for r in found if r.shared]:
        # the loads' lists as one small relation: its size is known, so the planner need not shuffle the rows
        folder = lambda r: r.folder.split("=", 1)[1]
        lists = [{"_folder": folder(r), "_load": r.load_id or folder(r), "_at": r.loaded_at,
                  "_batches": r.batches if batch is None else [batch]} for r in shared]
        lists = spark.range(1).select(F.inline(F.from_json(
            F.lit(json.dumps(lists)), "array<struct<_folder: string, _load: string, _at: bigint, _batches: array<int>>>")))
        once = StructType([f for f in schema if f.name != "batch_id"])
        rows = read({r.folder: r for r in shared}.values(), once).join(lists, F.col("load_id") == F.col("_folder"))
        parts.append(rows.withColumns({"load_id": F.col("_load"), "loaded_at": F.coalesce(F.timestamp_micros("_at"), "loaded_at")})
                     .withColumn("batch_id", F.explode("_batches")).select(*schema.names))
    if not parts:
        return spark.createDataFrame([], schema)
    rows = functools.reduce(DataFrame.unionByName, parts)
    return rows if batch is None else rows.where(F.col("batch_id") == batch)


def newest_stored_batch(spark: SparkSession, base: str, name: str) -> int | None:
    """The newest batch of a stored table, from the load log alone."""
    return max((b for r in committed(spark, base, name) for b in r.batches), default=None)


def latest_result(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The newest batch's rows of a stored table; its partitions are the only ones read."""
    newest = newest_stored_batch(spark, base, name)
    # no batch: only rows without a batch id, if any
    return result_table(spark, base, name).limit(0) if newest is None else result_table(spark, base, name, batch=newest)


def file_listing(spark: SparkSession, path: str, glob: str = "*.{json,json.gz}") -> DataFrame:
    """Path, byte size and modification time of every feed file; file contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime"))


def catalog_ids(warehouse: DataFrame) -> DataFrame:
    """Distinct product ids known to the warehouse."""
    return warehouse.select("product_id").where("product_id is not null").distinct()
