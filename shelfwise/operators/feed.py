"""Feed preparation: raw sales -> product catalog -> POS micro-batch chunks.

The catalog numbers products in order of their first appearance and the feed
is cut into fixed-size chunks in date order. Both need global positions; they
come from :func:`plans.ranking.distributed_rank`, not from a single-task window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import iso_timestamp, padded_id, parse_timestamp
from ..plans.materialise import materialise
from ..plans.ranking import distributed_rank

# Fixed values of the feed format.
BATCH_SIZE = 700
TXN_PREFIX = "TXN-"
PRODUCT_PREFIX = "P"
UNKNOWN_STORE = "UNKNOWN"

RAW_REQUIRED = ["product_name", "order_quantity", "unit_price", "order_date"]


def raw_sales_clean(raw: DataFrame) -> DataFrame:
    """Required fields present, quantity and price > 0, date parses (bad dates dropped)."""
    return (
        raw.dropna(subset=RAW_REQUIRED)
        .filter((F.col("order_quantity") > 0) & (F.col("unit_price") > 0))
        .withColumn("order_date", parse_timestamp("order_date"))
        .dropna(subset=["order_date"])
    )


def product_catalog(clean: DataFrame) -> DataFrame:
    """One id per distinct product name, P0001.. in order of the name's first row id."""
    first = clean.groupBy("product_name").agg(F.min("row_id").alias("first_row_id"))
    numbered = distributed_rank(materialise(first, "catalog-names"), [("first_row_id", False)], tiebreak=["product_name"],
                                method="row_number", out="_n")
    return numbered.select("product_name", padded_id(PRODUCT_PREFIX, "_n").alias("product_id"))


def product_count(clean: DataFrame) -> DataFrame:
    """Number of distinct product names."""
    return clean.agg(F.countDistinct("product_name").alias("unique_products"))


def feed_chunks(clean: DataFrame, catalog: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """T7 + T8 + N2: POS records in date order (row id breaks ties), chunk ids from 1.

    The joined rows are written once; their positions need them three times.
    The catalog grows with the data: how to join it is left to the planner and AQE.
    """
    joined = clean.join(catalog, "product_name")
    positioned = distributed_rank(materialise(joined, "feed-rows"), [("order_date", False), ("row_id", False)],
                                  method="row_number", out="_pos")
    store = F.col("region").cast("string") if "region" in clean.columns else F.lit(UNKNOWN_STORE)
    return positioned.select(
        F.concat(F.lit(TXN_PREFIX), F.col("row_id").cast("string")).alias("txn_id"),
        "product_id",
        "product_name",
        store.alias("store_id"),
        F.col("order_quantity").cast("int").alias("quantity_sold"),
        F.col("unit_price").cast("double").alias("unit_price"),
        iso_timestamp("order_date").alias("txn_timestamp"),
        (F.floor((F.col("_pos") - 1) / batch_size) + 1).cast("bigint").alias("feed_batch"),
    )


def write_feed(chunks: DataFrame, folder: str) -> None:
    """K5: replace the POS feed folder with one sub-folder of JSON-lines files per chunk.

    Rows are hash-partitioned on the chunk id first, so each chunk lands in
    one file written by one task and chunks are written in parallel.
    """
    (chunks.repartition("feed_batch").write.mode("overwrite")
        .partitionBy("feed_batch").json(folder))
