"""Reporting queries over the result tables: filters, KPIs, top/bottom lists, latest state.

Each takes result-table DataFrames and returns a lazy DataFrame; only the
final answer (a handful of rows for KPIs and top-k lists) reaches the caller.
Grouped reports drop null group keys, as the dashboard's grouping does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import contains_regex_ci, long_sum, money_sum, money_sum_or_zero

BATCH = "batch_id"

# Fixed values of the dashboard.
ALL_STORES = "All Regions"
DEFAULT_THRESHOLD = 20           # slider default (5..100, step 5)
TOP_K = 15
CRITICAL_BELOW = 10
STATUS_CRITICAL = "CRITICAL"
STATUS_LOW = "LOW STOCK"
SEVERITY_HIGH_ABOVE = 50
SEVERITY_HIGH = "rose"
SEVERITY_NORMAL = "amber"
FEED_FILES_SHOWN = 10


def store_list(sales: DataFrame) -> DataFrame:
    """Distinct non-null stores, sorted."""
    return sales.select("store_id").dropna().distinct().orderBy("store_id")


def filter_store(sales: DataFrame, store: str | None) -> DataFrame:
    """C11: one store, or every store for None / 'All Regions'."""
    if store is None or store == ALL_STORES:
        return sales
    return sales.filter(F.col("store_id") == store)


def search_products(sales: DataFrame, pattern: str | None) -> DataFrame:
    """Name or id matches the regex anywhere, case-insensitive; null never matches."""
    if not pattern:
        return sales
    return sales.filter(contains_regex_ci("product_name", pattern) | contains_regex_ci("product_id", pattern))


def sales_filtered(sales: DataFrame, store: str | None = None, pattern: str | None = None) -> DataFrame:
    return search_products(filter_store(sales, store), pattern)


def kpi_totals(filtered_sales: DataFrame) -> DataFrame:
    """Revenue, units and transactions of the filtered sales; 0 when empty."""
    return filtered_sales.agg(
        money_sum_or_zero("total_revenue").alias("total_revenue"),
        F.coalesce(long_sum("units_sold"), F.lit(0).cast("bigint")).alias("total_units"),
        F.coalesce(long_sum("txn_count"), F.lit(0).cast("bigint")).alias("total_txns"),
    )


def active_batches(sales: DataFrame) -> DataFrame:
    """Number of distinct micro-batches loaded."""
    return sales.agg(F.countDistinct(BATCH).alias("active_batches"))


def latest_inventory(inventory: DataFrame) -> DataFrame:
    """L1: each product's row from its most recent batch.

    ``max(struct(batch_id, ...))`` per product is an aggregate with a partial
    step, so no product's history is sorted in one task.
    """
    rest = [c for c in inventory.columns if c not in (BATCH, "product_id")]
    return (
        inventory.groupBy("product_id")
        .agg(F.max(F.struct(BATCH, *rest)).alias("_last"))
        .select("product_id", "_last.*")
        .select(*inventory.columns)
    )


def kpi_low_stock(latest_inv: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """G6 + T5: products under a user threshold (own thresholds ignored) and the badge."""
    n = F.count_if(F.col("current_stock") < threshold).cast("bigint")
    return latest_inv.agg(n.alias("low_stock_count")).withColumn(
        "severity",
        F.when(F.col("low_stock_count") > SEVERITY_HIGH_ABOVE, SEVERITY_HIGH).otherwise(SEVERITY_NORMAL))


def kpi_delays(delay_alerts: DataFrame) -> DataFrame:
    """Every row of the delay-alert table, all batches."""
    return delay_alerts.agg(F.count(F.lit(1)).alias("total_delays"))


def kpi_delays_of(alerts: DataFrame, batches: DataFrame) -> DataFrame:
    """G7 without the alert table: every alert recurs in every batch, so the counts multiply."""
    loads = batches.agg(F.count(F.lit(1)))
    return alerts.agg(F.count(F.lit(1)).alias("n")).select((F.col("n") * loads.scalar()).alias("total_delays"))


def top_products(filtered_sales: DataFrame, k: int = TOP_K) -> DataFrame:
    """O1: top products by revenue, grouped by name; ties broken by name."""
    return (
        filtered_sales.filter(F.col("product_name").isNotNull())
        .groupBy("product_name").agg(money_sum("total_revenue").alias("total_revenue"))
        .orderBy(F.col("total_revenue").desc(), F.col("product_name").asc())
        .limit(k)
    )


def lowest_stock(latest_inv: DataFrame, k: int = TOP_K) -> DataFrame:
    """O2: the k lowest current stocks; ties broken by product id."""
    return latest_inv.orderBy(F.col("current_stock").asc(), F.col("product_id").asc()).limit(k)


def critical_items(latest_inv: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """T4: products under the user threshold with a status, lowest stock first."""
    status = F.when(F.col("current_stock") < CRITICAL_BELOW, STATUS_CRITICAL).otherwise(STATUS_LOW)
    return (
        latest_inv.filter(F.col("current_stock") < threshold)
        .select("product_id", "warehouse_stock", "units_sold_batch", "current_stock",
                status.alias("stock_status"))
        .orderBy("current_stock", "product_id")
    )


def revenue_by_store(sales: DataFrame) -> DataFrame:
    """Revenue per store over all sales (the store filter does not apply)."""
    return (sales.filter(F.col("store_id").isNotNull())
            .groupBy("store_id").agg(money_sum("total_revenue").alias("total_revenue")))


def batch_trend(sales: DataFrame) -> DataFrame:
    """Revenue, units and transactions per batch, in batch order."""
    return (
        sales.groupBy(BATCH)
        .agg(money_sum("total_revenue").alias("total_revenue"),
             long_sum("units_sold").alias("units_sold"),
             long_sum("txn_count").alias("txn_count"))
        .orderBy(BATCH)
    )


def batch_summary(sales: DataFrame) -> DataFrame:
    """Records and revenue per batch, with the load time when the table has one."""
    aggs = [long_sum("txn_count").alias("records_processed"),
            money_sum("total_revenue").alias("total_batch_revenue")]
    if "loaded_at" in sales.columns:
        aggs.append(F.min("loaded_at").alias("loaded_timestamp"))
    return sales.groupBy(BATCH).agg(*aggs).orderBy(BATCH)


def supplier_delay_summary(delay_alerts: DataFrame) -> DataFrame:
    """Delayed orders and mean delay per supplier, all batches."""
    return (
        delay_alerts.filter(F.col("supplier_id").isNotNull())
        .groupBy("supplier_id")
        .agg(F.count("po_id").alias("delayed_orders"), F.avg("delay_days").alias("avg_delay"))
    )


def supplier_delay_summary_of(alerts: DataFrame, batches: DataFrame) -> DataFrame:
    """G10 without the alert table: the counts multiply by the number of batches, the means stay. No batch: no rows."""
    loads = batches.agg(F.count(F.lit(1)).alias("n"))
    return (supplier_delay_summary(alerts).withColumn("loads", loads.scalar()).filter("loads > 0")
            .select("supplier_id", (F.col("delayed_orders") * F.col("loads")).alias("delayed_orders"), "avg_delay"))


def where_loaded(alerts: DataFrame, batches: DataFrame) -> DataFrame:
    """The alerts as any one batch holds them. No batch: no rows."""
    loads = batches.agg(F.count(F.lit(1)).alias("n"))
    return alerts.withColumn("loads", loads.scalar()).filter("loads > 0").drop("loads")


def supplier_delay_distinct(delay_alerts: DataFrame) -> DataFrame:
    """H5: the same per supplier, counting each purchase order once however many batches saw it."""
    per_po = (delay_alerts.filter(F.col("supplier_id").isNotNull())
              .groupBy("supplier_id", "po_id").agg(F.max("delay_days").alias("delay_days")))
    return per_po.groupBy("supplier_id").agg(
        F.count("po_id").alias("delayed_orders"), F.avg("delay_days").alias("avg_delay"))


def latest_batch(df: DataFrame) -> DataFrame:
    """Rows of the table's most recent batch (scalar subquery on the partition column)."""
    newest = df.agg(F.max(BATCH))
    return df.filter(F.col(BATCH) == newest.scalar())


def ranking_list(ranking: DataFrame) -> DataFrame:
    """One batch's ranking, best first."""
    return (ranking.select("rank", "product_id", "product_name", "units_sold", "total_revenue")
            .orderBy("rank", "product_id", "product_name"))


def latest_ranking(ranking: DataFrame) -> DataFrame:
    """L2 over a stored table: the latest batch's ranking, best first."""
    return ranking_list(latest_batch(ranking))


def delay_list(delay_alerts: DataFrame) -> DataFrame:
    """One batch's delay alerts, longest delay first."""
    return (delay_alerts.select("po_id", "product_id", "supplier_id", "expected_delivery_date",
                                "actual_delivery_date", "delay_days")
            .orderBy(F.col("delay_days").desc(), F.col("po_id")))


def latest_delays(delay_alerts: DataFrame) -> DataFrame:
    """L3 over a stored table: the latest batch's delay alerts, longest delay first."""
    return delay_list(latest_batch(delay_alerts))


def _chunks(listing: DataFrame) -> DataFrame:
    """(chunk, bytes) of a written feed: a chunk is the number of its folder, whatever files hold it."""
    chunk = F.regexp_extract("path", r"/feed_batch=([0-9]+)/", 1).cast("bigint").alias("chunk")
    return listing.select(chunk, "length").groupBy("chunk").agg(F.sum("length").alias("bytes"))


def feed_files(listing: DataFrame, shown: int = FEED_FILES_SHOWN) -> DataFrame:
    """S7 + O4: the newest ``shown`` feed chunks by number, oldest first, size in KB."""
    newest = _chunks(listing).orderBy(F.col("chunk").desc()).limit(shown).orderBy("chunk")
    return newest.select(F.format_string("feed_batch=%d", "chunk").alias("file_name"),
                         F.round(F.col("bytes") / 1024.0, 2).alias("size_kb"))


def feed_file_count(listing: DataFrame) -> DataFrame:
    return _chunks(listing).agg(F.count(F.lit(1)).alias("file_count"))
