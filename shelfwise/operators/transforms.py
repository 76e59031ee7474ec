"""The five per-batch business transformations.

Every function works on one micro-batch or on many at once: when the input
carries ``batch_id`` it becomes part of every grouping, join and ranking key,
so a single job computes all batches exactly as separate per-batch runs would.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import long_sum, money_sum, revenue_sum
from ..plans.materialise import materialise
from ..plans.ranking import distributed_rank

BATCH = "batch_id"

# Fixed values of the business rules (defaults; callers may pass their own).
LOW_STOCK_THRESHOLD = 20
SUPPLIER_DELAY_THRESHOLD_DAYS = 2


def _batch(df: DataFrame) -> list[str]:
    return [BATCH] if BATCH in df.columns else []


def sales_aggregation(pos_clean: DataFrame) -> DataFrame:
    """G1: units, revenue and transaction count per (product, name, store).

    Revenue is summed as an exact decimal; ``txn_count`` counts non-null ids.
    A hash aggregate with a partial step per map task absorbs hot products.
    """
    keys = _batch(pos_clean) + ["product_id", "product_name", "store_id"]
    return (
        pos_clean.groupBy(*keys)
        .agg(long_sum("quantity_sold").alias("units_sold"),
             revenue_sum("quantity_sold", "unit_price").alias("total_revenue"),
             F.count("txn_id").alias("txn_count"))
    )


def batch_ids(df: DataFrame) -> DataFrame:
    """Distinct batch ids present in a frame (one row per micro-batch)."""
    return df.select(BATCH).distinct()


def _for_every_batch(table: DataFrame, batches: DataFrame) -> DataFrame:
    """Repeat a reference table once per batch, as a per-batch run re-reads it.

    The batch list is a scalar subquery (one small array, one value per
    micro-batch), exploded map-side: no join, no shuffle of ``table``.
    """
    return table.withColumn(BATCH, F.explode(_batch_list(batches)))


def _batch_list(batches: DataFrame) -> Column:
    return batches.agg(F.array_sort(F.collect_set(BATCH)).alias("ids")).scalar()


def inventory_calculation(sales_agg: DataFrame, warehouse_clean: DataFrame,
                          batches: DataFrame | None = None,
                          keep: Callable[[DataFrame], DataFrame] = lambda df: df,
                          by_product: bool = False) -> DataFrame:
    """T1 (with G2, N1): current stock = warehouse stock - units sold in this batch.

    Left outer join keeps products without sales (sold 0); sales of products
    missing from the warehouse are dropped. With several batches, the warehouse
    is repeated for each batch in ``batches`` (default: batches with sales).
    ``keep`` is applied to the stock with its units before it is repeated: one row a product. ``by_product`` deals
    those rows by product (a frame that ``keep`` read back isn't), so what follows per product moves no repeated row.
    """
    bkeys = _batch(sales_agg)
    per_product = sales_agg.groupBy(*bkeys, "product_id").agg(long_sum("units_sold").alias("units_sold_batch"))
    wh = warehouse_clean.select("product_id", "warehouse_stock", "reorder_threshold")
    if bkeys:
        # one row a product, with a map of its batches' units, meets the stock before that is repeated for the
        # batches: neither this join nor a window per product moves the repeated rows
        units = F.map_from_entries(F.collect_list(F.struct(BATCH, "units_sold_batch")))
        by_batch = per_product.where(F.col(BATCH).isNotNull()).groupBy("product_id").agg(units.alias("_units"))
        stock = keep(wh.join(by_batch, "product_id", "left"))
        joined = _for_every_batch(stock.repartition("product_id") if by_product else stock,
                                  batches if batches is not None else batch_ids(sales_agg))
        joined = joined.withColumn("units_sold_batch", F.try_element_at("_units", F.col(BATCH)))
    else:
        joined = wh.join(per_product, "product_id", "left")
    sold = F.coalesce(F.col("units_sold_batch"), F.lit(0).cast("bigint"))
    return joined.select(*bkeys, "product_id", "warehouse_stock", "reorder_threshold",
                         sold.alias("units_sold_batch"),
                         (F.col("warehouse_stock") - sold).cast("bigint").alias("current_stock"))


def newest_batch(batches: DataFrame) -> DataFrame:
    """One row with the newest batch id; null where there is no batch."""
    return batches.agg(F.max(BATCH).alias(BATCH))


def of_batch(df: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of the one batch that ``batch`` holds (a scalar subquery, pushed down to the feed's scan side)."""
    return df.filter(F.col(BATCH) == batch.scalar())


def newest_inventory(sales_agg: DataFrame, warehouse_clean: DataFrame, batches: DataFrame) -> DataFrame:
    """T1 for the newest batch alone, without repeating the warehouse for the others.

    Every product of the warehouse has a row in every batch, so this holds each
    product's latest row (L1). No batch: no rows.
    """
    newest = newest_batch(batches)
    sold = of_batch(sales_agg, newest).drop(BATCH)
    stock = inventory_calculation(sold, warehouse_clean).withColumn(BATCH, newest.scalar())
    return stock.filter(F.col(BATCH).isNotNull()).select(BATCH, *[c for c in stock.columns if c != BATCH])


def product_ranking(sales_agg: DataFrame, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """W1 (with G3): products ranked by revenue within the batch, RANK() semantics.

    Totals are per (product_id, product_name), so one id under two names ranks
    twice. The rank is computed by :func:`distributed_rank`, not by a window
    that would sort a whole batch in one task; the totals, which its bounds,
    counts and rows all read, are computed once and written to the shared folder
    (by ``keep``, where the caller removes them, as a load does).
    """
    bkeys = _batch(sales_agg)
    totals = (
        sales_agg.groupBy(*bkeys, "product_id", "product_name")
        .agg(money_sum("total_revenue").alias("total_revenue"),
             long_sum("units_sold").alias("units_sold"))
    )
    held = materialise(totals, "rank-totals") if keep is None else keep(totals)
    return distributed_rank(held, [("total_revenue", True)], group=bkeys, tiebreak=["product_id", "product_name"], method="rank")


def low_stock_detection(inventory: DataFrame, default_threshold: int = LOW_STOCK_THRESHOLD) -> DataFrame:
    """Current stock strictly below the product's threshold (default where missing)."""
    limit = F.coalesce(F.col("reorder_threshold"), F.lit(default_threshold))
    return (
        inventory.filter(F.col("current_stock") < limit)
        .select(*_batch(inventory), "product_id", "current_stock", "reorder_threshold",
                F.lit(True).alias("low_stock_flag"))
    )


def supplier_delay_detection(supplier_clean: DataFrame,
                             threshold_days: int = SUPPLIER_DELAY_THRESHOLD_DAYS) -> DataFrame:
    """Purchase orders delivered more than ``threshold_days`` late."""
    delay = F.datediff("actual_delivery_date", "expected_delivery_date")
    return (
        supplier_clean.withColumn("delay_days", delay)
        .filter(F.col("delay_days") > threshold_days)
        .select(*_batch(supplier_clean), "po_id", "product_id", "supplier_id",
                "expected_delivery_date", "actual_delivery_date", "delay_days")
    )


def supplier_alerts_per_batch(alerts: DataFrame, batches: DataFrame, listed: bool = False) -> DataFrame:
    """The alert table as loaded, one copy of every alert per micro-batch.

    ``listed``: each alert once, with the list ``batch_ids``; a load stores it in that form and its readers
    see one copy per micro-batch.
    """
    return alerts.withColumn("batch_ids", _batch_list(batches)) if listed else _for_every_batch(alerts, batches)


def inventory_cumulative(inventory: DataFrame) -> DataFrame:
    """H4: stock carried across batches: warehouse stock - running sum of units sold.

    The window is per product over its batches, so a partition holds one row
    per batch of one product, never a whole batch.
    """
    w = Window.partitionBy("product_id").orderBy(BATCH).rowsBetween(Window.unboundedPreceding, 0)
    sold = F.sum("units_sold_batch").over(w).cast("bigint")
    return inventory.select(
        BATCH, "product_id", "warehouse_stock", "reorder_threshold", "units_sold_batch",
        sold.alias("units_sold_to_date"),
        (F.col("warehouse_stock") - sold).cast("bigint").alias("cumulative_stock"),
    )
