"""Cleaning and validation of the POS, warehouse and supplier feeds.

Rules are applied in a fixed order: null removal, validity filter, de-duplication,
then parsing. De-duplication is scoped to the micro-batch (``batch_id`` when the
frame carries one) and keeps the row that sorts first by the POS tie-break
order, so the answer never depends on which task saw which copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import any_null, parse_date, parse_timestamp
from ..plans.dedup import keep_first, split_first

BATCH = "batch_id"

# Fixed values that define the cleaning rules.
POS_REQUIRED = ["product_id", "quantity_sold", "unit_price"]
POS_ORDER = ["product_id", "quantity_sold", "unit_price", "store_id", "txn_timestamp", "product_name"]
WAREHOUSE_REQUIRED = ["product_id", "warehouse_stock"]
WAREHOUSE_ORDER = ["warehouse_stock", "reorder_threshold"]
SUPPLIER_REQUIRED = ["product_id", "supplier_id", "expected_delivery_date", "actual_delivery_date"]
SUPPLIER_ORDER = ["product_id", "supplier_id", "expected_delivery_date", "actual_delivery_date"]

REASON_NULL, REASON_INVALID, REASON_DUPLICATE = "null", "invalid", "duplicate"


def _scope(df: DataFrame, key: str) -> list[str]:
    return ([BATCH] if BATCH in df.columns else []) + [key]


def pos_drop_nulls(df: DataFrame) -> DataFrame:
    """Rows missing product, quantity or price are removed (NaN counts as missing)."""
    return df.dropna(subset=POS_REQUIRED)


def pos_valid(df: DataFrame) -> DataFrame:
    """Quantity and price strictly positive (run after C1: NaN > 0 is true in Spark)."""
    return df.filter((F.col("quantity_sold") > 0) & (F.col("unit_price") > 0))


def pos_dedup(df: DataFrame) -> DataFrame:
    """One row per txn_id within the batch; null ids form one group."""
    return keep_first(df, _scope(df, "txn_id"), POS_ORDER)


def pos_parse(df: DataFrame) -> DataFrame:
    """C4: txn_timestamp text to timestamp; unparseable text becomes null, the row stays."""
    return df.withColumn("txn_timestamp", parse_timestamp("txn_timestamp"))


def clean_pos(df: DataFrame) -> DataFrame:
    """C5 = C1 -> C2 -> C3 -> C4."""
    return pos_parse(pos_dedup(pos_valid(pos_drop_nulls(df))))


def null_condition() -> F.Column:
    """Row fails C1 (a required field is null, or the price is NaN)."""
    return any_null(["product_id"], nan_is_null=False) | any_null(["quantity_sold"], nan_is_null=False) \
        | any_null(["unit_price"])


def invalid_condition() -> F.Column:
    """Row fails C2 (quantity or price not strictly positive)."""
    return ~((F.col("quantity_sold") > 0) & (F.col("unit_price") > 0))


def pos_rejects(df: DataFrame) -> DataFrame:
    """H6: every dropped row once, with the first rule it failed (null, invalid, duplicate).

    Null and invalid rows are labelled in one narrow pass; only the valid rows
    go through the duplicate split, so the input is read by two branches.
    """
    reason = F.when(null_condition(), F.lit(REASON_NULL)).when(invalid_condition(), F.lit(REASON_INVALID))
    labeled = df.withColumn("reason", reason)
    bad = labeled.filter(F.col("reason").isNotNull())
    valid = labeled.filter(F.col("reason").isNull()).drop("reason")
    _, extra = split_first(valid, _scope(df, "txn_id"), POS_ORDER)
    return bad.unionByName(extra.withColumn("reason", F.lit(REASON_DUPLICATE)))


def clean_report(df: DataFrame) -> DataFrame:
    """Per batch raw, rejected-by-rule and clean row counts.

    Two aggregation levels, both with map-side partial aggregation: per
    (batch, txn_id) first, so duplicates are counted without a window.
    """
    keys = _scope(df, "txn_id")
    is_null = null_condition()
    is_valid = ~is_null & ~invalid_condition()
    per_txn = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(is_null).alias("nulls"),
        F.count_if(~is_null & invalid_condition()).alias("invalid"),
        F.count_if(is_valid).alias("valid"),
    )
    out_keys = keys[:-1]
    agg = per_txn.groupBy(*out_keys) if out_keys else per_txn.groupBy()
    return agg.agg(
        F.sum("raw").cast("bigint").alias("raw_rows"),
        F.sum("nulls").cast("bigint").alias("null_rows"),
        F.sum("invalid").cast("bigint").alias("invalid_rows"),
        (F.sum("valid") - F.count_if(F.col("valid") > 0)).cast("bigint").alias("duplicate_rows"),
        F.count_if(F.col("valid") > 0).cast("bigint").alias("clean_rows"),
    )


def clean_warehouse(df: DataFrame) -> DataFrame:
    """Drop rows without product or stock; one row per product."""
    return keep_first(df.dropna(subset=WAREHOUSE_REQUIRED), ["product_id"], WAREHOUSE_ORDER)


def clean_supplier(df: DataFrame) -> DataFrame:
    """Drop rows missing product, supplier or a date; one row per po_id; text to dates."""
    kept = keep_first(df.dropna(subset=SUPPLIER_REQUIRED), ["po_id"], SUPPLIER_ORDER)
    return (kept.withColumn("expected_delivery_date", parse_date("expected_delivery_date"))
                .withColumn("actual_delivery_date", parse_date("actual_delivery_date")))
