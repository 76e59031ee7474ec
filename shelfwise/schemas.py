"""Fixed schemas of the feeds and of the five per-batch result tables."""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# POS sale record as it arrives in the JSON-lines feed; every field nullable.
POS = StructType([
    StructField("txn_id", StringType()),
    StructField("product_id", StringType()),
    StructField("product_name", StringType()),
    StructField("store_id", StringType()),
    StructField("quantity_sold", IntegerType()),
    StructField("unit_price", DoubleType()),
    StructField("txn_timestamp", StringType()),
])

# POS record carrying the business batch id in the data (see streaming notes).
POS_BATCHED = StructType(POS.fields + [StructField("batch_id", IntegerType())])

WAREHOUSE = StructType([
    StructField("product_id", StringType()),
    StructField("warehouse_stock", IntegerType()),
    StructField("reorder_threshold", IntegerType()),
])

SUPPLIER = StructType([
    StructField("po_id", StringType()),
    StructField("product_id", StringType()),
    StructField("supplier_id", StringType()),
    StructField("expected_delivery_date", StringType()),
    StructField("actual_delivery_date", StringType()),
])

# Raw retail sales export; the header names contain spaces.
RAW_SALES_CSV = StructType([
    StructField("Row ID", LongType()),
    StructField("Product Name", StringType()),
    StructField("Region", StringType()),
    StructField("Order Quantity", IntegerType()),
    StructField("Unit Price", DoubleType()),
    StructField("Order Date", StringType()),
])

# Result tables: business columns, then batch_id (partition column) and loaded_at.
SALES_AGGREGATION = StructType([
    StructField("product_id", StringType()),
    StructField("product_name", StringType()),
    StructField("store_id", StringType()),
    StructField("units_sold", LongType()),
    StructField("total_revenue", DoubleType()),
    StructField("txn_count", LongType()),
])

INVENTORY_STATUS = StructType([
    StructField("product_id", StringType()),
    StructField("warehouse_stock", IntegerType()),
    StructField("reorder_threshold", IntegerType()),
    StructField("units_sold_batch", LongType()),
    StructField("current_stock", LongType()),
])

PRODUCT_RANKING = StructType([
    StructField("product_id", StringType()),
    StructField("product_name", StringType()),
    StructField("total_revenue", DoubleType()),
    StructField("units_sold", LongType()),
    StructField("rank", LongType()),
])

LOW_STOCK_ALERTS = StructType([
    StructField("product_id", StringType()),
    StructField("current_stock", LongType()),
    StructField("reorder_threshold", IntegerType()),
    StructField("low_stock_flag", BooleanType()),
])

SUPPLIER_DELAY_ALERTS = StructType([
    StructField("po_id", StringType()),
    StructField("product_id", StringType()),
    StructField("supplier_id", StringType()),
    StructField("expected_delivery_date", DateType()),
    StructField("actual_delivery_date", DateType()),
    StructField("delay_days", IntegerType()),
])

INVENTORY_CUMULATIVE = StructType([
    StructField("product_id", StringType()),
    StructField("warehouse_stock", IntegerType()),
    StructField("reorder_threshold", IntegerType()),
    StructField("units_sold_batch", LongType()),
    StructField("units_sold_to_date", LongType()),
    StructField("cumulative_stock", LongType()),
])

# Kept beside the results: one total per product after each epoch, the files of each load, rows that came too late.
UNITS_TO_DATE = StructType([
    StructField("product_id", StringType()),
    StructField("units_sold_to_date", LongType()),
])

LOADED_FILES = StructType([
    StructField("path", StringType()),
    StructField("length", LongType()),
    StructField("modificationTime", TimestampType()),
])

BATCH_FIELDS = [
    StructField("batch_id", IntegerType()),
    StructField("loaded_at", TimestampType()),
    StructField("load_id", StringType()),
]

RESULT_TABLES = {
    "sales_aggregation": SALES_AGGREGATION,
    "inventory_status": INVENTORY_STATUS,
    "product_ranking": PRODUCT_RANKING,
    "low_stock_alerts": LOW_STOCK_ALERTS,
    "supplier_delay_alerts": SUPPLIER_DELAY_ALERTS,
}

KEPT_TABLES = {
    "inventory_cumulative": INVENTORY_CUMULATIVE,
    "units_to_date": UNITS_TO_DATE,
    "loaded_files": LOADED_FILES,
    "late_rows": POS,
}

# Kept tables whose rows belong to a load, not to a batch.
BY_LOAD = ("units_to_date", "loaded_files")


def stored(schema: StructType, by_batch: bool = True) -> StructType:
    """Schema of a table as stored: its columns, batch_id unless ``by_batch`` is false, loaded_at, load_id."""
    return StructType(schema.fields + [f for f in BATCH_FIELDS if by_batch or f.name != "batch_id"])
