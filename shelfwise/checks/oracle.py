"""DuckDB SQL that states, independently of the Spark code, what each query returns.

The driver registers the parquet tables as views; the feed views are spelled
out here as CTEs with the same rules as ``sources.testviews``. Every computed
column is aliased to the Spark column name, integer results are cast to the
Spark type, and money is summed as decimal, so both sides hash alike.
"""

from __future__ import annotations

# ---- feed views ------------------------------------------------------------

POS = """
pos AS (
  SELECT concat('TXN-', cast(l_orderkey AS varchar), '-', cast(l_linenumber AS varchar)) AS txn_id,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE printf('P%04d', l_partkey) END AS product_id,
         p_name AS product_name,
         r_name AS store_id,
         CASE WHEN l_orderkey % 89 = 0 THEN NULL
              WHEN l_orderkey % 83 = 0 THEN -cast(l_quantity AS integer)
              ELSE cast(l_quantity AS integer) END AS quantity_sold,
         p_retailprice AS unit_price,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS txn_timestamp,
         cast((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 AS integer) AS batch_id
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

WAREHOUSE = """
warehouse AS (
  SELECT printf('P%04d', p_partkey) AS product_id,
         CASE WHEN p_partkey % 50 = 7 THEN NULL ELSE cast(5 + (p_partkey * 37) % 296 AS integer) END AS warehouse_stock,
         CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE cast(15 + 5 * (p_partkey % 4) AS integer) END AS reorder_threshold
  FROM part
)"""

SUPPLIER_PO = """
supplier_po AS (
  SELECT concat('PO-', cast(l_orderkey AS varchar), '-', cast(l_linenumber AS varchar)) AS po_id,
         printf('P%04d', l_partkey) AS product_id,
         concat('SUP-', cast(l_suppkey AS varchar)) AS supplier_id,
         strftime(cast(l_shipdate AS date), '%Y-%m-%d') AS expected_delivery_date,
         CASE WHEN l_orderkey % 71 = 0 THEN NULL
              ELSE strftime(cast(l_shipdate AS date)
                   + cast((l_orderkey * 7 + l_linenumber * 3 + l_suppkey) % 9 AS integer), '%Y-%m-%d') END
           AS actual_delivery_date
  FROM lineitem
)"""

RAW_SALES = """
raw_sales AS (
  SELECT event_id AS row_id,
         concat(event_type, '-', cast(user_id AS varchar)) AS product_name,
         event_type AS region,
         cast(CASE WHEN event_id % 53 = 0 THEN 0 ELSE 1 + event_id % 12 END AS integer) AS order_quantity,
         CASE WHEN event_id % 59 = 0 THEN NULL ELSE value END AS unit_price,
         CASE WHEN event_id % 101 = 0 THEN 'n/a' ELSE substr(cast(ts AS varchar), 1, 10) END AS order_date
  FROM events
)"""

# ---- derived relations (each a CTE; later ones may use earlier ones) ---------

POS_ORDER = ("product_id NULLS FIRST, quantity_sold NULLS FIRST, unit_price NULLS FIRST, "
             "store_id NULLS FIRST, txn_timestamp NULLS FIRST, product_name NULLS FIRST")

POS_NN = """
pos_nn AS (
  SELECT * FROM pos
  WHERE product_id IS NOT NULL AND quantity_sold IS NOT NULL AND unit_price IS NOT NULL
    AND NOT isnan(unit_price)
)"""

POS_VALID = """
pos_valid AS (SELECT * FROM pos_nn WHERE quantity_sold > 0 AND unit_price > 0)"""

POS_DEDUP = f"""
pos_dedup AS (
  SELECT txn_id, product_id, product_name, store_id, quantity_sold, unit_price, txn_timestamp, batch_id
  FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, txn_id ORDER BY {POS_ORDER}) AS rn
        FROM pos_valid)
  WHERE rn = 1
)"""

POS_CLEAN = """
pos_clean AS (
  SELECT txn_id, product_id, product_name, store_id, quantity_sold, unit_price,
         try_cast(txn_timestamp AS timestamp) AS txn_timestamp, batch_id
  FROM pos_dedup
)"""

SALES_AGG = """
sales_agg AS (
  SELECT batch_id, product_id, product_name, store_id,
         cast(sum(quantity_sold) AS bigint) AS units_sold,
         cast(sum(quantity_sold * cast(cast(unit_price AS varchar) AS decimal(24,10))) AS double) AS total_revenue,
         cast(count(txn_id) AS bigint) AS txn_count
  FROM pos_clean
  GROUP BY batch_id, product_id, product_name, store_id
)"""

WAREHOUSE_CLEAN = """
warehouse_clean AS (
  SELECT product_id, warehouse_stock, reorder_threshold
  FROM (SELECT *, row_number() OVER (PARTITION BY product_id
                                      ORDER BY warehouse_stock NULLS FIRST, reorder_threshold NULLS FIRST) AS rn
        FROM warehouse WHERE product_id IS NOT NULL AND warehouse_stock IS NOT NULL)
  WHERE rn = 1
)"""

SUPPLIER_CLEAN = """
supplier_clean AS (
  SELECT po_id, product_id, supplier_id,
         try_cast(expected_delivery_date AS date) AS expected_delivery_date,
         try_cast(actual_delivery_date AS date) AS actual_delivery_date
  FROM (SELECT *, row_number() OVER (PARTITION BY po_id
                     ORDER BY product_id NULLS FIRST, supplier_id NULLS FIRST,
                              expected_delivery_date NULLS FIRST, actual_delivery_date NULLS FIRST) AS rn
        FROM supplier_po
        WHERE product_id IS NOT NULL AND supplier_id IS NOT NULL
          AND expected_delivery_date IS NOT NULL AND actual_delivery_date IS NOT NULL)
  WHERE rn = 1
)"""

BATCHES = """
batches AS (SELECT DISTINCT batch_id FROM pos)"""

INVENTORY = """
inventory AS (
  SELECT b.batch_id, w.product_id, w.warehouse_stock, w.reorder_threshold,
         cast(coalesce(s.units_sold_batch, 0) AS bigint) AS units_sold_batch,
         cast(w.warehouse_stock - coalesce(s.units_sold_batch, 0) AS bigint) AS current_stock
  FROM warehouse_clean w
  CROSS JOIN batches b
  LEFT JOIN (SELECT batch_id, product_id, sum(units_sold) AS units_sold_batch
             FROM sales_agg GROUP BY batch_id, product_id) s
    ON s.batch_id = b.batch_id AND s.product_id = w.product_id
)"""

RANKING = """
ranking AS (
  SELECT batch_id, product_id, product_name, total_revenue, units_sold,
         cast(rank() OVER (PARTITION BY batch_id ORDER BY total_revenue DESC) AS bigint) AS rank
  FROM (SELECT batch_id, product_id, product_name,
               cast(sum(cast(cast(total_revenue AS varchar) AS decimal(28,10))) AS double) AS total_revenue,
               cast(sum(units_sold) AS bigint) AS units_sold
        FROM sales_agg GROUP BY batch_id, product_id, product_name)
)"""

LOW_STOCK = """
low_stock AS (
  SELECT batch_id, product_id, current_stock, reorder_threshold, true AS low_stock_flag
  FROM inventory WHERE current_stock < coalesce(reorder_threshold, 20)
)"""

DELAYS = """
delays AS (
  SELECT po_id, product_id, supplier_id, expected_delivery_date, actual_delivery_date,
         cast(date_diff('day', expected_delivery_date, actual_delivery_date) AS integer) AS delay_days
  FROM supplier_clean
  WHERE date_diff('day', expected_delivery_date, actual_delivery_date) > 2
)"""

DELAY_TABLE = """
delay_table AS (SELECT d.*, b.batch_id FROM delays d CROSS JOIN batches b)"""

LATEST_INV = """
latest_inv AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY batch_id DESC) AS rn FROM inventory)
  WHERE rn = 1
)"""

RAW_CLEAN = """
raw_clean AS (
  SELECT row_id, product_name, region, order_quantity, unit_price,
         try_cast(order_date AS timestamp) AS order_date
  FROM raw_sales
  WHERE product_name IS NOT NULL AND order_quantity IS NOT NULL AND unit_price IS NOT NULL
    AND NOT isnan(unit_price) AND order_date IS NOT NULL
    AND order_quantity > 0 AND unit_price > 0 AND try_cast(order_date AS timestamp) IS NOT NULL
)"""

CATALOG = """
catalog AS (
  SELECT product_name, printf('P%04d', row_number() OVER (ORDER BY min(row_id))) AS product_id
  FROM raw_clean GROUP BY product_name
)"""

CLEAN_REPORT = """
clean_report AS (
SELECT p.batch_id,
       cast(count(*) AS bigint) AS raw_rows,
       cast(count(*) FILTER (WHERE product_id IS NULL OR quantity_sold IS NULL OR unit_price IS NULL
                             OR isnan(unit_price)) AS bigint) AS null_rows,
       cast(count(*) FILTER (WHERE NOT (product_id IS NULL OR quantity_sold IS NULL OR unit_price IS NULL
                             OR isnan(unit_price)) AND NOT (quantity_sold > 0 AND unit_price > 0)) AS bigint)
         AS invalid_rows,
       cast(coalesce(max(v.valid_rows), 0) - coalesce(max(c.clean_rows), 0) AS bigint) AS duplicate_rows,
       cast(coalesce(max(c.clean_rows), 0) AS bigint) AS clean_rows
FROM pos p
LEFT JOIN (SELECT batch_id, count(*) AS valid_rows FROM pos_valid GROUP BY batch_id) v USING (batch_id)
LEFT JOIN (SELECT batch_id, count(*) AS clean_rows FROM pos_dedup GROUP BY batch_id) c USING (batch_id)
GROUP BY p.batch_id
)"""

# name -> (cte text, dependencies)
_CTES = {
    "pos": (POS, []),
    "warehouse": (WAREHOUSE, []),
    "supplier_po": (SUPPLIER_PO, []),
    "raw_sales": (RAW_SALES, []),
    "pos_nn": (POS_NN, ["pos"]),
    "pos_valid": (POS_VALID, ["pos_nn"]),
    "pos_dedup": (POS_DEDUP, ["pos_valid"]),
    "pos_clean": (POS_CLEAN, ["pos_dedup"]),
    "sales_agg": (SALES_AGG, ["pos_clean"]),
    "warehouse_clean": (WAREHOUSE_CLEAN, ["warehouse"]),
    "supplier_clean": (SUPPLIER_CLEAN, ["supplier_po"]),
    "batches": (BATCHES, ["pos"]),
    "inventory": (INVENTORY, ["warehouse_clean", "batches", "sales_agg"]),
    "ranking": (RANKING, ["sales_agg"]),
    "low_stock": (LOW_STOCK, ["inventory"]),
    "delays": (DELAYS, ["supplier_clean"]),
    "delay_table": (DELAY_TABLE, ["delays", "batches"]),
    "latest_inv": (LATEST_INV, ["inventory"]),
    "raw_clean": (RAW_CLEAN, ["raw_sales"]),
    "catalog": (CATALOG, ["raw_clean"]),
    "clean_report": (CLEAN_REPORT, ["pos_dedup"]),
}


def with_ctes(select: str, *names: str) -> str:
    """``WITH`` clause holding the named CTEs and everything they depend on."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for dep in _CTES[n][1]:
            visit(dep)
        ordered.append(n)

    for n in names:
        visit(n)
    body = ",".join(_CTES[n][0] for n in ordered)
    return f"WITH {body}\n{select.strip()}"
