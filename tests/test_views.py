"""The feed views over the star-schema tables."""

import datetime

from shelfwise import queries as Q
from shelfwise.operators import transforms as T
from shelfwise.sources import testviews as V

DAY = datetime.datetime(1995, 1, 5)


def write(spark, folder, name, schema, rows):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def tables(spark, folder):
    write(spark, folder, "region", "r_regionkey bigint, r_name string", [(1, "ASIA")])
    write(spark, folder, "nation", "n_nationkey bigint, n_regionkey bigint", [(1, 1), (2, 9)])
    write(spark, folder, "customer", "c_custkey bigint, c_nationkey bigint", [(1, 1), (1, 1), (2, 2), (3, None)])
    write(spark, folder, "part", "p_partkey bigint, p_name string, p_retailprice double", [(1, "a", 1.0), (1, "b", 2.0)])
    month = lambda m: datetime.datetime(1995, m, 5)
    write(spark, folder, "orders", "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp",
          [(1, 1, month(1)), (1, 1, month(2)), (2, 1, None), (3, 2, month(3)), (4, 3, month(4)), (5, 1, month(5)),
           (6, 1, month(6)), (7, None, month(7)), (None, 1, month(8)), (9, 1, month(9))])
    write(spark, folder, "lineitem", "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
          "l_quantity double, l_shipdate timestamp",
          [(o, p, 1, n, 5.0, DAY) for o, p, n in [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 1, 1), (5, 8, 1), (5, None, 2),
                                                  (7, 1, 1), (None, 1, 1), (9, 8, 1), (9, 1, 2)]] + [(71, 1, 1, 1, 1.0, None)])


def test_batches_are_those_of_the_feed_without_joining_every_line(spark, tmp_dir):
    """the batch ids are the feed's; lines meet the orders once an order, and no column but the keys goes along."""
    tables(spark, tmp_dir)
    ids = lambda df: sorted(r.batch_id if r.batch_id is not None else -1 for r in df.collect())
    batches = Q.batches(spark, tmp_dir)
    assert ids(batches) == ids(T.batch_ids(V.pos(spark, tmp_dir))) == [-1, 0, 1, 8]
    plan = batches._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [l_orderkey" in plan and "l_linenumber" not in plan.split("Relation")[0]


def test_supplier_dates_are_iso_text(spark, tmp_dir):
    tables(spark, tmp_dir)
    rows = {(r.expected_delivery_date, r.actual_delivery_date) for r in V.supplier_po(spark, tmp_dir).collect()}
    lag = lambda o, n: (DAY + datetime.timedelta((o * 7 + n * 3 + 1) % 9)).strftime("%Y-%m-%d")
    assert ("1995-01-05", lag(1, 1)) in rows and ("1995-01-05", lag(9, 2)) in rows and (None, None) in rows
