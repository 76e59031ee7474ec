"""Every registered query against its DuckDB SQL on the smallest scale factor."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle_check import compare
from shelfwise.queries import QUERIES, SUPPLIER_ROWS_A_FILE
from shelfwise.sources import testviews as V

from conftest import SF_CHECK, SF_SMALL

STREAMING = {n for n in QUERIES if n.startswith(("stream_", "stored_", "batch_ledger"))}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["batch_id", "product_id", "product_name", "store_id",
                          "units_sold", "total_revenue", "txn_count"]


def test_registry_has_oracles():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert set(QUERIES) <= set(sql)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMING))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res[0] in ("ok", "rows-only"), res


def test_streaming_queries_match_oracle(spark):
    res = compare(spark, SF_SMALL, sorted(STREAMING), verbose=False)
    assert all(v[0] == "ok" for v in res.values()), res


def test_supplier_files_grow_with_the_rows(spark):
    files = []
    for sf in (SF_SMALL, SF_CHECK):
        df = QUERIES["supplier_json_scan"](spark, sf)
        rows = [r["count"] for r in df.groupBy(F.input_file_name()).count().collect()]
        assert max(rows) <= 1.2 * SUPPLIER_ROWS_A_FILE
        files.append(len(rows))
    assert files[0] < files[1] <= 60_000 / SUPPLIER_ROWS_A_FILE + 2


@pytest.mark.parametrize("name", ["latest_delays", "supplier_delay_distinct"])
def test_no_batch_no_delays(spark, monkeypatch, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0
    pos = V.pos
    monkeypatch.setattr(V, "pos", lambda *a: pos(*a).limit(0))
    assert QUERIES[name](spark, SF_SMALL).count() == 0


def test_entry_without_a_package_of_the_text_operators():
    """The retail queries stay when something that only the text operators need can't be imported."""
    import os
    import subprocess
    import sys

    code = ("import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; q = e.queries();"
            " assert 'sales_aggregation' in q and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(entry.__file__))
