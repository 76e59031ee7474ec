"""The queries that SQL can express, beside DuckDB, on whole tables."""

import pytest
from oracle_check import compare

from edge import SF_SMALL


@pytest.mark.parametrize("name", ["op3_secret_scan", "op4_odd_sketch", "op5_preference_chat", "op6_budget_mix",
                                  "op9_fuzzy_lines", "op11_merkle_descent", "op12_cover_anchors", "op13_four_russians"])
def test_query_matches_sql(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res[0] == "ok", res
