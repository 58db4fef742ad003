"""Plan-shape regression tests: the scale properties stay in the plans that ran."""

import json
import os
import subprocess
import sys

import pytest

from tests.conftest import SF001
from tools.explain_plans import summarise

QUERIES = ["v08_roc_points", "v11_box_stats", "m05_unstratified_split", "s08_history_filter",
           "s10_forward_return", "e01_correlation_matrix", "c05_sector_median_impute"]


@pytest.mark.parametrize("name", QUERIES)
def test_no_keyless_or_sort_merge_joins(spark, name):
    from __spark_entry__ import queries
    df = queries()[name](spark, SF001)
    df.collect()  # the plan is then the one adaptive execution settled on
    ops = summarise(df)["ops"]
    assert ops["BroadcastNestedLoopJoin"] == 0 and ops["CartesianProduct"] == 0
    assert ops["SortMergeJoin"] == 0


def test_fixture_scans_are_pruned(spark):
    from sievekit.sources.fixtures import fundamentals
    scans = {t: set(c) for t, c, _ in summarise(fundamentals(spark, SF001))["scans"]}
    assert scans["lineitem"] == {"l_orderkey", "l_discount", "l_tax"}
    assert scans["orders"] == {"o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"}


def test_date_window_reaches_the_scan(spark):
    from sievekit.sources.fixtures import prices
    from sievekit.sources.prices import date_window
    scans = summarise(date_window(prices(spark, SF001), "1998-12-31"))["scans"]
    pushed = " ".join(f for t, _, f in scans if t == "orders")
    assert "o_orderdate" in pushed


def test_all_plans_that_a_query_runs():
    """Not only the last plan: statistic passes and barriers have no keyless join and no Python
    operator either, and read only some columns of the tables."""
    names = ["c13_clean_and_engineer", "m04_stratified_split", "v14_comparison_table"]
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, os.path.join(root, "tools", "explain_plans.py"), "--json", SF001, *names],
                         capture_output=True, text=True, timeout=300, check=True)
    result = json.loads(run.stdout.strip().splitlines()[-1])
    assert list(result) == names
    for r in result.values():
        assert r["executions"] > 1 and r["jobs"] >= r["executions"] and r["shuffle_mb"] > 0
        assert r["ops"].get("Exchange", 0) > 0 and r["spill_mb"] == 0
        for op in ("BroadcastNestedLoopJoin", "CartesianProduct", "SortMergeJoin", "BatchEvalPython", "ArrowEvalPython", "MapInArrow"):
            assert r["ops"].get(op, 0) == 0
        lineitem = [set(cols) for table, cols, _ in r["scans"] if table == "lineitem"]
        assert all(cols <= {"l_orderkey", "l_discount", "l_tax"} for cols in lineitem)
