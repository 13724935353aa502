"""Every registered query against its SQL, and the shape of every physical plan."""

from __future__ import annotations

import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from tools.compare import connect, difference  # noqa: E402

from conftest import SF_DIR  # noqa: E402

UNSCALABLE = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "collect_list", "collect_set")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_matches_sql(spark, duck, name):
    assert difference(spark, duck, name, SF_DIR) == ""


def test_entry_point(spark):
    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n in entry.queries() if n[0] in "jwiau"])
def test_plans_have_no_unscalable_node(spark, name):
    """With broadcasts off, so that the shuffled plan is what is looked at."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert not [node for node in UNSCALABLE if node in plan]
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if re.search(r"\bWindow \[", line):
            assert not any("SinglePartition" in below for below in lines[i:i + 6]), "window in one partition"
