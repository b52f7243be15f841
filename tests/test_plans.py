"""What the physical plans must and must not contain."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as driver
from tidemill.operators.neighbors import positions
from tidemill.operators.visitors import MODES
from tidemill.plans import inputs as I

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="the driver's tables are not here")


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "keyword_window_count", "keyword_lateral", "visitor_repair", "log_split", "cdc_route", "cdc_upsert_latest", "iqr_remove",
    "value_shares", "crosstab_columns", "corr_matrix", "describe_object", "longest_run", "null_counts"])
def test_no_cross_join_and_no_row_python(spark, name):
    plan = _plan(driver.queries()[name](spark, DATA))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert banned not in plan


def test_flagship_reads_only_what_it_needs(spark):
    plan = _plan(driver.queries()["keyword_window_count"](spark, DATA))
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    assert schemas == {"event_id:bigint,ts:timestamp_ntz,event_type:string", "p_partkey:bigint,p_name:string", ""}
    assert "Not(EqualTo(event_type,signup))" in plan
    assert "partial_count(1)" in plan


def test_logs_are_parsed_once_per_scan(spark):
    plan = _plan(driver.queries()["log_page"](spark, DATA))
    assert plan.count("parseJson") == 1
    routed = _plan(driver.queries()["cdc_route"](spark, DATA))
    assert len(re.findall(r"from_json\(StructField\(before", routed)) == 1


def test_copies_are_limited_before_the_shuffle(spark):
    plan = _plan(positions(I.policies(spark, DATA), "id", ["premium", "balance"], 5))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


@pytest.mark.parametrize("name", ["visitor_repair", "visitor_repair_documented", "log_split"])
def test_the_repair_parses_once_and_sorts_no_log(spark, name):
    plan = _plan(driver.queries()[name](spark, DATA))
    assert plan.count("parseJson") == 1
    assert "SortAggregate" not in plan


@pytest.mark.parametrize("mode", MODES)
def test_the_repairs_aggregates_use_hash_tables(spark, monkeypatch, mode):
    plans, checkpoint = [], type(spark.range(1)).checkpoint
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", lambda frame, *a, **k: plans.append(_plan(frame)) or checkpoint(frame, *a, **k))
    driver.queries()["visitor_repair" if mode == "as_written" else "visitor_repair_documented"](spark, DATA)
    assert sum("HashAggregate" in p for p in plans) >= 1
    assert not any("SortAggregate" in p for p in plans)
    assert sum(p.count("parseJson") for p in plans) == 1


@pytest.mark.parametrize("name", ["value_shares", "crosstab_columns", "crosstab_sorted"])
def test_counts_used_twice_are_evaluated_once(spark, name):
    assert "FileScan" not in _plan(driver.queries()[name](spark, DATA))
