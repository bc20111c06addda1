"""The physical plans that make the operators scale."""

import re

import pytest

from tests.conftest import as_values, record
from vigilog.operators import parsing
from vigilog.plans import lookups, records, selection, statistics, streams, tables  # noqa: F401  (they register queries)
from vigilog.plans.registry import QUERIES


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    names = ["dedup_first", "priority_sample", "rate_limit", "stats_grouping_sets", "count_by_severity", "recent_events",
             "page_events", "retain_last_n", "login_attempt_number", "correlated_pairs", "session_gaps",
             "session_lookup", "correlation_chains", "events_per_minute", "high_severity_metrics", "validate_events"]
    return {n: plan_of(QUERIES[n](spark, sf_dir)) for n in names}


@pytest.mark.parametrize("name", ["dedup_first", "priority_sample", "rate_limit"])
def test_ranks_are_cut_before_the_shuffle(plans, name):
    below = plans[name].split("Exchange hashpartitioning")[-1]
    assert "WindowGroupLimit" in below and "Partial" in below
    assert plans[name].count("Exchange hashpartitioning") == 1


def test_events_are_combined_before_the_expansion(plans):
    above, below = plans["stats_grouping_sets"].split("Expand", 1)
    assert "partial_count(1)" in below and "partial_count(1)" not in above


@pytest.mark.parametrize("name", ["recent_events", "page_events", "retain_last_n"])
def test_top_rows_need_no_full_sort(plans, name):
    assert "TakeOrderedAndProject" in plans[name] and "rangepartitioning" not in plans[name]


@pytest.mark.parametrize("name,key,bucketed", [
    ("login_attempt_number", "user_id", 2), ("correlated_pairs", "correlation_id", 2), ("session_gaps", "user_id", 1)])
def test_rows_are_shuffled_by_bucket_and_whole_groups_only_aggregated(plans, name, key, bucketed):
    lines = plans[name].splitlines()
    by_key = [i for i, line in enumerate(lines) if re.search(rf"Exchange hashpartitioning\({key}#\d+, \d+\)", line)]
    for i in by_key:
        below = "".join(lines[i + 1:i + 3])
        assert "Aggregate" in below, below
    assert len(re.findall(rf"hashpartitioning\({key}#\d+, _bucket#\d+L", plans[name])) == bucketed


def test_only_bounded_sides_are_broadcast_by_hint(spark, sf_dir):
    """With automatic broadcasts off, only the hot keys and their lookup rows are broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lookup = plan_of(QUERIES["session_lookup"](spark, sf_dir))
        enrich = plan_of(QUERIES["enrich_user"](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in enrich and "SortMergeJoin" in enrich
    assert lookup.count("SortMergeJoin") == 1


@pytest.mark.parametrize("name,columns", [
    ("count_by_severity", "event_id:bigint,user_id:bigint"),
    ("events_per_minute", "event_id:bigint,ts:timestamp_ntz,user_id:bigint"),
    ("high_severity_metrics", "event_id:bigint,user_id:bigint")])
def test_scans_read_only_what_is_needed(plans, name, columns):
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plans[name]) == [columns]


def test_filters_reach_the_scan(spark, sf_dir):
    e = tables.sec_events(spark, sf_dir).filter("event_id > 990").select("event_id", "user_id")
    assert "GreaterThan(event_id,990)" in plan_of(e)


def test_a_record_is_parsed_once(spark, sf_dir):
    parsed = parsing.good_records(parsing.parse_value(as_values(spark, [record(0)])))
    assert plan_of(parsed.select("event_id", "severity")).count("from_json(") == 1
    plan = plan_of(QUERIES["parse_json"](spark, sf_dir))
    assert plan.count("from_json(") == 1 and plan.count("StructsToJsonEvaluator(Map(ignoreNullFields") == 1


def test_checks_are_counted_in_one_pass(plans):
    assert len(re.findall(r"FileScan parquet [^\n]*events.parquet", plans["validate_events"])) == 1


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_cross_joins_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas", "BatchEvalPython"):
        assert word not in plan
